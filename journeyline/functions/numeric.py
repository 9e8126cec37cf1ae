"""Small arithmetic helpers built from Spark's own expressions (all JVM side)."""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

MICROS_PER_USD = 1_000_000.0
NANOS_PER_USD = 1_000_000_000.0


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def idiv(a, b) -> Column:
    """Integral division (Spark's ``div``), exact on bigint."""
    return F.call_function("div", col(a), b if isinstance(b, Column) else F.lit(b))


def exact(c) -> Column:
    """The integer as DECIMAL(38,0): products and sums of it have no 64-bit bound."""
    return col(c).cast("decimal(38,0)")


def share_of(amount, parts, scale: int) -> Column:
    """``amount * scale / parts`` rounded half up, exact for every bigint amount (DECIMAL(38,0)).

    Whole parts are scaled as a decimal; only the remainder (less than ``parts``) is scaled in 64 bits."""
    a, n = col(amount), parts if isinstance(parts, Column) else F.lit(parts).cast("bigint")
    whole = (idiv(a, n).cast("decimal(19,0)") * F.lit(scale).cast("decimal(18,0)")).cast("decimal(38,0)")
    rest = idiv((a % n) * (2 * scale) + n, n * 2)
    return (whole + rest.cast("decimal(19,0)")).cast("decimal(38,0)")


def safe_div(a, b) -> Column:
    """NULL instead of an error when the divisor is 0 or NULL; always double."""
    return F.try_divide(col(a).cast("double"), col(b).cast("double"))


def round_to(x, places: int) -> Column:
    """HALF_UP rounding on the decimal value of a double (the warehouse ROUND)."""
    return F.round(col(x), places)


def long_lit(v: int) -> Column:
    return F.lit(v).cast("bigint")


def flag(cond: Column) -> Column:
    """1/0 bigint flag; NULL conditions count as 0 (CASE WHEN ... THEN 1 ELSE 0)."""
    return F.when(cond, long_lit(1)).otherwise(long_lit(0))


def usd_from_micros(micros) -> Column:
    """Exact bigint/decimal micros -> double dollars with a single division."""
    return col(micros).cast("double") / F.lit(MICROS_PER_USD)


def usd_from_nanos(nanos) -> Column:
    return col(nanos).cast("double") / F.lit(NANOS_PER_USD)


def scaled_int(c, places: int) -> Column:
    """A double already rounded to ``places`` decimals, as an exact integer count of units."""
    return F.round(col(c) * float(10 ** places)).cast("bigint")


def sum_rounded(c, places: int = 2) -> Column:
    """Exact SUM of values already rounded to ``places`` decimals (double result)."""
    return F.sum(scaled_int(c, places)).cast("double") / F.lit(float(10 ** places))


def avg_rounded(c, places: int = 2) -> Column:
    """Exact AVG of values already rounded to ``places`` decimals; NULLs skipped."""
    return F.try_divide(F.sum(scaled_int(c, places)).cast("double"),
                        F.count(col(c)).cast("double") * float(10 ** places))


def sum_usd(c) -> Column:
    """Exact SUM of dollar amounts (doubles holding whole micros)."""
    return F.sum(F.round(col(c) * MICROS_PER_USD).cast("bigint")).cast("double") / F.lit(MICROS_PER_USD)


def share_pct(c, places: int = 2) -> Column:
    """Percentage of the column's total. The window spans all rows, so apply it only to an
    already aggregated result with a handful of rows (a few groups), never to detail rows."""
    return round_to(safe_div(col(c) * 100, F.sum(col(c)).over(Window.partitionBy())), places)
