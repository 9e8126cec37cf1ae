"""Positions, totals and ranks per key that stay parallel when one key holds a third of all rows.

``row_number() OVER (PARTITION BY visitor ORDER BY start)`` puts every row of a visitor in one task, and so does a
join on the visitor. Here rows are dealt by (key, bucket) instead, and only one row for each (key, bucket) is dealt by
the key alone:

1. rows are aggregated by (key, bucket), with partial aggregates before the shuffle;
2. a window over each key's few bucket rows gives running sums (the rows in earlier buckets) and totals;
3. these go back to the rows by a join on (key, bucket).

There is one plan for every size and every distribution: nothing is asked of the data first, nothing is checkpointed and
nothing is broadcast by hint. A key with few rows has at most as many bucket rows as rows.

* ``sequence_within`` buckets by hours of the start time (order preserving), so one task holds at most one hour of one
  key: position = rows in earlier hours + position in the hour.
* ``running_within`` adds running sums in that order, or against it, in the same way.
* ``totals_within`` needs no order and buckets by a hash (``SALTS`` buckets a key).
* ``ntiles`` ranks all rows by several measures at once: cells of near values, the values of a cell, the prefixes of the
  tie breaker within a value, and positions within a prefix take the place of the bucket.

NULL is a key like any other (as in PARTITION BY).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import idiv, long_lit

#: Buckets that a key's rows are spread over where their order doesn't matter.
SALTS = 4096
HOUR = 3600
#: Bits of a measure that name its cell besides the length: 64 lengths x 2^10 cells at most.
CELL_BITS = 10
#: Characters of the tie breaker that split the rows of one value.
PREFIX = 4

#: How an aggregate of (key, bucket) rows combines over the buckets of a key.
_AGGREGATES = {"sum": F.sum, "min": F.min, "max": F.max}


_BY = ["_no_key", "_key", "_bucket"]


def _dealt(df: DataFrame, key: str, bucket: Column) -> DataFrame:
    """``df`` with the columns by which its rows are dealt, none of them NULL: so the windows, the aggregation and the join share
    one exchange (an ``<=>`` join would deal the rows by expressions of its own, a second time)."""
    return df.withColumns({"_no_key": F.col(key).isNull(), "_key": F.coalesce(F.col(key).cast("string"), F.lit("")), "_bucket": bucket})


def _by_time(df: DataFrame, key: str, start: str, bucket_seconds: int) -> DataFrame:
    """Rows dealt by key and time bucket; rows that a step before has dealt so (``keep``) stay where they are."""
    if all(c in df.columns for c in _BY):
        return df
    hour = F.floor(F.unix_micros(start) / (bucket_seconds * 1_000_000))
    return _dealt(df, key, F.coalesce(hour, long_lit(-2 ** 62)))  # a NULL start comes first


def sequence_within(df: DataFrame, key: str, start: str, order_cols: list[str], seq_col: str = "seq", count_col: str = "n",
                    key_aggs: dict[str, tuple[str, Column]] | None = None, bucket_seconds: int = HOUR, keep: bool = False) -> DataFrame:
    """Add ``seq_col`` (1-based position of the row in its key, by ``start`` and then ``order_cols``), ``count_col`` (rows of
    the key) and one column for each ``key_aggs`` entry: ``name: ("sum" | "min" | "max", expression over the rows)``.
    ``keep`` leaves the columns by which rows are dealt, for a further step with the same key and order."""
    aggs = dict(key_aggs or {})
    rows = _by_time(df, key, start, bucket_seconds)
    buckets = rows.groupBy(*_BY).agg(F.count(F.lit(1)).alias("_rows"),
                                     *[_AGGREGATES[kind](expr).alias(name) for name, (kind, expr) in aggs.items()])
    by_key = Window.partitionBy(*_BY[:2])
    earlier = by_key.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.select(*_BY, F.coalesce(F.sum("_rows").over(earlier), long_lit(0)).alias("_before"),
                             F.sum("_rows").over(by_key).alias(count_col),
                             *[_AGGREGATES[kind](name).over(by_key).alias(name) for name, (kind, _) in aggs.items()])
    place = F.row_number().over(Window.partitionBy(*_BY).orderBy(start, *order_cols)).cast("bigint")
    placed = rows.withColumn("_place", place).join(buckets, _BY)
    kept = [c for c in _BY if keep and c not in df.columns]
    return placed.select(*df.columns, (F.col("_before") + F.col("_place")).alias(seq_col), count_col, *aggs, *kept)


def running_within(df: DataFrame, key: str, start: str, order_cols: list[str], sums: dict[str, Column], reverse: bool = False,
                   bucket_seconds: int = HOUR, keep: bool = False) -> DataFrame:
    """Add running sums (name: expression, NULL counts as nothing) over the key's rows up to and with the row, by ``start`` and
    then ``order_cols``; with ``reverse`` over the row and those after it. ``order_cols`` must tell a key's rows apart."""
    rows = _by_time(df, key, start, bucket_seconds)
    buckets = rows.groupBy(*_BY).agg(*[F.sum(expr).alias(name) for name, expr in sums.items()])
    turn = (lambda c: F.col(c).desc()) if reverse else (lambda c: F.col(c).asc())
    past = Window.partitionBy(*_BY[:2]).orderBy(turn("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.select(*_BY, *[F.sum(name).over(past).alias(f"_past_{name}") for name in sums])
    here = Window.partitionBy(*_BY).orderBy(*[turn(c) for c in (start, *order_cols)]).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = rows.withColumns({f"_here_{name}": F.sum(expr).over(here) for name, expr in sums.items()}).join(buckets, _BY)
    kept = [c for c in _BY if keep and c not in df.columns]
    own = [c for c in df.columns if keep or c not in _BY]
    return placed.select(*own, *[(F.coalesce(f"_past_{n}", F.lit(0)) + F.coalesce(f"_here_{n}", F.lit(0))).alias(n) for n in sums], *kept)


def totals_within(df: DataFrame, key: str, spread: Column, aggs: dict[str, tuple[str, Column]],
                  distinct: dict[str, str] | None = None) -> DataFrame:
    """Add totals over all rows of the row's ``key``: ``aggs`` as in ``sequence_within``, and for each ``distinct`` entry
    (name: column) the number of its distinct values, NULL not counted.

    Rows are dealt by a hash of ``spread``; rows with one value of a ``distinct`` column must have one ``spread``, so that
    the counts of a key's buckets add up."""
    distinct = distinct or {}
    rows, by = _dealt(df, key, F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int")), _BY
    partial = [_AGGREGATES[kind](expr).alias(name) for name, (kind, expr) in aggs.items()]
    again = [_AGGREGATES[kind](name).alias(name) for name, (kind, _) in aggs.items()]
    if distinct:  # one row for each value first
        buckets = rows.groupBy(*by, *distinct.values()).agg(*partial)
        buckets = buckets.groupBy(*by).agg(*again, *[F.count(c).alias(name) for name, c in distinct.items()])
    else:
        buckets = rows.groupBy(*by).agg(*partial)
    by_key = Window.partitionBy(*by[:2])
    kinds = {**{name: kind for name, (kind, _) in aggs.items()}, **{name: "sum" for name in distinct}}
    buckets = buckets.select(*by, *[_AGGREGATES[kind](name).over(by_key).alias(name) for name, kind in kinds.items()])
    return rows.join(buckets, by).select(*df.columns, *kinds)


def _cell(value: str) -> Column:
    """A coarse number of the bigint ``value`` that keeps its order: its sign, its length in bits and its leading bits."""
    v = F.col(value)
    size = F.abs(v)  # ids and money stay far below 2^62
    length = F.when(size == 0, F.lit(0)).otherwise(F.length(F.bin(size)))
    shift = F.greatest(length - CELL_BITS, F.lit(0))
    cell = length.cast("long") * (1 << CELL_BITS) + F.call_function("shiftright", size, shift)
    return F.when(v < 0, -cell).otherwise(cell)


def _ntile_of(rank: Column, n: Column, buckets: int) -> Column:
    """NTILE from a 1-based rank among ``n``: the first ``n % buckets`` tiles have one row more than the others."""
    size, larger = idiv(n, buckets), n % buckets
    among_larger = larger * (size + 1)
    return F.when(rank <= among_larger, idiv(rank - 1, size + 1) + 1).otherwise(
        larger + idiv(rank - among_larger - 1, F.greatest(size, long_lit(1))) + 1).cast("bigint")


def ntiles(df: DataFrame, identity: str, measures: dict[str, Column], buckets: int) -> DataFrame:
    """``identity`` and, for each measure (name: ascending bigint expression), ``NTILE(buckets) OVER (ORDER BY measure,
    identity)``, of a table with one row for each ``identity`` (a string, not NULL).

    A row's rank is the number of rows in smaller cells, of smaller values in its cell, of its value with a smaller
    prefix of the identity, and its position among the rest. Counts by (value, prefix) come first; the windows run over
    those, by measure over at most 2^17 cells and by cell and by value over what belongs to it."""
    long = df.select(identity, F.explode(F.array(*[F.struct(F.lit(name).alias("measure"), expr.cast("bigint").alias("value"))
                                                   for name, expr in measures.items()])).alias("_m"))
    long = long.select(identity, "_m.measure", "_m.value", F.substring(identity, 1, PREFIX).alias("_prefix"))
    keys = ["measure", "value", "_prefix"]
    counts = long.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))

    def before(rows: DataFrame, by: list[str], order: str, name: str) -> DataFrame:
        w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return rows.withColumn(name, F.coalesce(F.sum("_rows").over(w), long_lit(0)))

    values = counts.groupBy("measure", "value").agg(F.sum("_rows").alias("_rows")).withColumn("_cell", _cell("value"))
    cells = before(values.groupBy("measure", "_cell").agg(F.sum("_rows").alias("_rows")), ["measure"], "_cell", "_in_cells")
    cells = cells.withColumn("_n", F.sum("_rows").over(Window.partitionBy("measure"))).drop("_rows")
    values = before(values, ["measure", "_cell"], "value", "_in_values").drop("_rows").join(cells, ["measure", "_cell"])
    offsets = before(counts, ["measure", "value"], "_prefix", "_in_prefixes").drop("_rows").join(values, ["measure", "value"])
    offsets = offsets.select(*keys, (F.col("_in_cells") + F.col("_in_values") + F.col("_in_prefixes")).alias("_before"), "_n")
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(identity))
    ranked = long.withColumn("_place", place).join(offsets, keys)
    tile = _ntile_of(F.col("_before") + F.col("_place"), F.col("_n"), buckets)
    ranked = ranked.select(identity, "measure", tile.alias("_tile"))
    return ranked.groupBy(identity).agg(*[F.max(F.when(F.col("measure") == name, F.col("_tile"))).alias(name) for name in measures])
