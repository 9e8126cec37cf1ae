"""Filtered dashboards from stored cuboids (K13, with country and date): a lattice of roll-ups.

A page filter may name any of ``DIMS`` and a chart groups by some of them. The marts have neither country and date
together nor measures that add up after a filter, so filters on them need sums of their own: additive measures (sessions,
stages, conversions, revenue, cost, as integers) by every subset of the dimensions. Sessions are aggregated once, to the
finest cuboid; each coarser one is rolled up from the stored cuboid one dimension finer, so no row is copied for the
grouping sets (no Expand) and the session rows are read once. Cuboids are stored in one table partitioned by
``grouping_id`` (as GROUPING SETS number them: the bit of a dimension is set if it is rolled up).

A query reads the one cuboid whose dimensions are those it groups by or filters: a partition filter, with the page's
filters pushed into the Parquet scan. A filter on a NULL dimension (NULL country) is a value like any other
(``None``). Distinct visitors don't add up and have bitmaps (operators/distinct_visitors.py).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.channels import channel_grouping
from ..functions.numeric import flag, long_lit, round_to, safe_div, usd_from_micros
from ..functions.scores import reached_conversion, reached_deep_engagement, reached_engagement
from .campaign import PAID_SEARCH_COST_PER_SESSION, PAID_SOCIAL_COST_PER_SESSION

DIMS = ["channel_grouping", "traffic_source", "device_category", "country", "session_date"]
MEASURES = ["sessions", "conversions", "bounces", "sessions_engagement", "sessions_deep_engagement", "revenue_micros", "cost_cents", "paid_sessions"]


def grouping_id(dims) -> int:
    """The number of the cuboid with ``dims``: a bit for each dimension that is rolled up, the first one the highest."""
    unknown = set(dims) - set(DIMS)
    if unknown:
        raise ValueError(f"no such dimension: {sorted(unknown)}")
    return sum(1 << (len(DIMS) - 1 - i) for i, d in enumerate(DIMS) if d not in dims)


def finest(stg: DataFrame) -> DataFrame:
    """The sessions' additive measures by all dimensions; the only step that reads sessions."""
    rows = stg.select(
        channel_grouping(full=True).alias("channel_grouping"), *DIMS[1:], "is_bounced", "is_converted",
        reached_engagement().alias("e"), reached_deep_engagement().alias("d"), reached_conversion().alias("c"),
        (F.col("traffic_medium") == "cpc").alias("cpc"), F.coalesce("transaction_revenue_micros", long_lit(0)).alias("rev"))
    search, social = F.col("channel_grouping") == "Paid Search", (F.col("channel_grouping") == "Social") & F.col("cpc")
    cents = F.when(search, long_lit(round(100 * PAID_SEARCH_COST_PER_SESSION))).when(social, long_lit(round(100 * PAID_SOCIAL_COST_PER_SESSION)))
    return rows.groupBy(*DIMS).agg(
        F.count(F.lit(1)).alias("sessions"), F.sum("c").alias("conversions"), F.sum("is_bounced").alias("bounces"),
        F.sum("e").alias("sessions_engagement"), F.sum("d").alias("sessions_deep_engagement"), F.sum("rev").alias("revenue_micros"),
        F.sum(F.coalesce(cents, long_lit(0))).alias("cost_cents"), F.sum(flag(search | social)).alias("paid_sessions"))


def parent(dims: tuple[str, ...]) -> tuple[str, ...]:
    """The next finer cuboid that a cuboid is rolled up from: with the first dimension that it lacks."""
    missing = next(d for d in DIMS if d not in dims)
    return tuple(d for d in DIMS if d in dims or d == missing)


def build_cuboids(stg: DataFrame, path: str) -> DataFrame:
    """Write all cuboids under ``path``, level by level (one write each), and return the stored table."""
    spark = stg.sparkSession
    level = {tuple(DIMS): finest(stg)}
    for size in range(len(DIMS), -1, -1):
        stored = None
        for dims, rows in level.items():
            whole = rows.select(F.lit(grouping_id(dims)).alias("grouping_id"), *[
                F.col(d) if d in dims else F.lit(None).cast("date" if d == "session_date" else "string").alias(d) for d in DIMS], *MEASURES)
            stored = whole if stored is None else stored.unionByName(whole)
        stored.write.mode("overwrite" if size == len(DIMS) else "append").partitionBy("grouping_id").parquet(path)
        if size:
            finer = read_cuboids(spark, path)  # lists the directories written so far
            coarser = {tuple(d for d in dims if d != out) for dims in level for out in dims}
            level = {dims: finer.where(F.col("grouping_id") == str(grouping_id(parent(dims)))).groupBy(*dims).agg(*[F.sum(m).alias(m) for m in MEASURES])
                     for dims in sorted(coarser)}
            # the roll-up to no dimension of no rows would be one row of NULLs
            level = {dims: rows if dims else rows.where("sessions is not null") for dims, rows in level.items()}
    return read_cuboids(spark, path)


def read_cuboids(spark: SparkSession, path: str) -> DataFrame:
    dims = ", ".join(f"{d} {'date' if d == 'session_date' else 'string'}" for d in DIMS)
    return spark.read.schema(f"{dims}, {', '.join(f'{m} bigint' for m in MEASURES)}, grouping_id string").parquet(path)


def _filter(df: DataFrame, filters: dict) -> DataFrame:
    """Page filters: a value, a list of values, or a pair ("between", low, high); ``None`` is the value NULL."""
    for column, wanted in filters.items():
        if isinstance(wanted, tuple) and len(wanted) == 3 and wanted[0] == "between":
            df = df.where(F.col(column).between(F.lit(wanted[1]), F.lit(wanted[2])))
            continue
        values = list(wanted) if isinstance(wanted, (list, set)) else [wanted]
        given = [v for v in values if v is not None]
        cond = F.col(column).isin(given) if given else F.lit(False)
        df = df.where(cond | F.col(column).isNull() if None in values else cond)
    return df


def slice_of(cuboids: DataFrame, by: list[str], filters: dict | None = None) -> DataFrame:
    """Sums of the measures by ``by`` under page filters, from the one cuboid that has just these dimensions."""
    filters = filters or {}
    rows = cuboids.where(F.col("grouping_id") == str(grouping_id({*by, *filters})))
    # no sessions at all are 0 where there is nothing to group by
    return _filter(rows, filters).groupBy(*by).agg(*[F.coalesce(F.sum(m), long_lit(0)).alias(m) for m in MEASURES])


def kpis(cuboids: DataFrame, by: list[str], filters: dict | None = None) -> DataFrame:
    """K1-K4 under page filters: sessions, conversions, rates, revenue, cost and pooled ROAS by ``by``."""
    g = slice_of(cuboids, by, filters)
    revenue, cost = usd_from_micros("revenue_micros"), F.col("cost_cents").cast("double") / 100.0
    return g.select(*by, "sessions", "conversions", "bounces",
                    round_to(safe_div("conversions", "sessions") * 100, 2).alias("conversion_rate_pct"),
                    round_to(safe_div("bounces", "sessions") * 100, 2).alias("bounce_rate_pct"),
                    round_to(revenue, 2).alias("total_revenue"), round_to(F.try_divide(revenue, F.col("sessions").cast("double")), 2).alias("revenue_per_session"),
                    cost.alias("estimated_cost"), "paid_sessions",
                    F.when(F.col("cost_cents") > 0, round_to(F.try_divide(revenue, cost), 2)).alias("pooled_roas"))


def funnel(cuboids: DataFrame, by: list[str], filters: dict | None = None) -> DataFrame:
    """K9-K11 under page filters: stage counts and rates by ``by``."""
    return slice_of(cuboids, by, filters).select(
        *by, F.col("sessions").alias("sessions_landing"), "sessions_engagement", "sessions_deep_engagement", F.col("conversions").alias("sessions_conversion"),
        round_to(safe_div("conversions", "sessions") * 100, 2).alias("overall_conversion_rate_pct"),
        round_to(safe_div("sessions_engagement", "sessions") * 100, 2).alias("landing_to_engagement_pct"),
        round_to(safe_div("sessions_deep_engagement", "sessions_engagement") * 100, 2).alias("engagement_to_deep_pct"),
        round_to(safe_div("conversions", "sessions_deep_engagement") * 100, 2).alias("deep_to_conversion_pct"))
