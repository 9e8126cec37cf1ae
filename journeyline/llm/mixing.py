"""Operator 3: mix sources to target weights by systematic sampling.

Sources are weighted 5, 2, 1, 5, 2, 1, ... by code point order, null last, and share the size of all documents (words
``[^\\x20\\x09-\\x0D]+``). A target stops at MOST times its source's size; the excess goes to the others by weight until
none is above. Every document of a source has target / size expected copies. Its documents stand in the order of
(size, doc_id), so that each stretch of the prefix sum of expected copies holds documents of like size; one offset
per source in [0, 1) is added, and a document is emitted once for every integer that its stretch of the sum crosses, at
most MOST times. The offset is the one of OFFSETS evenly spaced ones, starting at the source's md5, whose words come nearest
to the target: with the first alone a source of 50 documents missed it by up to 19 %. The documents of one size are
emitted floor(sum after them) - floor(sum before them) times, so the counts by (source, size) tell the words of every
offset. Nothing is drawn at random at run time, so reruns agree.

Ranks come from one range-partitioned sort of the counts of equal rows (source, size, doc_id, text's hash): the rows of a
source in earlier partitions, then a window over its rows of one partition, so sparse, missing and equal ids or a source
that holds most rows cross many tasks. Joins are by (source, size, doc_id, hash), never by source alone. The table of
sources is one row each and is ordered in one task.

Null texts have size 0; a source whose size is 0 has target 0 and no copies; null doc_ids come last in their size, by hash;
repeated rows are separate documents, in any order among themselves. Other columns are kept as they are by ``mix``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from journeyline.llm import scratch

WEIGHTS = (5, 2, 1)
MOST = 3
OFFSETS = 32
WORD = "[^\\x20\\x09-\\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, n_docs) -> with target and offset; one row per source."""
    order = W.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), ((F.row_number().over(order) - 1) % len(WEIGHTS) + 1).cast("int"))
    every = W.partitionBy()
    # by the factor at which a source reaches its limit: those before the first that doesn't reach it are full
    fill = W.orderBy((MOST * F.col("source_size") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(W.unboundedPreceding, -1)
    share = (F.sum("source_size").over(every) - F.coalesce(F.sum(MOST * F.col("source_size")).over(before), F.lit(0))).cast("double") / (
        F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    level = (sizes.withColumn("weight", weight.cast("long")).withColumn("share", share)
             .withColumn("fits", F.col("weight") * F.col("share") <= MOST * F.col("source_size")))
    factor = F.min(F.when(F.col("fits"), F.struct((MOST * F.col("source_size") / F.col("weight")).alias("at"), F.col("share").alias("share")))).over(every)["share"]
    full = (MOST * F.col("source_size")).cast("double")
    target = F.when(factor.isNull(), full).otherwise(F.least(full, F.col("weight") * factor))
    digits = F.substring(F.md5(F.coalesce(F.concat(F.lit("source:"), "source"), F.lit("no source")).cast("binary")), 1, 8)
    return level.select("source", "source_size", "n_docs", target.alias("target"),
                        (F.conv(digits, 16, 10).cast("long") / F.lit(4294967296.0)).alias("offset"))


def _crossed(after: Column, before: Column, offset: Column) -> Column:
    """Integers crossed between two places of a source."""
    return (F.floor(after * F.col("each") + offset) - F.floor(before * F.col("each") + offset)).cast("long")


def _nearest(by_size: DataFrame) -> DataFrame:
    """(src, chosen): each source's offset; OFFSETS sums for each source, from counts by size."""
    def turned(k: int) -> Column:
        x = F.col("offset") + F.lit(k / OFFSETS)
        return F.when(x >= 1, x - 1).otherwise(x)

    sums = by_size.groupBy("src").agg(F.first("target").alias("target"), F.first("offset").alias("offset"), *[
        F.sum(_crossed(F.col("below") + F.col("n"), F.col("below"), turned(k)) * F.col("size")).alias(f"t{k}") for k in range(OFFSETS)])
    best = F.array_min(F.array(*[F.struct(F.abs(F.col(f"t{k}") - F.col("target")).alias("off"), F.lit(k).alias("k"), turned(k).alias("at"))
                                 for k in range(OFFSETS)]))
    return sums.select("src", best["at"].alias("chosen"))


def _placed(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """``rows`` with the columns of ``_sized`` -> also copies; ``sizes``: these columns of the same rows."""
    order = [F.col("src").asc(), F.col("size").asc(), F.col("doc_id").asc_nulls_last(), F.col("spread").asc()]
    parts = int(sizes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    alike = sizes.groupBy("src", "size", "doc_id", "spread").agg(F.count(F.lit(1)).alias("n"), F.first("source").alias("source"))
    alike = scratch.save(alike.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()), "alike")  # narrow counts, read by all that follows
    runs = alike.groupBy("src", "part").agg(F.sum("n").alias("n"))  # partitions + sources rows
    runs = runs.select("src", "part", (F.sum("n").over(W.partitionBy("src").orderBy("part")) - F.col("n")).alias("before"))
    by_size = alike.groupBy("src", "size").agg(F.sum("n").alias("n"), F.first("source").alias("source"))
    by_source = by_size.groupBy("src").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("n_docs"), F.first("source").alias("source"))
    by_source = targets(by_source.drop("src")).select(_src(F.col("source")).alias("src"), "source_size", "target", "offset")
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    by_size = (by_size.drop("source").withColumn("below", F.sum("n").over(W.partitionBy("src").orderBy("size")) - F.col("n"))
               .join(by_source, "src").withColumn("each", each))
    runs = runs.join(by_source.withColumn("each", each).join(_nearest(by_size), "src"), "src")
    earlier = W.partitionBy("src", "part").orderBy(*order[1:]).rowsBetween(W.unboundedPreceding, -1)
    starts = (alike.withColumn("within", F.coalesce(F.sum("n").over(earlier), F.lit(0))).join(runs, ["src", "part"])
              .select("src", "size", _key(), "spread", (F.col("before") + F.col("within")).alias("start"), "source_size", "target", "each", "chosen"))
    rank = F.row_number().over(W.partitionBy("src", "size", "key", "spread").orderBy(F.lit(1)))
    place = F.col("start") + F.col("rank")
    return (rows.withColumn("key", _key()).withColumn("rank", rank).join(starts, ["src", "size", "key", "spread"])
            .withColumn("copies", F.least(_crossed(place, place - 1, F.col("chosen")), F.lit(MOST).cast("long"))))


def _key() -> Column:
    """doc_id as a join key that null ids have, too."""
    return F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce(F.col("doc_id"), F.lit(0)).alias("id")).alias("key")


def _src(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> list[Column]:
    doc_id, source = F.col(id_col).cast("long"), F.col(source_col).cast("string")
    spread = F.xxhash64(doc_id, F.col(text_col))
    return [doc_id.alias("doc_id"), source.alias("source"), _src(source).alias("src"), word_count(F.col(text_col)).alias("size"), spread.alias("spread")]


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken for every row."""
    rows = scratch.save(docs.select(*_sized(docs, id_col, text_col, source_col)), "sizes")
    return (_placed(rows, rows).withColumn("taken", F.col("copies") * F.col("size"))
            .select("doc_id", "source", "size", "source_size", "target", "copies", "taken"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of ``docs``, all columns, each as often as the plan takes it."""
    sized = _sized(docs, id_col, text_col, source_col)
    rows = docs.select(*sized, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    taken = _placed(rows, docs.select(*sized)).where("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy")).select("row.*")
