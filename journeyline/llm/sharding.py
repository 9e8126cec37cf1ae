"""Operator 6: shards balanced in bytes, tokens and rows by vector bin packing.

Documents with equal texts form a group, and groups are gathered in packets: a group's packet is its text's hash
modulo PACKETS, which bounds what the driver places. A group heavier than 1 / HEAVY of the whole in any of the three
dimensions (there are at most 3 * HEAVY such groups) is a packet of its own, whole where it fits in a shard: only a group
above a shard's capacity, the mean, in some dimension is split, by doc_id hash in as few parts as capacities hold, so one
text that a third of all documents share can't overfill a shard. If one doc_id, or none, has more than 1 / HEAVY of all rows
in such a group (there are at most HEAVY such pairs), its rows, which nothing tells apart, are spread by a stored row key. Packets are placed from the heaviest down, by
their largest share in a dimension, each in the shard where the dot product of its vector with the shards' residual capacities is highest; capacities
are the means, so a shard that is ahead in one dimension attracts packets that are heavy in the others. Only shards count
that the packet leaves at or below the level of bytes to which the packets still to come can fill all others; where
there is none, the packet goes to the shard with the fewest bytes. So bytes come out level (law ``bytes``), and all
packets are placed by all three dimensions.

Slots count from 0 in a shard without gaps: packets in the order of placement, blocks of rows by hash within a packet,
rows by doc_id within a block. A heavy packet has so many more blocks that none holds more than in a light one.

Null texts have no bytes, size 1 and one common group, with the CRC of no bytes (0); null doc_ids sort last; repeated
rows take a slot each. No rows in give no rows out; ``shard`` keeps all other columns.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from journeyline.llm import scratch
from journeyline.llm.mixing import word_count

SHARDS = 16
PACKETS = 4096
HEAVY = 1024
BLOCKS = 64


def place(weights: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each packet; ``weights`` is (packets, 3) and already ordered from the heaviest down."""
    total = weights.sum(axis=0)
    scale = np.where(total > 0, total, 1) / shards
    unit = weights / scale
    residual = np.ones((shards, weights.shape[1]))
    where = np.zeros(len(unit), np.int64)
    held, left = np.zeros(shards), unit[:, 0].sum()
    for i, w in enumerate(unit):
        level = ((left + np.cumsum(np.sort(held))) / np.arange(1, shards + 1)).min()
        fits = held + w[0] <= level + 1e-9
        best = np.where(fits, np.round(residual @ (w / max(np.linalg.norm(w), 1e-300)), 12), -np.inf)
        where[i] = int(np.argmax(best)) if fits.any() else int(np.argmin(np.round(held, 12)))
        held[where[i]] += w[0]
        left -= w[0]
        residual[where[i]] -= w
    return where


def _measured(docs: DataFrame, id_col: str, text_col: str, whole: bool) -> DataFrame:
    """``m_`` (what the packing needs) and, if ``whole``, ``row`` (all columns), so that no other column's name can clash. Stored: the
    texts are measured once, and a row keeps its key."""
    text = F.col(text_col).cast("string")
    raw = F.coalesce(text, F.lit("")).cast("binary")
    row = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if whole else []
    return scratch.save(docs.select(*row, F.struct(
        F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(raw) + 1).cast("long").alias("size"), word_count(text).alias("tokens"),
        F.crc32(raw).alias("text_crc32"), F.xxhash64(raw).alias("group"), F.xxhash64(F.col(id_col)).alias("salt"),
        F.monotonically_increasing_id().alias("key")).alias("m_")), "measured")


_RESULT = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")


def _results() -> list:
    return [F.col("m_.size").alias("size"), F.col("m_.text_crc32").alias("text_crc32"), F.lit("bytes").alias("law"), F.col("shard"), F.col("slot"),
            F.lit(None).cast("int").alias("grown_shard")]


def assign(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    return _assigned(_measured(docs, id_col, text_col, False), shards).select("m_.doc_id", *_results())


def shard(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS) -> DataFrame:
    """All columns of ``docs`` and the results; a column of ``docs`` that is named like a result gives way to it."""
    keep = [F.col(f"row.`{c}`") for c in docs.columns if c not in _RESULT]
    return _assigned(_measured(docs, id_col, text_col, True), shards).select(*keep, *_results())


def _assigned(rows: DataFrame, shards: int) -> DataFrame:
    spark = rows.sparkSession
    m = rows.select("m_.group", "m_.size", "m_.tokens")
    groups = m.groupBy("group").agg(F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("n"))
    total = m.agg(F.sum("size"), F.sum("tokens"), F.count(F.lit(1))).first()
    total = [int(x or 0) for x in total]
    share = F.greatest(*[F.col(c) / F.lit(max(t, 1)) for c, t in zip(("size", "tokens", "n"), total)])
    heavy = (groups.withColumn("share", share).where(F.col("share") * max(HEAVY, shards) > 1)
             .select("group", F.ceil(F.col("share") * shards).alias("parts"), F.ceil(F.col("share") * HEAVY).alias("pieces")).collect())
    # at most 3 * HEAVY rows (or 3 * shards, if there are more shards): their shares add up to at most 3
    known = spark.createDataFrame([(r.group, int(r.parts), -(-int(r.pieces) // int(r.parts)), k) for k, r in enumerate(sorted(heavy))],
                                  "group long, parts int, pieces int, nth int")
    own = F.broadcast(known.withColumnRenamed("group", "heavy_group"))
    packed = rows.join(own, F.col("m_.group") == F.col("heavy_group"), "left")
    pairs = packed.where("nth is not null").groupBy(F.col("m_.group").alias("its_group"), F.col("m_.doc_id").alias("its_id")).agg(F.count(F.lit(1)).alias("n"))
    crowded = pairs.where((F.col("n") > 1) & (F.col("n") * HEAVY > total[2])).select("its_group", "its_id", F.lit(True).alias("crowded"))  # at most HEAVY rows
    met = (F.col("m_.group") == F.col("its_group")) & F.col("m_.doc_id").eqNullSafe(F.col("its_id"))
    packed = packed.join(F.broadcast(crowded), met, "left").drop("its_group", "its_id")
    packed = packed.withColumn("salt", F.when(F.col("crowded"), F.xxhash64("m_.key")).otherwise(F.col("m_.salt")))
    first = F.lit(PACKETS) + F.col("nth") * (1 << 20)
    packet = F.when(F.col("nth").isNotNull(), first + F.pmod("salt", "parts")).otherwise(F.pmod("m_.group", F.lit(PACKETS))).cast("long")
    packed = packed.withColumn("packet", packet).withColumn("block", F.pmod(F.xxhash64("salt"), BLOCKS * F.coalesce("pieces", F.lit(1))).cast("int"))
    packed = packed.drop("heavy_group", "parts", "pieces", "nth", "crowded", "salt")
    cells = packed.groupBy("packet", "block").agg(F.sum("m_.size").alias("size"), F.sum("m_.tokens").alias("tokens"), F.count(F.lit(1)).alias("n"))
    packets = cells.groupBy("packet").agg(F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.sum("n").alias("n"))
    most = [max(t, 1) for t in total]
    # at most PACKETS + 3 * HEAVY + 3 * shards rows
    bins = sorted(packets.collect(), key=lambda r: (-max(r["size"] / most[0], r.tokens / most[1], r.n / most[2]), r.packet))
    weights = np.array([[r["size"], r.tokens, r.n] for r in bins], float).reshape(-1, 3)
    filled, placed = [0] * shards, []
    for r, s in zip(bins, place(weights, shards)):
        placed.append((r.packet, int(s), filled[s]))
        filled[s] += r.n
    start = F.broadcast(spark.createDataFrame(placed, "packet long, shard int, start long"))
    before = cells.withColumn("before", F.sum("n").over(W.partitionBy("packet").orderBy("block")) - F.col("n")).select("packet", "block", "before")
    offset = before.join(start, "packet").select("packet", "block", "shard", (F.col("start") + F.col("before")).alias("offset"))
    rank = F.row_number().over(W.partitionBy("packet", "block").orderBy(F.col("m_.doc_id").asc_nulls_last()))
    return (packed.withColumn("rank", rank).join(offset, ["packet", "block"])
            .withColumn("slot", (F.col("offset") + F.col("rank") - 1).cast("long")).drop("packet", "block", "rank", "offset"))
