"""Operator 1: near-duplicate groups by fast similarity sketching, banding and exact verification.

Sketch. In round i every shingle is thrown into bin h_i(shingle) of T bins with a value that starts with i; a bin
keeps its least value, so a text stops as soon as all its bins are filled, after about T ln T throws whatever its
length. Rounds T..2T-1 throw every shingle into bin i - T, so each coordinate is certain to fill. Two sketches
agree in a coordinate with the probability of the sets' Jaccard similarity, with Chernoff-type concentration.

Candidates. BANDS keys of ROWS coordinates each; at similarity 0.85 a pair misses every band with probability
(1 - 0.85^6)^32 < 3e-7. A bucket's pairs are never listed. Exact copies are first folded into one node (equal word
sequences). In each bucket one pivot, the member that meets most others, is compared with the members; after the
verified links are merged, only buckets that still hold several components go on, and there only pairs between
different components whose one-bit sketches differ in at most MAX_DIFF of T bits (five standard deviations above
the mean at 0.85) are verified. So no link between components is passed over, and a group of n copies costs about
n candidates.

Verification is on the full sets of 64-bit shingle hashes: 100 * |intersection| >= 85 * |union|.

Null or blank texts have no shingles and link with nothing. A null doc_id is returned, without a component, and
takes part in no link. Rows that share a doc_id share a node. No rows in give no rows out; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from journeyline.llm import scratch, textkit
from journeyline.llm.graph import components

T = 1024
BANDS, ROWS = 32, 6
MAX_DIFF = 119
PERCENT = 85
STAR_ROUNDS = 2
SHINGLE = 5
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_THROWS = 1 << 16

SKETCH = "doc_id long, n_shingles long, key0 long, key1 long, bands array<long>, bits array<long>"


def sketch(owner: np.ndarray, hashes: np.ndarray, rows: int, t: int = T) -> np.ndarray:
    """(rows, t) matrix of bin values; a row without elements stays empty."""
    out = np.full(rows * t, _EMPTY)
    i = 0
    while len(hashes) and i < 2 * t:
        k = max(1, _THROWS // len(hashes))
        for r in range(i, min(i + k, 2 * t)):
            x = textkit.mix(hashes, r + 1)
            into = (x >> np.uint64(32)) * np.uint64(t) >> np.uint64(32) if r < t else np.full(len(x), r - t, np.uint64)
            value = (x & np.uint64(0xFFFFFFFF)) | np.uint64(r << 32)
            np.minimum.at(out, owner * t + into.astype(np.int64), value)
        i += k
        open_ = (out.reshape(rows, t) == _EMPTY).any(axis=1)
        left = open_[owner]
        owner, hashes = owner[left], hashes[left]
    return out.reshape(rows, t)


def band_keys(signature: np.ndarray) -> np.ndarray:
    part = signature[:, :BANDS * ROWS].reshape(len(signature), BANDS, ROWS)
    key = np.zeros(part.shape[:2], np.uint64)
    for j in range(ROWS):
        key = textkit.mix(key ^ part[:, :, j], j)
    return textkit.mix(key + np.arange(BANDS, dtype=np.uint64), 99)


def one_bit(signature: np.ndarray) -> np.ndarray:
    """T/64 words holding one hashed bit of each coordinate."""
    bits = (textkit.mix(signature, 5) & np.uint64(1)).astype(np.uint8)
    return np.packbits(bits, axis=1).view(np.uint64)


def _longs(matrix: np.ndarray) -> pa.Array:
    rows, width = matrix.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(rows + 1) * width, pa.int32()), pa.array(matrix.reshape(-1).view(np.int64)))


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, rows, data, offsets in textkit.pieces(batch.column(1)):
            owner, hashes, count, key = textkit.text_shingles(data, offsets, SHINGLE)
            s = sketch(owner, hashes, rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(i, rows), pa.array(count.astype(np.int64)), pa.array(key[0].view(np.int64)),
                 pa.array(key[1].view(np.int64)), _longs(band_keys(s)), _longs(one_bit(s))],
                ["doc_id", "n_shingles", "key0", "key1", "bands", "bits"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text's sorted shingle hashes as bytes."""
    for batch in batches:
        for i, rows, data, offsets in textkit.pieces(batch.column(1)):
            _, hashes, count, _ = textkit.text_shingles(data, offsets, SHINGLE)
            ends = np.concatenate(([0], np.cumsum(count)))
            raw = hashes.tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(i, rows), pa.array([raw[8 * s:8 * e] for s, e in zip(ends[:-1], ends[1:])], pa.binary())],
                ["doc_id", "shingles"])


def _common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = [len(np.intersect1d(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), assume_unique=True))
             for x, y in zip(batch.column(2), batch.column(3))]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64())], ["a", "b", "common"])


def similar_bits(left: str, right: str) -> Column:
    diff = sum((F.bit_count(F.col(f"{left}.bits")[i].bitwiseXOR(F.col(f"{right}.bits")[i])) for i in range(T // 64)), F.lit(0))
    return diff <= MAX_DIFF


def similar_size(left: str, right: str) -> Column:
    x, y = F.col(f"{left}.n"), F.col(f"{right}.n")
    return (100 * x >= PERCENT * y) & (100 * y >= PERCENT * x)


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.join(left, "a").join(right, "b")
    size = (F.octet_length("sa") + F.octet_length("sb")) / 8
    counted = (both.where((F.least(F.octet_length("sa"), F.octet_length("sb")) * 100 >= PERCENT * F.greatest(F.octet_length("sa"), F.octet_length("sb"))))
               .select("a", "b", "sa", "sb", size.cast("long").alias("size")))
    common = counted.select(F.struct("a", "size").alias("a"), "b", "sa", "sb").mapInArrow(
        _common, "a struct<a: long, size: long>, b long, common long")
    return common.where(100 * F.col("common") >= PERCENT * (F.col("a.size") - F.col("common"))).select("a.a", "b")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row."""
    scratch.prepare(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    every = scratch.save(texts.mapInArrow(_sketches, SKETCH), "sketch")
    nodes = scratch.save(
        every.where("n_shingles > 0 and doc_id is not null").groupBy("key0", "key1")
        .agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"), F.first("bits").alias("bits")), "nodes")

    rows = nodes.select("rep", F.explode("bands").alias("bucket"))
    shared = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    rows = scratch.save(rows.join(shared, "bucket"), "buckets")
    scores = rows.groupBy("rep").agg(F.sum("members").alias("score"))
    meeting = scratch.save(nodes.join(scores, "rep"), "meeting")
    sets = scratch.save(texts.join(meeting.select(F.col("rep").alias("doc_id")).distinct(), "doc_id")
                        .mapInArrow(_sets, "doc_id long, shingles binary"), "sets")
    slim = meeting.select("rep", "n", "bits")

    links, labels = None, None

    def open_rows(extra: list[str]) -> DataFrame:
        """Rows of buckets with several components, with each member's component."""
        member = meeting.select("rep", *extra)
        if labels is not None:
            member = member.join(labels.withColumnRenamed("id", "rep"), "rep", "left")
        else:
            member = member.withColumn("comp", F.lit(None).cast("long"))
        member = member.withColumn("alone", F.col("comp").isNull()).withColumn("comp", F.coalesce("comp", "rep"))
        return rows.select("bucket", "rep").join(member, "rep")

    def merge(pairs: DataFrame) -> None:
        nonlocal links, labels
        found = scratch.save(verified(pairs, sets), "found")
        links = found if links is None else links.unionAll(found)
        labels = components(links)

    for _ in range(STAR_ROUNDS):
        here = open_rows(["score"])
        pivots = (here.groupBy("bucket").agg(
            F.max(F.when(F.col("alone"), F.struct("score", (-F.col("rep")).alias("minus")))).alias("top"),
            F.min("comp").alias("low"), F.max("comp").alias("high"))
            .where("low <> high and top is not null").select("bucket", (-F.col("top.minus")).alias("a")))
        pairs = (here.select("bucket", F.col("rep").alias("b")).join(pivots, "bucket").where("a <> b")
                 .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
        x, y = slim.alias("x"), slim.alias("y")
        near = (pairs.join(x, F.col("a") == F.col("x.rep")).join(y, F.col("b") == F.col("y.rep"))
                .where(similar_size("x", "y") & similar_bits("x", "y")).select("a", "b"))
        merge(near)

    several = open_rows([]).groupBy("bucket").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high")
    rest = scratch.save(open_rows(["n", "bits", "bands"]).join(several.select("bucket"), "bucket").drop("alone"), "rest")
    x, y = rest.alias("x"), rest.alias("y")
    first = F.array_position(F.zip_with("x.bands", "y.bands", lambda p, q: p == q), F.lit(True))
    pairs = (x.join(y, (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.rep") < F.col("y.rep")) & (F.col("x.comp") != F.col("y.comp"))
                    & similar_size("x", "y") & similar_bits("x", "y")
                    & (F.col("x.bucket") == F.element_at(F.col("x.bands"), first.cast("int"))))
             .select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b")))
    merge(pairs)

    final = (nodes.select("key0", "key1", "rep").join(labels.withColumnRenamed("id", "rep"), "rep", "left")
             .select("key0", "key1", F.coalesce("comp", "rep").alias("component_id")))
    linked = F.col("n_shingles") > 0
    keyed = every.select("doc_id", "n_shingles", F.when(linked, F.col("key0")).alias("key0"), F.when(linked, F.col("key1")).alias("key1"))
    return (keyed.join(final, ["key0", "key1"], "left")
            .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")))
            .select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")))
