"""Operator 10: token ids, packed best-fit-decreasing into rows of fixed width.

Texts are encoded with a public byte-level BPE vocabulary (a tiktoken rank file, a parameter). A text longer than the
width is split in parts of the width, without loss: the parts of a document, in order, are its ids. A document is known by
doc_id and doc_key, a hash of doc_id and text, so unlike texts that share a doc_id stay apart. The parts are stored and
counted, then dealt to packing groups of about GROUP_PARTS parts by a hash of doc_key and part number, whatever the
input's partitions. Rows of one doc_id and text beyond HEAVY in number are dealt by their stored row too. A group is
packed in one task, longest part first, each in the open row with the least room that suffices. That row is found by
a segment tree over the possible capacities, whose leaf c tells whether an open row has just c left, in log2(width)
steps; if there is none, a row is opened.

Each packed row has its ids (16 bits, little endian, padded to the width), the documents, their keys and part numbers of its
segments, their cumulative lengths (from 0 to the number of ids in use) and positions that begin again at 0 with each
segment. ``write_packed`` writes them as Parquet: one row of the matrix in each record.

Null and empty texts have no ids and are in no row; a null doc_id is carried as null; repeated rows are packed each;
other columns are ignored. The vocabulary needs ids under 65535, the padding.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from journeyline.llm import scratch

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
WIDTH = 2048
GROUP_PARTS = 4000
HEAVY = 500
BROADCAST_KEYS = 1_000_000
PAD = 65535
FLOW = 4 << 20

PARTS = "doc_id long, doc_key long, row long, part int, n_tokens int, ids binary"
PACKED = ("pack_group long, row int, n_tokens int, doc_ids array<long>, doc_keys array<long>, parts array<int>, cu_seqlens array<int>, "
          "input_ids binary, position_ids binary")
_SCHEMA = pa.schema([("pack_group", pa.int64()), ("row", pa.int32()), ("n_tokens", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("doc_keys", pa.list_(pa.int64())),
                     ("parts", pa.list_(pa.int32())), ("cu_seqlens", pa.list_(pa.int32())), ("input_ids", pa.binary()), ("position_ids", pa.binary())])
_ENCODERS: dict[int, object] = {}


def encoder(ranks: bytes):
    """The encoder of a rank file's content; one for each worker process."""
    key = hash(ranks)
    if key not in _ENCODERS:
        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
        if max(table.values()) >= PAD:
            raise ValueError("the vocabulary has ids that 16 bits can't hold")
        _ENCODERS[key] = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
    return _ENCODERS[key]


class Capacities:
    """Open rows by remaining capacity; a segment tree holds the greatest capacity present below each node."""

    def __init__(self, width: int):
        self.leaves = 1 << int(width).bit_length()
        self.tree = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(width + 1)]

    def _set(self, capacity: int, value: int) -> None:
        tree, i = self.tree, self.leaves + capacity
        tree[i] = value
        while i > 1:
            i >>= 1
            top = max(tree[2 * i], tree[2 * i + 1])
            if tree[i] == top:
                break
            tree[i] = top

    def add(self, capacity: int, row: int) -> None:
        if capacity:
            if not self.rows[capacity]:
                self._set(capacity, capacity)
            self.rows[capacity].append(row)

    def take(self, size: int) -> tuple[int, int] | None:
        """The least capacity of at least ``size``, and a row that has it; None if no row has room."""
        tree = self.tree
        if tree[1] < size:
            return None
        i = 1
        while i < self.leaves:
            i *= 2
            if tree[i] < size:
                i += 1
        capacity = i - self.leaves
        row = self.rows[capacity].pop()
        if not self.rows[capacity]:
            self._set(capacity, 0)
        return capacity, row


def best_fit(sizes: list[int], width: int) -> list[list[int]]:
    """Indices of the segments in each row; ``sizes`` in any order, each from 1 to ``width``."""
    rows: list[list[int]] = []
    open_ = Capacities(width)
    for k in sorted(range(len(sizes)), key=lambda k: (-sizes[k], k)):
        got = open_.take(sizes[k])
        if got is None:
            got = width, len(rows)
            rows.append([])
        rows[got[1]].append(k)
        open_.add(got[0] - sizes[k], got[1])
    return rows


def tokenized(docs: DataFrame, ranks: bytes, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each part of a document."""
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    names = [x.split()[0] for x in PARTS.split(", ")]
    types = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(shared.value)
        out, size = [], 0
        flush = lambda: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
        for batch in batches:
            for doc_id, key, row, text in zip(*(batch.column(k).to_pylist() for k in range(3)), batch.column(3)):
                ids = np.array(enc.encode_ordinary(text.as_py() or ""), np.uint16)
                for part, i in enumerate(range(0, len(ids), width)):
                    cut = ids[i:i + width]
                    out.append((doc_id, key, row, part, len(cut), cut.astype("<u2").tobytes()))
                    size += 2 * len(cut)
                    if size > FLOW:
                        yield flush()
                        out, size = [], 0
        if out:
            yield flush()

    doc_id, text = F.col(id_col).cast("long"), F.col(text_col).cast("string")
    rows = docs.select(doc_id.alias("doc_id"), F.xxhash64(doc_id, text).alias("doc_key"), F.monotonically_increasing_id().alias("row"), text.alias("text"))
    return rows.where(F.length("text") > 0).mapInArrow(run, PARTS)


def dealt(parts: DataFrame, groups: int) -> DataFrame:
    """The stored parts with their packing group; rows of one doc_id and text beyond HEAVY are spread by their row."""
    heavy = parts.where("part = 0").groupBy("doc_key").agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > HEAVY)
    heavy = scratch.save(heavy.select(F.col("doc_key").alias("heavy_key")), "heavy")
    if heavy.count() <= BROADCAST_KEYS:
        heavy = F.broadcast(heavy)
    marked = parts.join(heavy, F.col("doc_key") == F.col("heavy_key"), "left")
    salt = F.when(F.col("heavy_key").isNotNull(), F.col("row")).otherwise(F.lit(-1).cast("long"))
    return marked.select(F.pmod(F.xxhash64("doc_key", "part", salt), F.lit(groups)).alias("pack_group"), "doc_id", "doc_key", "part", "n_tokens", "ids")


def _packer(width: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        doc_ids, doc_keys, parts = (table.column(c).to_pylist() for c in ("doc_id", "doc_key", "part"))
        order = sorted(range(len(parts)), key=lambda k: (doc_ids[k] is None, doc_ids[k] or 0, doc_keys[k], parts[k]))
        sizes = table.column("n_tokens").to_pylist()
        ids = table.column("ids")
        group = table.column("pack_group")[0].as_py()
        out = []
        for r, members in enumerate(best_fit([sizes[k] for k in order], width)):
            members = [order[k] for k in members]
            lengths = [sizes[k] for k in members]
            used = sum(lengths)
            row = np.full(width, PAD, "<u2")
            row[:used] = np.frombuffer(b"".join(ids[k].as_py() for k in members), "<u2")
            positions = np.zeros(width, "<u2")
            positions[:used] = np.concatenate([np.arange(n) for n in lengths])
            out.append((group, r, used, [doc_ids[k] for k in members], [doc_keys[k] for k in members], [parts[k] for k in members],
                        [0, *np.cumsum(lengths).tolist()], row.tobytes(), positions.tobytes()))
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _SCHEMA)], schema=_SCHEMA)

    return run


def pack(docs: DataFrame, ranks_path: str = RANKS, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Packed rows of all texts of ``docs``."""
    scratch.prepare(docs.sparkSession)
    with open(ranks_path, "rb") as f:
        ranks = f.read()
    parts = scratch.save(tokenized(docs, ranks, width, id_col, text_col), "parts")
    groups = max(1, -(-parts.count() // GROUP_PARTS))
    parts = dealt(parts, groups)
    # as many partitions as groups, so that one task holds about one group
    return parts.repartition(groups, "pack_group").groupBy("pack_group").applyInArrow(_packer(width), PACKED)


def write_packed(docs: DataFrame, path: str, **options) -> None:
    """Write the packed rows as Parquet."""
    pack(docs, **options).write.parquet(path)
