"""Merkle manifest of a dataset: a content-addressed DAG of digests, and each leaf's proof by descent from the root.

H is the lower-case hexadecimal SHA-256 of its inputs, concatenated; digests are put in as text. A row's leaf is H of its
columns, each ``-`` if null, else its UTF-8 byte count, ``:`` and its value. The leaves of a source, ascending by doc_id
(null first; equal ids by leaf), form a tree: as long as there are more nodes than one, every three consecutive ones,
at the end of a level fewer, become their H. What remains is the source's subroot. The subroots, by source (null
first, then bytewise), form a tree in the same way, whose top is the root of the dataset.

Building. Leaves are ranked by one range-partitioned sort (a source's leaves cross many tasks, so no source has to fit in
one) and grouped by rank in packs of 3^``HEIGHT`` = 729: a pack is the subtree of six levels over them, stored as its top
digest and its records (digest, children). The tops are the next pass' nodes. A pass shuffles 1/729 of the one before.

Proving. Requests descend from the root: a request names a digest, is joined with the pack of that digest, and becomes
one request for each node at the pack's lower edge, with the children not selected on the way added to its path. Its
position, the rank's digits to base three, says which child is the selected one. So all leaves below a node share one
request until the lowest pack, where each leaf follows its own last digits; no record is asked for once for every leaf. The
path, collected from root to leaf, is reversed at the end.

Bounds: a pack has 729 nodes; a path two strings for each level. Sources may be many (they are ranked as leaves are) and
one may hold most rows. Rows that are equal in all columns are leaves of their own, with equal digests and proofs of their
own. Extra columns are ignored; an empty table has no root and no proofs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from journeyline.llm import scratch

ARITY = 3
HEIGHT = 6
SIZE = ARITY ** HEIGHT
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_TOP = "top"  # the tree over the sources has this one key
_RECORDS = "array<struct<digest:string,children:array<string>>>"
_RECORDS_TYPE = pa.list_(pa.struct([("digest", pa.string()), ("children", pa.list_(pa.string()))]))
_PATH = [("lefts", pa.list_(pa.string())), ("rights", pa.list_(pa.string()))]


class Manifest(NamedTuple):
    """``store``: the records (digest, children) by pack; ``leaves``: rows by lowest pack; ``sources``: subroots, likewise."""

    store: DataFrame
    leaves: DataFrame
    sources: DataFrame
    root: DataFrame  # tree, digest, depth: one row, none for an empty table


def leaf(values: list[Column]) -> Column:
    """H of the values, each by its byte count and text, or ``-``."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def _depth(n: Column) -> Column:
    """Levels above ``n`` leaves: the least d with 3^d >= n."""
    return sum((n > ARITY ** k).cast("int") for k in range(39))


def _ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with their ``rank`` (from 0) in their ``tree``, by ``order`` (null first), and the tree's ``depth``.

    One sort by ranges of (tree, order); a row's rank is its place in its partition plus the rows of its tree before that
    partition. Rows equal in ``order`` are equal, so any order of theirs gives the same digests; ``tie`` only spreads them."""
    spark = rows.sparkSession
    keys = [F.col("tree").asc(), *[F.col(c).asc_nulls_first() for c in order], F.col("tie").asc()]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(parts, *keys).sortWithinPartitions(*keys).drop("tie")
    placed = scratch.save(placed.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place")), "ranked")
    runs = placed.groupBy("tree", "part").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))  # partitions + trees rows
    tree = W.partitionBy("tree")
    before = F.coalesce(F.sum("n").over(tree.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    runs = runs.select("tree", "part", (before - F.col("first")).alias("shift"), _depth(F.sum("n").over(tree)).alias("depth"))
    return placed.join(runs, ["tree", "part"]).withColumn("rank", F.col("place") + F.col("shift")).drop("part", "place", "shift")


def _h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _folded(nodes: list[str], height: int) -> tuple[str, list[dict]]:
    """The top of ``height`` levels over the nodes, and the records of all digests made."""
    records = {}
    for _ in range(height):
        runs = [nodes[i:i + ARITY] for i in range(0, len(nodes), ARITY)]
        nodes = [_h(*run) for run in runs]
        records.update(zip(nodes, runs))
    return nodes[0], [{"digest": d, "children": c} for d, c in records.items()]


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        tops, records = [], []
        for nodes, height in zip(b.column("nodes").to_pylist(), b.column("height").to_pylist()):
            top, made = _folded(nodes, height)
            tops.append(top)
            records.append(made)
        yield pa.RecordBatch.from_arrays([*[b.column(c) for c in ("tree", "block", "depth")], pa.array(tops, pa.string()), pa.array(records, _RECORDS_TYPE)],
                                         ["tree", "block", "depth", "digest", "records"])


def _trees(ranked: DataFrame) -> tuple[DataFrame, list[DataFrame], DataFrame]:
    """The rows of each lowest pack, the packs of all passes, and each tree's top, of rows (tree, rank, depth, digest, ...)."""
    keep = [c for c in ranked.columns if c not in ("tree", "rank", "depth")]
    block = F.expr(f"rank div {SIZE}").alias("block")
    low = ranked.groupBy("tree", block).agg(F.max("depth").alias("depth"), F.array_sort(F.collect_list(F.struct("rank", *keep))).alias("rows"))
    low = scratch.save(low, "lowest")
    spark = ranked.sparkSession
    deepest = low.agg(F.max("depth")).first()[0] or 0  # one number
    nodes = low.select("tree", "block", "depth", F.col("rows.digest").alias("nodes"))
    packs, tops = [], []
    for done in range(0, max(deepest, 1), HEIGHT):
        height = F.least(F.lit(HEIGHT), F.col("depth") - done).cast("int").alias("height")
        made = nodes.select("*", height).mapInArrow(_pack, f"tree string, block long, depth int, digest string, records {_RECORDS}")
        made = scratch.save(made, "packs")
        packs.append(made)
        tops.append(made.where(F.col("depth") <= done + HEIGHT).select("tree", "digest", "depth"))
        above = made.where(F.col("depth") > done + HEIGHT)
        nodes = above.groupBy("tree", F.expr(f"block div {SIZE}").alias("block")).agg(
            F.max("depth").alias("depth"), F.expr("array_sort(collect_list(struct(block, digest))).digest").alias("nodes"))
    top = tops[0]
    for t in tops[1:]:
        top = top.unionByName(t)
    return low, packs, top


def build(docs: DataFrame, payload: dict[str, Column] | None = None) -> Manifest:
    """The manifest of a table of documents. ``payload``: further columns that leaves carry to their proofs."""
    spark = scratch.prepare(docs.sparkSession)
    source = F.col("source").cast("string")
    tree = F.coalesce(F.concat(F.lit("="), source), F.lit(""))  # never null, in the order of the sources
    rows = docs.select(tree.alias("tree"), F.col("doc_id").cast("long").alias("doc_id"), leaf([F.col(c) for c in FIELDS]).alias("digest"),
                       *[c.alias(n) for n, c in (payload or {}).items()])
    leaves, packs, subroots = _trees(_ranked(rows, ["doc_id", "digest"]))
    subroots = subroots.select(F.lit(_TOP).alias("tree"), F.col("tree").alias("below"), "digest", F.col("depth").alias("below_depth"))
    sources, more, root = _trees(_ranked(subroots, ["below"]))
    store = None
    for p in [*packs, *more]:
        p = p.where("depth > 0").select("digest", "records")
        store = p if store is None else store.unionByName(p)
    # content-addressed: equal subtrees are one entry
    store = scratch.save(store.groupBy("digest").agg(F.first("records").alias("records")), "store")
    return Manifest(store, leaves, sources, scratch.save(root, "root"))


def _step(children: list[str], digit: int) -> tuple[str, str]:
    return "".join(children[:digit]), "".join(children[digit + 1:])


def _expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Requests for the nodes at the lower edge of each request's pack, with the path so far."""
    for b in batches:
        out = {c: [] for c in ("tree", "block", "digest", "depth", "left", "lefts", "rights")}
        for r in b.to_pylist():
            kids = {x["digest"]: x["children"] for x in r["records"]}
            height = (r["left"] - 1) % HEIGHT + 1
            here = [(r["digest"], r["block"], r["lefts"], r["rights"])]
            for _ in range(height):
                here = [(child, at * ARITY + digit, lefts + [_step(kids[d], digit)[0]], rights + [_step(kids[d], digit)[1]])
                        for d, at, lefts, rights in here for digit, child in enumerate(kids[d])]
            for d, at, lefts, rights in here:
                for c, v in zip(out, (r["tree"], at, d, r["depth"], r["left"] - height, lefts, rights)):
                    out[c].append(v)
        yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("tree", pa.string()), ("block", pa.int64()), ("digest", pa.string()),
                                                                ("depth", pa.int32()), ("left", pa.int32()), *_PATH]))


_REQUEST = "tree string, block long, digest string, depth int, left int, lefts array<string>, rights array<string>"


def _lowest(store: DataFrame, tops: DataFrame, deepest: int) -> DataFrame:
    """One request for each lowest pack, of the trees' tops (tree, digest, depth, lefts, rights)."""
    asked = tops.select("tree", F.lit(0).cast("long").alias("block"), "digest", "depth", F.col("depth").alias("left"), "lefts", "rights")
    for left in range(-(-deepest // HEIGHT) * HEIGHT, HEIGHT, -HEIGHT):  # trees of unlike depth take part from their own level on
        deep = asked.where(F.col("left") > left - HEIGHT).join(store, "digest").mapInArrow(_expand, _REQUEST)
        asked = scratch.save(asked.where(F.col("left") <= left - HEIGHT).unionByName(deep), "requests")
    return asked


def _descend(fields: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                kids = {x["digest"]: x["children"] for x in r["records"] or ()}
                out = []
                for row in r["rows"]:
                    here, lefts, rights = r["digest"], list(r["lefts"]), list(r["rights"])
                    for level in range(r["left"] - 1, -1, -1):
                        digit = row["rank"] // ARITY ** level % ARITY
                        beside = _step(kids[here], digit)
                        here = kids[here][digit]
                        lefts.append(beside[0])
                        rights.append(beside[1])
                    if here != row["digest"]:
                        raise ValueError(f"the store has {here} where leaf {row['digest']} belongs")
                    out.append({**row, "tree": r["tree"], "lefts": lefts[::-1], "rights": rights[::-1]})
                yield pa.RecordBatch.from_pylist(out, schema=fields)
    return run


def _requested(low: DataFrame, asked: DataFrame, store: DataFrame) -> DataFrame:
    """Each row of the lowest packs with its path from leaf to root (``lefts``, ``rights``: the siblings on both sides)."""
    row = low.schema["rows"].dataType.elementType
    arrow = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32()}
    names = [(f.name, f.dataType.simpleString()) for f in row.fields]
    schema = pa.schema([("tree", pa.string()), *[(n, arrow[t]) for n, t in names], *_PATH])
    spark_schema = ", ".join(["tree string", *[f"{n} {t}" for n, t in names], "lefts array<string>, rights array<string>"])
    met = low.select("tree", "block", "rows").join(asked, ["tree", "block"]).join(store, "digest", "left")
    return met.mapInArrow(_descend(schema), spark_schema)


def proofs(m: Manifest) -> DataFrame:
    """One row for each leaf: tree, rank, doc_id, digest (the leaf), payload, subroot, root, and the path from leaf to root.

    ``lefts`` and ``rights`` hold, level by level, the digests of the leaf's run before and after the selected one, as text."""
    none = F.array().cast("array<string>")
    root = m.root.withColumns({"lefts": none, "rights": none})
    first = m.root.first()
    tops = _requested(m.sources, _lowest(m.store, root, first.depth if first else 0), m.store)
    # paths were reversed to run from leaf to root; the descent goes on from their end
    tops = scratch.save(tops.select(F.col("below").alias("tree"), "digest", F.col("below_depth").alias("depth"),
                                    F.reverse("lefts").alias("lefts"), F.reverse("rights").alias("rights")), "subroots")
    deepest = tops.agg(F.max("depth")).first()[0] or 0  # one number
    out = _requested(m.leaves, _lowest(m.store, tops, deepest), m.store)
    out = out.join(tops.select("tree", F.col("digest").alias("subroot")), "tree")
    return out.withColumn("root", F.lit(first.digest if first else None).cast("string"))


def proof_digest() -> Column:
    """H of the siblings, from the leaf's level to the root's, left to right."""
    return F.sha2(F.array_join(F.flatten(F.transform(F.arrays_zip("lefts", "rights"), lambda s: F.array(s["lefts"], s["rights"]))), ""), 256)


def folded(start: Column) -> Column:
    """The root that ``start`` gives with the path's siblings."""
    return F.aggregate(F.arrays_zip("lefts", "rights"), start, lambda h, s: F.sha2(F.concat(s["lefts"], h, s["rights"]), 256))


def audit(docs: DataFrame) -> DataFrame:
    """Proofs of all rows, and what they say of a copy in which the texts of some rows have lost their line ends.

    Tampered are the rows whose doc_id has an even CRC-32 as decimal text (a null doc_id: none)."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    text = F.when(hit, F.replace(F.col("text").cast("string"), F.lit("\n"), F.lit(""))).otherwise(F.col("text").cast("string"))
    now = leaf([text if c == "text" else F.col(c) for c in FIELDS])
    p = proofs(build(docs, {"now": now}))
    p = p.select("doc_id", F.col("digest").alias("leaf"), "subroot", "root", proof_digest().alias("proof_sha256"), folded(F.col("now")).alias("folded_root"))
    return p.withColumn("verified", F.col("folded_root") == F.col("root"))
