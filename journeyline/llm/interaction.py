"""Filter interaction audit: what each of five filters removes in every order of applying them, kept up to date by a stream.

The filters A to D look at a text alone; E fails a row whose text a smaller doc_id has anywhere in the table. A row's five
verdicts are a mask, and the counts of masks in a part (a source) hold the results of all 120 orders: filter f at a step
removes the rows whose mask has f and none of the filters before it.

The stream reads the table's files as available-now micro-batches, about ``BATCHES`` of them. One pass over the texts
gives A to D and the text's SHA-256; texts go no further. Under that digest, the state holds the smallest doc_id so
far and its rows' parts. As a call for each digest costs far more than its work, digests share a state key, about ``TEXTS``
to one: there are as many keys as the table's row count asks for, so that a key's state has the same size in every table.
A row with a greater id counts with E. When a smaller id arrives, the earlier smallest one's mask
without E is retracted from its part's counter (-1) and counted again with E (+1). Each micro-batch writes its changes
under its epoch's number, so a repeated epoch writes the same folder again; the counters are the sum of all epochs. Order
of files and rows doesn't matter, and the state outlives executors in the stream's checkpoint.

A text may fill a third of the table. Within each Arrow batch only the rows with the text's smallest id go to its key; the
others fail E whatever comes, need no state, and are spread over all keys. So a text has one row for each batch that
holds it, besides repeated rows of one id.

Null texts are empty. Null and empty sources are one part, the empty string. A row without doc_id is no one's
predecessor and has none: it never fails E. Rows that repeat doc_id and text don't fail E by each other. Labels without doc_id
are ignored; of several labels of one id, a 1 prevails. An empty table gives no rows, as it has no part.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from journeyline.llm import scratch

FILTERS = "ABCDE"
A, B, C, D, E = (1 << i for i in range(5))
BATCHES = 4
#: What a row's text has to be asked of the state: its smallest id; nothing; nothing, and the row has no id.
ASK, DECIDED, NAMELESS = range(3)
#: Texts that share a state key.
TEXTS = 256
_SIGNS = b"#$%&*|"
_CAPITALS = bytes(range(65, 91))
_MARKED = pa.schema([("key", pa.int64()), ("digest", pa.string()), ("doc_id", pa.int64()), ("part", pa.string()), ("mask", pa.int32()), ("state", pa.int32())])
_CHANGE = "doc_id long, part string, mask int, delta long"
_STATE = "texts string"


def text_mask(text: str) -> int:
    """The filters of A to D that a text fails."""
    raw = text.encode()
    words = raw.split()  # bytes split at space and \x09 to \x0d
    n = len(words)
    return (A * (n < 200) | B * (100 * len(set(words)) < 50 * n) | D * (len(raw.translate(None, _SIGNS)) < len(raw))
            | C * (100 * (len(raw) - len(raw.translate(None, _CAPITALS))) > 2 * len(text)))


def _marked(keys: int):
    """key, digest, doc_id (0 if null: a null would make pandas read all ids as floats), part, mask and state."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("doc_id").to_pylist()
            digests, masks = [], []
            known: dict[str, int] = {}
            least: dict[str, int] = {}
            for i, text in zip(ids, b.column("text")):
                text = text.as_py() or ""
                digest = hashlib.sha256(text.encode()).hexdigest()
                if digest not in known:
                    known[digest] = text_mask(text)
                digests.append(digest)
                masks.append(known[digest])
                if i is not None and i < least.get(digest, i + 1):
                    least[digest] = i
            state = [NAMELESS if i is None else DECIDED if i > least[d] else ASK for i, d in zip(ids, digests)]
            masks = [m | E if s == DECIDED else m for m, s in zip(masks, state)]
            own = [(int(d[:15], 16) + n * (s != ASK)) % keys for n, (d, s) in enumerate(zip(digests, state))]
            columns = (own, digests, [i or 0 for i in ids], b.column("part"), masks, state)
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(columns, _MARKED)], schema=_MARKED)
    return run


def _update(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Counts the rows of the key's texts, and moves the smallest ids; a text's state is its smallest id and that id's parts."""
    texts = json.loads(state.get[0]) if state.exists else {}
    changes = []  # doc_id, part, mask, delta
    for frame in frames:
        for digest, i, part, mask, s in zip(*[frame[c].tolist() for c in ("digest", "doc_id", "part", "mask", "state")]):
            if s != ASK:
                changes.append((i if s == DECIDED else None, part, mask, 1))
                continue
            smallest, parts = texts.get(digest, (None, {}))
            if smallest is not None and i > smallest:
                changes.append((i, part, mask | E, 1))
                continue
            if smallest is None or i < smallest:  # the earlier rows have a predecessor now
                for p, n in parts.items():
                    changes += [(smallest, p, mask, -n), (smallest, p, mask | E, n)]
                parts = {}
            parts[part] = parts.get(part, 0) + 1
            texts[digest] = (i, parts)
            changes.append((i, part, mask, 1))
    state.update((json.dumps(texts),))
    ids, parts, masks, deltas = zip(*changes)
    yield pd.DataFrame({"doc_id": pd.array(ids, "Int64"), "part": parts, "mask": np.array(masks, "int32"), "delta": np.array(deltas, "int64")})


def _labelled(labels: DataFrame) -> DataFrame:
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    return scratch.save(marks.agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")), "labelled")


def _stream(spark: SparkSession, path: str, batches: int) -> DataFrame:
    """The files of a Parquet table as a stream of about ``batches`` micro-batches; the table may be one file."""
    table = spark.read.parquet(path)
    files = len(table.inputFiles())
    reader = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", max(1, -(-files // batches)))
    name = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if name.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(name).isFile():
        return reader.option("pathGlobFilter", name.getName()).parquet(name.getParent().toString())
    return reader.parquet(path)


def count_masks(spark: SparkSession, path: str, labels: DataFrame, batches: int = BATCHES) -> DataFrame:
    """Runs the stream over the Parquet files at ``path``: part, mask, rows, good (quality 1) and toxic (1)."""
    scratch.prepare(spark)
    base = f"{scratch.root(spark)}/filter-audit-{uuid.uuid4().hex}"
    marks = _labelled(labels)
    rows = _stream(spark, path, batches).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                                                F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"))
    keys = max(1, -(-spark.read.parquet(path).count() // TEXTS))  # from the files' row counts
    marked = rows.mapInArrow(_marked(keys), "key long, digest string, doc_id long, part string, mask int, state int")
    changes = marked.groupBy("key").applyInPandasWithState(_update, _CHANGE, _STATE, "update", GroupStateTimeout.NoTimeout)

    def write(batch: DataFrame, epoch: int) -> None:
        each = batch.groupBy("doc_id", "part", "mask").agg(F.sum("delta").alias("delta")).where("delta <> 0")
        both = each.join(marks, "doc_id", "left")
        sums = [F.sum(F.col("delta") * c).alias(n) for c, n in ((F.lit(1), "n"), (F.coalesce("good", F.lit(0)), "good"), (F.coalesce("toxic", F.lit(0)), "toxic"))]
        both.groupBy("part", "mask").agg(*sums).write.mode("overwrite").parquet(f"{base}/counters/epoch={epoch}")

    spark.createDataFrame([], "part string, mask int, n long, good long, toxic long").write.parquet(f"{base}/counters/epoch=-1")
    query = (changes.writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", f"{base}/checkpoint")
             .trigger(availableNow=True).start())
    query.awaitTermination()
    counted = spark.read.parquet(f"{base}/counters")
    return counted.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])


def orders(counters: DataFrame) -> DataFrame:
    """What every step of every order of the filters does in each part, from its counts of masks (at most 32)."""
    cells = counters.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    every = F.split(F.lit(" ".join("".join(p) for p in permutations(FILTERS))), " ")
    rows = cells.withColumn("filter_order", F.explode(every)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    letter = F.substr("filter_order", F.col("step"), F.lit(1))
    earlier = F.substr("filter_order", F.lit(1), F.col("step") - 1)
    rows = rows.withColumn("own", sum(F.when(letter == f, 1 << i).otherwise(0) for i, f in enumerate(FILTERS)))
    rows = rows.withColumn("earlier", sum(F.when(F.contains(earlier, F.lit(f)), 1 << i).otherwise(0) for i, f in enumerate(FILTERS)))

    def total(holds, value):
        return F.aggregate("cells", F.lit(0).cast("long"), lambda s, c: s + F.when(holds(c["mask"]), value(c)).otherwise(0).cast("long"))

    own, past = F.col("own"), F.col("earlier")

    def fails(m):
        return m.bitwiseAND(own) != 0

    def gone(m):
        return m.bitwiseAND(past) != 0

    out = {"kept": total(lambda m: ~fails(m) & ~gone(m), lambda c: c["n"]),
           "removed": total(lambda m: fails(m) & ~gone(m), lambda c: c["n"]),
           "redundant": total(lambda m: fails(m) & gone(m), lambda c: c["n"]),
           "unique_fails": total(lambda m: m == own, lambda c: c["n"]),
           "good_lost": total(lambda m: fails(m) & ~gone(m), lambda c: c["good"]),
           "toxic_lost": total(lambda m: fails(m) & ~gone(m), lambda c: c["toxic"]),
           # of a mask's k filters each comes first in 120 / k orders
           "shapley": total(fails, lambda c: c["n"] * F.call_function("div", F.lit(120), F.greatest(F.bit_count(c["mask"]), F.lit(1))))}
    return rows.select("part", "filter_order", "step", *[v.alias(k) for k, v in out.items()])


def audit(spark: SparkSession, path: str, labels: DataFrame, batches: int = BATCHES) -> DataFrame:
    return orders(count_masks(spark, path, labels, batches))
