"""Operator 7: global removal of repeated multi-line chunks with content-defined boundaries.

Every line is hashed; a rolling hash over the last ROLL line hashes of a text ends a chunk where the window is full and
the hash 0 modulo DIVISOR, so boundaries depend on the nearby lines alone and shift with them. A chunk of at least two lines (one of them
with a word) that occurs elsewhere, in this text or another, is removed everywhere but at its first place: the least
(doc_id, chunk number), null doc_ids last. That is ``line_dedup`` and ``remove_repeated``.

``passage_dedup`` and ``remove_passages`` also find what has no chunk of its own: any run of whole lines with RUN_WORDS
words or more, one line or many, whose bytes stand in the same order elsewhere. For each line with a word they compare the
shortest run of RUN_WORDS words that begins there and the shortest that ends there, besides the chunks; each longer run
is the union of such runs, so a match grows line by line to both sides as far as its lines agree. Blank lines at its two ends
stay. Of a run the first place by (doc_id, text hash, line) is kept; each line that goes has an earlier equal line, so none
is lost everywhere.

Candidates are found by chunk hash, with counts combined before the shuffle; the chunks with a shared hash are then
grouped by hash and bytes, so only chunks whose bytes are equal count as repeated. Hot chunks are combined before the
shuffle too, and rows meet their chunk's first place in a join, which Spark splits where it is skewed.

Null texts have no lines and stay null, empty texts stay empty. Rows that repeat a doc_id are one document: a chunk that
is kept in one of them is kept in all. Rows with a null doc_id lose nothing and give no first place. Other columns are kept
by ``remove_repeated``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from journeyline.llm import scratch, textkit

ROLL = 2
DIVISOR = 3
RUN_WORDS = 50
_SEED = 17


def _lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """For each line: row, first byte, end byte, number in its row, hash, whether it is its row's last."""
    rows = len(offsets) - 1
    breaks = np.flatnonzero(data == 10)
    first = np.sort(np.concatenate((offsets[:-1], breaks + 1)))
    # a text of k line breaks has k + 1 lines; the line after a row's last break starts at its end
    row = np.repeat(np.arange(rows), 1 + np.searchsorted(breaks, offsets[1:]) - np.searchsorted(breaks, offsets[:-1]))
    ends_row = np.append(row[1:] != row[:-1], True) if len(row) else np.zeros(0, bool)
    last = np.where(ends_row, offsets[row + 1], np.append(first[1:], 0) - 1)
    # order lines by row: a row's empty last line and the next row's first line start at the same byte
    begin = np.where(np.append(True, row[1:] != row[:-1]) if len(row) else np.zeros(0, bool), offsets[row], np.append(0, last[:-1] + 1))
    number = np.arange(len(row)) - np.searchsorted(row, row, "left")
    return row, begin, last, number, textkit.word_hashes(data, begin, last), ends_row


def chunks(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """For each chunk: row, number in its row, first line, lines, first byte, end byte, hash, whether it has a word."""
    row, begin, last, number, h, ends_row = _lines(data, offsets)
    rolled = h.copy()
    for k in range(1, ROLL):
        rolled ^= textkit.mix(np.concatenate((np.zeros(k, np.uint64), h[:-k])), k)
    # only full windows choose a boundary, so the lines around a passage change its first and last chunk at most
    cut = ((textkit.mix(rolled, _SEED) % np.uint64(DIVISOR) == 0) & (number >= ROLL - 1)) | ends_row
    stop = np.flatnonzero(cut)
    start = np.concatenate(([0], stop[:-1] + 1)) if len(stop) else stop
    s, e = begin[start], last[stop]
    word_start, _, _ = textkit.words(data, offsets)
    worded = np.searchsorted(word_start, e) > np.searchsorted(word_start, s)
    owner = row[start]
    nth = np.arange(len(start)) - np.searchsorted(owner, owner, "left")
    return owner, nth, number[start], stop - start + 1, s, e, textkit.word_hashes(data, s, e), worded


def runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """For each run of lines to compare: row, first line, lines, first byte, end byte, hash; see the module's text."""
    row, begin, last, number, h, _ = _lines(data, offsets)
    word_start, _, _ = textkit.words(data, offsets)
    before = np.searchsorted(word_start, begin)
    count = np.searchsorted(word_start, last) - before
    total = np.concatenate(([0], np.cumsum(count)))
    row_first, row_end = np.searchsorted(row, row, "left"), np.searchsorted(row, row, "right")
    worded = np.flatnonzero(count > 0)
    to = np.searchsorted(total, total[worded] + RUN_WORDS, "left")
    fits = to <= row_end[worded]
    since = np.searchsorted(total, total[worded + 1] - RUN_WORDS, "right") - 1
    holds = since >= row_first[worded]
    owner, _, first, lines, _, _, _, has_word = chunks(data, offsets)
    keep = (lines > 1) & has_word
    at = np.searchsorted(row, owner[keep], "left") + first[keep]
    i = np.concatenate((worded[fits], since[holds], at))
    j = np.concatenate((to[fits], worded[holds] + 1, at + lines[keep]))
    i, j = np.divmod(np.unique(i * (len(row) + 1) + j), len(row) + 1)
    return row[i], number[i], j - i, begin[i], last[j - 1], textkit.span_hash(h, i, j, textkit.WORD_BASE)


_CHUNK = "doc_id long, nth int, first_line int, n_lines int, hash long"


def _chunked(with_bytes: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, rows, data, offsets in textkit.pieces(batch.column(1)):
                owner, nth, first, lines, s, e, h, worded = chunks(data, offsets)
                keep = np.flatnonzero((lines > 1) & worded)
                out = [batch.column(0).slice(i, rows).take(pa.array(owner[keep])), pa.array(nth[keep].astype(np.int32)), pa.array(first[keep].astype(np.int32)),
                       pa.array(lines[keep].astype(np.int32)), pa.array(h[keep].view(np.int64))]
                names = ["doc_id", "nth", "first_line", "n_lines", "hash"]
                if with_bytes:
                    raw = data.tobytes()
                    out.append(pa.array([raw[a:b] for a, b in zip(s[keep], e[keep])], pa.binary()))
                    names.append("chunk")
                yield pa.RecordBatch.from_arrays(out, names)

    return run


def repeated_chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, nth, first_line, n_lines, kept_doc, kept_nth): every chunk occurrence to remove, and where it is kept."""
    scratch.prepare(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).where("doc_id is not null")
    place = F.struct("doc_id", "nth")
    ends = texts.mapInArrow(_chunked(False), _CHUNK).groupBy("hash").agg(F.min(place).alias("low"), F.max(place).alias("high"))
    shared = scratch.save(ends.where("low <> high").select("hash"), "hashes")
    # the bytes of those chunks alone; merge joins at every size, as these tables grow with the documents
    found = scratch.save(texts.mapInArrow(_chunked(True), _CHUNK + ", chunk binary").join(shared.hint("merge"), "hash"), "chunks")
    same = found.groupBy("hash", "chunk").agg(F.min(place).alias("kept"), F.max(place).alias("high")).where("kept <> high")
    # stored, so that the join deals both sides out itself and can split a hot chunk
    same = scratch.save(same.select(F.col("hash").alias("h"), F.col("chunk").alias("c"), "kept"), "kept")
    return (found.join(same.hint("merge"), (F.col("hash") == F.col("h")) & (F.col("chunk") == F.col("c"))).where("not (doc_id = kept.doc_id and nth = kept.nth)")
            .select("doc_id", "nth", "first_line", "n_lines", F.col("kept.doc_id").alias("kept_doc"), F.col("kept.nth").alias("kept_nth")).distinct())


def _with_spans(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``row`` (all columns), doc_id, text, spans: the lines to remove from each text."""
    spans = (repeated_chunks(docs, id_col, text_col).groupBy("doc_id")
             .agg(F.array_sort(F.collect_list(F.struct("first_line", "n_lines", "kept_doc", "kept_nth"))).alias("spans"))
             .withColumnRenamed("doc_id", "its_id"))
    spans = scratch.save(spans, "spans")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text"))
    return rows.join(spans.hint("merge"), F.col("doc_id") == F.col("its_id"), "left")


def _cleaned() -> Column:
    """The text without the lines of ``spans``, in time linear in its lines: numbers are told apart by hash, lines split once."""
    gone = F.flatten(F.transform("spans", lambda s: F.sequence(s["first_line"], s["first_line"] + s["n_lines"] - 1)))

    def without(lines: Column) -> Column:
        kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
        return F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")

    # a lambda's variable is worked out once; a plain column would be split again for each line
    clean = F.transform(F.array(F.split("text", "\n", -1)), without)[0]
    return F.when(F.col("spans").isNull(), F.col("text")).otherwise(clean)


def _measured(rows: DataFrame) -> DataFrame:
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.regexp_count("text", F.lit("\n")) + 1)
    return rows.select("doc_id", n_lines.cast("long").alias("n_lines"), F.coalesce(F.size("spans"), F.lit(0)).cast("long").alias("n_removed_chunks"),
                       F.coalesce(F.aggregate("spans", F.lit(0), lambda a, s: a + s["n_lines"]), F.lit(0)).cast("long").alias("n_removed_lines"),
                       "spans", _cleaned().alias("clean_text"))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_lines, n_removed_chunks, n_removed_lines, spans, clean_text for every row."""
    return _measured(_with_spans(docs, id_col, text_col))


def remove_repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, with the repeated chunks gone from the text."""
    rows = _with_spans(docs, id_col, text_col)
    return rows.select(*[(_cleaned() if c == text_col else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


_RUN = "doc_id long, its_key long, first_line int, n_lines int, hash long"
_SPAN = pa.struct([("first_line", pa.int32()), ("n_lines", pa.int32()), ("kept_doc", pa.int64()), ("kept_line", pa.int32())])


def _run_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, rows, data, offsets in textkit.pieces(batch.column(2)):
            owner, first, lines, _, _, h = runs(data, offsets)
            own = [batch.column(k).slice(i, rows).take(pa.array(owner)) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*own, pa.array(first.astype(np.int32)), pa.array(lines.astype(np.int32)), pa.array(h.view(np.int64))],
                                             ["doc_id", "its_key", "first_line", "n_lines", "hash"])


def _run_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the runs that a text's ``wanted`` column names."""
    for batch in batches:
        for i, rows, data, offsets in textkit.pieces(batch.column(2)):
            raw = data.tobytes()
            row, begin, last, _, _, _ = _lines(data, offsets)
            wanted = batch.column(3).slice(i, rows)
            owner = np.repeat(np.arange(rows), wanted.value_lengths().to_numpy())
            flat = wanted.flatten()
            at = np.searchsorted(row, owner, "left") + flat.field(0).to_numpy()
            end = at + flat.field(1).to_numpy()
            own = [batch.column(k).slice(i, rows).take(pa.array(owner)) for k in (0, 1)]
            step = 1 + (1 << 20) // max(1, int((last[end - 1] - begin[at]).max(initial=0)))  # runs overlap: batches of about 1 MB
            for k in range(0, len(at), step):
                cut = slice(k, k + step)
                yield pa.RecordBatch.from_arrays(
                    [*[c.slice(k, step) for c in (*own, flat.field(0), flat.field(1), flat.field(2))],
                     pa.array([raw[a:b] for a, b in zip(begin[at[cut]], last[end[cut] - 1])], pa.binary())],
                    ["doc_id", "its_key", "first_line", "n_lines", "hash", "chunk"])


def disjoint(found: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """(first line, lines, kept doc, kept line) of overlapping runs -> the same lines in runs as long as they can be, each line once."""
    joined: list[list[int]] = []
    for first, n, doc, line in sorted(found, key=lambda x: (x[2], x[3] - x[0], x[0])):
        top = joined[-1] if joined else None
        if top and top[2] == doc and top[3] - top[0] == line - first and first <= top[0] + top[1]:
            top[1] = max(top[1], first + n - top[0])
        else:
            joined.append([first, n, doc, line])
    out, done = [], 0
    for first, n, doc, line in sorted(joined, key=lambda x: (x[0], -x[1], x[2], x[3])):
        over = max(0, done - first)
        if n > over:
            out.append((first + over, n - over, doc, line + over))
            done = first + n
    return out


def _disjoint_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = [[dict(zip(("first_line", "n_lines", "kept_doc", "kept_line"), s)) for s in disjoint([tuple(x.values()) for x in found])]
                 for found in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(lists, pa.list_(_SPAN))], ["its_id", "its_key", "spans"])


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, its_key, first_line, n_lines, kept_doc, kept_line): every run to remove and where it is kept; runs overlap."""
    scratch.prepare(docs.sparkSession)
    text = F.col(text_col).cast("string")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("its_key"), text.alias("text")).where("doc_id is not null and text is not null")
    every = texts.mapInArrow(_run_rows, _RUN)
    place = ("doc_id", "its_key", "first_line")
    ends = every.groupBy("hash").agg(*[f(c).alias(f"{f.__name__}_{c}") for c in place for f in (F.min, F.max)])
    # merge joins at every size, as these tables grow with the documents; stored, so that a join can split a hot run
    shared = scratch.save(ends.where(" or ".join(f"min_{c} <> max_{c}" for c in place)).select("hash"), "hashes")
    wanted = (every.join(shared.hint("merge"), "hash").groupBy(F.col("doc_id").alias("d"), F.col("its_key").alias("k"))
              .agg(F.collect_set(F.struct("first_line", "n_lines", "hash")).alias("wanted")))
    wanted = scratch.save(wanted, "wanted")
    found = texts.join(wanted.hint("merge"), (F.col("doc_id") == F.col("d")) & (F.col("its_key") == F.col("k"))).select("doc_id", "its_key", "text", "wanted")
    found = scratch.save(found.mapInArrow(_run_bytes, _RUN + ", chunk binary"), "runs")
    at = F.struct(*place)
    same = found.groupBy("hash", "chunk").agg(F.min(at).alias("kept"), F.max(at).alias("high")).where("kept <> high")
    same = scratch.save(same.select(F.col("hash").alias("h"), F.col("chunk").alias("c"), "kept"), "kept")
    return (found.join(same.hint("merge"), (F.col("hash") == F.col("h")) & (F.col("chunk") == F.col("c")))
            .where("not (doc_id = kept.doc_id and its_key = kept.its_key and first_line = kept.first_line)")
            .select(*place, "n_lines", F.col("kept.doc_id").alias("kept_doc"), F.col("kept.first_line").alias("kept_line")))


def _with_run_spans(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``row`` (all columns), doc_id, text, spans: the lines to remove from each text, none twice."""
    found = (repeated_runs(docs, id_col, text_col).groupBy("doc_id", "its_key")
             .agg(F.collect_set(F.struct("first_line", "n_lines", "kept_doc", "kept_line")).alias("found")))
    spans = scratch.save(found.mapInArrow(_disjoint_rows, "its_id long, its_key long, spans array<struct<first_line:int,n_lines:int,kept_doc:long,kept_line:int>>"), "spans")
    text = F.col(text_col).cast("string")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).cast("long").alias("doc_id"), text.alias("text"),
                       F.xxhash64(text).alias("own_key"))
    return rows.join(spans.hint("merge"), (F.col("doc_id") == F.col("its_id")) & (F.col("own_key") == F.col("its_key")), "left")


def passage_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The columns of ``line_dedup``, with all repeated runs gone; spans name the line at which a run is kept."""
    return _measured(_with_run_spans(docs, id_col, text_col))


def remove_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, with the repeated runs gone from the text."""
    rows = _with_run_spans(docs, id_col, text_col)
    return rows.select(*[(_cleaned() if c == text_col else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
