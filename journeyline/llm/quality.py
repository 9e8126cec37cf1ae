"""Operator 4: quality rules with zstandard compression bands.

Counted base rules reject short and repetitive texts. The bands compare bytes before and after zstandard over the
whole text and over each fixed chunk of CHUNK bytes: a ratio above a band's upper limit marks repetition, one below
its lower limit incompressible noise (keys, encoded binaries). The limits depend on the number of bytes, as short
inputs compress less: base64 (ratios to 1.15 at 256 bytes, 1.33 in long texts) is below its limit from 256 bytes on,
hexadecimal (1.95 at 16 KB, 2.0 in long texts) from 16 KB on, where prose reaches 2.1 and more. A text is rejected when the whole is outside its band, or when more than CHUNK_PERCENT of its
chunks are outside theirs.

Null, empty and blank texts have no words and fail the base rules. Every row is returned once, repeated rows as often
as they come, null doc_ids too; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from journeyline.llm import scratch, textkit

MIN_WORDS = 50
CHUNK = 4096
CHUNK_PERCENT = 25
LEVEL = 3
#: (bytes from which it holds, least ratio, greatest ratio)
BANDS = ((0, 0.0, 3.0), (256, 1.16, 3.5), (512, 1.27, 3.5), (1024, 1.35, 4.0), (4096, 1.4, 4.5), (16384, 1.98, 4.5), (32768, 2.03, 5.0))
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True

SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "ratio double, n_chunks long, n_odd_chunks long, in_band boolean")


def limits(size: int) -> tuple[float, float]:
    return next((low, high) for least, low, high in reversed(BANDS) if size >= least)


def _ratio(raw: bytes, packer: zstandard.ZstdCompressor) -> tuple[float, bool]:
    if not raw:
        return 0.0, True
    ratio = len(raw) / len(packer.compress(raw))
    low, high = limits(len(raw))
    return ratio, low <= ratio <= high


def compression(raw: bytes, packer: zstandard.ZstdCompressor) -> tuple[float, int, int, bool]:
    """Whole ratio, chunks, chunks outside their band, and whether the text is within its bands."""
    ratio, good = _ratio(raw, packer)
    chunks = [raw[i:i + CHUNK] for i in range(0, len(raw), CHUNK)] if len(raw) > CHUNK else []
    odd = sum(not _ratio(c, packer)[1] for c in chunks)
    return ratio, len(chunks), odd, good and 100 * odd <= CHUNK_PERCENT * len(chunks)


def per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags)))
    return total[offsets[1:]] - total[offsets[:-1]]


def repeated_words(hashes: np.ndarray, row: np.ndarray, rows: int, size: int = 3) -> np.ndarray:
    """Words of each row that lie in a ``size``-word window that the row holds twice or more."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(rows, np.int64)
    start = np.flatnonzero(row[:n] == row[size - 1:])
    h = textkit.span_hash(hashes, start, start + size, textkit.WORD_BASE)
    order = np.lexsort((h, row[start]))
    r, h = row[start][order], h[order]
    same = (r[1:] == r[:-1]) & (h[1:] == h[:-1])
    twice = np.zeros(len(h), bool)
    twice[1:] |= same
    twice[:-1] |= same
    hit = np.zeros(len(hashes) + 1, np.int64)
    at = start[order][twice]
    np.add.at(hit, at, 1)
    np.add.at(hit, at + size, -1)
    return np.bincount(row[np.cumsum(hit[:-1]) > 0], minlength=rows)


def duplicate_lines(data: np.ndarray, offsets: np.ndarray, word_start: np.ndarray) -> np.ndarray:
    """Lines with a word that equal an earlier line of their text."""
    rows = len(offsets) - 1
    breaks = np.flatnonzero(data == 10)
    first = np.union1d(offsets[:-1], breaks + 1)
    first = first[first < len(data)]
    last = np.minimum(np.append(first[1:], len(data)), len(data))
    ends_with_break = data[last - 1] == 10 if len(data) else np.zeros(0, bool)
    last = last - ends_with_break
    has = np.searchsorted(word_start, last) > np.searchsorted(word_start, first)
    first, last = first[has], last[has]
    row = np.searchsorted(offsets, first, "right") - 1
    h = textkit.word_hashes(data, first, last)
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    again = np.zeros(len(h), bool)
    again[1:] = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
    return np.bincount(row[again], minlength=rows)


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    packer = zstandard.ZstdCompressor(level=LEVEL)
    for batch in batches:
        for i, rows, data, offsets in textkit.pieces(batch.column(1)):
            s, e, row = textkit.words(data, offsets)
            points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
            chars = np.bincount(row, weights=points[e] - points[s], minlength=rows)
            raw = data.tobytes()
            bands = [compression(raw[x:y], packer) for x, y in zip(offsets[:-1], offsets[1:])]
            ratio, chunks, odd, good = zip(*bands)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(i, rows), pa.array(np.bincount(row, minlength=rows)), pa.array(chars.astype(np.int64)),
                 pa.array(per_row(_SYMBOL[data], offsets)), pa.array(duplicate_lines(data, offsets, s)),
                 pa.array(repeated_words(textkit.word_hashes(data, s, e), row, rows)),
                 pa.array(ratio, pa.float64()), pa.array(chunks, pa.int64()), pa.array(odd, pa.int64()), pa.array(good)],
                ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "ratio", "n_chunks", "n_odd_chunks", "in_band"])


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the counts, the compression figures, base_failed and kept."""
    scratch.prepare(docs.sparkSession)
    measured = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(_measure, SCHEMA)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return measured.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & F.col("in_band"))


def filter_quality(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose text passes. One pass, no shuffle."""
    scratch.prepare(docs.sparkSession)
    at = docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = pa.array(np.arange(batch.num_rows))
            for m in _measure([pa.RecordBatch.from_arrays([ids, batch.column(at)], ["doc_id", "text"])]):
                n, again = np.asarray(m.column(1)), np.asarray(m.column(5))
                good = (n >= MIN_WORDS) & (100 * again <= 50 * n) & np.asarray(m.column(9))
                rows = batch.slice(m.column(0)[0].as_py(), m.num_rows).filter(pa.array(good))
                if rows.num_rows:
                    yield rows

    return docs.mapInArrow(keep, docs.schema)
