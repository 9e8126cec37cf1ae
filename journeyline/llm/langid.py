"""Operator 9: language identification by segmentation-marginalised unigrams.

The pieces are those of a fixed public vocabulary (a sentencepiece model file, a parameter; nothing is trained on it)
of at most LONGEST bytes, with all single bytes, so that every word has a segmentation. A word is taken with the
vocabulary's word-start mark; runs of more than CUT bytes are scored in cuts of CUT bytes.

Learning. For each language, every training text's words pass once through the forward-backward algorithm with equal
piece probabilities; a piece's expected number of uses over all segmentations, smoothed, gives its probability. The
counts cover all training rows and are summed by Spark; what comes to the driver is one number for each language and
piece of the vocabulary. Scoring. The forward algorithm sums the probabilities of all segmentations of each word,
under each language; a text's score is the product over its words, and ``score`` the posterior of the best language.

Rows whose crc32 of the doc_id (as text) is divisible by 5, or whose doc_id or lang is null, are not learned from.
A null text or one without a letter gives ``und`` with score 0, as does everything if nothing was learned. Ties go to
the first language in code point order. Repeated rows are scored each; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from journeyline.llm import scratch, textkit

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
LONGEST, CUT = 16, 32
SMOOTH = 0.1
SCALE = 1e3  # per byte: keeps the sums of a cut far from underflow
KEPT_WORDS = 1 << 19
AT_ONCE = 1 << 15
TEST_FOLD, FOLDS = 0, 5
_SLOTS = 20
_MARK = "▁"


class Pieces:
    """Pieces as byte strings, found by the hash of a span of text in two direct-address tables."""

    def __init__(self, pieces: list[bytes]):
        self.pieces = sorted({bytes([b]) for b in range(256)} | {p for p in pieces if 0 < len(p) <= LONGEST})
        data = np.frombuffer(b"".join(self.pieces), np.uint8)
        ends = np.cumsum([len(p) for p in self.pieces])
        starts = ends - np.array([len(p) for p in self.pieces])
        self.hashes = textkit.word_hashes(data, starts, ends)
        self.lengths = ends - starts
        self.tables = [np.full(1 << _SLOTS, -1, np.int32) for _ in range(3)]
        for i, h in enumerate(self.hashes.tolist()):
            for k, table in enumerate(self.tables):
                slot = h >> (k * _SLOTS) & (1 << _SLOTS) - 1
                if table[slot] < 0:
                    table[slot] = i
                    break
            else:
                raise ValueError("no free slot for a piece")

    def find(self, hashes: np.ndarray) -> np.ndarray:
        out = np.full(len(hashes), -1, np.int32)
        rest = np.arange(len(hashes))
        for k, table in enumerate(self.tables):  # an empty slot ends the search, as a piece takes its first free one
            h = hashes[rest]
            got = table[(h >> np.uint64(k * _SLOTS)).astype(np.int64) & (1 << _SLOTS) - 1]
            taken = np.flatnonzero(got >= 0)
            same = self.hashes[got[taken]] == h[taken]
            out[rest[taken[same]]] = got[taken[same]]
            rest = rest[taken[~same]]
        return out


def vocabulary(path: str = VOCABULARY) -> list[bytes]:
    """The model's pieces as bytes, the word-start mark as a space; control and byte pieces are left out."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    return [model.id_to_piece(i).replace(_MARK, " ").encode() for i in plain]


class Words:
    """The words of a batch of texts: every occurrence's row, and each distinct word's key, bytes (with mark) and size."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        start, end, row = textkit.words(data, offsets)
        cuts = -(-(end - start) // CUT)
        owner = np.repeat(np.arange(len(start)), cuts)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
        s = start[owner] + nth * CUT
        e = np.minimum(s + CUT, end[owner])
        self.row = row[owner]
        key = textkit.word_hashes(data, s, e) ^ (nth == 0).astype(np.uint64)
        self.keys, first, self.word = np.unique(key, return_index=True, return_inverse=True)
        self._data, self._start, self._mark = data, s[first], (nth[first] == 0).astype(np.int64)
        self.size = e[first] - self._start + self._mark

    def spelled(self, which: np.ndarray) -> np.ndarray:
        """The bytes of the words ``which``, one after the other; a word's start is marked by a space."""
        size, mark = self.size[which], self._mark[which]
        inside = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        at = np.repeat(self._start[which] - mark, size) + inside
        if not len(at):
            return np.zeros(0, np.uint8)
        return np.where((inside == 0) & (np.repeat(mark, size) == 1), 32, self._data[np.maximum(at, 0)]).astype(np.uint8)


class Lattice:
    """Words, longest first (``order``), with the pieces that fit at each of their bytes."""

    def __init__(self, pieces: Pieces, flat: np.ndarray, size: np.ndarray):
        self.order = np.argsort(-size, kind="stable")
        start = np.cumsum(size) - size
        self.size = size[self.order]
        self.base = start[self.order]
        total = len(flat)
        left = np.repeat(start + size, size) - np.arange(total)
        up, down = textkit._powers(textkit.BYTE_BASE, total + 1)
        prefix = np.zeros(total + 1, np.uint64)
        np.cumsum((flat.astype(np.uint64) + np.uint64(1)) * up[:total], out=prefix[1:])
        self.fits: list[np.ndarray] = []  # for each length: the piece that starts at a byte, or -1
        for n in range(1, LONGEST + 1):
            found = np.full(total, -1, np.int32)
            p = np.flatnonzero(left >= n)
            if len(p):
                found[p] = pieces.find(textkit.mix((prefix[p + n] - prefix[p]) * down[p] + np.uint64(n)))
            self.fits.append(found)

    def _steps(self, d: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For words of at least d bytes: (length, words, piece) of the pieces that end at byte d."""
        active = int(np.searchsorted(-self.size, -d, "right"))
        for n in range(1, min(d, LONGEST) + 1):
            piece = self.fits[n - 1][self.base[:active] + d - n]
            w = np.flatnonzero(piece >= 0)
            if len(w):
                yield n, w, piece[w]

    def forward(self, probability: np.ndarray) -> np.ndarray:
        """Scaled sums (words, bytes + 1, languages); ``probability`` is (pieces, languages) and scaled."""
        longest = int(self.size[0]) if len(self.size) else 0
        alpha = np.zeros((longest + 1, len(self.size), probability.shape[1]))
        alpha[0] = 1
        for d in range(1, longest + 1):
            for n, w, piece in self._steps(d):
                alpha[d, w] += alpha[d - n, w] * probability[piece]
        return alpha

    def log_scores(self, probability: np.ndarray) -> np.ndarray:
        alpha = self.forward(probability)
        last = alpha[self.size, np.arange(len(self.size))] if len(self.size) else np.zeros((0, probability.shape[1]))
        return np.log(last) - self.size[:, None] * np.log(SCALE)

    def expected(self, weight: np.ndarray, pieces: Pieces) -> np.ndarray:
        """Expected uses of each piece over all segmentations, all pieces being equally likely; (pieces, columns of weight)."""
        flat = np.power(SCALE, pieces.lengths)[:, None] / len(pieces.pieces)
        alpha = self.forward(flat)[:, :, 0]
        beta = np.zeros_like(alpha)
        words = np.arange(len(self.size))
        out = np.zeros((len(pieces.pieces), weight.shape[1]))
        if not len(words):
            return out
        beta[self.size, words] = 1
        z = alpha[self.size, words]
        used = []
        for d in range(int(self.size[0]), 0, -1):
            for n, w, piece in self._steps(d):
                after = flat[piece, 0] * beta[d, w]
                beta[d - n, w] += after
                used.append((piece, w, alpha[d - n, w] * after / z[w]))
        piece, w, use = (np.concatenate(x) for x in zip(*used))
        for k in range(weight.shape[1]):
            out[:, k] = np.bincount(piece, weights=use * weight[w, k], minlength=len(out))
        return out


class Scores:
    """Log scores of words under each language; those of the last words met are kept, up to KEPT_WORDS."""

    def __init__(self, pieces: Pieces, probability: np.ndarray):
        self.pieces, self.scaled = pieces, probability * np.power(SCALE, pieces.lengths)[:, None]
        self.keys, self.logs = np.zeros(0, np.uint64), np.zeros((0, probability.shape[1]))

    def of(self, words: Words) -> np.ndarray:
        """(distinct words of the batch, languages)."""
        at = np.searchsorted(self.keys, words.keys)
        known = np.zeros(len(words.keys), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == words.keys[inside]
        out = np.empty((len(words.keys), self.logs.shape[1]))
        out[known] = self.logs[at[known]]
        new = np.flatnonzero(~known)
        if len(new):
            lattice = Lattice(self.pieces, words.spelled(new), words.size[new])
            out[new[lattice.order]] = lattice.log_scores(self.scaled)
            if len(self.keys) + len(new) > KEPT_WORDS:
                self.keys, self.logs = words.keys, out.copy()
            else:
                self.keys, self.logs = np.insert(self.keys, at[new], words.keys[new]), np.insert(self.logs, at[new], out[new], axis=0)
        return out


class Uses:
    """Expected uses of each piece for each language; words are gathered with their counts and worked off together."""

    def __init__(self, pieces: Pieces):
        self.pieces, self.langs, self.sums = pieces, [], np.zeros((len(pieces.pieces), 0))
        self._clear()

    def _clear(self) -> None:
        self.keys, self.place, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros((0, len(self.langs)))
        self.flat, self.size = [], []

    def add(self, words: Words, lang_of_row: list[str]) -> None:
        for name in set(lang_of_row) - set(self.langs):
            self.langs.append(name)
            self.sums = np.column_stack([self.sums, np.zeros(len(self.sums))])
            self.counts = np.column_stack([self.counts, np.zeros(len(self.counts))])
        code = np.array([self.langs.index(x) for x in lang_of_row])
        n, wide = len(words.keys), len(self.langs)
        counts = np.bincount(words.word * wide + code[words.row], minlength=n * wide).reshape(n, wide).astype(float)
        at = np.searchsorted(self.keys, words.keys)
        known = np.zeros(n, bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == words.keys[inside]
        self.counts[self.place[at[known]]] += counts[known]
        new = np.flatnonzero(~known)
        self.flat.append(words.spelled(new))
        self.size.append(words.size[new])
        self.keys = np.insert(self.keys, at[new], words.keys[new])
        self.place = np.insert(self.place, at[new], len(self.counts) + np.arange(len(new)))
        self.counts = np.vstack([self.counts, counts[new]])
        if len(self.keys) > KEPT_WORDS // 4:
            self.work_off()

    def work_off(self) -> None:
        size = np.concatenate(self.size) if self.size else np.zeros(0, np.int64)
        flat = np.concatenate(self.flat) if self.flat else np.zeros(0, np.uint8)
        ends = np.cumsum(size)
        for i in range(0, len(size), AT_ONCE):
            j = min(i + AT_ONCE, len(size))
            lattice = Lattice(self.pieces, flat[ends[i] - size[i]:ends[j - 1]], size[i:j])
            self.sums += lattice.expected(self.counts[i:j][lattice.order], self.pieces)
        self._clear()


def fold(id_col: Column) -> Column:
    return F.crc32(id_col.cast("string").cast("binary")) % FOLDS


def learn(docs: DataFrame, vocab: list[bytes], id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages in code point order and their piece probabilities (pieces, languages)."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(vocab)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uses = Uses(Pieces(shared.value))
        for batch in batches:
            names = batch.column(0).to_pylist()
            for i, rows, data, offsets in textkit.pieces(batch.column(1)):
                uses.add(Words(data, offsets), names[i:i + rows])
        uses.work_off()
        for k, name in enumerate(uses.langs):
            used = np.flatnonzero(uses.sums[:, k])
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(used), pa.string()), pa.array(used.astype(np.int32)), pa.array(uses.sums[used, k])], ["lang", "piece", "uses"])

    rows = docs.where((fold(F.col(id_col)) != TEST_FOLD) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counts = rows.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")).mapInArrow(count, "lang string, piece int, uses double")
    # bounded by languages times pieces of the vocabulary
    got = counts.groupBy("lang", "piece").agg(F.sum(F.round("uses", 6).cast("decimal(38,6)")).cast("double").alias("uses")).toPandas()
    langs = sorted(got["lang"].unique())
    size = len(Pieces(vocab).pieces)
    table = np.full((size, len(langs)), SMOOTH)
    if langs:
        np.add.at(table, (got["piece"].to_numpy(), np.searchsorted(np.array(langs), got["lang"].to_numpy(str))), got["uses"].to_numpy())
    return langs, table / table.sum(axis=0, keepdims=True)


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray], vocab: list[bytes], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row."""
    scratch.prepare(docs.sparkSession)
    langs, probability = model
    shared = docs.sparkSession.sparkContext.broadcast((vocab, langs, probability))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab_, langs_, p = shared.value
        scores = Scores(Pieces(vocab_), p)
        for batch in batches:
            letters = np.asarray(batch.column(2).fill_null(False))
            for i, rows, data, offsets in textkit.pieces(batch.column(1)):
                total = np.zeros((rows, max(1, len(langs_))))
                if langs_:
                    words = Words(data, offsets)
                    each = scores.of(words)
                    for k in range(len(langs_)):
                        total[:, k] = np.bincount(words.row, weights=each[words.word, k], minlength=rows)
                best = total.argmax(axis=1)
                posterior = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
                known = letters[i:i + rows] & bool(langs_)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, rows), pa.array([langs_[b] if ok else "und" for b, ok in zip(best, known)], pa.string()),
                     pa.array(np.where(known, posterior, 0.0))], ["doc_id", "lang_pred", "score"])

    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), text.rlike("\\p{L}").alias("letters"))
    out = rows.mapInArrow(score, "doc_id long, lang_pred string, score double")
    return out.select("doc_id", F.coalesce(fold(F.col("doc_id")) == TEST_FOLD, F.lit(False)).alias("held_out"), "lang_pred", "score")


def language_id(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """Learn from the training folds of ``docs`` and identify all its rows."""
    scratch.prepare(docs.sparkSession)
    vocab = vocabulary(path)
    return identify(docs, learn(docs, vocab), vocab)
