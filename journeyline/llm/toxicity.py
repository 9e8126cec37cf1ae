"""Operator 5: toxicity by Levenshtein automata over a lexicon trie, with context-window scores.

Lexicon. SEEDS and terms learned from labelled training texts: whole words, and word beginnings of STEMS letters
(insults are often compounded), that toxic texts hold far more often than others, counted over all labelled training rows: those with LEAST_DOCS toxic
documents and log odds over 2, by odds times the root of that count, up to LEXICON_BYTES of terms. A word of more than
TERM_BYTES is no term (its stems are). With T trie nodes (at most 1 + the bytes of all terms), K terms, D = TERM_BYTES and
S distinct bytes, the state after some bytes depends on them alone, and they lie within one edit of a path of the trie
or past an accepted stem, so there are at most 2 + 2 K + T (1 + D + D S + (D + 1)(S + 1)) states. The terms form
a trie; intersecting it with the Levenshtein automata (one edit, for terms of EDIT_FROM bytes or more; shorter ones
exact) and determinising gives one table of transitions on bytes, which all words of a batch walk at once. A stem accepts
a word of which some beginning is within one edit of it. A stem stands for longer stems, never for a whole word. Edits are counted in bytes of the lower-cased word, so a letter outside ASCII counts as two.

Context. A hit within quotation marks, or with a reporting word among the WINDOW words on either side, counts for less;
one with a word of address there for more. The score is a logistic function of the weighted hits of each term, of all
hits and of their share of the words. Its weights alone are fitted to a bounded sample of SAMPLE labelled training rows, the
least by hash of the doc_id, around a prior that holds alone where there are no labels.

Rows whose crc32 of the doc_id (as text) is divisible by 5 or null are not learned from; labels, lang, source and
doc_id are not inputs of a score. Null and empty texts have no hits and get the score of that. A document with
several labels counts as toxic if one of them says so. Repeated rows are scored each; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from journeyline.llm import scratch, textkit
from journeyline.llm.langid import TEST_FOLD, fold

SEEDS = ("idiot", "moron", "stupid", "loser", "trash", "scum", "pathetic", "worthless", "disgusting", "clown", "imbecile", "vermin", "filth", "dumbass")
REPORTING = ("said", "says", "wrote", "writes", "quoted", "quote", "called", "according", "sagte", "schrieb", "dit", "dijo")
ADDRESS = ("you", "your", "youre", "ihr", "dich", "vous", "toi", "usted", "eres")
SAMPLE = 10_000
LEXICON_BYTES = 3072
TERM_BYTES = 32
LEAST_DOCS = 8
STEMS = (5, 6, 7)
EDIT_FROM = 5
WINDOW = 6
QUOTED, REPORTED, ADDRESSED = 0.35, 0.6, 1.4
PRIOR_BIAS, PRIOR_HITS = -2.5, 2.0
RIDGE = 0.05

_TOKEN = np.zeros(256, bool)
_TOKEN[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
_STEM = "*"
_WORD = "[a-z0-9\\x{C0}-\\x{1FFF}\\x{2080}-\\x{10FFFF}]+"


@dataclass
class Automaton:
    """``step[state, class of byte]``; state 0 is dead, 1 the start; ``whole``/``stem``: the term accepted, or -1; ``edits``."""

    step: np.ndarray
    classes: np.ndarray
    whole: np.ndarray
    edits: np.ndarray
    longest: int

    @staticmethod
    def build(terms: list[tuple[str, bool]], stem_edits: bool = False) -> Automaton:
        """``terms``: (word, whether it stands for all words that begin with it); ``stem_edits``: such terms take an edit, too."""
        children, ends = [{}], [(-1, -1)]  # the trie; term that ends here as a whole word, as a stem
        deep = [False]  # whether a term with edits lies below
        spelled = [t.encode() for t, _ in terms]
        terms_fuzzy = [(stem_edits or not stem) and len(w) >= EDIT_FROM for w, (_, stem) in zip(spelled, terms)]
        for k, (word, (_, stem)) in enumerate(zip(spelled, terms)):
            at, fuzzy = 0, terms_fuzzy[k]
            deep[0] |= fuzzy
            for b in word:
                if b not in children[at]:
                    children[at][b] = len(children)
                    children.append({})
                    ends.append((-1, -1))
                    deep.append(False)
                at = children[at][b]
                deep[at] |= fuzzy
            ends[at] = (ends[at][0], k) if stem else (k, ends[at][1])
        letters = sorted({b for w in spelled for b in w})
        classes = np.zeros(256, np.int64)
        classes[letters] = np.arange(1, len(letters) + 1)

        def closed(items: set) -> frozenset:
            # a deletion: the term's next byte is missing from the word
            more = {(c, 1) for n, e in items if e == 0 and n >= 0 for c in children[n].values() if deep[c]}
            return frozenset(items | {x for x in more if (x[0], 0) not in items})

        def moved(state: frozenset, byte: int | None) -> frozenset:
            out = set()
            for n, e in state:
                if n < 0:
                    out.add((n, e))  # within a word that begins with a stem, e edits off
                    continue
                if byte in children[n] and (e == 0 or deep[children[n][byte]]):
                    out.add((children[n][byte], e))
                if e == 0 and deep[n]:
                    out.add((n, 1))  # an insertion
                    out.update((c, 1) for b, c in children[n].items() if deep[c] and b != byte)  # a substitution
            out = closed(out)
            stems = {(e, ends[n][1]) for n, e in out if n >= 0 and ends[n][1] >= 0 and (e == 0 or terms_fuzzy[ends[n][1]])}
            stems |= {(e, -1 - n) for n, e in out if n < 0}
            # the best stem alone can count; where it is exact, nothing that is an edit off can
            if not stems:
                return out
            least, k = min(stems)
            return frozenset({(n, e) for n, e in out if n >= 0 and e <= least} | {(-1 - k, least)})

        def accepted(state: frozenset) -> tuple[int, int]:
            found = [(e, 0, ends[n][0]) for n, e in state if n >= 0 and ends[n][0] >= 0 and (e == 0 or terms_fuzzy[ends[n][0]])]
            found += [(e, 1, -1 - n) for n, e in state if n < 0]
            return (min(found)[2], min(found)[0]) if found else (-1, 0)

        start = closed({(0, 0)})
        ids, todo, step = {frozenset(): 0, start: 1}, [start], [[0] * (len(letters) + 1), []]
        while todo:
            state = todo.pop()
            row = []
            for byte in [None, *letters]:
                to = moved(state, byte)
                if to not in ids:
                    ids[to] = len(ids)
                    todo.append(to)
                    step.append([])
                row.append(ids[to])
            step[ids[state]] = row
        whole, edits = zip(*(accepted(s) for s in ids))
        return Automaton(np.array(step, np.int32).reshape(len(ids), -1), classes, np.array(whole, np.int32), np.array(edits, np.int32),
                         max([len(w) for w in spelled], default=0) + 1)

    def match(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word, term, edits) of the words that some term accepts."""
        state = np.ones(len(start), np.int32)
        live = np.arange(len(start))
        at = 0
        size = end - start
        while len(live):
            live = live[(size[live] > at) & (state[live] > 0)]
            if not len(live):
                break
            state[live] = self.step[state[live], self.classes[data[start[live] + at]]]
            at += 1
        hit = np.flatnonzero((state > 1) & (self.whole[state] >= 0))
        return hit, self.whole[state[hit]], self.edits[state[hit]]


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    low = textkit.lowered(data)
    plain = np.where(_TOKEN[low], low, 32).astype(np.uint8)
    # Latin-1 signs (C2 xx) and general punctuation, curly quotes among it (E2 80 xx, E2 81 xx), hold no letters
    two = np.flatnonzero(low == 0xC2)
    three = np.flatnonzero((low[:-2] == 0xE2) & ((low[1:-1] == 0x80) | (low[1:-1] == 0x81)))
    plain[np.concatenate((two, two + 1, three, three + 1, three + 2))] = 32
    return plain, *textkit.words(plain, offsets)


def _hash_set(words: tuple[str, ...]) -> np.ndarray:
    raw = [w.encode() for w in words]
    ends = np.cumsum([len(w) for w in raw])
    return textkit.word_hashes(np.frombuffer(b"".join(raw), np.uint8), ends - [len(w) for w in raw], ends)


def _near(flags: np.ndarray, row: np.ndarray, hit: np.ndarray) -> np.ndarray:
    """Whether a flagged word of the same text stands within WINDOW words of each hit."""
    total = np.concatenate(([0], np.cumsum(flags)))
    first = np.searchsorted(row, row[hit], "left")
    last = np.searchsorted(row, row[hit], "right")
    return total[np.minimum(hit + WINDOW + 1, last)] > total[np.maximum(hit - WINDOW, first)]


def _quoted(data: np.ndarray, offsets: np.ndarray, at: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Whether a byte lies after an odd number of straight marks, or more opening than closing ones, on its line."""
    if not len(at):
        return np.zeros(0, bool)
    pad = np.concatenate((data, np.zeros(2, np.uint8)))
    a, b, c = pad[:-2], pad[1:-1], pad[2:]
    straight = data == 0x22
    opens = (a == 0xE2) & (b == 0x80) & ((c == 0x9C) | (c == 0x9E)) | (a == 0xC2) & (b == 0xAB)
    closes = (a == 0xE2) & (b == 0x80) & (c == 0x9D) | (a == 0xC2) & (b == 0xBB)
    breaks = np.concatenate(([0], np.flatnonzero(data == 10) + 1))
    line = np.maximum(breaks[np.searchsorted(breaks, at, "right") - 1], offsets[row])
    odd = np.concatenate(([0], np.cumsum(straight)))
    level = np.concatenate(([0], np.cumsum(opens.astype(np.int64) - closes)))
    return ((odd[at] - odd[line]) % 2 == 1) | (level[at] - level[line] > 0)


def features(data: np.ndarray, offsets: np.ndarray, automaton: Automaton, terms: int) -> np.ndarray:
    """Per text: log of 1 + weighted hits for each term, then of all hits, inexact hits, and hits for 100 words."""
    rows = len(offsets) - 1
    plain, start, end, row = tokens(data, offsets)
    hit, term, edits = automaton.match(plain, start, end)
    hashes = textkit.word_hashes(plain, start, end) if len(hit) else np.zeros(len(start), np.uint64)
    weight = np.ones(len(hit))
    weight[_quoted(data, offsets, start[hit], row[hit])] *= QUOTED
    weight[_near(np.isin(hashes, _hash_set(REPORTING)), row, hit)] *= REPORTED
    weight[_near(np.isin(hashes, _hash_set(ADDRESS)), row, hit)] *= ADDRESSED
    weight /= 1 + edits
    out = np.zeros((rows, terms + 3))
    np.add.at(out, (row[hit], term), weight)
    total = np.bincount(row[hit], weights=weight, minlength=rows)
    out[:, terms] = total
    out[:, terms + 1] = np.bincount(row[hit], weights=weight * (edits > 0), minlength=rows)
    out[:, terms + 2] = 100 * total / np.maximum(1, np.bincount(row, minlength=rows))
    return np.log1p(out)


def _prior(terms: int) -> np.ndarray:
    return np.concatenate(([PRIOR_BIAS], np.zeros(terms), [PRIOR_HITS, 0.0, 0.0]))


def fit(x: np.ndarray, y: np.ndarray, terms: int, rounds: int = 25) -> np.ndarray:
    """Logistic regression by Newton's method with a ridge around the prior."""
    prior = _prior(terms)
    w = prior.copy()
    if not len(y):
        return w
    x = np.column_stack([np.ones(len(x)), x])
    ridge = np.full(len(w), RIDGE * max(1.0, len(y) / 1000))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge), x.T @ (y - p) - ridge * (w - prior))
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(its_id, text, toxic) of all labelled documents of the training folds; of those that repeat an id, one text."""
    known = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (fold(F.col("doc_id")) != TEST_FOLD))
             .groupBy(F.col("doc_id").cast("long").alias("its_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic")))
    texts = docs.select(F.col(id_col).cast("long").alias("its_id"), F.col(text_col).cast("string").alias("text"))
    texts = texts.where(fold(F.col("its_id")) != TEST_FOLD)
    return texts.join(known, "its_id").groupBy("its_id").agg(F.max(F.struct("text", "toxic")).alias("one")).select("its_id", "one.text", "one.toxic")


def training_sample(rows: DataFrame) -> DataFrame:
    """(text, toxic) of at most SAMPLE of the training rows, the least by hash."""
    # ids alone are ordered in one task, SAMPLE of each partition at most; as many are broadcast
    ids = rows.select("its_id").orderBy(F.xxhash64("its_id"), "its_id").limit(SAMPLE)
    return rows.join(F.broadcast(ids), "its_id").select("text", "toxic")


def learned_terms(rows: DataFrame) -> list[tuple[str, bool]]:
    """The terms whose documents are toxic most plainly, in at least LEAST_DOCS toxic documents; at most LEXICON_BYTES of terms."""
    counts = rows.agg(F.sum("toxic").alias("bad"), F.count(F.lit(1)).alias("n")).first()
    bad, good = int(counts.bad or 0), int((counts.n or 0) - (counts.bad or 0))
    if not bad or not good:
        return []
    found = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(_WORD), F.lit(0)))
    # a form is a whole word, or a stem and a mark that no word holds: strings are made distinct by hashing, structs pair by pair
    forms = F.flatten(F.transform(found, lambda w: F.array(
        w, *[F.when(F.length(w) > k, F.concat(F.substring(w, 1, k), F.lit(_STEM))) for k in STEMS])))
    each = rows.select("toxic", F.explode(F.array_distinct(forms)).alias("form")).where("form is not null")
    sums = each.groupBy("form").agg(F.sum("toxic").alias("a"), F.count(F.lit(1)).alias("n"))
    sums = sums.select("a", "n", F.rtrim(F.col("form"), F.lit(_STEM)).alias("word"), F.endswith("form", F.lit(_STEM)).alias("stem")).where(f"length(word) > 3 and octet_length(word) <= {TERM_BYTES}")
    odds = F.log((F.col("a") + 0.5) / bad) - F.log((F.col("n") - F.col("a") + 0.5) / good)
    ranked = sums.where(F.col("a") >= LEAST_DOCS).withColumn("odds", odds).where("odds > 2").withColumn("rank", F.col("odds") * F.sqrt("a"))
    # each word brings three stems at most, so the best LEXICON_BYTES rows hold terms enough
    best = ranked.orderBy(F.col("rank").desc(), "word", "stem").limit(LEXICON_BYTES).select("word", "stem").collect()
    chosen: list[tuple[str, bool]] = []
    room = LEXICON_BYTES
    for r in best:
        covered = r.stem and any(s and r.word.startswith(w) for w, s in chosen)
        if not covered and len(r.word.encode()) <= room:
            chosen.append((r.word, r.stem))
            room -= len(r.word.encode())
    return chosen


def _feature_rows(sample: DataFrame, automaton: Automaton, terms: int) -> tuple[np.ndarray, np.ndarray]:
    shared = sample.sparkSession.sparkContext.broadcast(automaton)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, rows, data, offsets in textkit.pieces(batch.column(0)):
                x = features(data, offsets, shared.value, terms)
                flat = pa.ListArray.from_arrays(pa.array(np.arange(rows + 1) * x.shape[1], pa.int32()), pa.array(x.reshape(-1)))
                yield pa.RecordBatch.from_arrays([flat, batch.column(1).slice(i, rows)], ["x", "toxic"])

    got = sample.select("text", "toxic").mapInArrow(measure, "x array<double>, toxic int").toPandas()  # at most SAMPLE rows
    order = sorted(range(len(got)), key=lambda i: (got["toxic"][i], tuple(got["x"][i])))  # sums in one order: reruns agree
    x = np.array([got["x"][i] for i in order]).reshape(len(order), terms + 3)
    return x, np.array([got["toxic"][i] for i in order], float)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    spark = scratch.prepare(docs.sparkSession)
    labelled = scratch.save(training_rows(docs, labels, id_col, text_col), "labelled")
    sample = scratch.save(training_sample(labelled), "sample")
    terms = [(w, False) for w in SEEDS]
    terms += [t for t in learned_terms(labelled) if t not in terms]
    automaton = Automaton.build(terms, stem_edits=True)
    weights = fit(*_feature_rows(sample, automaton, len(terms)), len(terms))
    shared = spark.sparkContext.broadcast((automaton, weights))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, w = shared.value
        for batch in batches:
            for i, rows, data, offsets in textkit.pieces(batch.column(1)):
                x = features(data, offsets, a, len(w) - 4)
                p = 1 / (1 + np.exp(-np.clip(w[0] + x @ w[1:], -30, 30)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, rows), pa.array(p)], ["doc_id", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = rows.mapInArrow(score, "doc_id long, score double")
    return out.select("doc_id", F.coalesce(fold(F.col("doc_id")) == TEST_FOLD, F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))
