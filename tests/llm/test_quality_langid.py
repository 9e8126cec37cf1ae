import base64
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import zlib
from cases import SCHEMA, WORD, awkward, prose, table, words
from journeyline.llm import langid, quality, textkit


def base(text):
    text = text or ""
    w = words(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    often = Counter(windows)
    again = {i + k for i, x in enumerate(windows) if often[x] > 1 for k in range(3)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(again)


def test_counts_equal_brute_force(spark):
    rows = awkward() + [(5000 + i, t, None, None, 0, "", 0, 0, "") for i, t in enumerate(
        ["a a a a a", "a b c a b c", "x\nx\nx\n\n \n ", "# $ % & | < > *", "l1 x\nl2 y\nl1 x", "l1 x\r\nl1 x", "\n".join(["same line of words"] * 40)])]
    got = quality.quality(table(spark, rows)).collect()
    want = Counter((r[0], *base(r[1])) for r in rows)
    assert want == Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got)
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (not r.base_failed and r.in_band)
    kept = Counter((r.doc_id, r.n_words) for r in got if r.kept)
    out = quality.filter_quality(table(spark, rows))
    assert out.columns == SCHEMA.replace(",", "").split()[::2]
    assert Counter((r.doc_id, len(words(r.text))) for r in out.collect()) == kept
    assert quality.quality(spark.createDataFrame([], SCHEMA)).count() == 0


def test_bands_reject_repetition_and_noise(spark):
    rng = random.Random(3)
    noise = " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/") for _ in range(60)) for _ in range(400))
    loop = " ".join(f"item {i % 7} costs {i}" for i in range(4000))
    mixed = " ".join(prose(rng, 3000, 30000).split()) + " " + "tick tock " * 4000
    rows = [(1, prose(rng, 2000, 30000), "", "", 0, "", 0, 0, ""), (2, noise, "", "", 0, "", 0, 0, ""), (3, loop, "", "", 0, "", 0, 0, ""),
            (4, mixed, "", "", 0, "", 0, 0, "")]
    verdict = {r.doc_id: r.in_band for r in quality.quality(table(spark, rows)).collect()}
    assert verdict == {1: True, 2: False, 3: False, 4: False}
    packer = __import__("zstandard").ZstdCompressor(level=quality.LEVEL)
    assert quality.compression(bytes(rng.randrange(256) for _ in range(20000)), packer)[3] is False
    for n in (192, 384, 700, 1500, 3000, 10000, 40000, 300000):
        raw = rng.randbytes(n)
        assert not quality.compression(base64.encodebytes(raw), packer)[3]
        assert quality.compression(raw.hex(" ", 16).encode(), packer)[3] == (2 * n < quality.BANDS[-2][0])


def test_forward_sums_all_segmentations():
    pieces = langid.Pieces(langid.vocabulary())
    rng = np.random.default_rng(0)
    p = rng.random((len(pieces.pieces), 2))
    p /= p.sum(axis=0)
    index = {x: i for i, x in enumerate(pieces.pieces)}

    def every(word, k):
        total = [1.0] + [0.0] * len(word)
        for d in range(1, len(word) + 1):
            for n in range(1, min(d, langid.LONGEST) + 1):
                if word[d - n:d] in index:
                    total[d] += total[d - n] * p[index[word[d - n:d]], k]
        return math.log(total[-1])

    texts = ["hello world", "", None, "été à la 12 x", "  internationalisierungsmassnahmenkatalog y\tab", "hello"]
    scores = langid.Scores(pieces, p)
    for _ in range(2):  # from the lattice, then from the kept scores
        for i, rows, data, offsets in textkit.pieces(pa.array(texts)):
            w = langid.Words(data, offsets)
            each = scores.of(w)[w.word]
            for r in range(rows):
                raw = [x.encode() for x in words(texts[i + r])]
                cuts = [(b" " if c == 0 else b"") + x[c:c + langid.CUT] for x in raw for c in range(0, len(x), langid.CUT)]
                assert np.allclose(each[w.row == r].sum(axis=0), [sum(every(c, k) for c in cuts) for k in (0, 1)])


def test_expected_uses_cover_every_byte():
    pieces = langid.Pieces(langid.vocabulary())
    uses = langid.Uses(pieces)
    for i, rows, data, offsets in textkit.pieces(pa.array(["ab cd ab", "été ab"])):
        for _ in range(3):
            uses.add(langid.Words(data, offsets), ["x", "y"])
    uses.work_off()
    got = dict(zip(uses.langs, (uses.sums * pieces.lengths[:, None]).sum(axis=0)))
    assert np.isclose(got["x"], 3 * 9) and np.isclose(got["y"], 3 * 9)


def test_languages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    got = langid.language_id(docs).collect()
    assert len(got) == len(truth)
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {d for d in truth if zlib.crc32(str(d).encode()) % 5 == 0}
    assert np.mean([truth[r.doc_id] == r.lang_pred for r in held]) > 0.97 and all(0 <= r.score <= 1 for r in got)


def test_language_of_awkward_rows(spark):
    rows = awkward()
    got = langid.language_id(table(spark, rows)).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    none = {r[0] for r in rows if not re.search(r"[^\W\d_]", r[1] or "")}
    assert all((r.lang_pred == "und") == (r.doc_id in none) for r in got if r.doc_id is not None)
    assert all(not r.held_out for r in got if r.doc_id is None)
    assert langid.language_id(spark.createDataFrame([], SCHEMA)).count() == 0
    assert {r.lang_pred for r in langid.language_id(table(spark, [(*r[:2], None, *r[3:]) for r in rows])).collect()} == {"und"}
