from collections import Counter

import numpy as np
from cases import SCHEMA, awkward, table, words
from journeyline.llm import minhash


def brute(rows):
    """component of each doc_id by comparing all pairs of full sets."""
    sets = {}
    for r in rows:
        w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in r[1] or ""))
        sets.setdefault(r[0], []).append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    parent = {d: d for d in sets if d is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    flat = [(d, s) for d, many in sets.items() if d is not None for s in many if s]
    for i, (a, s) in enumerate(flat):
        for b, t in flat[:i]:
            if 100 * len(s & t) >= 85 * len(s | t):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {d: root(d) for d in parent}, sets


def check(spark, rows):
    comp, sets = brute(rows)
    got = minhash.near_duplicates(table(spark, rows)).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    for r in got:
        assert r.n_shingles in [len(s) for s in sets[r.doc_id]]
        assert r.component_id == (None if r.doc_id is None else comp[r.doc_id])
        assert r.kept == (r.doc_id == r.component_id)


def test_awkward_rows_equal_brute_force(spark):
    check(spark, awkward())


def test_chains_stars_and_false_candidates_equal_brute_force(spark):
    import random
    rng = random.Random(5)
    rows, text = [], [f"w{rng.randrange(10**6)}" for _ in range(90)]
    for k in range(40):  # a chain: only neighbours are similar enough
        text = list(text)
        text[(2 * k) % 90] = f"w{rng.randrange(10**6)}"
        rows.append((500 - k, " ".join(text), None, None, 0, "", 0, 0, ""))
    base = [f"v{rng.randrange(10**6)}" for _ in range(120)]
    for k in range(80):  # around a centre, from near to far
        copy = list(base)
        for _ in range(k // 8):
            copy[rng.randrange(120)] = f"v{rng.randrange(10**6)}"
        rows.append((2000 - k, " ".join(copy), None, None, 0, "", 0, 0, ""))
    check(spark, rows)


def test_no_rows(spark):
    assert minhash.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_sketch_fills_every_bin_and_estimates_similarity():
    rng = np.random.default_rng(2)
    a = rng.integers(0, 2**63, 400, dtype=np.uint64)
    b = np.concatenate((a[:300], rng.integers(0, 2**63, 100, dtype=np.uint64)))
    one = a[:1]
    owner = np.concatenate((np.zeros(400, int), np.ones(400, int), [2]))
    s = minhash.sketch(owner, np.concatenate((a, b, one)), 4)
    assert (s[:3] != minhash._EMPTY).all() and (s[3] == minhash._EMPTY).all()
    assert abs((s[0] == s[1]).mean() - 300 / 500) < 0.06
    assert (minhash.sketch(np.zeros(400, int), a, 1)[0] == s[0]).all()  # a text's sketch doesn't depend on its batch
