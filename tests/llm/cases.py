"""Small tables with the awkward cases that every operator must take: nulls, blanks, long texts, repeats, clashing names."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, size long, shard long, doc string"


def prose(rng, n, vocabulary=400):
    words = [f"{rng.choice('abcdefgh')}{rng.randrange(vocabulary)}" for _ in range(n)]
    return re.sub(r"(\S+ \S+ \S+ \S+ \S+ \S+ \S+) ", "\\1\n", " ".join(words))


def awkward(seed=1, n=60):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        text = prose(rng, rng.choice([1, 3, 20, 60, 150]))
        rows.append([i, text, rng.choice(["en", "de", None]), rng.choice(["a", "b", "ä", None])])
    base = prose(rng, 120).split(" ")
    for k in range(12):  # near copies, some of copies
        copy = list(base)
        for _ in range(k // 2):
            copy[rng.randrange(len(copy))] = f"x{rng.randrange(10**6)}"
        rows.append([1000 + k, " ".join(copy), "en", "a"])
    rows += [[2000 + k, " ".join(base), "en", "a"] for k in range(15)]  # exact copies
    rows += [[3000, " ".join(base).upper(), "en", "b"], [3001, None, "en", "a"], [3002, "", "de", "b"], [3003, " \t\n ", None, None],
             [3004, prose(rng, 20000), "en", "ä"], [None, " ".join(base), "en", "a"], [None, None, None, None], [3005, "one two", "en", "a"],
             [3006, "one two", "en", "a"], [3007, "word " * 300, "en", "b"], [3008, "Ünïcödé – ½ 字 text\r\nnext\x0bline", "de", "ä"],
             [3009, "\n\n\nx y\n\n", "en", "a"]]
    rows += [list(rows[0]), list(rows[0]), list(rows[70])]  # repeated rows
    return [tuple([*r, None if r[1] is None else len(r[1]), "row", 7, 9, None]) for r in rows]


def table(spark, rows, parts=3):
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def words(text):
    return WORD.findall(text or "")
