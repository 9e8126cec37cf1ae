"""The Merkle manifest, the filter interaction audit and the URL filters against brute-force versions."""

import hashlib
import itertools
import random
import zlib
from collections import Counter, defaultdict

import pytest
from cases import SCHEMA, awkward, table
from journeyline.llm import interaction, merkle, scratch, urlfilter
from pyspark.sql import functions as F

# ---- Merkle manifest ---------------------------------------------------------------------------


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_leaf(doc_id, text, lang, source, n_chars):
    out = []
    for v in (doc_id, source, lang, n_chars, text):
        out.append("-" if v is None else f"{len(str(v).encode())}:{v}")
    return h(*out)


def climb(nodes):
    """The top, and for each node the digests before and after it in its runs, level by level."""
    sides, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, p in enumerate(at):
            run = nodes[p // 3 * 3:p // 3 * 3 + 3]
            sides[i].append(("".join(run[:p % 3]), "".join(run[p % 3 + 1:])))
            at[i] = p // 3
        nodes = [h(*nodes[i:i + 3]) for i in range(0, len(nodes), 3)]
    return nodes[0], sides


def brute_audit(rows):
    trees = defaultdict(list)
    for doc_id, text, lang, source, n_chars, *_ in rows:
        now = text
        if doc_id is not None and text is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0:
            now = text.replace("\n", "")
        trees[source].append((doc_id is not None, doc_id or 0, brute_leaf(doc_id, text, lang, source, n_chars), doc_id, brute_leaf(doc_id, now, lang, source, n_chars)))
    tops, inner = {}, {}
    for s, leaves in trees.items():
        leaves.sort(key=lambda x: x[:3])
        tops[s], inner[s] = climb([x[2] for x in leaves])
    order = sorted(tops, key=lambda s: (s is not None, (s or "").encode()))
    root, outer = climb([tops[s] for s in order])
    out = []
    for s, leaves in trees.items():
        for (_, _, leaf, doc_id, now), sides in zip(leaves, inner[s]):
            path = sides + outer[order.index(s)]
            for left, right in path:
                now = h(left, now, right)
            out.append((doc_id, leaf, tops[s], root, h(*[left + right for left, right in path]), now, now == root))
    return Counter(out)


def audited(df):
    return Counter(tuple(r) for r in merkle.audit(df).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect())


def test_manifest_of_awkward_rows(spark):
    rows = awkward()
    rows += [(5000 + i, "a\nb", "en", None, 3, "", 0, 0, "") for i in range(4)] + [(7, "x", "en", "", 1, "", 0, 0, "")] * 5
    got = audited(table(spark, rows))
    assert got == brute_audit(rows)
    assert {r[6] for r in got} == {True, False}


@pytest.mark.parametrize("n", [1, 3, 4, 729, 730, 2400])
def test_manifest_of_trees_over_several_packs(spark, n):
    rng = random.Random(n)
    ids = rng.sample(range(-10 ** 12, 10 ** 12), n)
    rows = [(i, f"t\n{i}", "en", "hot", 5, None, None, None, None) for i in ids] + [(i, "u", None, "cold", None, None, None, None, None) for i in range(3)]
    assert audited(table(spark, rows, 5)) == brute_audit(rows)


def test_manifest_of_many_sources(spark):
    rows = [(i, f"t{i}", "en", f"s{i % 800}", 5, None, None, None, None) for i in range(1000)]
    assert audited(table(spark, rows, 4)) == brute_audit(rows)


def test_manifest_store_is_content_addressed(spark):
    rows = [(1, "same", "en", "a", 4, None, None, None, None)] * 1500
    m = merkle.build(table(spark, rows))
    stored = m.store.collect()
    assert len(stored) == len({r.digest for r in stored}) and all(h(*x.children) == x.digest for r in stored for x in r.records)
    assert audited(table(spark, rows)) == brute_audit(rows)


def test_manifest_of_an_empty_table(spark):
    assert audited(table(spark, [])) == Counter()


# ---- filter interaction audit ------------------------------------------------------------------


def fails(text):
    w = text.encode().split()
    return ("A" * (len(w) < 200) + "B" * (100 * len(set(w)) < 50 * len(w)) + "C" * (100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text))
            + "D" * any(c in "#$%&*|" for c in text))


def brute_orders(rows, labels):
    least = {}
    for i, text, *_ in rows:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, t in labels if i is not None and t == 1}
    parts = defaultdict(list)
    for i, text, _, source, *_ in rows:
        failed = set(fails(text or "") + ("E" if i is not None and i > least[text or ""] else ""))
        parts[source or ""].append((failed, i in good, i in toxic))
    out = {}
    for part, docs in parts.items():
        shapley = Counter()
        for order in itertools.permutations("ABCDE"):
            for step, f in enumerate(order):
                before = set(order[:step])
                gone = [bool(d[0] & before) for d in docs]
                removed = [f in d[0] and not g for d, g in zip(docs, gone)]
                shapley[f] += sum(removed)
                out[part, "".join(order), step + 1] = [
                    sum(not g and f not in d[0] for d, g in zip(docs, gone)), sum(removed), sum(f in d[0] and g for d, g in zip(docs, gone)),
                    sum(d[0] == {f} for d in docs), sum(r and d[1] for d, r in zip(docs, removed)), sum(r and d[2] for d, r in zip(docs, removed))]
        for (p, order, step), v in out.items():
            if p == part:
                v.append(shapley[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def audit_rows():
    rng = random.Random(4)
    rows = awkward()
    word = [f"w{i}" for i in range(400)]
    clean = [" ".join(rng.sample(word, 250)) for _ in range(6)]
    for k in range(60):  # equal texts under falling and rising ids, in several sources
        rows.append((9000 - 37 * k % 61, clean[k % 6], "en", rng.choice(["a", "b", None, ""]), 1, "", 0, 0, ""))
    rows += [(2 ** 62 + k, clean[5] + " more", "en", "big", 1, "", 0, 0, "") for k in (3, 1, 2)] + [(None, clean[5] + " more", "en", "big", 1, "", 0, 0, "")] * 2
    rows += [(20, clean[0] + " $", "en", "a", 1, "", 0, 0, ""), (21, "ABC " * 300, "en", "a", 1, "", 0, 0, ""), (9500, clean[1], "en", "b", 1, "", 0, 0, "")]
    return rows


def write_files(spark, rows, path, files):
    for part in range(files):
        spark.createDataFrame(rows[part::files], SCHEMA).coalesce(1).write.mode("append").parquet(path)


@pytest.mark.parametrize("files, batches", [(1, 4), (6, 6), (7, 3)])
def test_audit_equals_brute_force_in_any_number_of_batches(spark, tmp_path, files, batches):
    rows = audit_rows()
    labels = [(2 ** 62 + 1, 1, True), (2 ** 62 + 2, 0, True)] + [(i, i % 2, i % 3 == 0) for i in range(0, 9600, 3)] + [(None, 1, True), (6, 0, True), (9, None, None)]
    given = spark.createDataFrame([(i, q, None if t is None else int(t)) for i, q, t in labels], "doc_id long, quality int, toxic int")
    write_files(spark, rows, f"{tmp_path}/documents.parquet", files)
    out = interaction.audit(spark, f"{tmp_path}/documents.parquet", given, batches)
    got = {(r.part, r.filter_order, r.step): tuple(r[3:]) for r in out.select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley").collect()}
    assert got == brute_orders(rows, labels)


def test_audit_retracts_when_smaller_ids_arrive(spark, tmp_path):
    """Each file has a smaller id of the same text than all before it, in a source of its own: only the last keeps its row."""
    text = " ".join(f"w{i}" for i in range(300))
    path = f"{tmp_path}/documents.parquet"
    for k in range(4):
        spark.createDataFrame([(100 - k, text, "en", f"s{k}", 1, "", 0, 0, "")], SCHEMA).coalesce(1).write.mode("append").parquet(path)
    counted = interaction.count_masks(spark, path, spark.createDataFrame([], "doc_id long, quality int, toxic int"), 4)
    assert {(r.part, r.mask): r.n for r in counted.where("n <> 0").collect()} == {("s3", 0): 1, **{(f"s{k}", interaction.E): 1 for k in range(3)}}


def test_audit_of_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert interaction.audit(spark, f"{tmp_path}/documents.parquet", labels).count() == 0


# ---- URL filters -------------------------------------------------------------------------------

URLS = ["http://a.example.org/es/1", "https://A.EXAMPLE.org/en/12?x=1", "http://example.org/en/2", "http://org/", "http://org", "http://x.com/fr/", "http://com/de/9#a",
        "http://notcom/de/9", "ftp://u@h.net:80/p//?b=2&utm_source=z&a=1#f", "https://www.h.net/p", "http://H.net:443/p/", "no scheme", "", None, "://", "x://y://z/://w",
        "http://spam.net/a", "https://www.spam.net/a/?utm_x=1", "http://spam.net/b?q=1", "http://ü.net/ß?é", "http://h.net?x#y/z", "http://h.net#/es/", "http://a\nb.com/fr/\nx"]


def brute_judge(url, listed):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    end = min([rest.find(c) for c in "/?#" if c in rest] + [len(rest)])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    tail = rest[end:].split("#")[0]
    path, _, asked = tail.partition("?")
    fits = [(len(r[1] + r[2]), r[1] + r[2], r[0]) for r in urlfilter.RULES if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    if fits:
        return host, path, max(fits)[1], max(fits)[2], False
    hit = brute_key(host, path, asked) in listed
    return host, path, None, "block" if hit else "allow", hit


def brute_key(host, path, asked):
    name = host.removeprefix("www.")
    name = name.removesuffix(":80") if name.endswith(":80") else name.removesuffix(":443")
    kept = sorted(p for p in asked.split("&") if p and not p.startswith("utm_"))
    return name + path.rstrip("/") + ("?" + "&".join(kept) if kept else "") if name else None


def judged(spark, urls, listed, **more):
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)], "page_id long, url string, host string, hit string").repartition(3)
    out = urlfilter.judge(pages, listed, **more).select("page_id", "host", "path", "rule", "verdict", "listed").collect()
    assert sorted(r.page_id for r in out) == list(range(len(urls)))
    return {r.page_id: tuple(r)[1:] for r in out}


@pytest.mark.parametrize("max_blocks", [1, 1 << 18])
def test_url_verdicts(spark, max_blocks):
    urls = URLS + [f"http://hot.net/{i % 3}" for i in range(400)] + [f"https://many.net/{i}?utm_a={i}" for i in range(900)]
    on = spark.createDataFrame([(u,) for u in ["http://spam.net/a", "HTTPS://h.net/p", "http://hot.net/1/", "http://a.example.org/es/1", None, "junk"]
                                + [f"http://many.net/{i}" for i in range(0, 900, 7)] + [f"http://else.net/{i}" for i in range(3000)]], "url string")
    listed = urlfilter.listing(on)
    keys = {r.url_key for r in listed.collect()}
    got = judged(spark, urls, listed, max_blocks=max_blocks)
    assert got == {i: brute_judge(u, keys) for i, u in enumerate(urls)}
    assert got[urls.index("https://www.spam.net/a/?utm_x=1")][3:] == ("block", True)


def test_bloom_filter_misses_no_listed_url_and_passes_few_others(spark):
    listed = scratch.save(spark.range(20000).select(F.concat(F.lit("h.net/"), "id").alias("url_key")), "test-listed")
    blocks = urlfilter.blocks_for(20000)
    assert blocks & (blocks - 1) == 0 and 64 * urlfilter.WORDS * blocks >= 20000 * urlfilter.BITS
    filter_ = urlfilter.bloom(listed, blocks)
    assert filter_.count() <= blocks
    asked = spark.range(60000).select(F.concat(F.lit("h.net/"), "id").alias("url_key"), (F.col("id") < 20000).alias("on"))
    n = {r.on: (r.passed, r.n) for r in urlfilter.probe(asked, filter_, blocks).groupBy("on").agg(F.count_if("maybe").alias("passed"), F.count(F.lit(1)).alias("n")).collect()}
    assert n[True] == (20000, 20000) and n[False][0] < 0.01 * n[False][1]


def test_urls_of_empty_tables(spark):
    none = urlfilter.listing(spark.createDataFrame([], "url string"))
    assert judged(spark, URLS, none) == {i: brute_judge(u, set()) for i, u in enumerate(URLS)}
    assert urlfilter.judge(spark.createDataFrame([], "page_id long, url string"), none).count() == 0
