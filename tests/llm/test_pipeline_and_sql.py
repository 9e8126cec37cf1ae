import importlib
import sys
from collections import Counter

import duckdb
import pytest
from journeyline.llm import scratch
from journeyline.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def value(v):
    return f"{v:.9g}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    cur = con.execute(ORACLE[name])
    names = [d[0] for d in cur.description]
    want = Counter(tuple(map(value, r)) for r in cur.fetchall())
    out = QUERIES[name](spark, SF)
    assert sorted(out.columns) == sorted(names)
    assert Counter(tuple(map(value, r)) for r in out.select(*names).collect()) == want


def test_pipeline_stages(spark):
    pipeline = importlib.import_module("corpus_pipeline")
    from test_mixing_sharding import water
    from test_near_duplicates import brute
    from test_quality_langid import base
    from journeyline.llm import decontam, quality
    assert [n for n, _ in pipeline.STAGES] == ["quality", "near_dedup", "decontamination", "mixing", "sharding"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [tuple(r) for r in docs.collect()]
    rows += [rows[3], (None, rows[4][1], "en", None, 1), (900001, None, None, None, None), (900002, "", "en", "src1", 0)]
    long = [r for r in rows if r[1] and len(set(r[1].split())) > 80 and not any(c in r[1] for c in "#@")][:2]
    alone = " ".join(f"{w}x{i}" for i, w in enumerate(long[0][1].split()[:120]))
    other = " ".join(f"{w}y{i}" for i, w in enumerate(long[1][1].split()[:120]))
    rows += [(long[0][0], alone, "en", "src1", 5), (None, other, "en", "src1", 5), (None, other, "en", "src2", 6), (None, alone + " z", "en", "src2", 7)]
    docs = spark.createDataFrame(rows, docs.schema).repartition(3)
    step = {}
    for name, stage in pipeline.STAGES:
        before = [tuple(r) for r in docs.collect()]
        docs = scratch.save(stage(spark, docs, SF), name)
        step[name] = before, [tuple(r) for r in docs.collect()], docs.columns
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    assert all(step[n][2] == names for n in step if n != "sharding") and step["sharding"][2][:5] == names

    packer = __import__("zstandard").ZstdCompressor(level=quality.LEVEL)

    def passes(text):
        n, _, _, _, again = base(text)
        return n >= 50 and 100 * again <= 50 * n and quality.compression(text.encode(), packer)[3]

    before, after, _ = step["quality"]
    assert Counter(after) == Counter(r for r in before if passes(r[1]))
    before, after, _ = step["near_dedup"]
    comp, _ = brute([(k, *r[1:]) for k, r in enumerate(before)])  # rows are linked, whatever their ids
    groups = {}
    for k, r in enumerate(before):
        groups.setdefault(comp[k], []).append(r)
    assert len(after) == len(groups)
    for group in groups.values():
        best = min(group, key=lambda r: (r[0] is None, r[0] or 0))
        assert any(r in after for r in group if r[0] == best[0])
    texts = [r[1] for r in after]
    assert texts.count(alone) == texts.count(other) == 1  # an id that another text has, and rows without an id
    before, after, _ = step["decontamination"]
    bad = {r.doc_id for r in decontam.contaminated(spark.createDataFrame(before, docs.select(names).schema), spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    bench = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert {r[0] for r in before if any(b in r[1] for b in bench)} <= bad
    assert Counter(after) == Counter(r for r in before if r[0] not in bad or r[0] is None)
    before, after, _ = step["mixing"]
    assert set(after) <= set(before) and max(Counter(after).values()) <= 3
    size = Counter()
    for r in before:
        size[r[3]] += base(r[1])[0]
    got = Counter()
    for r in after:
        got[r[3]] += base(r[1])[0]
    long = max(base(r[1])[0] for r in before)
    assert all(abs(got[s] - t) <= long for s, t in water(size).items())
    before, after, columns = step["sharding"]
    assert Counter(r[:5] for r in after) == Counter(before)
    at = {c: columns.index(c) for c in ("shard", "slot")}
    for s in {r[at["shard"]] for r in after}:
        assert sorted(r[at["slot"]] for r in after if r[at["shard"]] == s) == list(range(sum(r[at["shard"]] == s for r in after)))


def test_pipeline_runs_from_its_entry(spark):
    sys.modules.pop("corpus_pipeline", None)
    entry = importlib.import_module("__spark_entry__")
    assert {"pipeline"} <= set(entry.queries()) and sum(n.startswith("op") for n in entry.queries()) == 13


def test_queries_without_sql_are_the_known_ones():
    assert set(QUERIES) - set(ORACLE) == {"op4_quality", "op5_toxicity", "op6_sharding", "op7_line_dedup", "op9_language_id", "op10_token_packing"}
    assert set(ORACLE) <= set(QUERIES)
