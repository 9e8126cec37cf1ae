"""The driver contract: entry runs, every query has SQL, names line up."""

import subprocess
import sys

import __spark_entry__ as entry
from journeyline.plans.queries import QUERIES


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "total_revenue" in df.columns


def test_every_query_has_oracle_sql():
    assert set(QUERIES) <= set(entry.oracle_sql())
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(QUERIES) >= 50


def test_entry_without_a_library_of_the_other_queries():
    # a module set to None can't be imported, as if it weren't installed
    code = ("import sys; sys.modules['journeyline.llm'] = None; import __spark_entry__ as e; "
            "from journeyline.plans.queries import QUERIES; assert set(e.queries()) == set(QUERIES)")
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=entry.__file__.rsplit("/", 1)[0])
    assert done.returncode == 0, done.stderr
    assert "left out" in done.stderr


def test_release_models(spark):
    from conftest import SF_SMALL
    from journeyline.plans.queries import release_models, staged
    stg = staged(spark, SF_SMALL)
    stg.count()
    assert stg.is_cached
    assert release_models(spark) >= 1
    assert not stg.is_cached
    assert staged(spark, SF_SMALL) is not stg  # rebuilt on next use
