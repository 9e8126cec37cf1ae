"""NULL visitor / session ids: the marts follow SQL semantics (COUNT DISTINCT skips NULL,
an equality join never matches NULL), checked against the oracle SQL on the same rows."""

import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import hand_rows
from journeyline.operators import attribution, campaign, funnel
from journeyline.operators.staging import stg_sessions
from journeyline.plans import oracle_sql as O
from journeyline.schemas import RAW_SESSIONS

EXTRA = [  # visitor, visitId, start, totals, traffic, device, geo, date
    (None, 991, 1499000000, (1, 3, 3, 70, None, 1, 20000000), ("google", "organic", "(not set)", None, None),
     ("browser", "desktop", "os"), ("Canada", None), "20170702"),
    (None, 992, 1499100000, (1, 1, 1, None, 1, None, None), ("google", "organic", "(not set)", None, None),
     ("browser", "desktop", "os"), ("Canada", None), "20170703"),
    ("B", None, 1499200000, (1, 4, 4, 90, None, None, None), ("google", "organic", "(not set)", None, None),
     ("browser", "mobile", "os"), ("United States", None), "20170704"),
]


def _norm(rows):
    def v(x):
        return round(x, 6) if isinstance(x, float) else x
    return sorted((tuple(v(x) for x in r) for r in rows), key=repr)


def _compare(spark_df, sql, stg_pdf):
    con = duckdb.connect()
    con.register("stg", stg_pdf)
    res = con.execute(sql)
    cols = [d[0] for d in res.description]
    want = _norm(res.fetchall())
    got = _norm(spark_df.select(*cols).collect())
    assert got == want


@pytest.fixture(scope="module")
def null_stg(spark):
    raw = spark.createDataFrame(hand_rows() + EXTRA, RAW_SESSIONS).where("date <= '20170731'")
    return stg_sessions(raw).cache()


def test_marts_with_null_ids_match_sql(spark, null_stg):
    pdf = null_stg.withColumn("rev_micros", F.coalesce("transaction_revenue_micros", F.lit(0))).toPandas()
    assert null_stg.where("session_id IS NULL").count() == 3
    _compare(campaign.mart_campaign_performance(null_stg), "WITH " + O.CAMPAIGN_CTES.strip() + " SELECT * FROM mart_cp", pdf)
    _compare(attribution.mart_attribution_analysis(null_stg),
             "WITH " + O.ATTRIBUTION_CTES.strip() + " SELECT * FROM mart_attr", pdf)
    _compare(funnel.mart_conversion_funnel(null_stg),
             "WITH " + O.FUNNEL_CTES.strip() + " SELECT * FROM mart_funnel", pdf)
    _compare(funnel.int_funnel_steps(null_stg),
             "WITH " + O.FUNNEL_CTES.strip() + f" SELECT {O.IFS_COLUMNS} FROM ifs", pdf)
