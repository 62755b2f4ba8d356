"""Every registered query against its DuckDB oracle on sf0.001 (whole tables)."""

import pytest
from oracle_compare import compare, duck

from tidepool.plans.catalog import ORACLE, QUERIES

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con(sf_small):
    return duck(sf_small)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, sf_small, name):
    assert name in ORACLE
    ok, msg = compare(spark, con, name, QUERIES[name], ORACLE[name], sf_small)
    assert ok, msg


def test_entry_smoke(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.columns == ["window_end", "item_id", "view_count", "top_rank"]
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_entry_wrappers_apply_session_settings(spark, sf_small):
    import __spark_entry__ as e

    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = e.queries()["pv_hourly"](spark, sf_small)
        assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
        assert df.count() > 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
