"""Every registered query against its DuckDB oracle (order-insensitive)."""

import pytest

from worklens.catalog import ORACLE, QUERIES
from worklens.catalog.check import compare, duck

KEYS = sorted(QUERIES)


@pytest.fixture(scope="module")
def con(sf_oracle):
    return duck(sf_oracle)


def test_every_key_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, sf_oracle, key):
    res = compare(spark, con, key, QUERIES[key], ORACLE.get(key), sf_oracle)
    assert res["status"] == "ok", res


ZONE_SENSITIVE = ["c01_clean_backlog", "c12_approver_detail", "c18_po_throughput",
                  "c19_line_throughput_wide", "d08_week_start_sunday", "d09_format_week",
                  "s08_write_jsonl", "t02_weekly_throughput_stream", "t03_streaming_dedupe"]


@pytest.mark.parametrize("key", ZONE_SENSITIVE)
def test_results_do_not_depend_on_session_zone(spark, con, sf_oracle, key):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        res = compare(spark, con, key, QUERIES[key], ORACLE.get(key), sf_oracle)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert res["status"] == "ok", res
