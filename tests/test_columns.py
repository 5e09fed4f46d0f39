"""Scalar helpers on the edge rows of FIXTURES.md §3."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from worklens.context import (
    APPROVER_AGE_EDGES, APPROVER_AMOUNT_EDGES, BACKLOG_AGE_EDGES, BACKLOG_AMOUNT_EDGES,
)
from worklens.functions import columns as C


def _col(spark, values, expr, dtype="int"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_backlog_age_bins_closed_open(spark):
    got = _col(spark, [0, 29, 30, 59, 60, 89, 90, -1, None],
               lambda c: C.fixed_bins(c, BACKLOG_AGE_EDGES))
    assert got == [0, 0, 30, 30, 60, 60, 90, 90, None]


def test_backlog_amount_bins(spark):
    vals = [Decimal("249999.99"), Decimal("250000"), Decimal("499999.99"),
            Decimal("500000"), Decimal("-1"), None]
    got = _col(spark, vals, lambda c: C.fixed_bins(c, BACKLOG_AMOUNT_EDGES), "decimal(18,2)")
    assert got == [0, 250000, 250000, 500000, 500000, None]


def test_approver_bins(spark):
    assert _col(spark, [6, 7, 13, 14, 29, 30, -1],
                lambda c: C.fixed_bins(c, APPROVER_AGE_EDGES)) == [0, 7, 7, 14, 14, 30, 30]
    vals = [Decimal("49999.99"), Decimal("50000"), Decimal("250000"), Decimal("500000"),
            Decimal("-1")]
    assert _col(spark, vals, lambda c: C.fixed_bins(c, APPROVER_AMOUNT_EDGES),
                "decimal(18,2)") == [0, 50000, 250000, 500000, 500000]


def test_underflow_null_option(spark):
    assert _col(spark, [-1, 0, 95], lambda c: C.fixed_bins(c, BACKLOG_AGE_EDGES, "null")) \
        == [None, 0, 90]


def test_week_start_is_sunday(spark):
    # 2001-07-01 is a Sunday, 2001-07-07 a Saturday.
    got = _col(spark, [dt.date(2001, 7, 1), dt.date(2001, 7, 7), dt.date(2001, 7, 8)],
               C.week_start_sunday, "date")
    assert got == [dt.date(2001, 7, 1), dt.date(2001, 7, 1), dt.date(2001, 7, 8)]
    assert _col(spark, [dt.date(2001, 7, 1)], C.format_week, "date") == ["07/01"]


def test_fiscal_year_july_start(spark):
    got = _col(spark, [dt.date(2001, 6, 30), dt.date(2001, 7, 1), None], C.fiscal_year, "date")
    assert got == [2001, 2002, None]
    assert _col(spark, [dt.date(2001, 7, 2)],
                lambda c: C.is_current_fy(c, dt.date(2001, 12, 31)), "date") == [True]


def test_truncate_ellipsis(spark):
    s53, s54 = "a" * 53, "b" * 54
    got = _col(spark, [s53, s54, None], C.truncate_ellipsis, "string")
    assert got == [s53, "b" * 50 + "...", None]


def test_abbreviate_and_trim(spark):
    assert _col(spark, ["07_NATION_7", "x", None], C.abbreviate, "string") == ["07", "x", None]
    assert _col(spark, [" R12 "], C.trim, "string") == ["R12"]


def test_parse_date_and_age(spark):
    assert _col(spark, ["2001-06-30T00:00:00Z", "garbage", None], C.parse_date, "string") \
        == [dt.date(2001, 6, 30), None, None]
    assert _col(spark, [dt.date(2001, 7, 2), dt.date(2001, 6, 1)],
                lambda c: C.age_days(c, dt.date(2001, 7, 1)), "date") == [-1, 30]


def test_usd_half_even(spark):
    vals = [Decimal("1234567.50"), Decimal("1234568.50"), Decimal("50000.49")]
    assert _col(spark, vals, C.usd, "decimal(18,2)") == ["$1,234,568", "$1,234,568", "$50,000"]


def test_category_factor(spark):
    levels = ("NINV", "SE", "INV")
    assert _col(spark, ["SE", "IGNORE", None], lambda c: C.category_in(c, levels), "string") \
        == ["SE", None, None]
    assert _col(spark, ["INV", "IGNORE"], lambda c: C.category_rank(c, levels), "string") \
        == [3, None]


def test_array_length_missing_is_zero(spark):
    df = spark.createDataFrame([([1, 2],), (None,), ([],)], "a array<int>")
    assert [r[0] for r in df.select(C.array_length("a")).collect()] == [2, 0, 0]


def test_row_sum_propagates_null(spark):
    df = spark.createDataFrame([(1, 2), (1, None)], "a int, b int")
    assert [r[0] for r in df.select(C.row_sum(["a", "b"])).collect()] == [3, None]
