"""Generic operators: semantics and the equivalences the plans rely on."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from worklens.operators import core as O


def test_keep_first_takes_smallest_order(spark):
    df = spark.createDataFrame(
        [("p", 1, 3, "late"), ("p", 1, 1, "early"), ("p", 2, 5, "other"), ("q", 1, 2, "only")],
        "k string, line int, t int, v string")
    got = {(r.k, r.line): r.v for r in O.keep_first(df, ["k", "line"], ["t"]).collect()}
    assert got == {("p", 1): "early", ("p", 2): "other", ("q", 1): "only"}


def test_sum_strict_null_if_any_null(spark):
    df = spark.createDataFrame([("a", Decimal("1.50")), ("a", None), ("b", Decimal("2.00"))],
                               "k string, x decimal(18,2)")
    got = {r.k: r.s for r in df.groupBy("k").agg(O.sum_strict("x").alias("s")).collect()}
    assert got == {"a": None, "b": Decimal("2.00")}


def test_bucket_counts_equals_pivot_fillna(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x"), ("b", None)],
                               "k string, b string")
    buckets = [("x", "x_cnt"), ("y", "y_cnt"), ("z", "z_cnt")]
    got = sorted(tuple(r) for r in O.bucket_counts(df, ["k"], "b", buckets).collect())
    piv = (df.groupBy("k").pivot("b", ["x", "y", "z"]).count().fillna(0)
             .withColumnsRenamed({"x": "x_cnt", "y": "y_cnt", "z": "z_cnt"}))
    assert got == sorted(tuple(r) for r in piv.collect())
    assert got == [("a", 1, 1, 0), ("b", 1, 0, 0)]


def test_with_totals_marks_levels_and_keeps_null_group(spark):
    df = spark.createDataFrame([("A", "u", 1), ("A", "v", 2), (None, "w", 4)],
                               "g string, k string, m bigint")
    rows = O.with_totals(df, "g", "k", ["m"]).collect()
    by_level = {}
    for r in rows:
        by_level.setdefault(r.row_level, []).append((r.g, r.k, r.m))
    assert sorted(by_level[0], key=str) == sorted([("A", "u", 1), ("A", "v", 2), (None, "w", 4)],
                                                  key=str)
    assert sorted(by_level[1], key=str) == sorted([("A", None, 3), (None, None, 4)], key=str)
    assert by_level[3] == [(None, None, 7)]


def test_null_safe_full_join_matches_nulls(spark):
    a = spark.createDataFrame([(1, None, 10), (1, "x", 11)], "t int, c string, pa int")
    b = spark.createDataFrame([(1, None, 20), (2, "y", 21)], "t int, c string, pb int")
    got = sorted((tuple(r) for r in O.null_safe_full_join(a, b, ["t", "c"]).collect()), key=str)
    assert got == sorted([(1, None, 10, 20), (1, "x", 11, None), (2, "y", None, 21)], key=str)


def test_unpivot_keeps_nulls(spark):
    df = spark.createDataFrame([("a", 1, None)], "k string, m1 bigint, m2 bigint")
    got = sorted(tuple(r) for r in
                 O.unpivot_counts(df, ["k"], {"m1": "One", "m2": "Two"}).collect())
    assert got == [("a", "One", 1), ("a", "Two", None)]


def test_zip_single_rows(spark):
    a = spark.range(5).agg(F.count(F.lit(1)).alias("n"))
    b = spark.range(5).agg(F.sum("id").alias("s"))
    assert tuple(O.zip_single_rows([a, b]).first()) == (5, 10)


def test_attach_group_total_strict(spark):
    df = spark.createDataFrame([("p", 1), ("p", 2), ("q", 3), ("q", None)], "k string, x int")
    got = [tuple(r) for r in O.attach_group_total(df, ["k"], "x", "tot").collect()]
    assert sorted(got, key=str) == sorted([("p", 1, 3), ("p", 2, 3), ("q", 3, None),
                                           ("q", None, None)], key=str)


def test_checked_dimension_rejects_duplicate_keys(spark):
    dup = spark.createDataFrame([("SE", "b1"), ("INV", "b1")], "category string, buyer string")
    with pytest.raises(ValueError):
        O.checked_dimension(dup, "buyer", 100)


def test_checked_dimension_broadcasts_only_under_limit(spark):
    dim = spark.createDataFrame([("SE", "b1"), ("INV", "b2")], "category string, buyer string")
    fact = spark.range(10).withColumn("buyer", F.concat(F.lit("b"), (F.col("id") % 2 + 1).cast("string")))
    small = fact.join(O.checked_dimension(dim, "buyer", 10), "buyer")
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = fact.join(O.checked_dimension(dim, "buyer", 1), "buyer")
        plan = big._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan or "AdaptiveSparkPlan" in plan
        assert big.count() == 10
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_cluster_settings_scale_with_input():
    from worklens.session import cluster_settings
    small = cluster_settings(1 << 30, 8)
    big = cluster_settings(100 * (1 << 40), 8000)
    assert int(small["spark.sql.shuffle.partitions"]) == 16          # two waves of tasks
    assert int(big["spark.sql.shuffle.partitions"]) == 409_600       # 256 MB each
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_keep_first_with_map_payload(spark):
    df = spark.createDataFrame([("p", 2, {"a": 1}), ("p", 1, {"b": 2})],
                               "k string, t int, m map<string,int>")
    r = O.keep_first(df, ["k"], ["t"]).first()
    assert (r.t, r.m) == (1, {"b": 2})
