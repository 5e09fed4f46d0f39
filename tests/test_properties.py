"""Property tests: Spark operators against plain-Python definitions of the reference semantics."""

from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from worklens.context import BACKLOG_AGE_EDGES
from worklens.functions import columns as C
from worklens.operators import core as O

SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def r_bin(x, edges):
    """The reference's nested if_else: closed-open bins, everything else in the top bin."""
    if x is None:
        return None
    for lo, hi in zip(edges[:-1], edges[1:]):
        if lo <= x < hi:
            return lo
    return edges[-1]


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.integers(-500, 500)), min_size=1, max_size=60))
def test_fixed_bins_matches_nested_conditionals(spark, ages):
    df = spark.createDataFrame([(i, a) for i, a in enumerate(ages)], "i int, age int")
    got = [r.b for r in df.select("i", C.fixed_bins("age", BACKLOG_AGE_EDGES).alias("b"))
                          .orderBy("i").collect()]
    assert got == [r_bin(a, BACKLOG_AGE_EDGES) for a in ages]


rows_strategy = st.lists(
    st.tuples(st.sampled_from(["p", "q", "r"]), st.integers(1, 3), st.integers(0, 5),
              st.integers(0, 3), st.one_of(st.none(), st.integers(0, 10_000))),
    min_size=1, max_size=40, unique_by=lambda t: (t[0], t[1], t[2], t[3]))


@SETTINGS
@given(rows_strategy)
def test_keep_first_and_strict_sum_match_python(spark, rows):
    df = spark.createDataFrame(
        [(k, ln, t, tb, None if a is None else Decimal(a)) for k, ln, t, tb, a in rows],
        "k string, line int, t int, tb int, amt decimal(18,2)")
    first = {}
    for k, ln, t, tb, a in sorted(rows, key=lambda r: (r[2], r[3])):
        first.setdefault((k, ln), a)
    got = {(r.k, r.line): (None if r.amt is None else int(r.amt))
           for r in O.keep_first(df, ["k", "line"], ["t", "tb"]).collect()}
    assert got == first
    sums = {}
    for (k, _), a in first.items():
        prev = sums.get(k, 0)
        sums[k] = None if prev is None or a is None else prev + a
    firsts = O.keep_first(df, ["k", "line"], ["t", "tb"])
    got_sums = {r.k: (None if r.s is None else int(r.s))
                for r in firsts.groupBy("k").agg(O.sum_strict("amt").alias("s")).collect()}
    assert got_sums == sums


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["A", "B", None]), st.sampled_from(["u", "v", "w"]),
                          st.integers(0, 9)), min_size=1, max_size=30))
def test_with_totals_equals_python_subtotals(spark, rows):
    df = spark.createDataFrame(rows, "g string, k string, m int")
    per = {}
    for g, k, m in rows:
        per[(g, k)] = per.get((g, k), 0) + m
    detail = spark.createDataFrame([(g, k, v) for (g, k), v in per.items()],
                                   "g string, k string, m long")
    out = O.with_totals(detail, "g", "k", ["m"]).collect()
    subs = {r.g: r.m for r in out if r.row_level == 1}
    want = {}
    for (g, _), v in per.items():
        want[g] = want.get(g, 0) + v
    assert subs == want
    assert [r.m for r in out if r.row_level == 3] == [sum(per.values())]
