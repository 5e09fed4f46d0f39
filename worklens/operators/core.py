"""Generic DataFrame -> DataFrame building blocks.

Every function here only composes built-in DataFrame operators; Catalyst sees
one logical plan and chooses the physical strategy.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from worklens.session import plan_memo


def dimension_stats(df: DataFrame, key: str) -> tuple[int, int]:
    """Row count and distinct-key count of a dimension: one small job per plan and session.

    Memoised by the plan's semantic hash for the life of the session (a
    dimension is assumed not to change under a running session; see
    ``session.forget_plans``).
    """
    memo = plan_memo(df.sparkSession, "dimension_stats")
    k = (df.semanticHash(), key)
    if k not in memo:
        row = df.agg(F.count(F.lit(1)).alias("n"),
                     F.count_distinct(F.col(key)).alias("k")).first()
        memo[k] = (int(row["n"]), int(row["k"]))
    return memo[k]


def checked_dimension(df: DataFrame, key: str, max_rows: int,
                      unique: bool = True) -> DataFrame:
    """Size-checked broadcast of a dimension.

    Broadcast only when the measured row count is at most ``max_rows``; above it
    the dimension is returned as is and the join falls back to a shuffle join
    (sort-merge, or whatever AQE re-plans from runtime sizes).  ``unique``
    asserts the join key is unique, because a repeated key would silently
    duplicate fact rows (the reference never checks this).
    """
    n, k = dimension_stats(df, key)
    if unique and n != k:
        raise ValueError(f"dimension key {key!r} is not unique: {n} rows, {k} keys")
    return F.broadcast(df) if n <= max_rows else df


def bounded_by_dimension(df: DataFrame, dimension: DataFrame, key: str,
                         max_rows: int) -> DataFrame:
    """Broadcast ``df`` whose rows are at most one per dimension key.

    For per-key results of facts that passed an inner join with the
    dimension: their size is bounded by the dimension's checked row count, so
    they may be broadcast exactly when the dimension may.
    """
    n, _ = dimension_stats(dimension, key)
    return F.broadcast(df) if n <= max_rows else df


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str],
               then: Sequence[str] = (), one_row_per_order: bool = False) -> DataFrame:
    """A-13: the first row per key, all columns kept.

    "First" is the smallest ``order`` tuple, where a null comes after every value;
    remaining ties are broken by ``then`` and by the other columns, so the choice
    is deterministic.  Callers that need few columns should pass few: the winner
    is the same as long as ``order`` and ``then`` are there, and what is not
    passed is neither read nor shuffled.

    One ``min`` over a struct whose leading fields are the order key: a
    declarative aggregate, so Spark aggregates partially before the shuffle and a
    hot key is reduced map-side instead of being sorted whole in one task.  (A
    struct buffer makes it a sort-based aggregate, which spills instead of failing
    under memory pressure.)  Where ``order`` is a single column that no two rows of
    a key share (an extract's row number), ``one_row_per_order`` takes each
    column by ``min_by``; fixed-width columns then aggregate by hash, unsorted.
    """
    rest = [c for c in df.columns if c not in keys]
    if one_row_per_order:
        (only,) = order
        return df.groupBy(*keys).agg(*[F.min_by(c, only).alias(c) for c in rest]).select(*keys, *rest)
    lead = [x for c in order for x in (F.col(c).isNull().alias(f"_null_{c}"), F.col(c))]
    fields = [c for c in then if c not in order]
    fields += [c for c in rest if c not in order and c not in fields]
    if any(_unorderable(df.schema[c].dataType) for c in [*order, *fields]):
        # Map-typed payloads cannot be compared: order by the key only.
        first = F.min_by(F.struct(*rest), F.struct(*lead))
    else:
        first = F.min(F.struct(*lead, *fields))
    return (df.groupBy(*keys).agg(first.alias("_first"))
              .select(*keys, *[F.col(f"_first.{c}").alias(c) for c in rest]))


def latest_per_key(df: DataFrame, key: str, version: str) -> DataFrame:
    """One row per key: the one with the largest version (null: before any), then the largest row.

    An aggregate on the key, so a join on the same key afterwards needs no
    further exchange; project to the fields needed first.  Without a column
    ``version`` the largest row counts.
    """
    lead = [version] if version in df.columns else []
    rest = [c for c in df.columns if c not in (key, *lead)]
    last = df.groupBy(key).agg(F.max(F.struct(*lead, *rest)).alias("_last"))
    return last.select(key, *[F.col(f"_last.{c}").alias(c) for c in rest])


def _unorderable(t: T.DataType) -> bool:
    if isinstance(t, T.MapType):
        return True
    if isinstance(t, T.ArrayType):
        return _unorderable(t.elementType)
    if isinstance(t, T.StructType):
        return any(_unorderable(f.dataType) for f in t.fields)
    return False


def sum_strict(col: Column | str) -> Column:
    """A-04: group sum that is null when any input is null (R ``sum`` without na.rm)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(F.count(F.lit(1)) == F.count(c), F.sum(c))


def bucket_counts(df: DataFrame, group_cols: Sequence[str], bucket: Column | str,
                  buckets: Sequence[tuple[object, str]],
                  extra: Sequence[Column] = ()) -> DataFrame:
    """R-01 + R-02: per group, one count column per bucket value, 0 when empty.

    Equivalent to ``groupBy(group).pivot(bucket, values).count().fillna(0)`` but
    a single hash aggregation (pivot adds a second one), and every bucket column
    exists whether or not it has rows.
    """
    b = F.col(bucket) if isinstance(bucket, str) else bucket
    aggs = [F.count_if(b == F.lit(v)).alias(name) for v, name in buckets]
    return df.groupBy(*group_cols).agg(*aggs, *extra)


def with_totals(df: DataFrame, group_col: str, key_col: str,
                measures: Sequence[str]) -> DataFrame:
    """A-05 + A-06 + U-01: detail rows, one subtotal per group, one grand total.

    One ROLLUP over the (already small) detail table.  ``row_level`` is 0 for a
    detail row, 1 for a subtotal and 3 for the total, so a null group value in
    the data is never confused with a total row.
    """
    sums = [F.sum(m).cast("bigint").alias(m) for m in measures]
    return (df.rollup(group_col, key_col)
              .agg(*sums, F.grouping_id().alias("row_level")))


def null_safe_full_join(left: DataFrame, right: DataFrame,
                        keys: Sequence[str]) -> DataFrame:
    """J-06: full outer join on all ``keys`` where null matches null."""
    l, r = left.alias("l"), right.alias("r")
    cond = reduce(lambda a, b: a & b,
                  [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys])
    out_keys = [F.coalesce(F.col(f"l.{k}"), F.col(f"r.{k}")).alias(k) for k in keys]
    rest_l = [F.col(f"l.{c}") for c in left.columns if c not in keys]
    rest_r = [F.col(f"r.{c}") for c in right.columns if c not in keys]
    return l.join(r, cond, "full").select(*out_keys, *rest_l, *rest_r)


def unpivot_counts(df: DataFrame, ids: Sequence[str], values: Mapping[str, str],
                   var: str = "type", val: str = "count") -> DataFrame:
    """R-03: measure columns -> (type, count) rows; null counts are kept."""
    renamed = df.withColumnsRenamed(dict(values))
    return renamed.unpivot(list(ids), list(values.values()), var, val)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """U-01: stack by column name; missing columns become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def attach_group_total(df: DataFrame, keys: Sequence[str], col: str, name: str,
                       strict: bool = True) -> DataFrame:
    """W-01: the group's total attached to every row of the group.

    Written as aggregate-then-join rather than ``sum().over(partitionBy(keys))``:
    a window needs every row of a group in one task, so one hot key would load
    one task with a third of the data; the aggregation combines map-side and
    the join back is split by AQE's skew-join handling.  The join is null-safe:
    null is a group like any other, and no ``is not null`` filter is inferred on
    one side, which would keep Spark from reusing the exchange that both sides
    start from (``df`` is then computed once).  ``strict`` gives the reference's
    null-if-any-null sum.
    """
    total = sum_strict(col) if strict else F.sum(col)
    own = {k: f"_group_{k}" for k in keys}
    totals = df.groupBy(*keys).agg(total.alias(name)).withColumnsRenamed(own)
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(g)) for k, g in own.items()])
    rest = [c for c in df.columns if c not in keys]
    return df.join(totals, same, "left").select(*keys, *rest, name)


def zip_single_rows(frames: Sequence[DataFrame]) -> DataFrame:
    """J-07: glue one-row frames side by side (column names must be disjoint).

    A union of the rows followed by a global ``max`` per column: no join, and
    each frame keeps its own plan.  Empty frames contribute nulls.
    """
    cols = [c for f in frames for c in f.columns]
    return union_all(frames).agg(*[F.max(c).alias(c) for c in cols])


def running_total(df: DataFrame, order_col: str, col: str, name: str) -> DataFrame:
    """W-02: cumulative sum in ``order_col`` order.

    Only for small, already aggregated inputs (here: one row per category);
    an unpartitioned window moves all rows to one task.
    """
    w = Window.orderBy(order_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(name, F.sum(col).over(w))
