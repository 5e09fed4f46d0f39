"""Query registry: key -> (Spark callable, DuckDB oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def present_money(df: DataFrame) -> DataFrame:
    """Decimal columns leave the registry as doubles.

    Plans compute money exactly in decimal (sums are order-independent); the
    finished value is then presented as a double, the reference's own money
    type.  The conversion of an exact value is deterministic, so every engine
    shows the same bits.
    """
    casts = {f.name: F.col(f.name).cast("double") for f in df.schema.fields
             if isinstance(f.dataType, T.DecimalType)}
    return df.withColumns(casts) if casts else df


def register(key: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    """Register a query; ``sql=None`` marks it as not SQL-expressible (rows-only check)."""
    def deco(fn: QueryFn) -> QueryFn:
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")

        @wraps(fn)
        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            return present_money(fn(spark, sf_dir))

        QUERIES[key] = query
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


RANK_SQL = "case {c} when 'NINV' then 1 when 'SE' then 2 when 'INV' then 3 end"
FACTOR_SQL = "case when {c} in ('NINV', 'SE', 'INV') then {c} end"


def rank_sql(col: str) -> str:
    return RANK_SQL.format(c=col)


def factor_sql(col: str) -> str:
    return FACTOR_SQL.format(c=col)
