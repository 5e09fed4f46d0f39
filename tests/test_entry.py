"""The driver contract in __spark_entry__.py."""

import importlib.util
import os

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _entry_module():
    spec = importlib.util.spec_from_file_location("spark_entry",
                                                  os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_entry_runs_on_smoke_data(spark):
    m = _entry_module()
    df = m.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert {"category", "buyer", "row_kind", "total"} <= set(df.columns)


def test_queries_and_oracles_align():
    m = _entry_module()
    q, o = m.queries(), m.oracle_sql()
    assert q and set(o) <= set(q)
    assert all(callable(f) for f in q.values())
