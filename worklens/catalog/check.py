"""Compare registered Spark queries with their DuckDB oracle (order-insensitive).

    python -m worklens.catalog.check /root/testdata/sf0.01 [key-prefix ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f")
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if hasattr(v, "asDict"):
        return str(v)
    if isinstance(v, (list, tuple)):
        return str([_norm(x) for x in v])
    return v


def normalise(cols: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    out.sort(key=lambda r: tuple((x is None, str(x)) for x in r))
    return [cols[i] for i in order], out


def compare(spark, con, key: str, fn, sql: str | None, sf_dir: str) -> dict:
    t0 = time.time()
    df = fn(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    res = {"key": key, "rows": len(rows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    con.execute(f"create or replace view oracle_result as {sql}")
    rel = con.sql("select * from oracle_result")
    ocols = [d[0] for d in rel.description]
    orows = rel.fetchall()
    scols, srows = normalise(df.columns, rows)
    ocols, orows = normalise(ocols, orows)
    if scols != ocols:
        res.update(status="COLUMNS", spark_cols=scols, oracle_cols=ocols)
    elif len(srows) != len(orows):
        res.update(status="ROWCOUNT", oracle_rows=len(orows))
    elif srows != orows:
        diff = [(a, b) for a, b in zip(srows, orows) if a != b][:3]
        res.update(status="VALUES", first_diffs=diff)
    else:
        res["status"] = "ok"
    return res


def main(argv: list[str]) -> int:
    from worklens.catalog import ORACLE, QUERIES
    from worklens.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    prefixes = argv[1:]
    spark = local_session()
    con = duck(sf_dir)
    bad = 0
    for key, fn in QUERIES.items():
        if prefixes and not any(key.startswith(p) for p in prefixes):
            continue
        try:
            res = compare(spark, con, key, fn, ORACLE.get(key), sf_dir)
        except Exception as exc:  # report and continue
            res = {"key": key, "status": "ERROR", "error": repr(exc)[:400]}
        bad += res["status"] not in ("ok", "rows-only")
        print(res, flush=True)
    print(f"failures: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
