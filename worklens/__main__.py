"""Command-line run: both reports from landed extracts.

    python -m worklens --as-of 2001-07-01 --out /shared/reports/2001-07-01 \\
        --backlog /landing/backlog.csv --worklist /landing/worklist.parquet \\
        --buyers /landing/buyers.csv --po-docs /docs/po --req-docs /docs/req \\
        --po /store/po --archive /shared/archive

Every path may be anything Spark reads (local, HDFS, object store).  Format is
taken from the extension (``.csv`` / ``.json`` / otherwise Parquet).  The
archive gets this run's snapshot (a rerun of the same ``--archive-time`` replaces it)
before the trends are read.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from pyspark.sql import DataFrame, SparkSession

from worklens import schemas
from worklens.context import RunContext
from worklens.plans import report
from worklens.session import apply_settings, cluster_settings
from worklens.sources import io
from worklens.sources.landing import quarantine


def _fmt(path: str) -> str:
    p = path.rstrip("/").lower()
    return "csv" if p.endswith(".csv") else "json" if p.endswith((".json", ".jsonl")) \
        else "parquet"


def _read(spark: SparkSession, path: str, schema) -> DataFrame:
    return io.read_table(spark, path, schema, _fmt(path))


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="worklens", description=__doc__.split("\n")[0])
    ap.add_argument("--as-of", required=True, type=dt.date.fromisoformat)
    ap.add_argument("--date-from", type=dt.date.fromisoformat,
                    help="first approval date; without it none is too early")
    ap.add_argument("--date-to", type=dt.date.fromisoformat)
    ap.add_argument("--po-weeks-until", type=dt.date.fromisoformat,
                    help="last week of the wide throughput tables (default: as-of)")
    ap.add_argument("--po-after", type=dt.date.fromisoformat)
    ap.add_argument("--out", required=True)
    ap.add_argument("--backlog", required=True)
    ap.add_argument("--worklist", required=True)
    ap.add_argument("--buyers", required=True)
    ap.add_argument("--po-docs", required=True)
    ap.add_argument("--req-docs", required=True)
    ap.add_argument("--po")
    ap.add_argument("--archive")
    ap.add_argument("--archive-time", type=dt.datetime.fromisoformat,
                    help="instant of this run's snapshot, e.g. 2024-05-06T08:15 "
                         "(default: midnight of as-of); a rerun of it replaces the snapshot")
    ap.add_argument("--quarantine",
                    help="folder for rows of the CSV extracts that do not parse")
    ap.add_argument("--tune-for-bytes", type=int,
                    help="size shuffle partitions for this many input bytes")
    a = ap.parse_args(argv)

    overrides = {k: v for k, v in (("date_from", a.date_from), ("date_to", a.date_to),
                                   ("po_date_after", a.po_after), ("archive_time", a.archive_time),
                                   ("po_weeks_until", a.po_weeks_until)) if v is not None}
    ctx = RunContext(as_of=a.as_of, **overrides)
    spark = SparkSession.builder.appName("worklens").getOrCreate()
    if a.tune_for_bytes:
        cores = spark.sparkContext.defaultParallelism
        apply_settings(spark, cluster_settings(a.tune_for_bytes, cores))
    landed = {name: land(spark, path) for name, path, land in (
        ("backlog", a.backlog, io.land_backlog), ("worklist", a.worklist, io.land_worklist))
        if _fmt(path) == "csv"}
    if a.quarantine:
        for name, extract in landed.items():
            quarantine(extract, f"{a.quarantine.rstrip('/')}/{name}")
    out = a.out.rstrip("/")
    paths = report.run_backlog_report(
        spark,
        landed["backlog"].rows if "backlog" in landed else _read(spark, a.backlog, schemas.BACKLOG),
        landed["worklist"].rows if "worklist" in landed else _read(spark, a.worklist, schemas.WORKLIST),
        _read(spark, a.buyers, schemas.BUYERS),
        _read(spark, a.po_docs, schemas.PO_DOC),
        _read(spark, a.req_docs, schemas.REQ_DOC),
        ctx, f"{out}/backlog", archive_root=a.archive)
    if a.po:
        paths.update(report.run_throughput_report(_read(spark, a.po, schemas.PO),
                                                  _read(spark, a.buyers, schemas.BUYERS),
                                                  ctx, f"{out}/throughput"))
    print(json.dumps({**paths, **{f"{k}_extract": x.counts.get for k, x in landed.items()}}, indent=1))
    return 0


if __name__ == "__main__":
    sys.exit(main())
