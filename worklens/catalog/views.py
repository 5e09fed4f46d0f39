"""Temporary views over the inputs and report datasets, for ``spark.sql`` users.

    register_views(spark, "/data/sf0.01")
    spark.sql("select category, sum(total) from age_table group by category")

Views are lazy: registering runs nothing.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from worklens.catalog.inputs import Inputs
from worklens.plans import archive, backlog, throughput, worklist


def register_views(spark: SparkSession, sf_dir: str) -> list[str]:
    """Create or replace one temp view per input and dataset; returns the view names."""
    i = Inputs(spark, sf_dir)
    ctx = i.ctx
    views = {
        "buyers_cat": i.buyers, "backlog_raw": i.backlog_raw, "approver_raw": i.approver_raw,
        "po_data": i.po_data, "backlog_split": i.split, "prepared_worklist": i.prepared,
        "age_table": backlog.age_table(i.split), "age_report": backlog.age_report(i.split),
        "status_chart": backlog.status_chart(i.split, i.buyers),
        "old_table": backlog.old_table(i.split, ctx),
        "amount_report": backlog.amount_report(i.split, ctx),
        "approver_overview": worklist.approver_overview(i.prepared),
        "approver_detail": worklist.approver_detail(i.prepared, i.po_docs, i.req_docs, ctx),
        "archive_history": archive.backlog_history(i.split, ctx.history_dates),
        "po_throughput": throughput.po_throughput(i.po_data, i.buyers, ctx),
        "line_throughput": throughput.line_throughput(i.po_data, i.buyers, ctx),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)
