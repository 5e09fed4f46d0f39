"""Explicit schemas for every input.

The reference infers types from spreadsheets and reads its archive back by
column position.  Here every source is read with a fixed StructType, so the
output schema of every plan is known before any data is touched.
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)

# One row per open requisition (the backlog extract).
BACKLOG = T.StructType([
    T.StructField("business_unit", T.StringType()),
    T.StructField("requisition_id", T.StringType()),
    T.StructField("hold", T.StringType()),
    T.StructField("requisition_date", T.DateType()),
    T.StructField("origin", T.StringType()),
    T.StructField("requester", T.StringType()),
    T.StructField("date_of_approval", T.DateType()),
    T.StructField("buyer", T.StringType()),
    T.StructField("last_change_date", T.DateType()),
    T.StructField("buyer_assignment", T.StringType()),
    T.StructField("hold_req_process", T.StringType()),
    T.StructField("out_to_bid", T.StringType()),
    T.StructField("req_total", MONEY),
])

# One row per PO line on the approver's worklist, with repeats.
WORKLIST = T.StructType([
    T.StructField("user", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("oper_id", T.StringType()),
    T.StructField("date_time", T.TimestampNTZType()),
    T.StructField("unit", T.StringType()),
    T.StructField("po_no", T.StringType()),
    T.StructField("origin", T.StringType()),
    T.StructField("merch_amt", MONEY),
    T.StructField("line", T.IntegerType()),
    # Tie breakers of repeated lines, if given: landed extracts get their row's place as tie1.
    T.StructField("tie1", T.LongType()),
    T.StructField("tie2", T.LongType()),
])

# Buyer dimension.
BUYERS = T.StructType([
    T.StructField("category", T.StringType(), False),
    T.StructField("buyer", T.StringType(), False),
])

# Purchase orders (throughput source).  ``lines`` is the nested line list of a
# document source; a normalised source carries ``n_lines`` instead (or both).
PO_LINE = T.StructType([
    T.StructField("line_no", T.IntegerType()),
    T.StructField("requisition", T.StructType([
        T.StructField("req_id", T.StringType()),
        T.StructField("req_line", T.IntegerType()),
    ])),
])
PO = T.StructType([
    T.StructField("po_no", T.StringType()),
    T.StructField("po_date", T.TimestampNTZType()),
    T.StructField("buyer", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("n_lines", T.LongType()),
    T.StructField("lines", T.ArrayType(PO_LINE)),
])

# Documents behind the PO -> requisition lookup; of several with one key the one
# updated last counts.
UPDATED = T.StructField("updated_at", T.TimestampNTZType())
PO_DOC = T.StructType([
    T.StructField("po_no", T.StringType()),
    T.StructField("lines", T.ArrayType(PO_LINE)),
    UPDATED,
])
REQ_DOC = T.StructType([
    T.StructField("req_id", T.StringType()),
    T.StructField("approved_on", T.StringType()),
    T.StructField("buyer", T.StringType()),
    T.StructField("lines", T.ArrayType(T.StructType([
        T.StructField("more_info", T.StringType()),
    ]))),
    UPDATED,
])

# First archive layout: ten columns, partitioned by the date of the snapshot.
ARCHIVE_BACKLOG = T.StructType([
    T.StructField("requisition_id", T.StringType()),
    T.StructField("hold", T.StringType()),
    T.StructField("out_to_bid", T.StringType()),
    T.StructField("date_of_approval", T.DateType()),
    T.StructField("buyer", T.StringType()),
    T.StructField("req_total", MONEY),
    T.StructField("age", T.IntegerType()),
    T.StructField("category", T.StringType()),
    T.StructField("archive_time", T.DateType()),
    T.StructField("status", T.StringType()),
])

TOTAL_MONEY = T.DecimalType(38, 2)
ARCHIVE_WORKLIST = T.StructType([
    T.StructField("po_no", T.StringType()),
    T.StructField("date_time", T.TimestampNTZType()),
    T.StructField("tie1", T.LongType()),
    T.StructField("tie2", T.LongType()),
    T.StructField("sum_of_po_amt", TOTAL_MONEY),
    T.StructField("age", T.IntegerType()),
    T.StructField("archive_time", T.DateType()),
])

# Archive of snapshots: every source column but the last change date, the instant of the
# run, and the status that tells the three backlog collections apart.
INSTANT = T.StructField("archive_time", T.TimestampNTZType())
SNAPSHOT_BACKLOG = T.StructType([
    *[f for f in BACKLOG.fields if f.name != "last_change_date"],
    T.StructField("age", T.IntegerType()),
    T.StructField("category", T.StringType()),
    INSTANT,
    T.StructField("status", T.StringType()),
])
SNAPSHOT_WORKLIST = T.StructType([
    *[f for f in WORKLIST.fields if f.name not in ("merch_amt", "line")],
    T.StructField("sum_of_po_amt", TOTAL_MONEY),
    T.StructField("age", T.IntegerType()),
    INSTANT,
])
# Mergeable counts per snapshot commit (trends).
STATUS_SUMMARY = T.StructType([
    T.StructField("commit", T.StringType()), INSTANT,
    T.StructField("status", T.StringType()), T.StructField("category", T.StringType()),
    T.StructField("all", T.LongType()), T.StructField("90plus", T.LongType()),
])
WORKLIST_SUMMARY = T.StructType([
    T.StructField("commit", T.StringType()), INSTANT, T.StructField("cnt", T.LongType()),
])
