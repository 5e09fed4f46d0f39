"""The reference's inputs as views over the driver's star-schema tables.

The driver ships TPC-H-like tables, not procurement extracts, so each input is
derived from them by a fixed, documented rule (FIXTURES.md §2).  Deterministic
null injection uses key arithmetic inside CASE expressions; no rows are ever
filtered out by it.  Every view reads whole tables and grows with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from worklens.context import BROADCAST_MAX_ROWS
from worklens.operators.core import checked_dimension
from worklens.schemas import MONEY
from worklens.session import plan_memo


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; the relation (file listing + footer schema) is built once per session.

    Only the logical plan object is reused; every query still scans the files.
    """
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    memo = plan_memo(spark, "tables")
    if path not in memo:
        memo[path] = spark.read.parquet(path)
    return memo[path]


def buyer_name(nationkey: Column, name: Column) -> Column:
    """Buyer login: zero-padded nation key, underscore, nation name."""
    return F.concat(F.lpad(nationkey.cast("string"), 2, "0"), F.lit("_"), name)


# Category per region key, and the two dimension buyers that
# never own work (one visible, one in the IGNORE group).
REGION_CATEGORY = {0: "NINV", 1: "SE", 2: "INV", 3: "IGNORE"}
IDLE_BUYERS = (("SE", "90_IDLE"), ("IGNORE", "91_IDLE"))


def buyers_cat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-03: buyer dimension (category, buyer): nations of regions 0-3 plus two idle buyers."""
    n = table(spark, sf_dir, "nation")
    region = F.col("n_regionkey")
    cat = F  # F.when(...) starts the CASE chain, Column.when(...) extends it
    for key, name in REGION_CATEGORY.items():
        cat = cat.when(region == key, name)
    from_nations = (n.where(F.col("n_regionkey") < 4)
                     .select(cat.alias("category"),
                             buyer_name(F.col("n_nationkey"), F.col("n_name")).alias("buyer")))
    # A literal relation built on the JVM side (no Python-side rows), so the
    # dimension's plan is identical on every call.
    rows = F.array(*[F.struct(F.lit(c).alias("category"), F.lit(b).alias("buyer"))
                     for c, b in IDLE_BUYERS])
    idle = spark.range(1).select(F.inline(rows))
    return from_nations.unionByName(idle)


def _orders_with_buyer(spark: SparkSession, sf_dir: str,
                       orders: DataFrame | None = None) -> DataFrame:
    o = orders if orders is not None else table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (o.join(c, o.o_custkey == c.c_custkey)
             .join(checked_dimension(n, "n_nationkey", BROADCAST_MAX_ROWS),
                   F.col("c_nationkey") == F.col("n_nationkey"))
             .withColumn("buyer_login", buyer_name(F.col("n_nationkey"), F.col("n_name"))))


def backlog_raw(spark: SparkSession, sf_dir: str, orders: DataFrame | None = None,
                keep: tuple[str, ...] = (), whole: bool = False) -> DataFrame:
    """S-01 view: one open requisition per order (``orders`` may be a stream).

    The columns that the reports use; ``whole`` adds the extract's others, which
    only the archive keeps.  ``keep`` carries extra columns of ``orders`` through.
    """
    k = F.col("o_orderkey")
    approved = F.to_date("o_orderdate")
    others = [
        F.concat(F.lit("BU"), (k % 7).cast("string")).alias("business_unit"),
        F.date_sub(approved, (k % 5).cast("int")).alias("requisition_date"),
        F.substring("o_orderpriority", 1, 1).alias("origin"),
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("requester"),
        F.date_add(approved, (k % 9).cast("int")).alias("last_change_date"),
        F.col("buyer_login").alias("buyer_assignment"),
        F.when(F.col("o_orderstatus") == "P", "Hold").alias("hold_req_process"),
    ]
    return _orders_with_buyer(spark, sf_dir, orders).select(
        *keep, *(others if whole else ()),
        k.cast("string").alias("requisition_id"),
        F.when(F.col("o_orderstatus") == "P", "Y").otherwise("N").alias("hold"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "Requested")
         .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit(None))
         .otherwise("Not Requested").alias("out_to_bid"),
        F.when(k % 103 == 0, F.lit(None))
         .otherwise(F.to_date("o_orderdate")).alias("date_of_approval"),
        F.when(k % 97 == 0, F.lit(None))
         .otherwise(F.col("buyer_login")).alias("buyer"),
        F.when(k % 101 == 0, F.lit(None))
         .otherwise((F.col("o_totalprice") * 2).cast(MONEY)).alias("req_total"),
    )


def approver_raw(spark: SparkSession, sf_dir: str, lineitem: DataFrame | None = None,
                 keep: tuple[str, ...] = (), whole: bool = False) -> DataFrame:
    """S-02 view: one worklist row per line item (repeated (po_no, line) pairs exist).

    ``keep`` carries extra columns of ``lineitem`` through (e.g. an ingest time);
    ``whole`` adds the extract's columns that only the archive keeps.
    """
    li = lineitem if lineitem is not None else table(spark, sf_dir, "lineitem")
    others = [
        F.concat(F.lit("U"), (F.col("l_suppkey") % 50).cast("string")).alias("user"),
        F.col("l_returnflag").alias("status"),
        F.concat(F.lit("O"), (F.col("l_partkey") % 20).cast("string")).alias("oper_id"),
        F.concat(F.lit("UN"), (F.col("l_orderkey") % 7).cast("string")).alias("unit"),
        F.col("l_linestatus").alias("origin"),
    ]
    return li.select(
        *keep, *(others if whole else ()),
        F.col("l_orderkey").cast("string").alias("po_no"),
        F.col("l_linenumber").alias("line"),
        F.col("l_shipdate").alias("date_time"),
        F.when(F.col("l_partkey") % 499 == 0, F.lit(None))
         .otherwise(F.col("l_extendedprice").cast(MONEY)).alias("merch_amt"),
        F.col("l_partkey").alias("tie1"),
        F.col("l_suppkey").alias("tie2"),
    )


def po_data(spark: SparkSession, sf_dir: str, orders: DataFrame | None = None) -> DataFrame:
    """S-04 view: PO header with its line count (normalised form of the nested ``lines``).

    Line counts come from a grouped count over line items: partial aggregation
    makes a PO with very many lines cost one row per map task, and no PO's
    lines are ever gathered into one array.
    """
    counts = (table(spark, sf_dir, "lineitem").groupBy("l_orderkey")
              .agg(F.count(F.lit(1)).alias("n_lines")))
    status = (F.when(F.col("o_orderstatus") == "O", "A")
               .when(F.col("o_orderstatus") == "F", "D").otherwise("X"))
    o = _orders_with_buyer(spark, sf_dir, orders)
    return (o.join(counts, o.o_orderkey == counts.l_orderkey, "left")
             .select(F.col("o_orderkey").cast("string").alias("po_no"),
                     F.col("o_orderdate").alias("po_date"),
                     status.alias("status"),
                     F.col("buyer_login").alias("buyer"),
                     F.coalesce(F.col("n_lines"), F.lit(0)).cast("bigint").alias("n_lines")))


def po_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-06 view: PO documents projected to their first line (all the lookup reads).

    The requisition id is padded with blanks, as in the document service.
    """
    li = table(spark, sf_dir, "lineitem")
    first = li.groupBy("l_orderkey").agg(F.min("l_linenumber").alias("line_no"))
    po_no = F.col("l_orderkey").cast("string")
    req = F.struct(F.concat(F.lit(" R"), po_no, F.lit(" ")).alias("req_id"),
                   F.col("line_no").alias("req_line"))
    return first.select(po_no.alias("po_no"),
                        F.array(F.struct(F.col("line_no"), req.alias("requisition")))
                         .alias("lines"))


def po_documents(spark: SparkSession, sf_dir: str, versions: bool = True) -> DataFrame:
    """S-04 / S-06 view: whole PO documents, each with all its lines (none, one or many).

    With ``versions`` every eleventh PO has an older document too, which holds
    one line of another requisition.
    """
    req = F.struct(F.concat(F.lit(" R"), F.col("l_orderkey").cast("string"), F.lit(" ")).alias("req_id"),
                   F.col("l_linenumber").alias("req_line"))
    line = F.struct(F.col("l_linenumber").alias("line_no"), req.alias("requisition"))
    lines = (table(spark, sf_dir, "lineitem").groupBy("l_orderkey")
             .agg(F.array_sort(F.collect_list(line)).alias("lines")))
    status = (F.when(F.col("o_orderstatus") == "O", "A")
               .when(F.col("o_orderstatus") == "F", "D").otherwise("X"))
    o = _orders_with_buyer(spark, sf_dir)
    docs = o.join(lines, o.o_orderkey == lines.l_orderkey, "left").select(
        F.col("o_orderkey").cast("string").alias("po_no"), F.col("o_orderdate").alias("po_date"),
        F.col("buyer_login").alias("buyer"), status.alias("status"),
        F.coalesce("lines", F.array().cast(lines.schema["lines"].dataType)).alias("lines"),
        F.col("o_orderdate").alias("updated_at"))
    if not versions:
        return docs.drop("updated_at")
    before = F.transform(F.slice("lines", 1, 1), lambda x: F.struct(
        x["line_no"].alias("line_no"), F.struct(F.lit("R-before").alias("req_id"),
                                                F.lit(0).alias("req_line")).alias("requisition")))
    older = docs.where(F.col("po_no").cast("long") % 11 == 0).withColumn("lines", before).withColumn(
        "updated_at", F.col("updated_at") - F.expr("interval 1 day"))
    return docs.unionByName(older)


def req_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-06 view: requisition documents of 0, 1 and 3 lines; every thirteenth has an older one too."""
    docs = req_docs(spark, sf_dir).withColumn("updated_at", F.lit("2001-01-01").cast("timestamp_ntz"))
    number = F.substring("req_id", 2, 20).cast("long")
    more = F.concat("lines", F.array_repeat(F.struct(F.lit("further line").alias("more_info")), 2))
    docs = docs.withColumn("lines", F.when(number % 2 == 0, more).otherwise(F.col("lines")))
    older = docs.where(number % 13 == 0).select(
        "req_id", F.lit("1999-09-09T00:00:00Z").alias("approved_on"), F.lit("before").alias("buyer"),
        F.lit(None).cast(docs.schema["lines"].dataType).alias("lines"),
        F.lit(None).cast("timestamp_ntz").alias("updated_at"))
    return docs.unionByName(older)


def req_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-06 view: requisition documents.

    Those of low-priority orders are filed under another id, so their POs
    exercise the lookup's default row.  ``lines`` is missing when the order has
    no document text.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    o = _orders_with_buyer(spark, sf_dir)
    letter = F.when(F.col("o_orderpriority") == "5-LOW", "L").otherwise("R")
    j = o.join(docs, o.o_orderkey == docs.doc_id, "left")
    return j.select(
        F.concat(letter, F.col("o_orderkey").cast("string")).alias("req_id"),
        F.concat(F.to_date("o_orderdate").cast("string"), F.lit("T00:00:00Z")).alias("approved_on"),
        F.col("buyer_login").alias("buyer"),
        F.when(F.col("text").isNotNull(),
               F.array(F.struct(F.col("text").alias("more_info")))).alias("lines"),
    )
