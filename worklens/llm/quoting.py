"""Quotation linking: reply-ordered conversations without quoted text.

A line that starts with quote marks (``>``, with spaces between) is quoted; the
number of marks is its level.  The lines of a message are parsed into own lines
(level 0) and quoted ones.  Every line is normalised (lower case, runs of
blanks to one space) and hashed, and a quoted line is joined to the message
that wrote it as an own line: first within the same conversation, in an
earlier turn, and only if no message there has it, to the first message
anywhere.  A line quoted at level 1 answers its writer directly; deeper levels
are quotes of quotes.  A message replies to the earlier message of its own
conversation whose lines it quotes most at its lowest linked level; ties go to
the latest.

Before the join the writers of a line are reduced to one row per conversation
and line (its first turn) and one per line (its first message), so a line that
a third of all messages share is one row; quoted lines need only an equi-join.

Replies form trees.  Roots and depths are found by pointer doubling over the
messages that quote, a logarithmic number of joins.  ``conv_id``, ``root_turn``,
``depth``, ``turn`` is the reply order.

Defined cases: null text has no lines; a quoted line that nobody wrote, and a
blank one, link to nothing and are removed all the same; a message without
linked quotes starts a thread; repeated rows (conv_id and turn) are one message
made of the smallest role and text; rows with a null conv_id or turn are kept
unlinked, as their own roots; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from worklens.llm.common import materialize

#: The quote marks at the start of a line.
MARKS = r"^[ \t]*((?:>[ \t]*)+)"


def messages(table: DataFrame) -> DataFrame:
    """conv_id, turn, role, text: one row per message."""
    rows = table.select("conv_id", F.col("turn").cast("long").alias("turn"),
                        F.col("role").cast("string").alias("role"),
                        F.col("text").cast("string").alias("text"))
    known = F.col("conv_id").isNotNull() & F.col("turn").isNotNull()
    one = rows.where(known).groupBy("conv_id", "turn").agg(
        F.min(F.struct("text", "role")).alias("m"))
    return one.select("conv_id", "turn", "m.role", "m.text").unionByName(rows.where(~known))


def parse(msgs: DataFrame) -> DataFrame:
    """Adds ``lines``: array of (level, body) in the order of the text."""
    def line(x):
        marks = F.regexp_extract(x, MARKS, 1)
        return F.struct(
            F.length(F.regexp_replace(marks, "[^>]", "")).alias("level"),
            F.regexp_replace(x, MARKS, "").alias("body"))
    return msgs.withColumn("lines", F.transform(
        F.split(F.coalesce("text", F.lit("")), "\n"), line))


def normalised_hash(body):
    """128 bits of the normalised line; null for a blank one."""
    flat = F.trim(F.regexp_replace(F.lower(body), r"\s+", " "))
    return F.when(flat != "", F.md5(flat.cast("binary")))


def link(parsed: DataFrame) -> DataFrame:
    """(conv_id, turn, level, to_conv, to_turn, n): quoted lines by the message that wrote them."""
    lines = parsed.where("conv_id is not null and turn is not null").select(
        "conv_id", "turn", F.explode("lines").alias("l"))
    lines = lines.select("conv_id", "turn", F.col("l.level").alias("level"),
                         normalised_hash(F.col("l.body")).alias("h")).where("h is not null")
    quoted = lines.where("level > 0")
    own = lines.where("level = 0")
    here = own.groupBy("conv_id", "h").agg(F.min("turn").alias("here_turn"))
    first = own.groupBy("h").agg(F.min(F.struct("conv_id", "turn")).alias("first"))
    near = quoted.join(here, ["conv_id", "h"], "left").withColumn(
        "here_turn", F.expr("if(here_turn < turn, here_turn, null)"))
    far = near.where("here_turn is null").join(first, "h").where(
        "first.conv_id <> conv_id").select(
        "conv_id", "turn", "level", F.col("first.conv_id").alias("to_conv"),
        F.col("first.turn").alias("to_turn"))
    close = near.where("here_turn is not null").select(
        "conv_id", "turn", "level", F.col("conv_id").alias("to_conv"),
        F.col("here_turn").alias("to_turn"))
    return close.unionByName(far).groupBy("conv_id", "turn", "level", "to_conv", "to_turn").agg(
        F.count("*").alias("n"))


def replies(links: DataFrame) -> DataFrame:
    """(conv_id, turn, parent_turn, n_linked) of the messages with a linked quote."""
    inside = links.where("to_conv = conv_id")
    parent = inside.groupBy("conv_id", "turn").agg(F.max_by(
        "to_turn", F.struct(-F.col("level"), F.col("n"), F.col("to_turn"))).alias("parent_turn"))
    count = links.groupBy("conv_id", "turn").agg(F.sum("n").alias("n_linked"))
    return count.join(parent, ["conv_id", "turn"], "left")


def threads(parents: DataFrame) -> DataFrame:
    """(conv_id, turn, root_turn, depth) for messages with a parent, by pointer doubling."""
    at = parents.select("conv_id", "turn", F.col("parent_turn").alias("up"),
                        F.lit(1).cast("long").alias("depth"))
    while True:
        at = materialize(at, "quote-threads")
        above = at.select("conv_id", F.col("turn").alias("up"), F.col("up").alias("up2"),
                          F.col("depth").alias("more"))
        step = at.join(above, ["conv_id", "up"], "left")
        if step.where("up2 is not null").isEmpty():
            return at.withColumnRenamed("up", "root_turn")
        at = step.select("conv_id", "turn", F.coalesce("up2", "up").alias("up"),
                         (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"))


def conversations(table: DataFrame) -> DataFrame:
    """One row per message with its place in the reply order and its text without quotes.

    conv_id, turn, role, parent_turn, root_turn, depth, n_quoted, n_linked,
    max_level, text.
    """
    parsed = parse(messages(table))
    linked = materialize(replies(link(parsed)), "quote-links")
    tree = threads(linked.where("parent_turn is not null"))
    quoted = F.filter("lines", lambda x: x["level"] > 0)
    own = F.transform(F.filter("lines", lambda x: x["level"] == 0), lambda x: x["body"])
    out = parsed.select(
        "conv_id", "turn", "role", F.size(quoted).cast("long").alias("n_quoted"),
        F.coalesce(F.array_max(F.transform("lines", lambda x: x["level"])), F.lit(0))
         .cast("long").alias("max_level"),
        F.trim(F.array_join(own, "\n")).alias("text"))
    return (out.join(linked, ["conv_id", "turn"], "left")
               .join(tree, ["conv_id", "turn"], "left")
               .select("conv_id", "turn", "role", "parent_turn",
                       F.coalesce("root_turn", "turn").alias("root_turn"),
                       F.coalesce("depth", F.lit(0)).cast("long").alias("depth"), "n_quoted",
                       F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"),
                       "max_level", "text"))

