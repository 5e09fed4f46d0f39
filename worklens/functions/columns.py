"""Scalar helpers: Column -> Column, all built-in expressions (codegen, no UDF)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from worklens.context import DESCRIPTION_WIDTH


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def to_date(col: Column | str) -> Column:
    """D-01: date-time -> date (session time zone)."""
    return F.to_date(_c(col))


def wall_clock_as_utc(col: Column | str) -> Column:
    """D-01 (streaming): a ``timestamp_ntz`` wall-clock -> the instant it names in UTC.

    Watermarks need a zone-aware timestamp; a plain cast would read the wall
    clock in the session zone and move window boundaries with it.  Built from
    zone-free parts (epoch day and time of day), so the result does not depend
    on ``spark.sql.session.timeZone``.  Whole seconds.
    """
    c = _c(col)
    secs = (F.unix_date(F.to_date(c)).cast("long") * 86400
            + F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c))
    return F.timestamp_seconds(secs)


def age_days(col: Column | str, as_of: dt.date | Column) -> Column:
    """D-02: whole days from ``col`` to the run date; negative when in the future."""
    end = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return F.datediff(end, F.to_date(_c(col)))


def parse_date(col: Column | str) -> Column:
    """D-04: leading ``yyyy-MM-dd`` of a text field -> date; unparsable -> null."""
    return F.try_to_date(F.substring(_c(col), 1, 10), "yyyy-MM-dd")


def fiscal_year(col: Column | str) -> Column:
    """D-05: fiscal year starting in July (2001-07-01 is in FY2002)."""
    return F.year(F.add_months(F.to_date(_c(col)), 6))


def is_current_fy(col: Column | str, as_of: dt.date) -> Column:
    """D-06: same fiscal year as the run date."""
    return fiscal_year(col) == fiscal_year(F.lit(as_of))


def is_given_fy(col: Column | str, fy: int) -> Column:
    """D-07: fiscal year equals ``fy``."""
    return fiscal_year(col) == F.lit(fy)


def week_start_sunday(col: Column | str) -> Column:
    """D-08: the Sunday on or before the date (``dayofweek`` is 1 on Sunday)."""
    d = F.to_date(_c(col))
    return F.date_sub(d, F.dayofweek(d) - 1)


def format_week(col: Column | str) -> Column:
    """D-09: ``MM/dd`` label of a date (the year is dropped, as in the report)."""
    return F.date_format(_c(col), "MM/dd")


def abbreviate(col: Column | str, n: int = 2) -> Column:
    """D-10: first ``n`` characters."""
    return F.left(_c(col), F.lit(n))


def truncate_ellipsis(col: Column | str, width: int = DESCRIPTION_WIDTH) -> Column:
    """D-11: at most ``width`` characters, the last three being ``...`` when cut."""
    c = _c(col)
    return F.when(F.length(c) > width,
                  F.concat(F.substring(c, 1, width - 3), F.lit("..."))).otherwise(c)


def trim(col: Column | str) -> Column:
    """D-12: strip surrounding blanks."""
    return F.trim(_c(col))


def sorted_list_text(col: Column | str, sep: str = ", ") -> Column:
    """D-13 (aggregate): the sorted values of a group joined into one text.

    Only for groups of bounded size (e.g. buyers of the dimension).
    """
    return F.array_join(F.array_sort(F.collect_list(_c(col))), sep)


def usd(col: Column | str) -> Column:
    """D-14: ``$1,234,567``; whole dollars, half-even rounding."""
    return F.concat(F.lit("$"), F.format_number(_c(col), 0))


def row_sum(cols: Sequence[Column | str]) -> Column:
    """D-17: sum of columns, null when any is null."""
    out = _c(cols[0])
    for c in cols[1:]:
        out = out + _c(c)
    return out


def fixed_bins(col: Column | str, edges: Sequence[int], underflow: str = "top") -> Column:
    """D-18: closed-open bins labelled by their lower edge.

    ``edges`` are ascending lower edges; the last bin is open-ended and, as in
    the reference's nested conditionals, also catches values below the first
    edge (``underflow="top"``).  ``underflow="null"`` leaves those unbinned.
    A null input stays null.
    """
    c = _c(col)
    expr = F.when(c.isNull(), F.lit(None))
    for lo, hi in zip(edges[:-1], edges[1:]):
        expr = expr.when((c >= lo) & (c < hi), F.lit(lo))
    last = F.lit(edges[-1])
    if underflow == "top":
        return expr.otherwise(last)
    if underflow == "null":
        return expr.when(c >= edges[-1], last)
    raise ValueError(f"underflow must be 'top' or 'null', not {underflow!r}")


def category_in(col: Column | str, levels: Sequence[str]) -> Column:
    """D-20: the value when it is one of ``levels``, else null."""
    c = _c(col)
    return F.when(c.isin(*levels), c)


def category_rank(col: Column | str, levels: Sequence[str]) -> Column:
    """D-20: 1-based position in ``levels``; null outside them (sorts last)."""
    c = _c(col)
    expr = F.when(c.isNull(), F.lit(None))
    for i, level in enumerate(levels, start=1):
        expr = expr.when(c == level, F.lit(i))
    return expr


def array_length(col: Column | str) -> Column:
    """D-22: number of elements, 0 when the array is missing."""
    return F.coalesce(F.size(_c(col)), F.lit(0))
