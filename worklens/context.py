"""Run parameters.

The reference reads "today" from the host clock and the snapshot time from the
launcher.  Here every date is a literal carried in one frozen object, so a run
is reproducible and no plan ever calls ``current_date()``.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from decimal import Decimal


# Fixed values that must equal the reference's for identical results.
# Category levels in display order for the backlog report, and for the
# throughput report; the dimension's fourth group is IGNORE.
BACKLOG_LEVELS = ("NINV", "SE", "INV")
THROUGHPUT_LEVELS = ("INV", "NINV", "SE")
IGNORE_CATEGORY = "IGNORE"
# Status flag values in the extracts.
HOLD_YES, HOLD_NO = "Y", "N"
OTB_REQUESTED, OTB_NOT_REQUESTED = "Requested", "Not Requested"
# Bin lower edges (closed-open); the last edge also catches everything else.
BACKLOG_AGE_EDGES = (0, 30, 60, 90)
BACKLOG_AMOUNT_EDGES = (0, 250000, 500000)
APPROVER_AGE_EDGES = (0, 7, 14, 30)
APPROVER_AMOUNT_EDGES = (0, 50000, 250000, 500000)
# PO statuses kept by the throughput query (approved, completed, dispatched).
PO_STATUSES = ("A", "C", "D")
# Width of the requisition description, ellipsis included.
DESCRIPTION_WIDTH = 53

BROADCAST_MAX_ROWS = 1_000_000


@dataclass(frozen=True)
class RunContext:
    """Everything a run depends on besides its input tables."""

    as_of: dt.date
    # Window of approval dates, both ends included; None leaves that end open.
    date_from: dt.date | None = None
    date_to: dt.date | None = None
    # Instant written with this run's snapshot (default: midnight of as_of).
    archive_time: dt.datetime | None = None
    # Throughput: strict lower bound on the PO date; None keeps all POs.
    po_date_after: dt.date | None = None
    # Wide throughput: its week columns end with the week of this date (default: as_of).
    po_weeks_until: dt.date | None = None
    po_statuses: tuple[str, ...] = PO_STATUSES
    min_age_days: int = 90
    min_po_amount: Decimal = Decimal("50000")
    # Snapshot dates of the archive history the trend fixtures are built from.
    history_dates: tuple[dt.date, ...] = ()
    # Largest dimension (rows) that may be broadcast.
    broadcast_max_rows: int = BROADCAST_MAX_ROWS

    @property
    def snapshot(self) -> dt.datetime:
        return self.archive_time or dt.datetime.combine(self.as_of, dt.time())

    @property
    def report_weeks(self) -> list[dt.date]:
        """The Sundays of the wide throughput report: a range given by the run, not the data.

        From the week after which POs count (a year before ``as_of`` if no bound is
        set) to that of ``po_weeks_until``.
        """
        first = self.po_date_after or self.as_of - dt.timedelta(weeks=52)
        last = self.po_weeks_until or self.as_of
        sunday = first - dt.timedelta(days=(first.weekday() + 1) % 7)
        return [sunday + dt.timedelta(weeks=i) for i in range((last - sunday).days // 7 + 1)]
