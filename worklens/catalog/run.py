"""The run the registered queries make over the driver's tables."""

from __future__ import annotations

import datetime as dt

from worklens.context import RunContext

FIXTURE = RunContext(
    as_of=dt.date(2001, 7, 1), date_from=dt.date(1996, 1, 1), date_to=dt.date(2001, 7, 15),
    po_date_after=dt.date(2001, 1, 1), po_weeks_until=dt.date(2001, 8, 1),
    history_dates=(dt.date(1995, 4, 2), dt.date(2001, 5, 1), dt.date(2001, 6, 1),
                   dt.date(2001, 7, 1)))
