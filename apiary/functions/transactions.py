"""Column functions for card transactions: the accept flag and calendar split."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Status names and the threshold of the flag (fixed values).
ACCEPTED = "ACCEPTED"
REJECTED = "REJECTED"
ACCEPT_FROM = 5

DATE_TEXT_FORMAT = "yyyy-MM-dd"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def txn_status(init_status: Column | str) -> Column:
    """``REJECTED`` below 5, ``ACCEPTED`` from 5 on, null stays null."""
    s = _col(init_status)
    return F.when(s < ACCEPT_FROM, F.lit(REJECTED)).when(s >= ACCEPT_FROM, F.lit(ACCEPTED))


def calendar_columns(ts: Column | str) -> dict[str, Column]:
    """The calendar split stored next to a transaction instant (UTC)."""
    t = _col(ts)
    return {
        "year": F.year(t),
        "month": F.month(t),
        "day": F.dayofmonth(t),
        "hour": F.hour(t),
        "min": F.minute(t),
        "date_text": F.date_format(t, DATE_TEXT_FORMAT),
    }
