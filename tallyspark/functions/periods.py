"""Period keys and the run timestamp."""

from __future__ import annotations

from datetime import datetime
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyspark.constants import RUN_TIMEZONE


def month_key(year: Column, month: Column) -> Column:
    """``YYYYMM`` with a zero-padded month."""
    return F.format_string("%d%02d", year, month)


def quarter_key(year: Column, quarter: Column) -> Column:
    """``YYYYQ`` (five characters)."""
    return F.format_string("%d%d", year, quarter)


def run_ts(now: datetime | None = None) -> str:
    """Wall-clock time in the run timezone, ``yyyy-MM-dd HH:mm:ss``.

    Taken once on the driver and passed as a literal so every row and every
    re-computation of a lost partition sees the same value.
    """
    now = now or datetime.now(ZoneInfo(RUN_TIMEZONE))
    if now.tzinfo is not None:
        now = now.astimezone(ZoneInfo(RUN_TIMEZONE))
    return now.strftime("%Y-%m-%d %H:%M:%S")
