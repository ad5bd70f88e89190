"""Business dates and pull windows."""

from __future__ import annotations

import re
from contextlib import suppress
from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from landfall.functions.columns import as_col


#: The two accepted shapes. Blanks around a date are ignored, anything else is not a date.
DATE_SHAPE = r"([0-9]{4})(-?)([0-9]{2})\2([0-9]{2})"


def parse_biz_date(text: str) -> str:
    """The date of one text as YYYY-MM-DD; raises unless it has an accepted shape and exists."""
    parts = re.fullmatch(DATE_SHAPE, text.strip(" "))
    if parts:
        year, _, month, day = parts.groups()
        with suppress(ValueError):
            return date(int(year), int(month), int(day)).isoformat()
    raise ValueError(f"invalid business date: {text!r}")


def resolve_biz_date(args: dict | None, env: str | None, now: datetime, scheduled: bool) -> str:
    """biz_date, then bizdate, then the environment value; today only for an interactive run."""
    args = args or {}
    for candidate in (args.get("biz_date"), args.get("bizdate"), env):
        if candidate is not None and str(candidate).strip():
            return parse_biz_date(str(candidate))
    if scheduled:
        raise ValueError("a scheduled run must be given its business date")
    return now.date().isoformat()


def normalize_biz_date(c) -> Column:
    """Column form of :func:`parse_biz_date`; an invalid text gives null."""
    text = F.trim(as_col(c))
    whole = f"^{DATE_SHAPE}$"
    return F.when(text.rlike(whole), F.regexp_replace(text, whole, "$1-$3-$4")).try_cast("date").cast("string")


def window_bounds(dt: str, days: int, closed: bool = False) -> tuple[str, str]:
    """The text bounds of a pull window of ``days`` days ending with ``dt``."""
    end = date.fromisoformat(dt)
    start = end - timedelta(days=days - 1)
    if closed:
        return f"{start} 00:00:00", f"{end} 23:59:59"
    return start.isoformat(), (end + timedelta(days=1)).isoformat()


def in_window(ts, dt: str, days: int, closed: bool = False) -> Column:
    """Half-open day window, or a closed window to the second. Literal bounds reach the scan."""
    low, high = (F.lit(b).cast("timestamp_ntz") for b in window_bounds(dt, days, closed))
    ts = as_col(ts)
    return (ts >= low) & (ts <= high) if closed else (ts >= low) & (ts < high)
