"""Ways to name the day of an event. They agree because sessions are pinned to UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_by_cast(event_time: str = "event_time") -> Column:
    return F.to_date(event_time)


def day_by_truncation(event_time: str = "event_time") -> Column:
    """The day as a timestamp at midnight."""
    return F.date_trunc("day", F.col(event_time))


def day_window(event_time: str = "event_time") -> Column:
    """A tumbling one-day window, a struct of start and end."""
    return F.window(event_time, "1 day")


def day_by_window(event_time: str = "event_time") -> Column:
    """The day as the start of its window."""
    return day_window(event_time)["start"].cast("date")
