"""Remaining useful life and the labels derived from it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wearline.schema import ALARM_AT, WARN_AT


def remaining_life(last_cycle: Column, cycle: Column, beyond: Column | None = None) -> Column:
    """Cycles left after this one; ``beyond`` is the life known to follow the last cycle."""
    end = last_cycle if beyond is None else beyond + last_cycle
    return end - cycle


def binary_label(rul: Column, warn_at: int = WARN_AT) -> Column:
    """1 from ``warn_at`` cycles before the end, inclusive, else 0."""
    return F.when(rul <= warn_at, 1).otherwise(0)


def three_class_label(rul: Column, warn_at: int = WARN_AT, alarm_at: int = ALARM_AT) -> Column:
    """2 in the alarm zone, 1 in the warning zone before it, 0 earlier; bounds inclusive."""
    return F.when(rul <= alarm_at, 2).when(rul <= warn_at, 1).otherwise(0)
