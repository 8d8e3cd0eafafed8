"""Time features from the raw ``'H:M'`` text."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_hour(ts: str | Column = "timestamp") -> Column:
    """Integer before the first colon."""
    return F.split(_c(ts), ":").getItem(0).cast("int")


def parse_minute(ts: str | Column = "timestamp") -> Column:
    """Integer after the first colon, 0 when there is none; later parts ignored."""
    return F.coalesce(F.get(F.split(_c(ts), ":"), F.lit(1)).cast("int"), F.lit(0))


def time_slot(hour: str | Column = "hour", minute: str | Column = "minute") -> Column:
    """15-minute slot of the day, hour*4 + minute div 15."""
    return (_c(hour) * 4 + F.floor(_c(minute) / 15)).cast("int")


def time_order(day: str | Column = "day", slot: str | Column = "time_slot") -> Column:
    """Global slot number day*96 + slot."""
    return (_c(day) * 96 + _c(slot)).cast("int")


def with_time_columns(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """T1-T3 as columns hour, minute, time_slot, time_order."""
    return (df.withColumn("hour", parse_hour(ts))
              .withColumn("minute", parse_minute(ts))
              .withColumn("time_slot", time_slot())
              .withColumn("time_order", time_order()))


def frac_hour(hour: str | Column = "hour", minute: str | Column = "minute") -> Column:
    """T4."""
    return _c(hour) + _c(minute) / 60.0


def slot_label(slot: str | Column = "time_slot") -> Column:
    """T5: 'h:mm' label of a slot."""
    s = _c(slot)
    return F.format_string("%d:%02d", F.floor(s / 4).cast("int"), (s % 4 * 15).cast("int"))


def time_of_day(ts: str | Column = "timestamp") -> Column:
    """Text to a time of day (on 1970-01-01)."""
    return F.to_timestamp(_c(ts), "H:m")


def cyclical(c: str | Column, period: float) -> tuple[Column, Column]:
    """(sin, cos) of 2*pi*c/period."""
    angle = _c(c) * (2.0 * math.pi) / float(period)
    return F.sin(angle), F.cos(angle)


CYCLES = (("hour", 24.0), ("minute", 60.0), ("time_slot", 96.0), ("day", 7.0))
CYCLE_NAMES = {"hour": "hour", "minute": "minute", "time_slot": "slot", "day": "day"}


def with_cyclical(df: DataFrame) -> DataFrame:
    cols = {}
    for src, period in CYCLES:
        s, c = cyclical(src, period)
        cols[f"{CYCLE_NAMES[src]}_sin"] = s
        cols[f"{CYCLE_NAMES[src]}_cos"] = c
    return df.withColumns(cols)


def _flag(cond: Column) -> Column:
    return F.coalesce(cond, F.lit(False)).cast("int")


def is_rush_hour(hour: str | Column = "hour") -> Column:
    """7..10 or 16..19, inclusive."""
    h = _c(hour)
    return _flag(h.between(7, 10) | h.between(16, 19))


def is_night(hour: str | Column = "hour") -> Column:
    """Hour >= 22 or <= 6."""
    h = _c(hour)
    return _flag((h >= 22) | (h <= 6))


def is_low_demand(hour: str | Column = "hour") -> Column:
    """17..20."""
    return _flag(_c(hour).between(17, 20))


def is_peak(hour: str | Column = "hour") -> Column:
    """10..14."""
    return _flag(_c(hour).between(10, 14))


def with_time_flags(df: DataFrame, naming: str = "v2") -> DataFrame:
    """T4, T11-T14; V1 names the two windows is_low_demand_window / is_peak_window."""
    low, peak = ("is_low_demand_window", "is_peak_window") if naming == "v1" else ("is_low_demand", "is_peak")
    return df.withColumns({
        "is_rush_hour": is_rush_hour(),
        "is_night": is_night(),
        low: is_low_demand(),
        peak: is_peak(),
        "frac_hour": frac_hour(),
    })
