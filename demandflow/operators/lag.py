"""One-day lag.

The lookup is history shifted one day forward, joined on the raw
(day, geohash, timestamp) text key. Both sides hash on that key; the key is
unique per observation cell, so no partition is hot.

Observations that are lagged again and again are better stored once in
buckets of that key (``lag_layout``): cells and shifted cells fall into the same
buckets, so every later lag join or pairing of days reads them without a shuffle.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LAG_KEYS = ["day", "geohash", "timestamp"]


def lag_lookup(history: DataFrame, target: str = "demand", name: str = "lag_demand_1d", at: str = "timestamp") -> DataFrame:
    return history.select((F.col("day") + 1).alias("day"), "geohash", at, F.col(target).alias(name))


def with_lag(df: DataFrame, history: DataFrame, target: str = "demand",
             name: str = "lag_demand_1d", at: str = "timestamp") -> DataFrame:
    """Left join; no previous-day cell gives null. ``at``: the time of day, as text or as ``time_slot``
    (which also matches '8:0' with '08:00')."""
    return df.join(lag_lookup(history, target, name, at), ["day", "geohash", at], "left")


def _bucketed(df: DataFrame, folder: str, buckets: int) -> DataFrame:
    """``df`` as a table of one sorted file a bucket of the lag's keys, under ``folder``."""
    name = f"lag_{uuid.uuid4().hex}"
    (df.repartition(buckets, *LAG_KEYS).write.format("parquet").option("path", f"{folder}/{name}")
       .bucketBy(buckets, *LAG_KEYS).sortBy(*LAG_KEYS).saveAsTable(name))
    return df.sparkSession.table(name)


def lag_layout(obs: DataFrame, folder: str, buckets: int, target: str = "demand", name: str = "lag_demand_1d") -> tuple[DataFrame, DataFrame]:
    """(cells, lookup): ``obs`` and its cells shifted by a day, in ``buckets`` buckets of the lag's keys."""
    cells = _bucketed(obs, folder, buckets)
    return cells, _bucketed(lag_lookup(cells, target, name), folder, buckets)


def with_bucketed_lag(cells: DataFrame, lookup: DataFrame) -> DataFrame:
    """J1/J2 on a layout: the join finds both sides of a bucket in one task."""
    return cells.join(lookup, LAG_KEYS, "left")


def bucketed_day_pairs(cells: DataFrame, lookup: DataFrame, day_b: int = 49, target: str = "demand", lagged: str = "lag_demand_1d") -> DataFrame:
    """J3 for consecutive days on a layout: cells of ``day_b`` and of the day before."""
    both = cells.where(F.col("day") == day_b).join(lookup, LAG_KEYS, "inner")
    return both.select("geohash", "timestamp", F.col(lagged).alias(f"{target}_{day_b - 1}"), F.col(target).alias(f"{target}_{day_b}"))


def day_pairs(obs: DataFrame, day_a: int = 48, day_b: int = 49, target: str = "demand") -> DataFrame:
    """Cells seen on both days, inner join on (geohash, timestamp)."""
    a = obs.where(F.col("day") == day_a).select("geohash", "timestamp", F.col(target).alias(f"{target}_{day_a}"))
    b = obs.where(F.col("day") == day_b).select("geohash", "timestamp", F.col(target).alias(f"{target}_{day_b}"))
    return a.join(b, ["geohash", "timestamp"], "inner")


def lag_coverage(history: DataFrame, future: DataFrame, day: int = 48) -> DataFrame:
    """Future rows that find a day-``day`` cell on (geohash, timestamp), over future rows."""
    prev = history.where(F.col("day") == day).select("geohash", "timestamp")
    matched = future.select("geohash", "timestamp").join(prev, ["geohash", "timestamp"], "inner") \
                    .agg(F.count(F.lit(1)).alias("matched"))
    total = future.agg(F.count(F.lit(1)).alias("future_rows"))
    return matched.crossJoin(total).withColumn(
        "coverage", F.col("matched") / F.col("future_rows"))
