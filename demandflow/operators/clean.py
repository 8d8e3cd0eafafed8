"""Cleaning: train statistics, imputation, clipping, the time-leak check.

I1-I3 and F6/F8 share one set of history statistics, computed once. The
statistics are scalars (one row, proven size), so they are read back and
applied as literals; both sides then stay a single narrow stage.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandflow.operators.stats import quantile_frame, scalar_row


@dataclass(frozen=True)
class TrainStats:
    temp_median: float | None
    road_mode: str | None
    weather_mode: str | None
    lanes_median: float | None
    lanes_nulls: int
    demand_lo: float | None
    demand_hi: float | None
    extra: dict | None = None


def stats_frame(history: DataFrame, clip_lower: float = 0.01, clip_upper: float = 0.99,
                extra: dict[str, dict[str, float]] | None = None) -> DataFrame:
    """One-row frame (temp_median, road_mode, weather_mode, lanes_median, lanes_nulls, demand_lo, demand_hi).

    All quantiles, those of ``extra`` {column: {name: probability}} included, are ranked in one plan; both modes and
    the null count come from one table of value counts.
    """
    quantiles = quantile_frame(history, {"Temperature": {"temp_median": 0.5}, "NumberofLanes": {"lanes_median": 0.5},
                                         "demand": {"demand_lo": clip_lower, "demand_hi": clip_upper}} | (extra or {}))
    values = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in ("RoadType", "Weather", "NumberofLanes")])
    counts = history.select(F.explode(values).alias("x")).select("x.*").groupBy("c", "v").agg(F.count(F.lit(1)).alias("n"))
    first = lambda c: F.min(F.when((F.col("c") == c) & F.col("v").isNotNull(), F.struct((-F.col("n")).alias("n"), "v")))["v"]
    categories = counts.agg(first("RoadType").alias("road_mode"), first("Weather").alias("weather_mode"),
                            F.coalesce(F.max(F.when((F.col("c") == "NumberofLanes") & F.col("v").isNull(), F.col("n"))), F.lit(0)).alias("lanes_nulls"))
    names = [name for wanted in (extra or {}).values() for name in wanted]
    return quantiles.crossJoin(categories).select("temp_median", "road_mode", "weather_mode", "lanes_median", "lanes_nulls",
                                                  "demand_lo", "demand_hi", *names)  # 1 x 1


def train_stats(history: DataFrame, clip_lower: float = 0.01, clip_upper: float = 0.99,
                extra: dict | None = None) -> TrainStats:
    """The statistics of ``stats_frame``, plus quantiles of ``extra`` {column: probs}, read in one job."""
    named = {c: {f"x{i}_{j}": p for j, p in enumerate(ps)} for i, (c, ps) in enumerate((extra or {}).items())}
    r = scalar_row(stats_frame(history, clip_lower, clip_upper, named))
    return TrainStats(r["temp_median"], r["road_mode"], r["weather_mode"], r["lanes_median"], int(r["lanes_nulls"]), r["demand_lo"], r["demand_hi"],
                      {c: [r[name] for name in names] for c, names in named.items()})


def impute(df: DataFrame, st: TrainStats, fill_lanes: bool = True) -> DataFrame:
    """I1-I3 (and F8: lanes median only when history had lane nulls)."""
    cols = {
        "Temperature": F.coalesce(F.col("Temperature"), F.lit(st.temp_median).cast("double")),
        "RoadType": F.coalesce(F.col("RoadType"), F.lit(st.road_mode).cast("string")),
        "Weather": F.coalesce(F.col("Weather"), F.lit(st.weather_mode).cast("string")),
    }
    if fill_lanes:  # a double column whatever the data, as a median may lie between two counts
        lanes = F.col("NumberofLanes").cast("double")
        cols["NumberofLanes"] = lanes if st.lanes_nulls == 0 else F.coalesce(lanes, F.lit(st.lanes_median).cast("double"))
    return df.withColumns(cols)


def clip_column(df: DataFrame, col: str, lo: float | None, hi: float | None) -> DataFrame:
    """Clip to [lo, hi] (a bound of None is open)."""
    c = F.col(col)
    if lo is not None:
        c = F.greatest(c, F.lit(float(lo)))
    if hi is not None:
        c = F.least(c, F.lit(float(hi)))
    return df.withColumn(col, F.when(F.col(col).isNull(), None).otherwise(c))


def leak_frame(history_t: DataFrame, future_t: DataFrame) -> DataFrame:
    """K14 as data: (train_max, test_min, no_overlap)."""
    tmax = history_t.agg(F.max("time_order").alias("train_max"))
    tmin = future_t.agg(F.min("time_order").alias("test_min"))
    return tmax.crossJoin(tmin).withColumn(
        "no_overlap", F.coalesce(F.col("test_min") > F.col("train_max"), F.lit(True)))


def assert_no_leak(history_t: DataFrame, future_t: DataFrame) -> None:
    """Stop when future slots do not all come after history."""
    r = scalar_row(leak_frame(history_t, future_t))
    if not r["no_overlap"]:
        raise ValueError(f"future starts at slot {r['test_min']}, history ends at {r['train_max']}")
