"""Feature tables of the three variants (E1/E2), as lazy DataFrame chains.

V1: clip demand to train quantiles, fill lanes, lag on clipped demand,
    7 encodings, frequency after the lag join.
V2: no clipping, frequency before the lag, lag on raw demand, 11 encodings.
NB: V2 without the lag column.

Both sides are read several times, for statistics, lag and row features: the caller
stores them (``inputs.stored_split``). Their row-level columns are stored once, as
every encoding aggregate reads them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandflow.functions.geo import dist_to_center, geohash_table, with_geo_columns
from demandflow.functions.interact import with_interactions
from demandflow.functions.timefeat import with_cyclical, with_time_columns, with_time_flags
from demandflow.operators.clean import (TrainStats, assert_no_leak, clip_column, impute,
                                        train_stats)
from demandflow.operators.encode import V1_ENCODINGS, V2_ENCODINGS, encode_all, with_fold
from demandflow.operators.stats import checked_broadcast
from demandflow.operators.lag import with_lag
from demandflow.session import cut_lineage
from demandflow.sources.observations import SOURCE_COLUMNS

TIME_COLS = ["hour", "minute", "time_slot", "time_order"]
GEO_COLS = ["latitude", "longitude", "geohash_4", "geohash_5", "dist_to_center"]
CYC_COLS = ["hour_sin", "hour_cos", "minute_sin", "minute_cos", "slot_sin", "slot_cos", "day_sin", "day_cos"]
INTER_COLS = ["road_weather", "road_vehicles", "road_encoded", "road_capacity", "lanes_sq", "is_highway",
              "is_street", "is_high_capacity", "is_bad_weather", "temp_bad_weather", "temp_highway",
              "has_landmark", "large_vehicles_allowed", "road_score"]
V2_EXTRA_COLS = ["road_hour", "highway_rush", "highway_peak", "lanes_peak"]


def _flag_cols(naming: str) -> list[str]:
    low, peak = ("is_low_demand_window", "is_peak_window") if naming == "v1" else ("is_low_demand", "is_peak")
    return ["is_rush_hour", "is_night", low, peak, "frac_hour"]


def column_order(variant: str, side: str) -> list[str]:
    src = SOURCE_COLUMNS if side == "history" else [c for c in SOURCE_COLUMNS if c != "demand"]
    if variant == "v1":
        tail = ["lag_demand_1d"] + [n for n, _, _ in V1_ENCODINGS] + ["geohash_freq"]
        return src + TIME_COLS + GEO_COLS + CYC_COLS + _flag_cols("v1") + INTER_COLS + tail
    mid = src + TIME_COLS + GEO_COLS + CYC_COLS + _flag_cols("v2") + INTER_COLS + V2_EXTRA_COLS + ["geohash_freq"]
    lag = ["lag_demand_1d"] if variant == "v2" else []
    return mid + lag + [n for n, _, _ in V2_ENCODINGS]


@dataclass
class Cleaned:
    history: DataFrame
    future: DataFrame
    stats: TrainStats
    center: tuple[float, float] | None = None


def clean(history: DataFrame, future: DataFrame, variant: str = "v2",
          clip_lower: float = 0.01, clip_upper: float = 0.99, with_center: bool = False,
          decoded: DataFrame | None = None) -> Cleaned:
    """Phase 1: time columns, leak check (V1), imputation, clipping (V1).

    With ``with_center`` the city centre (G6) is computed in the same
    quantile pass as the cleaning statistics (``decoded``: optional G2 table).
    """
    h, f = with_time_columns(history), with_time_columns(future)
    if variant == "v1":
        assert_no_leak(h, f)
    extra = {"latitude": [0.5], "longitude": [0.5]} if with_center else None
    st = train_stats(with_geo_columns(history, decoded=decoded) if with_center else history,
                     clip_lower, clip_upper, extra)
    h = impute(h, st, fill_lanes=(variant == "v1"))
    f = impute(f, st, fill_lanes=(variant == "v1"))
    if variant == "v1":
        h = clip_column(h, "demand", st.demand_lo, st.demand_hi)
    center = (st.extra["latitude"][0], st.extra["longitude"][0]) if with_center else None
    return Cleaned(h, f, st, center)


def row_features(df: DataFrame, center: tuple[float, float], variant: str,
                 decoded: DataFrame | None = None) -> DataFrame:
    """Geo, cyclical, flags, interactions: per-row expressions (plus the G2 lookup join)."""
    out = with_geo_columns(df, decoded=decoded).withColumn("dist_to_center", dist_to_center(*center))
    out = with_cyclical(out)
    out = with_time_flags(out, "v1" if variant == "v1" else "v2")
    return with_interactions(out, v2_extras=(variant != "v1"))


def build_features(history: DataFrame, future: DataFrame, variant: str = "v2",
                   fold_method: str = "shuffled") -> tuple[DataFrame, DataFrame]:
    """History and future feature tables of one variant ('v1', 'v2', 'nb')."""
    decoded = checked_broadcast(geohash_table([history, future]))
    c = clean(history, future, variant, with_center=True, decoded=decoded)
    h, f = c.history, c.future
    if variant != "nb":  # the lag goes on narrow rows
        h, f = with_lag(h, h), with_lag(f, h)
    h = row_features(h, c.center, variant, decoded)
    f = row_features(f, c.center, variant, decoded)
    h, f = cut_lineage(with_fold(h, method=fold_method)), cut_lineage(f)
    spec = V1_ENCODINGS if variant == "v1" else V2_ENCODINGS
    h_e, f_e = encode_all(h, f, spec, frequency=("geohash_freq", 0))
    return (h_e.select(*column_order(variant, "history")),
            f_e.select(*column_order(variant, "future")))


def model_columns(columns: list[str]) -> list[str]:
    """Every column but Index, timestamp, demand, day."""
    return [c for c in columns if c not in ("Index", "timestamp", "demand", "day", "fold")]
