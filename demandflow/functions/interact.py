"""Category and interaction features.

Null text follows the reference: a null category printed as text is 'nan'.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Road codes and the bad-weather set.
ROAD_CODES = {"Residential": 0, "Street": 1, "Highway": 2}
BAD_WEATHER = ["Rainy", "Snowy", "Foggy"]
NULL_TEXT = "nan"


def as_text(c: str | Column) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(col.cast("string"), F.lit(NULL_TEXT))


def joined(a: str, b: str) -> Column:
    """A + '_' + b with null printed as 'nan'."""
    return F.concat(as_text(a), F.lit("_"), as_text(b))


def flag(cond: Column) -> Column:
    return F.coalesce(cond, F.lit(False)).cast("int")


def road_encoded(road: str = "RoadType") -> Column:
    """Residential 0, Street 1, Highway 2, anything else 0."""
    mapping = F.create_map(*[x for k, v in ROAD_CODES.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(mapping[F.col(road)], F.lit(0)).cast("int")


def with_interactions(df: DataFrame, v2_extras: bool = True) -> DataFrame:
    """C1-C14, plus C15-C18 for V2/NB. Needs hour and, for V2, is_rush_hour/is_peak."""
    lanes = F.col("NumberofLanes")
    out = df.withColumns({
        "road_weather": joined("RoadType", "Weather"),
        "road_vehicles": joined("RoadType", "LargeVehicles"),
        "road_encoded": road_encoded(),
    })
    out = out.withColumns({
        "road_capacity": F.col("road_encoded") * lanes,
        "lanes_sq": lanes * lanes,
        "is_highway": flag(F.col("RoadType") == "Highway"),
        "is_street": flag(F.col("RoadType") == "Street"),
        "is_high_capacity": flag(lanes >= 4),
        "is_bad_weather": flag(F.col("Weather").isin(BAD_WEATHER)),
        "has_landmark": flag(F.col("Landmarks") == "Yes"),
        "large_vehicles_allowed": flag(F.col("LargeVehicles") == "Allowed"),
        "road_score": F.col("road_encoded") * 3 + lanes,
    })
    out = out.withColumns({
        "temp_bad_weather": F.col("Temperature") * F.col("is_bad_weather"),
        "temp_highway": F.col("Temperature") * F.col("is_highway"),
    })
    if v2_extras:
        peak = "is_peak" if "is_peak" in df.columns else "is_peak_window"
        out = out.withColumns({
            "road_hour": F.col("road_encoded") * 24 + F.col("hour"),
            "highway_rush": F.col("is_highway") * F.col("is_rush_hour"),
            "highway_peak": F.col("is_highway") * F.col(peak),
            "lanes_peak": lanes * F.col(peak),
        })
    return out
