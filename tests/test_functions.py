"""Time parsing, geohash decoding and interaction edge cases."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from demandflow.functions import geo, interact, timefeat


def encode(lat, lon, size):
    """Geohash of a point: the bits of its place along each axis, longitude first, five to a character."""
    bits = [[int((v + half) / (2 * half) * 2**40) >> (39 - i) & 1 for i in range(40)] for v, half in ((lon, 180), (lat, 90))]
    mixed = [b for pair in zip(*bits) for b in pair][:5 * size]
    return "".join(geo.BASE32[int("".join(map(str, mixed[i:i + 5])), 2)] for i in range(0, 5 * size, 5))


def test_parse_time_edges(spark):
    df = spark.createDataFrame([("0:0",), ("23:45",), ("8",), ("8:15:30",)], "timestamp string")
    rows = {r.timestamp: (r.hour, r.minute, r.time_slot)
            for r in timefeat.with_time_columns(df.withColumn("day", F.lit(48))).collect()}
    assert rows == {"0:0": (0, 0, 0), "23:45": (23, 45, 95), "8": (8, 0, 32), "8:15:30": (8, 15, 33)}


def test_flags_and_labels(spark):
    df = spark.createDataFrame([(h,) for h in range(24)], "hour int")
    out = {r.hour: r for r in df.select("hour", timefeat.is_rush_hour().alias("r"), timefeat.is_night().alias("n"),
                                       timefeat.is_peak().alias("p"), timefeat.is_low_demand().alias("l")).collect()}
    assert [h for h in range(24) if out[h].r] == [7, 8, 9, 10, 16, 17, 18, 19]
    assert [h for h in range(24) if out[h].n] == [0, 1, 2, 3, 4, 5, 6, 22, 23]
    assert [h for h in range(24) if out[h].p] == [10, 11, 12, 13, 14]
    assert [h for h in range(24) if out[h].l] == [17, 18, 19, 20]
    lab = spark.createDataFrame([(0,), (33,), (95,)], "time_slot int").select(timefeat.slot_label()).collect()
    assert [r[0] for r in lab] == ["0:00", "8:15", "23:45"]


def test_geohash_special_values(spark):
    df = spark.createDataFrame([("",), ("nan",), ("n0n",), (None,)], "g string")
    lat, lon = geo.decode_geohash("g")
    rows = df.select("g", lat.alias("lat"), lon.alias("lon")).collect()
    got = {r.g: (r.lat, r.lon) for r in rows}
    assert got[""] == (0.0, 0.0)
    assert got["nan"] == got["n0n"]
    assert got[None] == (None, None)


@settings(max_examples=15, deadline=None)
@given(st.integers(0, 10_000))
def test_geohash_decode_of_encoded_points(spark, seed):
    rnd = random.Random(seed)
    points = [(rnd.uniform(-89.9, 89.9), rnd.uniform(-179.9, 179.9), rnd.randint(1, 15)) for _ in range(100)]
    df = spark.createDataFrame([(encode(*p), *p) for p in points], "g string, y double, x double, n int")
    lat, lon = geo.decode_geohash("g")
    for r in df.select("y", "x", "n", lat.alias("lat"), lon.alias("lon")).collect():
        # a centre is at most half a cell away; the cell halves once for each bit
        assert abs(r.lat - r.y) <= 90 / 2 ** (5 * r.n // 2) + 1e-9 and abs(r.lon - r.x) <= 180 / 2 ** ((5 * r.n + 1) // 2) + 1e-9


def test_geohash_published_values(spark):
    rows = [("ezs42", 42.605, -5.603), ("u4pruydqqvj", 57.64911, 10.40744), ("", 0.0, 0.0), ("s", 22.5, 22.5), ("9q8yyk8ytpxr0000", 37.77493, -122.41942)]
    lat, lon = geo.decode_geohash("g")
    for r in spark.createDataFrame(rows, "g string, y double, x double").select("g", "y", "x", lat.alias("lat"), lon.alias("lon")).collect():
        assert abs(r.lat - r.y) < 1e-3 and abs(r.lon - r.x) < 1e-3
    unknown = spark.createDataFrame([("ai0", "000"), ("slo", "s00")], "g string, same string")
    lat2, lon2 = geo.decode_geohash("same")
    assert all((r.lat, r.lon) == (r.lat2, r.lon2) for r in unknown.select(lat.alias("lat"), lon.alias("lon"), lat2.alias("lat2"), lon2.alias("lon2")).collect())


def test_null_text_in_interactions(spark):
    df = spark.createDataFrame([("Highway", None, "Sunny", 4, "Yes", 20.0, 8, 1, 1)],
                               "RoadType string, LargeVehicles string, Weather string, NumberofLanes int, "
                               "Landmarks string, Temperature double, hour int, is_rush_hour int, is_peak int")
    r = interact.with_interactions(df).first()
    assert r.road_vehicles == "Highway_nan"
    assert r.road_encoded == 2 and r.road_capacity == 8 and r.road_score == 10 and r.road_hour == 56
    assert r.is_high_capacity == 1 and r.large_vehicles_allowed == 0 and r.temp_highway == 20.0


def test_decode_splits_a_row_once(spark):
    """The text is split once for each coordinate, not again for every character."""
    lat, lon = geo.decode_geohash("g")
    assert str(lat).count("split(") == 1 and str(lon).count("split(") == 1
