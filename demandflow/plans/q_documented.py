"""Registered queries: documented-only operators (D1-D8), with our definitions."""

from __future__ import annotations

from pyspark.sql import functions as F

from demandflow.functions.geo import decode_geohash, dist_to_center
from demandflow.operators import documented as D
from demandflow.plans import inputs as I
from demandflow.plans.q_encode import BLEND_CTE, _submission
from demandflow.plans.registry import query, rnd, sql_avg, sql_rnd
from demandflow.sources.observations import oracle

_BOTH = ('allrows as (select "Index", geohash, day, time_slot, hour, RoadType, Temperature, Weather from history_t '
         'union all select "Index", geohash, day, time_slot, hour, RoadType, Temperature, Weather from future_t)')


def _both(spark, sf):
    cols = ["Index", "geohash", "day", "time_slot", "hour", "RoadType", "Temperature", "Weather"]
    return I.history_t(spark, sf).select(*cols).unionByName(I.future_t(spark, sf).select(*cols))


def _mode_sql(col, by):
    part = ", ".join(by)
    return (f"(select {part}, {col} as m from (select {part}, {col}, row_number() over (partition by {part} "
            f"order by n desc, {col}) as r from (select {part}, {col}, count(*) as n from history_t "
            f"where {col} is not null group by {part}, {col})) where r = 1)")


def _gmode_sql(col):
    return (f"(select {col} from (select {col}, count(*) as n from history where {col} is not null group by 1) "
            f"order by n desc, {col} limit 1)")


@query("d1_roadtype_by_geohash_mode", oracle(
    f'select b."Index", coalesce(b.RoadType, l.m, {_gmode_sql("RoadType")}) as RoadType from allrows b '
    f'left join {_mode_sql("RoadType", ["geohash"])} l on l.geohash = b.geohash', _BOTH))
def d1(spark, sf):
    return D.fill_by_group_mode(_both(spark, sf), I.history_t(spark, sf), "RoadType", ["geohash"]).select(
        "Index", "RoadType")


@query("d2_temperature_by_time_geohash_mean", oracle(
    f'select b."Index", {sql_rnd("coalesce(b.Temperature, a.m, c.m, (select " + sql_avg("Temperature") + " from history))")}'
    f' as Temperature from allrows b left join (select geohash, hour, {sql_avg("Temperature")} as m from history_t '
    f'group by geohash, hour) a on a.geohash = b.geohash and a.hour = b.hour left join (select geohash, '
    f'{sql_avg("Temperature")} as m from history_t group by geohash) c on c.geohash = b.geohash', _BOTH))
def d2(spark, sf):
    out = D.fill_by_mean_chain(_both(spark, sf), I.history_t(spark, sf), "Temperature",
                               [["geohash", "hour"], ["geohash"]])
    return out.select("Index", rnd("Temperature").alias("Temperature"))


@query("d3_weather_by_temporal_mode", oracle(
    f'select b."Index", coalesce(b.Weather, l.m, {_gmode_sql("Weather")}) as Weather from allrows b '
    f'left join {_mode_sql("Weather", ["day", "time_slot"])} l on l.day = b.day and l.time_slot = b.time_slot',
    _BOTH))
def d3(spark, sf):
    return D.fill_by_group_mode(_both(spark, sf), I.history_t(spark, sf), "Weather", ["day", "time_slot"]).select(
        "Index", "Weather")


_ROLL = ('select "Index", {expr} from history_t window w as (partition by geohash order by time_order, "Index" '
         'rows between 3 preceding and 1 preceding)')


def _rolling(spark, sf):
    return D.rolling_previous(I.history_t(spark, sf).select("Index", "geohash", "day", "time_order", "demand"))


@query("d4_rolling_mean_3", oracle(_ROLL.format(expr=sql_rnd("avg(demand) over w") + " as rolling_mean_3")))
def d4(spark, sf):
    return _rolling(spark, sf).select("Index", rnd("rolling_mean_3").alias("rolling_mean_3"))


@query("d5_rolling_std_3", oracle(_ROLL.format(expr=sql_rnd("stddev_samp(demand) over w") + " as rolling_std_3")))
def d5(spark, sf):
    return _rolling(spark, sf).select("Index", rnd("rolling_std_3").alias("rolling_std_3"))


def _points(spark, sf):
    lat, lon = decode_geohash("geohash")
    return I.history(spark, sf).select("geohash").distinct().select("geohash", lat.alias("latitude"),
                                                                    lon.alias("longitude"))


@query("d6_kmeans_zones")
def d6(spark, sf):
    return D.kmeans_zones(_points(spark, sf), 10, 42).select("geohash", "zone")


@query("d6_kmeans_zones_check", oracle("select count(distinct geohash) as n_points, true as some_zones, 0 as n_not_nearest from history where geohash is not null"))
def d6_check(spark, sf):
    """Every location is in one zone, that of its nearest centre."""
    zones = D.kmeans_zones(_points(spark, sf).where("geohash is not null"), 10, 42)
    return zones.agg(F.count_distinct("geohash").alias("n_points"), F.count_distinct("zone").between(2, 10).alias("some_zones"),
                     F.count_if(F.col("centre_gap") > 1e-9).cast("int").alias("n_not_nearest"))


@query("d7_pca_check", oracle("select count(distinct geohash) as n_points, true as falls, true as apart from history where geohash is not null"))
def d7_check(spark, sf):
    """Components in order of variance and without correlation."""
    pc = d7(spark, sf).where("geohash is not null")
    return pc.agg(F.count_distinct("geohash").alias("n_points"), (F.var_pop("pc1") >= F.var_pop("pc2")).alias("falls"), (F.abs(F.corr("pc1", "pc2")) < 1e-6).alias("apart"))


@query("d7_pca")
def d7(spark, sf):
    c = I.cleaned(spark, sf, "v2").center
    pts = _points(spark, sf).withColumn("dist_to_center", dist_to_center(*c))
    return D.pca_components(pts, ["latitude", "longitude", "dist_to_center"], 2).select("geohash", "pc1", "pc2")


@query("d8_clip_unit_interval", oracle(
    f'select "Index", {sql_rnd("least(greatest(raw, 0.0), 1.0)")} as demand from sub', BLEND_CTE))
def d8(spark, sf):
    s = _submission(spark, sf)
    return s.select("Index", rnd(F.least(F.greatest(F.col("raw"), F.lit(0.0)), F.lit(1.0))).alias("demand"))


