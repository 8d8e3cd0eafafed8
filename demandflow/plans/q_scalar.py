"""Registered queries: time (T), geohash (G) and interaction (C) columns."""

from __future__ import annotations


from pyspark.sql import functions as F

from demandflow.functions import geo, interact, timefeat
from demandflow.operators.stats import checked_broadcast, quantile_frame
from demandflow.plans import inputs as I
from demandflow.plans.registry import query, rnd, sql_rnd
from demandflow.sources.observations import _SQL_HISTORY, oracle


def _obs_t(spark, sf):
    return timefeat.with_time_columns(I.obs(spark, sf))


# ---------------------------------------------------------------- time (T)

@query("t1_parse_time", oracle('select "Index", "timestamp", hour, minute from obs_t'))
def t1(spark, sf):
    return _obs_t(spark, sf).select("Index", "timestamp", "hour", "minute")


@query("t2_time_slot", oracle('select "Index", time_slot from obs_t'))
def t2(spark, sf):
    return _obs_t(spark, sf).select("Index", "time_slot")


@query("t3_time_order", oracle('select "Index", time_order from obs_t'))
def t3(spark, sf):
    return _obs_t(spark, sf).select("Index", "time_order")


@query("t4_frac_hour", oracle(f'select "Index", {sql_rnd("hour + minute / 60.0")} as frac_hour from obs_t'))
def t4(spark, sf):
    return _obs_t(spark, sf).select("Index", rnd(timefeat.frac_hour()).alias("frac_hour"))


@query("t5_slot_label", oracle(
    "select distinct time_slot, printf('%d:%02d', time_slot // 4, (time_slot % 4) * 15) as slot_label from obs_t"))
def t5(spark, sf):
    return _obs_t(spark, sf).select("time_slot", timefeat.slot_label().alias("slot_label")).distinct()


@query("t6_time_of_day", oracle(
    """select "Index", strftime(strptime("timestamp", '%H:%M'), '%H:%M:%S') as time_of_day from obs_t"""))
def t6(spark, sf):
    return _obs_t(spark, sf).select("Index", F.date_format(timefeat.time_of_day(), "HH:mm:ss").alias("time_of_day"))


def _cyc_sql(src: str, period: float, name: str) -> str:
    return (f'select "Index", {sql_rnd(f"sin(2 * pi() * {src} / {period})")} as {name}_sin, '
            f'{sql_rnd(f"cos(2 * pi() * {src} / {period})")} as {name}_cos from obs_t')


def _cyc(src: str, period: float, name: str):
    def fn(spark, sf):
        s, c = timefeat.cyclical(src, period)
        return _obs_t(spark, sf).select("Index", rnd(s).alias(f"{name}_sin"), rnd(c).alias(f"{name}_cos"))
    return fn


for _id, (_src, _period, _name) in {"t7_cyclical_hour": ("hour", 24.0, "hour"),
                                    "t8_cyclical_minute": ("minute", 60.0, "minute"),
                                    "t9_cyclical_slot": ("time_slot", 96.0, "slot"),
                                    "t10_cyclical_day": ("day", 7.0, "day")}.items():
    query(_id, oracle(_cyc_sql(_src, _period, _name)))(_cyc(_src, _period, _name))


_FLAGS = {
    "t11_is_rush_hour": ("is_rush_hour", timefeat.is_rush_hour, "hour between 7 and 10 or hour between 16 and 19"),
    "t12_is_night": ("is_night", timefeat.is_night, "hour >= 22 or hour <= 6"),
    "t13_is_low_demand": ("is_low_demand", timefeat.is_low_demand, "hour between 17 and 20"),
    "t14_is_peak": ("is_peak", timefeat.is_peak, "hour between 10 and 14"),
}


def _flag(name, fn):
    return lambda spark, sf: _obs_t(spark, sf).select("Index", fn().alias(name))


for _id, (_name, _fn, _cond) in _FLAGS.items():
    query(_id, oracle(f'select "Index", cast(coalesce({_cond}, false) as integer) as {_name} from obs_t'))(
        _flag(_name, _fn))


# ------------------------------------------------------------- geohash (G)

SQL_CHARS = 12  # unrolled characters; the fixture's codes are shorter


def sql_decode(col: str = "geohash") -> tuple[str, str]:
    """DuckDB text of G1 (lat, lon): per-character codes at fixed shifts, then the closed form."""
    lon_terms, lat_terms = [], []
    lon_left = lat_left = 30
    for j in range(SQL_CHARS):
        code = f"greatest(instr('{geo.BASE32}', substr({col}, {j + 1}, 1)) - 1, 0)"
        three = f"(((({code}) >> 4) & 1) * 4 + ((({code}) >> 2) & 1) * 2 + (({code}) & 1))"
        two = f"(((({code}) >> 3) & 1) * 2 + ((({code}) >> 1) & 1))"
        if j % 2 == 0:
            lon_left, lat_left = lon_left - 3, lat_left - 2
            lon_terms.append(f"{three} * {1 << lon_left}")
            lat_terms.append(f"{two} * {1 << lat_left}")
        else:
            lon_left, lat_left = lon_left - 2, lat_left - 3
            lon_terms.append(f"{two} * {1 << lon_left}")
            lat_terms.append(f"{three} * {1 << lat_left}")
    n = f"length({col})"
    lon_bits, lat_bits = f"ceil({n} * 5 / 2)", f"floor({n} * 5 / 2)"
    lon_idx = f"floor(cast({' + '.join(lon_terms)} as double) / pow(2, 30 - {lon_bits}))"
    lat_idx = f"floor(cast({' + '.join(lat_terms)} as double) / pow(2, 30 - {lat_bits}))"
    ok = f"{col} is not null and {n} <= {SQL_CHARS}"
    lat = f"case when {ok} then ({lat_idx} + 0.5) * 180.0 / pow(2, {lat_bits}) - 90.0 end"
    lon = f"case when {ok} then ({lon_idx} + 0.5) * 360.0 / pow(2, {lon_bits}) - 180.0 end"
    return lat, lon


SQL_LAT, SQL_LON = sql_decode("geohash")
GEO_CTE = f"""geo as (select "Index", geohash, {SQL_LAT} as latitude, {SQL_LON} as longitude,
  substr(geohash, 1, 4) as geohash_4, substr(geohash, 1, 5) as geohash_5,
  case when {_SQL_HISTORY} then 'history' else 'future' end as side from obs_t),
center as (select quantile_cont(latitude, 0.5) as clat, quantile_cont(longitude, 0.5) as clon
  from geo where side = 'history')"""


@query("g1_geohash_decode", oracle(
    f"select distinct geohash, {sql_rnd(SQL_LAT)} as latitude, {sql_rnd(SQL_LON)} as longitude from observations"))
def g1(spark, sf):
    lat, lon = geo.decode_geohash("geohash")
    return I.obs(spark, sf).select("geohash").distinct().select(
        "geohash", rnd(lat).alias("latitude"), rnd(lon).alias("longitude"))


@query("g2_decode_distinct_join", oracle(
    f'select "Index", {sql_rnd("latitude")} as latitude, {sql_rnd("longitude")} as longitude from geo',
    GEO_CTE))
def g2(spark, sf):
    """Decode each distinct code once, then a size-checked broadcast join back."""
    o = I.obs(spark, sf)
    lat, lon = geo.decode_geohash("geohash")
    table = o.select("geohash").distinct().select("geohash", lat.alias("latitude"), lon.alias("longitude"))
    return o.select("Index", "geohash").join(checked_broadcast(table), "geohash", "left").select(
        "Index", rnd("latitude").alias("latitude"), rnd("longitude").alias("longitude"))


@query("g3_geohash_prefixes", oracle('select "Index", geohash_4, geohash_5 from geo', GEO_CTE))
def g3(spark, sf):
    return I.obs(spark, sf).select("Index", geo.geohash_prefix("geohash", 4).alias("geohash_4"),
                                   geo.geohash_prefix("geohash", 5).alias("geohash_5"))


@query("g4_geohash_prefix3", oracle('select "Index", substr(geohash, 1, 3) as gh3 from observations'))
def g4(spark, sf):
    return I.obs(spark, sf).select("Index", geo.geohash_prefix("geohash", 3).alias("gh3"))


@query("g5_geohash_length", oracle('select "Index", length(geohash) as gh_len from observations'))
def g5(spark, sf):
    return I.obs(spark, sf).select("Index", geo.geohash_length().alias("gh_len"))


@query("g6_city_center", oracle(
    f"select {sql_rnd('clat')} as center_lat, {sql_rnd('clon')} as center_lon from center", GEO_CTE))
def g6(spark, sf):
    located = geo.with_geo_columns(I.history(spark, sf), decoded=I.decoded(spark, sf))
    medians = quantile_frame(located, {"latitude": {"lat": 0.5}, "longitude": {"lon": 0.5}})
    return medians.select(rnd("lat").alias("center_lat"), rnd("lon").alias("center_lon"))


@query("g7_dist_to_center", oracle(
    f'select "Index", {sql_rnd("sqrt(pow(latitude - clat, 2) + pow(longitude - clon, 2))")} as dist_to_center '
    "from geo cross join center", GEO_CTE))
def g7(spark, sf):
    c = I.cleaned(spark, sf).center
    return geo.with_geo_columns(I.obs(spark, sf), decoded=I.decoded(spark, sf)).select(
        "Index", rnd(geo.dist_to_center(*c)).alias("dist_to_center"))


# ---------------------------------------------------------- interactions (C)

CLEAN_CTE = f"""stats as (select
  (select quantile_cont(Temperature, 0.5) from history) as temp_median,
  (select RoadType from (select RoadType, count(*) as n from history where RoadType is not null group by 1)
     order by n desc, RoadType limit 1) as road_mode,
  (select Weather from (select Weather, count(*) as n from history where Weather is not null group by 1)
     order by n desc, Weather limit 1) as weather_mode),
clean_all as (select o."Index", o.geohash, o.day, o."timestamp", o.demand,
  coalesce(o.RoadType, s.road_mode) as RoadType, o.NumberofLanes, o.LargeVehicles, o.Landmarks,
  coalesce(o.Temperature, s.temp_median) as Temperature, coalesce(o.Weather, s.weather_mode) as Weather,
  o.hour, o.minute, o.time_slot, o.time_order,
  case when {_SQL_HISTORY} then 'history' else 'future' end as side
  from obs_t o cross join stats s),
inter as (select *,
  coalesce(RoadType, 'nan') || '_' || coalesce(Weather, 'nan') as road_weather,
  coalesce(RoadType, 'nan') || '_' || coalesce(LargeVehicles, 'nan') as road_vehicles,
  case RoadType when 'Residential' then 0 when 'Street' then 1 when 'Highway' then 2 else 0 end as road_encoded,
  cast(coalesce(RoadType = 'Highway', false) as integer) as is_highway,
  cast(coalesce(RoadType = 'Street', false) as integer) as is_street,
  cast(coalesce(NumberofLanes >= 4, false) as integer) as is_high_capacity,
  cast(coalesce(Weather in ('Rainy', 'Snowy', 'Foggy'), false) as integer) as is_bad_weather,
  cast(coalesce(Landmarks = 'Yes', false) as integer) as has_landmark,
  cast(coalesce(LargeVehicles = 'Allowed', false) as integer) as large_vehicles_allowed,
  cast(coalesce(hour between 7 and 10 or hour between 16 and 19, false) as integer) as is_rush_hour,
  cast(coalesce(hour between 10 and 14, false) as integer) as is_peak
  from clean_all)"""


def _clean_both(spark, sf):
    c = I.cleaned(spark, sf, "v2")
    both = c.history.drop("demand").unionByName(c.future)
    both = timefeat.with_time_flags(both, "v2")
    return interact.with_interactions(both, v2_extras=True)


_C_SIMPLE = {
    "c1_road_weather": ("road_weather", "road_weather"),
    "c2_road_vehicles": ("road_vehicles", "road_vehicles"),
    "c3_road_encoded": ("road_encoded", "road_encoded"),
    "c4_road_capacity": ("road_capacity", "road_encoded * NumberofLanes"),
    "c5_lanes_sq": ("lanes_sq", "NumberofLanes * NumberofLanes"),
    "c6_is_highway": ("is_highway", "is_highway"),
    "c7_is_street": ("is_street", "is_street"),
    "c8_is_high_capacity": ("is_high_capacity", "is_high_capacity"),
    "c9_is_bad_weather": ("is_bad_weather", "is_bad_weather"),
    "c12_has_landmark": ("has_landmark", "has_landmark"),
    "c13_large_vehicles_allowed": ("large_vehicles_allowed", "large_vehicles_allowed"),
    "c14_road_score": ("road_score", "road_encoded * 3 + NumberofLanes"),
    "c15_road_hour": ("road_hour", "road_encoded * 24 + hour"),
    "c16_highway_rush": ("highway_rush", "is_highway * is_rush_hour"),
    "c17_highway_peak": ("highway_peak", "is_highway * is_peak"),
    "c18_lanes_peak": ("lanes_peak", "NumberofLanes * is_peak"),
}


def _csel(col):
    return lambda spark, sf: _clean_both(spark, sf).select("Index", col)


for _id, (_col, _expr) in _C_SIMPLE.items():
    query(_id, oracle(f'select "Index", {_expr} as {_col} from inter', CLEAN_CTE))(_csel(_col))


@query("c10_temp_bad_weather", oracle(
    f'select "Index", {sql_rnd("Temperature * is_bad_weather")} as temp_bad_weather from inter', CLEAN_CTE))
def c10(spark, sf):
    return _clean_both(spark, sf).select("Index", rnd("temp_bad_weather").alias("temp_bad_weather"))


@query("c11_temp_highway", oracle(
    f'select "Index", {sql_rnd("Temperature * is_highway")} as temp_highway from inter', CLEAN_CTE))
def c11(spark, sf):
    return _clean_both(spark, sf).select("Index", rnd("temp_highway").alias("temp_highway"))


@query("c19_composite_keys", oracle(
    "select geohash || '_' || cast(hour as varchar) as gh_hour, count(*) as n from inter "
    "where side = 'history' group by geohash, hour", CLEAN_CTE))
def c19(spark, sf):
    """Group on the column tuple; the text key is built on the (small) output only."""
    h = I.cleaned(spark, sf, "v2").history
    return h.groupBy("geohash", "hour").agg(F.count(F.lit(1)).alias("n")).select(
        F.concat_ws("_", "geohash", F.col("hour").cast("string")).alias("gh_hour"), "n")


def _composite(a, b):
    def fn(spark, sf):
        h = I.cleaned(spark, sf, "v2").history.withColumn("geohash_4", geo.geohash_prefix("geohash", 4))
        return h.groupBy(a, b).agg(F.count(F.lit(1)).alias("n")).select(F.concat_ws("_", F.col(a).cast("string"), F.col(b).cast("string")).alias("key"), "n")
    return fn


for _name, _a, _b in (("road_hour", "RoadType", "hour"), ("geohash_road", "geohash", "RoadType"), ("geohash4_hour", "geohash_4", "hour")):
    query(f"c19_{_name}_keys", oracle(
        f"select cast(a as varchar) || '_' || cast(b as varchar) as key, count(*) as n from "
        f"(select {_a if _a != 'geohash_4' else 'substr(geohash, 1, 4)'} as a, {_b} as b from inter where side = 'history') group by a, b", CLEAN_CTE))(_composite(_a, _b))


@query("c20_log1p_demand", oracle(f'select "Index", {sql_rnd("ln(1 + demand)")} as log1p_demand from history'))
def c20(spark, sf):
    return I.history(spark, sf).select("Index", rnd(F.log1p("demand")).alias("log1p_demand"))


