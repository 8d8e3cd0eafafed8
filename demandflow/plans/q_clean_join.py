"""Registered queries: filters (F), imputation (I), joins (J), leak check."""

from __future__ import annotations

from pyspark.sql import functions as F

from demandflow.functions.timefeat import with_time_columns
from demandflow.operators import clean as C
from demandflow.operators import lag as L
from demandflow.operators.stats import mode_of, quantile_frame
from demandflow.plans import inputs as I
from demandflow.plans.registry import context, query, rnd, sql_rnd
from demandflow.sources.observations import oracle

STATS_CTE = """stats as (select
  (select quantile_cont(Temperature, 0.5) from history) as temp_median,
  (select RoadType from (select RoadType, count(*) as n from history where RoadType is not null group by 1)
     order by n desc, RoadType limit 1) as road_mode,
  (select Weather from (select Weather, count(*) as n from history where Weather is not null group by 1)
     order by n desc, Weather limit 1) as weather_mode,
  (select quantile_cont(NumberofLanes, 0.5) from history) as lanes_median,
  (select count(*) from history where NumberofLanes is null) as lanes_nulls,
  (select quantile_cont(demand, 0.01) from history) as demand_lo,
  (select quantile_cont(demand, 0.99) from history) as demand_hi),
both_sides as (select "Index", Temperature, RoadType, Weather, NumberofLanes from history
  union all select "Index", Temperature, RoadType, Weather, NumberofLanes from future)"""


# ------------------------------------------------------------- filters (F)

@query("f1_day_filter", oracle("select * from history where day = 48"))
def f1(spark, sf):
    return I.history(spark, sf).where(F.col("day") == 48)


@query("f3_dropna_temperature", oracle('select "Index", Temperature, demand from history where Temperature is not null'))
def f3(spark, sf):
    return I.history(spark, sf).na.drop(subset=["Temperature"]).select("Index", "Temperature", "demand")


TOP_GH_CTE = """top_gh as (select geohash from (select geohash, count(*) as n from history group by geohash)
  order by n desc, geohash limit 1)"""


def top_geohash(h):
    """Most frequent geohash (ties to the smallest) as a one-row frame."""
    return h.groupBy("geohash").agg(F.count(F.lit(1)).alias("n")) \
            .orderBy(F.col("n").desc(), F.col("geohash")).limit(1).select("geohash")


@query("f4_rows_of_top_geohash", oracle(
    'select "Index", geohash, demand from history where geohash in (select geohash from top_gh)', TOP_GH_CTE))
def f4(spark, sf):
    h = I.history(spark, sf)
    return h.join(F.broadcast(top_geohash(h)), "geohash", "left_semi").select("Index", "geohash", "demand")


NULLS_CTE = """nulls as (
  select 'RoadType' as column_name, count(*) filter (where RoadType is null) as n_null from history
  union all select 'Temperature', count(*) filter (where Temperature is null) from history
  union all select 'Weather', count(*) filter (where Weather is null) from history
  union all select 'LargeVehicles', count(*) filter (where LargeVehicles is null) from history
  union all select 'Landmarks', count(*) filter (where Landmarks is null) from history
  union all select 'NumberofLanes', count(*) filter (where NumberofLanes is null) from history
  union all select 'geohash', count(*) filter (where geohash is null) from history
  union all select 'timestamp', count(*) filter (where "timestamp" is null) from history
  union all select 'demand', count(*) filter (where demand is null) from history
  union all select 'day', count(*) filter (where day is null) from history
  union all select 'Index', count(*) filter (where "Index" is null) from history)"""


def null_counts(df):
    """A2: one aggregate of count_if per column, unpivoted to (column_name, n_null)."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return wide.unpivot([], df.columns, "column_name", "n_null")


@query("f5_null_columns", oracle("select column_name, n_null from nulls where n_null > 0", NULLS_CTE))
def f5(spark, sf):
    return null_counts(I.history(spark, sf)).where(F.col("n_null") > 0)


@query("f6_clip_quantiles", oracle(
    f'select "Index", {sql_rnd("least(greatest(demand, demand_lo), demand_hi)")} as demand '
    "from history cross join stats", STATS_CTE))
def f6(spark, sf):
    h = I.history(spark, sf)
    bounds = quantile_frame(h, {"demand": {"lo": 0.01, "hi": 0.99}})  # one row
    clipped = F.when(F.col("demand").isNotNull(), F.least(F.greatest("demand", "lo"), F.col("hi")))
    return h.crossJoin(F.broadcast(bounds)).select("Index", rnd(clipped).alias("demand"))


@query("f8_lanes_fill", oracle(
    'select "Index", case when lanes_nulls > 0 then coalesce(NumberofLanes, lanes_median) '
    "else cast(NumberofLanes as double) end as NumberofLanes from both_sides cross join stats", STATS_CTE))
def f8(spark, sf):
    c = I.cleaned(spark, sf, "v1")
    return c.history.select("Index", "NumberofLanes").unionByName(c.future.select("Index", "NumberofLanes"))


# ---------------------------------------------------------- imputation (I)

@query("i0_train_stats", oracle(
    f"select {sql_rnd('temp_median')} as temp_median, road_mode, weather_mode, {sql_rnd('lanes_median')} as lanes_median, "
    f"cast(lanes_nulls as bigint) as lanes_nulls, {sql_rnd('demand_lo')} as demand_lo, {sql_rnd('demand_hi')} as demand_hi "
    "from stats", STATS_CTE))
def i0(spark, sf):
    """The one-row statistics frame, built lazily (distributed quantiles, two-level modes)."""
    return C.stats_frame(I.history(spark, sf)).select(
        rnd("temp_median").alias("temp_median"), "road_mode", "weather_mode",
        rnd("lanes_median").alias("lanes_median"), F.col("lanes_nulls").cast("long").alias("lanes_nulls"),
        rnd("demand_lo").alias("demand_lo"), rnd("demand_hi").alias("demand_hi"))


def _both_clean(spark, sf):
    c = I.cleaned(spark, sf, "v2")
    return c.history.drop("demand").unionByName(c.future)


@query("i1_fill_temperature", oracle(
    f'select "Index", {sql_rnd("coalesce(Temperature, temp_median)")} as Temperature from both_sides cross join stats',
    STATS_CTE))
def i1(spark, sf):
    return _both_clean(spark, sf).select("Index", rnd("Temperature").alias("Temperature"))


@query("i2_fill_roadtype", oracle(
    'select "Index", coalesce(RoadType, road_mode) as RoadType from both_sides cross join stats', STATS_CTE))
def i2(spark, sf):
    return _both_clean(spark, sf).select("Index", "RoadType")


@query("i3_fill_weather", oracle(
    'select "Index", coalesce(Weather, weather_mode) as Weather from both_sides cross join stats', STATS_CTE))
def i3(spark, sf):
    return _both_clean(spark, sf).select("Index", "Weather")


@query("i3b_mode_by_group", oracle(
    "select day, Weather as weather_mode from (select day, Weather, row_number() over "
    "(partition by day order by n desc, Weather) as r from (select day, Weather, count(*) as n from history "
    "where Weather is not null group by day, Weather)) where r = 1"))
def i3b(spark, sf):
    """Grouped mode (two aggregations, no per-group value buffer), ties to the smallest value."""
    return mode_of(I.history(spark, sf), "Weather", "weather_mode", by=["day"])


# ----------------------------------------------------------------- joins (J)

LAG_SQL = ('select h."Index", l.demand as lag_demand_1d from {side} h left join history l '
           'on l.day + 1 = h.day and l.geohash = h.geohash and l."timestamp" = h."timestamp"')


@query("j1_lag_history", oracle(LAG_SQL.format(side="history")))
def j1(spark, sf):
    h = I.history(spark, sf)
    return L.with_lag(h, h).select("Index", "lag_demand_1d")


@query("j2_lag_future", oracle(LAG_SQL.format(side="future")))
def j2(spark, sf):
    return L.with_lag(I.future(spark, sf), I.history(spark, sf)).select("Index", "lag_demand_1d")


@query("j3_day_pairs", oracle(
    'select a.geohash, a."timestamp", a.demand as demand_48, b.demand as demand_49 from history a '
    'join history b on a.geohash = b.geohash and a."timestamp" = b."timestamp" where a.day = 48 and b.day = 49'))
def j3(spark, sf):
    return L.day_pairs(I.history(spark, sf))


@query("j1_lag_by_time_slot", oracle(
    'select a."Index", b.demand as lag_demand_1d from history_t a left join history_t b '
    "on b.day + 1 = a.day and b.geohash = a.geohash and b.time_slot = a.time_slot"))
def j1_slot(spark, sf):
    h = I.history_t(spark, sf)
    return L.with_lag(h, h, at="time_slot").select("Index", "lag_demand_1d")


def _layout(spark, sf):
    return context(spark, sf).get("lag_layout", lambda: L.lag_layout(I.history(spark, sf), I.scratch(spark, "lag"), int(spark.conf.get("spark.sql.shuffle.partitions"))))


@query("j1_lag_bucketed", oracle(LAG_SQL.format(side="history")))
def j1_bucketed(spark, sf):
    return L.with_bucketed_lag(*_layout(spark, sf)).select("Index", "lag_demand_1d")


@query("j3_day_pairs_bucketed", oracle(
    'select a.geohash, a."timestamp", a.demand as demand_48, b.demand as demand_49 from history a '
    'join history b on a.geohash = b.geohash and a."timestamp" = b."timestamp" where a.day = 48 and b.day = 49'))
def j3_bucketed(spark, sf):
    return L.bucketed_day_pairs(*_layout(spark, sf))


@query("j4_lag_coverage", oracle(
    "select m.matched, t.future_rows, " + sql_rnd("m.matched / t.future_rows") + " as coverage from "
    '(select count(*) as matched from future f join history h on h.day = 48 and h.geohash = f.geohash '
    'and h."timestamp" = f."timestamp") m cross join (select count(*) as future_rows from future) t'))
def j4(spark, sf):
    r = L.lag_coverage(I.history(spark, sf), I.future(spark, sf))
    return r.select("matched", "future_rows", rnd("coverage").alias("coverage"))


@query("j7_unseen_keys", oracle(
    "select distinct geohash from future f where not exists (select 1 from history h where h.geohash = f.geohash)"))
def j7(spark, sf):
    return I.future(spark, sf).select("geohash").distinct().join(I.history(spark, sf).select("geohash").distinct(),
                                                                 "geohash", "left_anti")


@query("j8_seen_keys", oracle(
    "select distinct geohash from future f where exists (select 1 from history h where h.geohash = f.geohash)"))
def j8(spark, sf):
    return I.future(spark, sf).select("geohash").distinct().join(I.history(spark, sf).select("geohash").distinct(),
                                                                 "geohash", "left_semi")


@query("k14_leak_check", oracle(
    "select (select max(time_order) from history_t) as train_max, (select min(time_order) from future_t) as test_min, "
    "coalesce((select min(time_order) from future_t) > (select max(time_order) from history_t), true) as no_overlap"))
def k14(spark, sf):
    return C.leak_frame(with_time_columns(I.history(spark, sf)), with_time_columns(I.future(spark, sf)))


