"""Registered queries: profiling aggregates (A), sorts and limits (O), set operations (U)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from demandflow.functions.geo import geohash_prefix
from demandflow.functions.timefeat import slot_label, time_of_day
from demandflow.operators import profile as P
from demandflow.operators.stats import exact_avg, exact_quantiles, ordered_row_number, quantile_frame
from demandflow.plans import inputs as I
from demandflow.plans.q_clean_join import NULLS_CTE, TOP_GH_CTE, null_counts, top_geohash
from demandflow.plans.registry import query, rnd, sql_avg, sql_rnd
from demandflow.sources.observations import SOURCE_COLUMNS, oracle

CATS = ["Weather", "RoadType", "LargeVehicles", "Landmarks", "NumberofLanes"]
NUMERIC = ["Index", "day", "demand", "NumberofLanes", "Temperature"]


@query("a1_shape", oracle("select 'history' as side, count(*) as n_rows, 11 as n_cols from history "
                          "union all select 'future', count(*), 10 from future"))
def a1(spark, sf):
    h, f = I.history(spark, sf), I.future(spark, sf)
    return (h.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit("history").alias("side"), "n_rows",
                                                             F.lit(len(h.columns)).alias("n_cols"))
            .unionByName(f.agg(F.count(F.lit(1)).alias("n_rows")).select(
                F.lit("future").alias("side"), "n_rows", F.lit(len(f.columns)).alias("n_cols"))))


@query("a2_null_counts", oracle("select column_name, n_null from nulls", NULLS_CTE))
def a2(spark, sf):
    return null_counts(I.history(spark, sf))


@query("a3_null_report", oracle(
    "select column_name, n_null, round(100.0 * n_null / (select count(*) from history), 2) as pct "
    "from nulls where n_null > 0", NULLS_CTE))
def a3(spark, sf):
    h = I.history(spark, sf)
    total = h.agg(F.count(F.lit(1)).alias("_rows"))
    return null_counts(h).where(F.col("n_null") > 0).crossJoin(F.broadcast(total)).select(
        "column_name", "n_null", F.round(F.col("n_null") * 100.0 / F.col("_rows"), 2).alias("pct"))


@query("c21_null_percent", oracle(
    "select column_name, round(100.0 * n_null / (select count(*) from history), 2) as pct "
    "from nulls where n_null > 0", NULLS_CTE))
def c21(spark, sf):
    return a3(spark, sf).select("column_name", "pct")


def _total_nulls(df):
    return df.agg(sum(F.count_if(F.col(c).isNull()) for c in df.columns).alias("total_nulls"))


@query("a4_total_nulls", oracle(
    "select 'history' as side, cast((select sum(n_null) from nulls) as bigint) as total_nulls "
    "union all select 'future', cast((select count(*) filter (where RoadType is null) "
    "+ count(*) filter (where Temperature is null) + count(*) filter (where Weather is null) from future) as bigint)",
    NULLS_CTE))
def a4(spark, sf):
    return (_total_nulls(I.history(spark, sf)).select(F.lit("history").alias("side"), "total_nulls")
            .unionByName(_total_nulls(I.future(spark, sf)).select(F.lit("future").alias("side"), "total_nulls")))


_SQL_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE"}


@query("a5_info", oracle(" union all ".join(
    f"select '{c}' as column_name, count(\"{c}\") as non_null, "
    f"(select typeof(\"{c}\") from history limit 1) as data_type from history" for c in SOURCE_COLUMNS)))
def a5(spark, sf):
    h = I.history(spark, sf)
    wide = h.agg(*[F.count(F.col(c)).alias(c) for c in h.columns])
    types = F.create_map(*[x for fld in h.schema.fields
                           for x in (F.lit(fld.name), F.lit(_SQL_TYPES.get(fld.dataType.simpleString(),
                                                                          fld.dataType.simpleString())))])
    return wide.unpivot([], h.columns, "column_name", "non_null").withColumn(
        "data_type", types[F.col("column_name")])


_DESCRIBE_SQL = " union all ".join(
    f"select '{c}' as column_name, count(\"{c}\") as count, {sql_rnd(sql_avg(f'\"{c}\"'))} as mean, "
    f"{sql_rnd(f'stddev_samp(\"{c}\")')} as std, {sql_rnd(f'min(\"{c}\")')} as min, "
    f"{sql_rnd(f'quantile_cont(\"{c}\", 0.25)')} as p25, {sql_rnd(f'quantile_cont(\"{c}\", 0.5)')} as p50, "
    f"{sql_rnd(f'quantile_cont(\"{c}\", 0.75)')} as p75, {sql_rnd(f'max(\"{c}\")')} as max from history"
    for c in NUMERIC)


@query("a6_describe", oracle(_DESCRIBE_SQL))
def a6(spark, sf):
    d = P.describe(I.history(spark, sf), NUMERIC)
    return d.select("column_name", "count", *[rnd(c).alias(c) for c in ["mean", "std", "min", "p25", "p50",
                                                                       "p75", "max"]])


@query("a7_distinct_counts", oracle(" union all ".join(
    f"select '{c}' as column_name, count(distinct \"{c}\") as n_distinct from history" for c in SOURCE_COLUMNS)))
def a7(spark, sf):
    h = I.history(spark, sf)
    return P.distinct_counts(h, h.columns)


PCTS = [1, 5, 10, 25, 50, 75, 90, 95, 99]


@query("a8_percentiles", oracle(" union all ".join(
    f"select {p} as pct, {sql_rnd(f'quantile_cont(demand, {p / 100})')} as value from history" for p in PCTS)))
def a8(spark, sf):
    q = exact_quantiles(I.history(spark, sf), "demand", [p / 100 for p in PCTS], [f"p{p}" for p in PCTS])
    return q.unpivot([], [f"p{p}" for p in PCTS], "name", "value").select(
        F.regexp_extract("name", r"(\d+)", 1).cast("int").alias("pct"), rnd("value").alias("value"))


@query("a9_target_summary", oracle(
    f"select {sql_rnd(sql_avg('demand'))} as mean, {sql_rnd('stddev_samp(demand)')} as std, "
    f"{sql_rnd('min(demand)')} as min, {sql_rnd('max(demand)')} as max, {sql_rnd('skewness(demand)')} as skew "
    "from history"))
def a9(spark, sf):
    return I.history(spark, sf).agg(
        rnd(exact_avg("demand")).alias("mean"), rnd(F.stddev_samp("demand")).alias("std"),
        rnd(F.min("demand")).alias("min"), rnd(F.max("demand")).alias("max"),
        rnd(P.skewness_unbiased("demand")).alias("skew"))


def _ranges(df, side):
    return df.agg(F.lit(side).alias("side"),
                  F.min("Index").alias("min_index"), F.max("Index").alias("max_index"),
                  F.min("timestamp").alias("min_ts"), F.max("timestamp").alias("max_ts"),
                  rnd(F.min("Temperature")).alias("min_temp"), rnd(F.max("Temperature")).alias("max_temp"),
                  F.min("hour").alias("min_hour"), F.max("hour").alias("max_hour"),
                  F.min("time_slot").alias("min_slot"), F.max("time_slot").alias("max_slot"),
                  F.min("time_order").alias("min_order"), F.max("time_order").alias("max_order"))


_RANGE_SQL = ("select '{s}' as side, min(\"Index\") as min_index, max(\"Index\") as max_index, "
              "min(\"timestamp\") as min_ts, max(\"timestamp\") as max_ts, "
              f"{sql_rnd('min(Temperature)')} as min_temp, {sql_rnd('max(Temperature)')} as max_temp, "
              "min(hour) as min_hour, max(hour) as max_hour, min(time_slot) as min_slot, max(time_slot) as max_slot, "
              "min(time_order) as min_order, max(time_order) as max_order from {t}")


@query("a10_ranges", oracle(_RANGE_SQL.format(s="history", t="history_t") + " union all " +
                            _RANGE_SQL.format(s="future", t="future_t")))
def a10(spark, sf):
    return _ranges(I.history_t(spark, sf), "history").unionByName(_ranges(I.future_t(spark, sf), "future"))


@query("a11_value_counts", oracle(" union all ".join(
    f"select '{c}' as column_name, cast(\"{c}\" as varchar) as value, count(*) as n from history group by \"{c}\""
    for c in CATS)))
def a11(spark, sf):
    return P.frequency_table(I.history(spark, sf), CATS)


GROUP_KEYS = ["gh3", "geohash", "RoadType", "Weather", "LargeVehicles", "NumberofLanes", "Landmarks"]
_GROUP_SQL = " union all ".join(
    f"select '{k}' as key_name, cast(\"{k}\" as varchar) as key_value, {sql_rnd(sql_avg('demand'))} as mean, "
    f"{sql_rnd('stddev_samp(demand)')} as std, count(*) as n from hist3 where \"{k}\" is not null group by \"{k}\""
    for k in GROUP_KEYS)
HIST3_CTE = "hist3 as (select *, substr(geohash, 1, 3) as gh3 from history)"


def _grouped(spark, sf):
    h = I.history(spark, sf).withColumn("gh3", geohash_prefix("geohash", 3))
    return P.grouped_stats(h, GROUP_KEYS)


@query("a12_stats_by_key", oracle(_GROUP_SQL, HIST3_CTE))
def a12(spark, sf):
    return _grouped(spark, sf).select("key_name", "key_value", rnd("mean").alias("mean"), rnd("std").alias("std"), "n")


@query("a13_by_hour_mean_median", oracle(
    f"select hour, {sql_rnd(sql_avg('demand'))} as mean, {sql_rnd('quantile_cont(demand, 0.5)')} as median, "
    "count(*) as n from history_t group by hour"))
def a13(spark, sf):
    h = I.history_t(spark, sf)
    med = exact_quantiles(h, "demand", [0.5], ["median"], by=["hour"], max_groups=24)
    base = h.groupBy("hour").agg(exact_avg("demand").alias("mean"), F.count(F.lit(1)).alias("n"))
    return base.join(med, "hour").select("hour", rnd("mean").alias("mean"), rnd("median").alias("median"), "n")


@query("a14_mean_by_hour", oracle(f"select hour, {sql_rnd(sql_avg('demand'))} as mean from history_t group by hour"))
def a14(spark, sf):
    return I.history_t(spark, sf).groupBy("hour").agg(rnd(exact_avg("demand")).alias("mean"))


@query("a15_mean_by_category_imputed", oracle(
    f"select 'RoadType' as key_name, coalesce(h.RoadType, s.road_mode) as key_value, {sql_rnd(sql_avg('demand'))} as mean "
    "from history h cross join stats s group by 2 union all "
    f"select 'Weather', coalesce(h.Weather, s.weather_mode), {sql_rnd(sql_avg('demand'))} from history h cross join stats s "
    "group by 2", """stats as (select
  (select RoadType from (select RoadType, count(*) as n from history where RoadType is not null group by 1)
     order by n desc, RoadType limit 1) as road_mode,
  (select Weather from (select Weather, count(*) as n from history where Weather is not null group by 1)
     order by n desc, Weather limit 1) as weather_mode)"""))
def a15(spark, sf):
    h = I.cleaned(spark, sf, "v2").history
    g = P.grouped_stats(h, ["RoadType", "Weather"])
    return g.select("key_name", "key_value", rnd("mean").alias("mean")).orderBy(F.col("mean").desc())


@query("a16_by_day", oracle(
    f"select day, {sql_rnd(sql_avg('demand'))} as mean, {sql_rnd('stddev_samp(demand)')} as std, count(*) as n "
    "from history group by day"))
def a16(spark, sf):
    return I.history(spark, sf).groupBy("day").agg(
        rnd(exact_avg("demand")).alias("mean"), rnd(F.stddev_samp("demand")).alias("std"), F.count(F.lit(1)).alias("n"))


@query("a17_first_last_time_by_day", oracle(
    "select day, strftime(min(strptime(\"timestamp\", '%H:%M')), '%H:%M:%S') as first_time, "
    "strftime(max(strptime(\"timestamp\", '%H:%M')), '%H:%M:%S') as last_time, count(*) as n "
    "from history where day in (select distinct day from history order by day limit 5) group by day"))
def a17(spark, sf):
    h = I.history(spark, sf)
    days = h.select("day").distinct().orderBy("day").limit(5)
    t = time_of_day()
    return h.join(F.broadcast(days), "day", "left_semi").groupBy("day").agg(
        F.date_format(F.min(t), "HH:mm:ss").alias("first_time"),
        F.date_format(F.max(t), "HH:mm:ss").alias("last_time"), F.count(F.lit(1)).alias("n"))


@query("a18_slot_counts", oracle(
    "select part, time_slot, printf('%d:%02d', time_slot // 4, (time_slot % 4) * 15) as slot_label, count(*) as n "
    "from (select 'history_' || day as part, time_slot from history_t "
    "union all select 'future_49', time_slot from future_t where day = 49) group by part, time_slot"))
def a18(spark, sf):
    h = I.history_t(spark, sf).select(
        F.concat(F.lit("history_"), F.col("day").cast("string")).alias("part"), "time_slot")
    f = I.future_t(spark, sf).where(F.col("day") == 49).select(F.lit("future_49").alias("part"), "time_slot")
    return h.unionByName(f).groupBy("part", "time_slot").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "slot_label", slot_label())


@query("a20_most_frequent_geohash", oracle(
    "select geohash, count(*) as n from history group by geohash order by n desc, geohash limit 1"))
def a20(spark, sf):
    return I.history(spark, sf).groupBy("geohash").agg(F.count(F.lit(1)).alias("n")) \
        .orderBy(F.col("n").desc(), "geohash").limit(1)


@query("a21_corr_temperature_demand", oracle(
    f"select {sql_rnd('corr(Temperature, demand)')} as pearson from history where Temperature is not null"))
def a21(spark, sf):
    return I.history(spark, sf).na.drop(subset=["Temperature"]).agg(
        rnd(F.corr("Temperature", "demand")).alias("pearson"))


@query("a22_corr_day_over_day", oracle(
    f"select {sql_rnd('corr(a.demand, b.demand)')} as pearson, count(*) as pairs from history a join history b "
    'on a.geohash = b.geohash and a."timestamp" = b."timestamp" where a.day = 48 and b.day = 49'))
def a22(spark, sf):
    from demandflow.operators.lag import day_pairs
    return day_pairs(I.history(spark, sf)).agg(rnd(F.corr("demand_48", "demand_49")).alias("pearson"),
                                               F.count(F.lit(1)).alias("pairs"))


@query("a23_top_geohash_hourly", oracle(
    f"select hour, {sql_rnd(sql_avg('demand'))} as mean, count(*) as n from history_t "
    "where geohash in (select geohash from top_gh) group by hour", TOP_GH_CTE))
def a23(spark, sf):
    h = I.history_t(spark, sf)
    return h.join(F.broadcast(top_geohash(h)), "geohash", "left_semi").groupBy("hour").agg(
        rnd(exact_avg("demand")).alias("mean"), F.count(F.lit(1)).alias("n"))


_HIST_SQL = ("select '{name}' as series, least(cast(floor(({x} - mn) / ((mx - mn) / 100.0)) as integer), 99) as bin, "
             "count(*) as n from (select {x} as x0, * from history) cross join "
             "(select min({x}) as mn, max({x}) as mx from history) group by 2")


@query("a24_histograms", oracle(_HIST_SQL.format(name="demand", x="demand") + " union all " +
                                _HIST_SQL.format(name="log1p_demand", x="ln(1 + demand)")))
def a24(spark, sf):
    h = I.history(spark, sf).select("demand", F.log1p("demand").alias("log1p_demand"))
    return (P.histogram(h, "demand").select(F.lit("demand").alias("series"), "bin", "n")
            .unionByName(P.histogram(h, "log1p_demand").select(F.lit("log1p_demand").alias("series"), "bin", "n")))


@query("a25_mean_before_after_clip", oracle(
    f"select {sql_rnd(sql_avg('demand'))} as mean_before, {sql_rnd(sql_avg('least(greatest(demand, lo), hi)'))} as mean_after "
    "from history cross join (select quantile_cont(demand, 0.01) as lo, quantile_cont(demand, 0.99) as hi "
    "from history)"))
def a25(spark, sf):
    h = I.history(spark, sf)
    bounds = quantile_frame(h, {"demand": {"lo": 0.01, "hi": 0.99}})  # one row
    clipped = F.when(F.col("demand").isNotNull(), F.least(F.greatest("demand", "lo"), F.col("hi")))
    return h.crossJoin(F.broadcast(bounds)).agg(rnd(exact_avg("demand")).alias("mean_before"), rnd(exact_avg(clipped)).alias("mean_after"))


@query("a26_global_mean", oracle(f"select {sql_rnd(sql_avg('demand'))} as global_mean from history"))
def a26(spark, sf):
    return I.history(spark, sf).agg(rnd(exact_avg("demand")).alias("global_mean"))


@query("a27_length_frequencies", oracle("select length(geohash) as gh_len, count(*) as n from history group by 1"))
def a27(spark, sf):
    return I.history(spark, sf).groupBy(F.length("geohash").alias("gh_len")).agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------- order (O)

@query("o1_chronological_order", oracle(
    'select "Index", time_order, row_number() over (order by time_order, "Index") - 1 as pos from history_t'))
def o1(spark, sf):
    """Position in (time_order, Index) order without a single-partition window over all rows."""
    return ordered_row_number(I.history_t(spark, sf).select("Index", "time_order"), ["time_order", "Index"], out="pos")


@query("o2_top10_by_mean", oracle(
    f"select * from (select key_name, key_value, {sql_rnd('mean')} as mean, n from (select 'gh3' as key_name, gh3 as key_value, "
    f"{sql_avg('demand')} as mean, count(*) as n from hist3 group by gh3) order by mean desc, key_value limit 10) "
    f"union all select * from (select key_name, key_value, {sql_rnd('mean')} as mean, n from (select 'geohash' as key_name, "
    f"geohash as key_value, {sql_avg('demand')} as mean, count(*) as n from hist3 group by geohash) "
    "order by mean desc, key_value limit 10)", HIST3_CTE))
def o2(spark, sf):
    g = _grouped(spark, sf).where(F.col("key_name").isin("gh3", "geohash"))
    w = Window.partitionBy("key_name").orderBy(F.col("mean").desc(), F.col("key_value"))
    return g.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= 10).select(
        "key_name", "key_value", rnd("mean").alias("mean"), "n")


_TOPK = {"geohash": 15, "Weather": 6, "RoadType": 6, "LargeVehicles": 6, "Landmarks": 6, "NumberofLanes": 6}


@query("o3_top_values", oracle(" union all ".join(
    f"select * from (select '{c}' as column_name, cast(\"{c}\" as varchar) as value, count(*) as n from history "
    f"group by \"{c}\" order by n desc, value asc nulls last limit {k})" for c, k in _TOPK.items())))
def o3(spark, sf):
    freq = P.frequency_table(I.history(spark, sf), list(_TOPK))
    return P.top_k_per_column(freq, _TOPK).select("column_name", "value", "n")


@query("o4_head", oracle('select * from history order by "Index" limit 5'))
def o4(spark, sf):
    return I.history(spark, sf).orderBy("Index").limit(5)


@query("o5_first_last_slots", oracle(
    "select * from (select 'first' as part, time_slot, count(*) as n from future_t where day = 49 group by time_slot "
    "order by time_slot limit 5) union all select * from (select 'last', time_slot, count(*) as n from future_t "
    "where day = 49 group by time_slot order by time_slot desc limit 5)"))
def o5(spark, sf):
    c = I.future_t(spark, sf).where(F.col("day") == 49).groupBy("time_slot").agg(F.count(F.lit(1)).alias("n"))
    first = c.orderBy("time_slot").limit(5).select(F.lit("first").alias("part"), "time_slot", "n")
    last = c.orderBy(F.col("time_slot").desc()).limit(5).select(F.lit("last").alias("part"), "time_slot", "n")
    return first.unionByName(last)


@query("o6_sorted_distinct", oracle(
    "select 'day' as kind, cast(day as varchar) as value from (select distinct day from history) union all "
    "select 'minute', cast(minute as varchar) from (select distinct minute from history_t) union all "
    "select 'time_slot', cast(time_slot as varchar) from (select distinct time_slot from history_t) union all "
    "select 'timestamp', v from (select distinct \"timestamp\" as v from history order by v limit 10)"))
def o6(spark, sf):
    h = I.history_t(spark, sf)
    parts = [h.select(F.lit(k).alias("kind"), F.col(k).cast("string").alias("value")).distinct()
             for k in ["day", "minute", "time_slot"]]
    ts = h.select(F.col("timestamp").alias("value")).distinct().orderBy("value").limit(10) \
          .select(F.lit("timestamp").alias("kind"), "value")
    out = parts[0]
    for p in parts[1:] + [ts]:
        out = out.unionByName(p)
    return out


# --------------------------------------------------------------- sets (U)

@query("u1_union_all", oracle(
    "select \"Index\", geohash, 'history' as side from history union all select \"Index\", geohash, 'future' from future"))
def u1(spark, sf):
    return I.history(spark, sf).select("Index", "geohash", F.lit("history").alias("side")).unionByName(
        I.future(spark, sf).select("Index", "geohash", F.lit("future").alias("side")))


@query("u2_union_distinct", oracle("select geohash from history union select geohash from future"))
def u2(spark, sf):
    return I.history(spark, sf).select("geohash").union(I.future(spark, sf).select("geohash")).distinct()


@query("u3_intersect", oracle(
    "select 'geohash' as kind, geohash as value from (select geohash from history intersect select geohash from future) "
    "union all select 'day', cast(day as varchar) from (select day from history intersect select day from future) "
    "union all select 'slot_49', cast(time_slot as varchar) from (select time_slot from history_t where day = 49 "
    "intersect select time_slot from future_t where day = 49)"))
def u3(spark, sf):
    h, f = I.history_t(spark, sf), I.future_t(spark, sf)
    gh = h.select("geohash").intersect(f.select("geohash")).select(F.lit("geohash").alias("kind"),
                                                                   F.col("geohash").alias("value"))
    dy = h.select("day").intersect(f.select("day")).select(F.lit("day").alias("kind"),
                                                           F.col("day").cast("string").alias("value"))
    sl = h.where(F.col("day") == 49).select("time_slot").intersect(
        f.where(F.col("day") == 49).select("time_slot")).select(
        F.lit("slot_49").alias("kind"), F.col("time_slot").cast("string").alias("value"))
    return gh.unionByName(dy).unionByName(sl)


@query("u4_except", oracle("select geohash from future except select geohash from history"))
def u4(spark, sf):
    return I.future(spark, sf).select("geohash").subtract(I.history(spark, sf).select("geohash"))
