"""DuckDB text of the V1 / V2 / NB feature tables (oracle side only)."""

from __future__ import annotations

from demandflow.operators.encode import V1_ENCODINGS, V2_ENCODINGS
from demandflow.plans.features import column_order
from demandflow.plans.q_scalar import SQL_LAT, SQL_LON
from demandflow.plans.registry import sql_rnd
from demandflow.sources.observations import _SQL_HISTORY

STRING_COLS = {"geohash", "timestamp", "RoadType", "LargeVehicles", "Landmarks", "Weather", "geohash_4",
               "geohash_5", "road_weather", "road_vehicles"}
INT_COLS = {"Index", "day", "NumberofLanes", "hour", "minute", "time_slot", "time_order", "is_rush_hour",
            "is_night", "is_low_demand", "is_peak", "is_low_demand_window", "is_peak_window", "road_encoded",
            "road_capacity", "lanes_sq", "is_highway", "is_street", "is_high_capacity", "is_bad_weather",
            "has_landmark", "large_vehicles_allowed", "road_score", "road_hour", "highway_rush", "highway_peak",
            "lanes_peak"}


#: K1 by definition: history in the order of a seeded hash, cut into five parts as equal as can be
FOLDS_CTE = """folds as (select "Index", cast((p >= n * 1 // 5)::int + (p >= n * 2 // 5)::int + (p >= n * 3 // 5)::int + (p >= n * 4 // 5)::int as integer) as fold
  from (select "Index", row_number() over (order by md5('42:' || "Index"), "Index") - 1 as p, count(*) over () as n from history))"""


def _q(c: str) -> str:
    return f'"{c}"'


def feature_sql(variant: str) -> tuple[str, str]:
    """(extra CTEs, final select) for one variant, rows of both sides with a side column."""
    v1 = variant == "v1"
    spec = V1_ENCODINGS if v1 else V2_ENCODINGS
    low, peak = ("is_low_demand_window", "is_peak_window") if v1 else ("is_low_demand", "is_peak")
    demand = "least(greatest(demand, demand_lo), demand_hi)" if v1 else "demand"
    lanes = ("case when lanes_nulls > 0 then coalesce(NumberofLanes, lanes_median) "
             "else cast(NumberofLanes as double) end") if v1 else "NumberofLanes"
    ctes = [FOLDS_CTE, f"""stats as (select
  (select quantile_cont(Temperature, 0.5) from history) as temp_median,
  (select RoadType from (select RoadType, count(*) as n from history where RoadType is not null group by 1)
     order by n desc, RoadType limit 1) as road_mode,
  (select Weather from (select Weather, count(*) as n from history where Weather is not null group by 1)
     order by n desc, Weather limit 1) as weather_mode,
  (select quantile_cont(NumberofLanes, 0.5) from history) as lanes_median,
  (select count(*) from history where NumberofLanes is null) as lanes_nulls,
  (select quantile_cont(demand, 0.01) from history) as demand_lo,
  (select quantile_cont(demand, 0.99) from history) as demand_hi)""",
            f"""cl as (select "Index", geohash, day, "timestamp",
  case when {_SQL_HISTORY} then {demand} end as demand,
  coalesce(RoadType, road_mode) as RoadType, {lanes} as NumberofLanes, LargeVehicles, Landmarks,
  coalesce(Temperature, temp_median) as Temperature, coalesce(Weather, weather_mode) as Weather,
  hour, minute, time_slot, time_order,
  case when {_SQL_HISTORY} then 'history' else 'future' end as side, fold
  from obs_t left join folds using ("Index") cross join stats)""",
            f"""gg as (select *, {SQL_LAT} as latitude, {SQL_LON} as longitude,
  substr(geohash, 1, 4) as geohash_4, substr(geohash, 1, 5) as geohash_5 from cl)""",
            """ctr as (select quantile_cont(latitude, 0.5) as clat, quantile_cont(longitude, 0.5) as clon
  from gg where side = 'history')""",
            f"""rf0 as (select gg.*, sqrt(pow(latitude - clat, 2) + pow(longitude - clon, 2)) as dist_to_center,
  sin(hour * (2 * pi()) / 24.0) as hour_sin, cos(hour * (2 * pi()) / 24.0) as hour_cos,
  sin(minute * (2 * pi()) / 60.0) as minute_sin, cos(minute * (2 * pi()) / 60.0) as minute_cos,
  sin(time_slot * (2 * pi()) / 96.0) as slot_sin, cos(time_slot * (2 * pi()) / 96.0) as slot_cos,
  sin(day * (2 * pi()) / 7.0) as day_sin, cos(day * (2 * pi()) / 7.0) as day_cos,
  cast(coalesce(hour between 7 and 10 or hour between 16 and 19, false) as integer) as is_rush_hour,
  cast(coalesce(hour >= 22 or hour <= 6, false) as integer) as is_night,
  cast(coalesce(hour between 17 and 20, false) as integer) as {low},
  cast(coalesce(hour between 10 and 14, false) as integer) as {peak},
  hour + minute / 60.0 as frac_hour,
  coalesce(RoadType, 'nan') || '_' || coalesce(Weather, 'nan') as road_weather,
  coalesce(RoadType, 'nan') || '_' || coalesce(LargeVehicles, 'nan') as road_vehicles,
  case RoadType when 'Residential' then 0 when 'Street' then 1 when 'Highway' then 2 else 0 end as road_encoded,
  NumberofLanes * NumberofLanes as lanes_sq,
  cast(coalesce(RoadType = 'Highway', false) as integer) as is_highway,
  cast(coalesce(RoadType = 'Street', false) as integer) as is_street,
  cast(coalesce(NumberofLanes >= 4, false) as integer) as is_high_capacity,
  cast(coalesce(Weather in ('Rainy', 'Snowy', 'Foggy'), false) as integer) as is_bad_weather,
  cast(coalesce(Landmarks = 'Yes', false) as integer) as has_landmark,
  cast(coalesce(LargeVehicles = 'Allowed', false) as integer) as large_vehicles_allowed
  from gg cross join ctr)""",
            f"""rf as (select *, road_encoded * NumberofLanes as road_capacity,
  Temperature * is_bad_weather as temp_bad_weather, Temperature * is_highway as temp_highway,
  road_encoded * 3 + NumberofLanes as road_score, road_encoded * 24 + hour as road_hour,
  is_highway * is_rush_hour as highway_rush, is_highway * {peak} as highway_peak,
  NumberofLanes * {peak} as lanes_peak from rf0)""",
            "hh as (select * from rf where side = 'history')",
            "freq as (select geohash, count(*) as kc from hh group by geohash)",
            "tot as (select count(*) as nrows from hh)",
            'lagk as (select day + 1 as day, geohash, "timestamp", demand as lag_demand_1d from hh)',
            "gm as (select cast(sum(cast(demand as decimal(38,12))) as double) / count(demand) as g from hh)"]
    joins_h, joins_f, cols_h, cols_f = [], [], [], []
    for i, (name, keys, m) in enumerate(spec):
        ks = ", ".join(_q(k) for k in keys)
        on = " and ".join(f"e{i}.{_q(k)} = x.{_q(k)}" for k in keys)
        # by definition: the targets of the key's rows in the other folds, and of all its rows
        own = " and ".join(f"b.{_q(k)} = a.{_q(k)}" for k in keys)
        total = "coalesce(cast(sum(cast(b.demand as decimal(38,12))) as double), 0.0)"
        ctes.append(f"te{i}o as (select a.*, ({total} + g * {float(m)!r}) / (count(b.demand) + {float(m)!r}) as v "
                    f"from (select distinct {ks}, fold from hh) a left join hh b on {own} and b.fold <> a.fold cross join gm group by {", ".join(f"a.{_q(k)}" for k in keys)}, a.fold, g)")
        ctes.append(f"te{i}u as (select {ks}, ({total} + g * {float(m)!r}) / (count(b.demand) + {float(m)!r}) as v "
                    f"from hh b cross join gm group by {ks}, g)")
        joins_h.append(f"left join te{i}o e{i} on {on} and e{i}.fold = x.fold")
        joins_f.append(f"left join te{i}u e{i} on {on}")
        cols_h.append(f"coalesce(e{i}.v, gm.g) as {name}")
        cols_f.append(f"coalesce(e{i}.v, gm.g) as {name}")
    lag_join = 'left join lagk l on l.day = x.day and l.geohash = x.geohash and l."timestamp" = x."timestamp"'
    with_lag = variant in ("v1", "v2")
    base_cols = ["x.*", "coalesce(fq.kc, 0) / cast(tot.nrows as double) as geohash_freq"]
    if with_lag:
        base_cols.append("l.lag_demand_1d")
    for side, joins, cols in (("history", joins_h, cols_h), ("future", joins_f, cols_f)):
        ctes.append(f"""fin_{side} as (select {", ".join(base_cols + cols)} from rf x
  left join freq fq on fq.geohash = x.geohash cross join tot cross join gm
  {lag_join if with_lag else ""} {" ".join(joins)} where x.side = '{side}')""")
    out_cols = column_order(variant, "history")
    sel = []
    for c in out_cols:
        if c in STRING_COLS or c in INT_COLS:
            sel.append(_q(c))
        else:
            sel.append(f"{sql_rnd(_q(c))} as {_q(c)}")
    sel.append("side")
    body = " union all ".join(f"select {', '.join(sel)} from fin_{s}" for s in ("history", "future"))
    return ",\n".join(ctes), body


def prefix_sql(spec=V2_ENCODINGS) -> tuple[str, str]:
    """(extra CTEs, final select) of the encodings of each fold of the time split, from the rows of earlier blocks."""
    ctes, _ = feature_sql("v2")
    names, parts = [], [ctes, """pos as (select *, row_number() over (order by time_order, "Index") - 1 as p, count(*) over () as cnt from hh)""",
                        "hb as (select *, case when p < cnt - 3 * (cnt // 4) then -1 else (p - (cnt - 3 * (cnt // 4))) // (cnt // 4) end as block from pos)",
                        "x as (select hb.*, cv, case when block < cv then 'train' else 'test' end as role from hb cross join (select unnest(range(3)) as cv) where block <= cv)",
                        "gv as (select cv, cast(sum(cast(demand as decimal(38,12))) as double) / count(demand) as g from x where role = 'train' group by cv)"]
    joins = []
    for i, (name, keys, m) in enumerate(spec):
        ks = ", ".join(_q(k) for k in keys)
        on = " and ".join(f"st.{_q(k)} = x.{_q(k)}" for k in keys)
        parts.append(f"st{i} as (select {ks}, block, fold, sum(cast(demand as decimal(38,12))) as s, count(demand) as n from hb group by {ks}, block, fold)")
        parts.append(f'px{i} as (select x."Index", x.cv, coalesce(cast(sum(st.s) as double), 0.0) as s, coalesce(sum(st.n), 0) as n from x left join st{i} st on {on} '
                     f'and st.block < x.cv and (x.role = \'test\' or st.fold <> x.fold) group by x."Index", x.cv)')
        joins.append(f'join px{i} on px{i}."Index" = x."Index" and px{i}.cv = x.cv')
        names.append(f"{sql_rnd(f'(px{i}.s + {float(m)!r} * gv.g) / (px{i}.n + {float(m)!r})')} as {name}")
    return ",\n".join(parts), f'select x."Index", x.cv, role, {", ".join(names)} from x join gv on gv.cv = x.cv {" ".join(joins)}'
