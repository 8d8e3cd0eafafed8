"""The ``observations`` view: driver ``events`` mapped to the traffic schema.

One SQL text serves both engines: Spark runs it through ``spark.sql`` with
the events DataFrame bound as ``{events}``; the DuckDB oracle runs the same
text as a CTE. Only identifier quoting differs (backticks vs double quotes).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandflow.functions.timefeat import with_time_columns

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

# History/future split: day 48, or day 49 before this slot, is history.
HISTORY_LAST_DAY = 49
CUT_SLOT = 36

# The fixture text (FIXTURES.md), kept verbatim apart from
# identifier quoting ({q}) and the bound events relation ({events}).
OBSERVATIONS_TEMPLATE = """
obs_e as (
  select event_id, user_id, value,
         case when day(ts) <= 15 then 48 else 49 end as day,
         hour(ts) as hh, cast(floor(minute(ts)/15)*15 as int) as mm
  from {events}),
obs_c as (
  select min(event_id) as idx, user_id, day, hh, mm, least(max(value)/500.0, 1.0) as demand
  from obs_e group by user_id, day, hh, mm),
observations as (
select idx as {q}Index{q},
  'qp' || substr('0123456789bcdefghjkmnpqrstuvwxyz', cast(1+user_id%3 as int), 1)
       || substr('0123456789bcdefghjkmnpqrstuvwxyz', cast(1+user_id%7 as int), 1)
       || substr('0123456789bcdefghjkmnpqrstuvwxyz', cast(1+floor(user_id/32)%32 as int), 1)
       || substr('0123456789bcdefghjkmnpqrstuvwxyz', cast(1+user_id%32 as int), 1) as geohash,
  day, cast(hh as varchar(8)) || ':' || cast(mm as varchar(8)) as {q}timestamp{q}, demand,
  case when idx%83=0 then null when user_id%10=0 then 'Highway'
       when user_id%10<=2 then 'Street' else 'Residential' end as RoadType,
  cast(1+user_id%5 as int) as NumberofLanes,
  case when user_id%3=0 then 'Allowed' else 'Not Allowed' end as LargeVehicles,
  case when user_id%4=0 then 'Yes' else 'No' end as Landmarks,
  case when idx%20=0 then null else 5.0e0+((idx*7)%300)/10.0e0 end as Temperature,
  case when idx%63=0 then null when idx%10<7 then 'Sunny' when idx%10=7 then 'Rainy'
       when idx%10=8 then 'Foggy' else 'Snowy' end as Weather
from obs_c
where not (user_id%50 = 7 and (day = 48 or hh < 9)))
"""

SOURCE_COLUMNS = ["Index", "geohash", "day", "timestamp", "demand", "RoadType",
                  "NumberofLanes", "LargeVehicles", "Landmarks", "Temperature", "Weather"]
FUTURE_COLUMNS = [c for c in SOURCE_COLUMNS if c != "demand"]

# DuckDB spelling of the time parse and the split, used only by oracle texts.
_SQL_HOUR = "cast(split_part(\"timestamp\", ':', 1) as integer)"
_SQL_MINUTE = "coalesce(cast(nullif(split_part(\"timestamp\", ':', 2), '') as integer), 0)"
_SQL_HISTORY = f"(day < {HISTORY_LAST_DAY} or (day = {HISTORY_LAST_DAY} and time_slot < {CUT_SLOT}))"

ORACLE_CTES = ("with " + OBSERVATIONS_TEMPLATE.strip().format(q='"', events="events") + f""",
obs_t as (
  select *, {_SQL_HOUR} as hour, {_SQL_MINUTE} as minute,
         {_SQL_HOUR} * 4 + {_SQL_MINUTE} // 15 as time_slot,
         day * 96 + {_SQL_HOUR} * 4 + {_SQL_MINUTE} // 15 as time_order
  from observations),
history_t as (select * from obs_t where {_SQL_HISTORY}),
future_t as (select * exclude (demand) from obs_t where not {_SQL_HISTORY}),
history as (select {", ".join('"%s"' % c for c in SOURCE_COLUMNS)} from history_t),
future as (select {", ".join('"%s"' % c for c in FUTURE_COLUMNS)} from future_t),
truth as (select "Index", demand from obs_t where not {_SQL_HISTORY})""")


def oracle(body: str, ctes: str = "") -> str:
    """DuckDB text: the shared CTE chain, optional extra CTEs, then ``body``."""
    extra = (",\n" + ctes.strip()) if ctes.strip() else ""
    return f"{ORACLE_CTES}{extra}\n{body.strip()}"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Traffic-schema rows derived from ``events`` (one aggregate, one shuffle)."""
    text = ("with " + OBSERVATIONS_TEMPLATE.strip().format(q="`", events="{events}")
            + "\nselect * from observations")
    return spark.sql(text, events=read_table(spark, sf_dir, "events"))


def is_history(day: str = "day", time_slot: str = "time_slot") -> Column:
    return (F.col(day) < HISTORY_LAST_DAY) | (
        (F.col(day) == HISTORY_LAST_DAY) & (F.col(time_slot) < CUT_SLOT))


def split_observations(obs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(history, future without demand, truth(Index, demand)); source columns only."""
    timed = with_time_columns(obs)
    hist = timed.where(is_history()).select(*SOURCE_COLUMNS)
    fut_rows = timed.where(~is_history())
    return hist, fut_rows.select(*FUTURE_COLUMNS), fut_rows.select("Index", "demand")


def history_future(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return split_observations(observations(spark, sf_dir))
