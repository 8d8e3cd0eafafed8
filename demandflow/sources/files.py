"""File sources and sinks (S1-S7): CSV with declared schemas, JSON parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

HISTORY_SCHEMA = T.StructType([
    T.StructField("Index", T.LongType()),
    T.StructField("geohash", T.StringType()),
    T.StructField("day", T.IntegerType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("demand", T.DoubleType()),
    T.StructField("RoadType", T.StringType()),
    T.StructField("NumberofLanes", T.IntegerType()),
    T.StructField("LargeVehicles", T.StringType()),
    T.StructField("Landmarks", T.StringType()),
    T.StructField("Temperature", T.DoubleType()),
    T.StructField("Weather", T.StringType()),
])
FUTURE_SCHEMA = T.StructType([f for f in HISTORY_SCHEMA.fields if f.name != "demand"])
SUBMISSION_SCHEMA = T.StructType([T.StructField("Index", T.LongType()), T.StructField("demand", T.DoubleType())])


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Header CSV with a declared schema (no inference pass)."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def compare_layout(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """S3: a row a column position: what ``schema`` expects, what the file's header names, whether all its values read
    as the expected type, and whether the position agrees in all of it."""
    found = spark.read.option("header", True).csv(path)  # as text
    n = max(len(schema), len(found.columns))
    wanted = [(f.name, f.dataType.simpleString()) for f in schema.fields] + [(None, None)] * (n - len(schema))
    names = found.columns + [None] * (n - len(found.columns))
    readable = [F.coalesce(F.bool_and(F.col(f"`{name}`").isNull() | F.col(f"`{name}`").try_cast(kind).isNotNull()), F.lit(True))
                if name is not None and kind is not None else F.lit(False) for name, (_, kind) in zip(names, wanted)]
    rows = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(a).cast("string").alias("expected"), F.lit(b).cast("string").alias("found"), ok.alias("readable"))
                     for i, ((a, _), b, ok) in enumerate(zip(wanted, names, readable))])
    return found.agg(rows.alias("r")).select(F.explode("r").alias("r")).select("r.*").withColumn("same", F.col("expected").eqNullSafe(F.col("found")) & F.col("readable"))


def write_csv(df: DataFrame, path: str) -> None:
    """Header CSV, one part file per partition (no single-task coalesce)."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_params(df: DataFrame, path: str) -> None:
    """A parameter table as JSON lines (one record per model)."""
    df.write.mode("overwrite").json(path)


def read_params(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """JSON parameter records back as typed columns."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).exists(p)


def params_or_compute(spark: SparkSession, path: str, compute, schema: T.StructType | None = None) -> DataFrame:
    """Saved parameters when present, else run ``compute`` and save its result."""
    if path_exists(spark, path):
        return read_params(spark, path, schema)
    df = compute()
    write_params(df, path)
    return read_params(spark, path, schema or df.schema)
