"""Profiling aggregates (A*, O*, U*): each one a single distributed pass.

Loops of per-value masks in the reference become one ``groupBy``; several
columns are profiled together by unpivoting them to (column_name, value)
and grouping on the name, so one shuffle serves every column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandflow.operators.stats import exact_avg, exact_quantiles


def unpivot_text(df: DataFrame, cols: Sequence[str], name: str = "column_name",
                 value: str = "value") -> DataFrame:
    """(column_name, value as text) for each listed column; nulls kept."""
    return df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias(name), F.col(c).cast("string").alias(value)) for c in cols])).alias("_x")) \
        .select(f"_x.{name}", f"_x.{value}")


def unpivot_num(df: DataFrame, cols: Sequence[str], name: str = "column_name", value: str = "v") -> DataFrame:
    return df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias(name), F.col(c).cast("double").alias(value)) for c in cols])).alias("_x")) \
        .select(f"_x.{name}", f"_x.{value}")


def distinct_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct non-null values per column via (column, value) dedup: map-side combined."""
    long = unpivot_text(df, cols).where(F.col("value").isNotNull())
    return long.distinct().groupBy("column_name").agg(F.count(F.lit(1)).alias("n_distinct"))


def frequency_table(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Value counts per column, nulls counted as their own value."""
    return unpivot_text(df, cols).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))


def top_k_per_column(freq: DataFrame, k_by_column: dict[str, int]) -> DataFrame:
    """O3: top-k values per column by count (ties: value ascending, null last).
    The window runs over the frequency table (distinct values), not rows."""
    w = Window.partitionBy("column_name").orderBy(F.col("n").desc(), F.col("value").asc_nulls_last())
    limits = F.create_map(*[x for c, k in k_by_column.items() for x in (F.lit(c), F.lit(k))])
    return freq.where(F.col("column_name").isin(list(k_by_column))) \
               .withColumn("rank", F.row_number().over(w)) \
               .where(F.col("rank") <= limits[F.col("column_name")])


def skewness_unbiased(c: str) -> Column:
    """pandas' bias-corrected sample skewness: Spark's skewness * sqrt(n(n-1))/(n-2)."""
    n = F.count(F.col(c))
    return F.skewness(c) * F.sqrt(n * (n - 1)) / (n - 2)


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, mean, std, min, 25/50/75%, max per numeric column (exact quantiles)."""
    long = unpivot_num(df, cols).where(F.col("v").isNotNull())
    basic = long.groupBy("column_name").agg(
        F.count("v").alias("count"), exact_avg("v").alias("mean"), F.stddev_samp("v").alias("std"),
        F.min("v").alias("min"), F.max("v").alias("max"))
    q = exact_quantiles(long, "v", [0.25, 0.5, 0.75], ["p25", "p50", "p75"], by=["column_name"],
                        max_groups=len(cols))
    return basic.join(q, "column_name")


def grouped_stats(df: DataFrame, keys: Sequence[str], target: str = "demand") -> DataFrame:
    """Mean, sample std and count of ``target`` per value of each key (null keys dropped)."""
    long = df.select(F.col(target), F.explode(F.array(*[
        F.struct(F.lit(k).alias("key_name"), F.col(k).cast("string").alias("key_value")) for k in keys]))
        .alias("_x")).select("_x.key_name", "_x.key_value", target)
    return long.where(F.col("key_value").isNotNull()).groupBy("key_name", "key_value").agg(
        exact_avg(target).alias("mean"), F.stddev_samp(target).alias("std"), F.count(F.lit(1)).alias("n"))


def histogram(df: DataFrame, c: str, bins: int = 100, name: str = "bin") -> DataFrame:
    """Equal-width bins over [min, max], last bin closed (numpy's rule)."""
    bounds = df.agg(F.min(c).alias("_mn"), F.max(c).alias("_mx"))
    width = (F.col("_mx") - F.col("_mn")) / float(bins)
    b = F.least(F.floor(F.try_divide(F.col(c) - F.col("_mn"), width)).cast("int"), F.lit(bins - 1))
    # one-row bounds frame: the cross join is N x 1
    return df.where(F.col(c).isNotNull()).crossJoin(F.broadcast(bounds)) \
             .select(F.coalesce(b, F.lit(0)).alias(name)).groupBy(name).agg(F.count(F.lit(1)).alias("n"))
