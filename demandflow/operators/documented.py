"""Operators the documentation names without code (D1-D8), with our definitions.

Rolling statistics (D4/D5) use no window partitioned by location, which
would put a hot location in one task: windows run over chunks of the ordered
rows, each with the last rows of the chunk before.
"""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandflow.operators.stats import checked_broadcast, exact_avg, mode_of, ordered_row_number


def fill_by_group_mode(df: DataFrame, history: DataFrame, col: str, by: list[str]) -> DataFrame:
    """Mode of ``col`` within ``by`` (history), else the global mode."""
    local = mode_of(history, col, "_lm", by=by)
    glob = mode_of(history, col, "_gm")
    return (df.join(checked_broadcast(local), by, "left").crossJoin(F.broadcast(glob))
              .withColumn(col, F.coalesce(F.col(col), F.col("_lm"), F.col("_gm"))).drop("_lm", "_gm"))


def fill_by_mean_chain(df: DataFrame, history: DataFrame, col: str, levels: list[list[str]]) -> DataFrame:
    """Mean of ``col`` at the finest level with data, then coarser levels, then global."""
    out = df
    fills = []
    for i, keys in enumerate(levels):
        t = history.groupBy(*keys).agg(exact_avg(col).alias(f"_m{i}"))
        out = out.join(checked_broadcast(t), keys, "left")
        fills.append(F.col(f"_m{i}"))
    glob = history.agg(exact_avg(col).alias("_mg"))
    out = out.crossJoin(F.broadcast(glob))
    return out.withColumn(col, F.coalesce(F.col(col), *fills, F.col("_mg"))).drop(
        *[f"_m{i}" for i in range(len(levels))], "_mg")


#: rows of a chunk of the ordered rows; a chunk is one window partition
CHUNK = 1 << 16


def rolling_previous(df: DataFrame, value: str = "demand", part: str = "geohash",
                     order: tuple[str, ...] = ("time_order", "Index"), k: int = 3, chunk: int = CHUNK) -> DataFrame:
    """Mean and sample std of the ``k`` previous rows of the same ``part`` (nulls ignored).

    Rows are numbered in (part, order) by range partition and cut into chunks of equal size, whatever location they
    belong to; the last ``k`` rows of a chunk are handed on to the next (the halo), so each row finds its
    predecessors in its own chunk.
    """
    numbered = ordered_row_number(df, [part, *order], "__pos")
    own = F.floor(F.col("__pos") / chunk)
    held = F.when(F.col("__pos") % chunk >= chunk - k, F.array(own, own + 1)).otherwise(F.array(own))
    spread = numbered.withColumn("__chunk", F.explode(held))
    w = Window.partitionBy("__chunk").orderBy("__pos")
    before = [F.when(F.lag(part, j).over(w).eqNullSafe(F.col(part)) & (F.lag("__pos", j).over(w).isNotNull()), F.lag(value, j).over(w)) for j in range(1, k + 1)]
    seen = spread.withColumn("__seen", F.filter(F.array(*before), lambda x: x.isNotNull())).where(F.col("__chunk") == own)
    n, total = F.size("__seen"), lambda f: F.aggregate("__seen", F.lit(0.0), lambda a, x: a + f(x))
    with_mean = seen.withColumn(f"rolling_mean_{k}", F.when(n > 0, total(lambda x: x.cast("double")) / n))
    squares = total(lambda x: (x - F.col(f"rolling_mean_{k}")) * (x - F.col(f"rolling_mean_{k}")))
    return with_mean.withColumn(f"rolling_std_{k}", F.when(n > 1, F.sqrt(squares / (n - 1)))).drop("__pos", "__chunk", "__seen")


def kmeans_zones(points: DataFrame, k: int = 10, seed: int = 42) -> DataFrame:
    """K-Means zones over (latitude, longitude) of distinct locations; ``centre_gap`` is the squared distance to the
    zone's centre less that to the nearest centre."""
    asm = VectorAssembler(inputCols=["latitude", "longitude"], outputCol="_f")
    data = asm.transform(points)
    model = KMeans(k=k, seed=seed, featuresCol="_f", predictionCol="zone").fit(data)
    squared = F.array(*[F.pow(F.col("latitude") - float(lat), 2) + F.pow(F.col("longitude") - float(lon), 2) for lat, lon in model.clusterCenters()])  # k centres
    return model.transform(data).withColumn("centre_gap", F.get(squared, F.col("zone")) - F.array_min(squared)).drop("_f")


def pca_components(df: DataFrame, cols: list[str], k: int = 2) -> DataFrame:
    """Principal components of the standardised columns."""
    asm = VectorAssembler(inputCols=cols, outputCol="_raw")
    scaled = StandardScaler(inputCol="_raw", outputCol="_std", withMean=True, withStd=True)
    a = asm.transform(df)
    s = scaled.fit(a).transform(a)
    model = PCA(k=k, inputCol="_std", outputCol="_pc").fit(s)
    from pyspark.ml.functions import vector_to_array
    out = model.transform(s).withColumn("_arr", vector_to_array("_pc"))
    return out.select(*df.columns, *[F.col("_arr")[i].alias(f"pc{i + 1}") for i in range(k)])
