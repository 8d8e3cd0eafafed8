"""Scoring chain (K8-K13, K15, A28) over long prediction tables.

Predictions are a long table (Index, model, seed, prediction): seeds average
per (Index, model) (K12), models are scored against truth (K8, K9) or by
time-split cross-validation (K10), weighted by inverse RMSE (K11), blended
and clipped at zero (K13, F7), and the output is checked (K15).

``encoding_predictions`` is a deterministic, data-derived predictor used to
exercise this chain with exact oracles: per key set, a smoothed target mean
with one fold of history held out per seed (bagged target encoding).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandflow.operators.encode import N_FOLDS, _key_array, attach, encoding_tables, out_of_fold
from demandflow.operators.stats import checked_broadcast, exact_avg, exact_quantiles, exact_sum, scalar_row

# The seed list and the blend weights of the two variants.
SEEDS = [42, 123, 456, 789, 2024]
DEFAULT_WEIGHTS_V1 = {"catboost": 0.45, "lightgbm": 0.30, "xgboost": 0.25}
FIXED_WEIGHTS_V2 = {"catboost": 0.55, "lightgbm": 0.25, "xgboost": 0.20}

# Stand-in predictors: (model name, key columns, smoothing).
STANDIN_MODELS = [("te_geohash", ["geohash"], 10.0), ("te_gh_hour", ["geohash", "hour"], 5.0),
                  ("te_rt_hour", ["RoadType", "hour"], 20.0)]


def _seed_of(fold_col: str = "fold"):
    return F.element_at(F.array(*[F.lit(s) for s in SEEDS]), F.col(fold_col) + 1)


def _enc_map(models, pick):
    return F.create_map(*[x for i, mdl in enumerate(models) for x in (F.lit(i), F.lit(pick(mdl)))])


def encoding_predictions(history: DataFrame, future: DataFrame, models=None,
                         folds: int = N_FOLDS) -> DataFrame:
    """(Index, model, seed, prediction) for every stand-in model: per key set, the
    smoothed mean with one history fold held out per seed. All models share one
    aggregation; a row takes its key's values of all folds in one lookup."""
    models = list(models or STANDIN_MODELS)
    tables, info = encoding_tables(history, models)
    g, rows = info["mean"], future
    for i, (name, keys, m) in enumerate(models):
        lookup = tables.where(F.col("enc") == i).select("key", out_of_fold(F.lit(float(m)), g, folds).alias("value"), F.col("r").alias("rows"))
        rows = attach(rows, lookup, keys, f"_p{i}", size=info["bytes"].get(i, 0) + 8 * folds * info["keys"].get(i, 0), total=info["rows"])
    found = F.array(*[F.struct(F.lit(name).alias("model"), F.coalesce(F.col(f"_p{i}"), F.array_repeat(F.lit(float(g)), folds)).alias("values"))
                      for i, (name, _, _) in enumerate(models)])
    return rows.select("Index", F.explode(found).alias("m")).select("Index", "m.model", F.posexplode("m.values").alias("fold", "_p")) \
               .select("Index", "model", _seed_of().alias("seed"), F.greatest(F.col("_p"), F.lit(0.0)).alias("prediction"))


def seed_average(preds: DataFrame) -> DataFrame:
    """Mean prediction per (Index, model)."""
    return preds.groupBy("Index", "model").agg(exact_avg("prediction").alias("prediction"))


def _sq(c):
    return F.col(c) * F.col(c)


def score(pred: DataFrame, truth: DataFrame, by: Sequence[str] = ("model",), y: str = "demand",
          p: str = "prediction") -> DataFrame:
    """K8/K9: rmse and r2 per group. SSE and the sums behind SST are exact decimal sums."""
    j = pred.join(truth.select("Index", F.col(y).alias("_y")), "Index")
    agg = j.groupBy(*by).agg(
        exact_sum(F.pow(F.col("_y") - F.col(p), 2)).alias("_sse"), exact_sum("_y").alias("_sy"),
        exact_sum(_sq("_y")).alias("_syy"), F.count(F.lit(1)).alias("_n"))
    sst = F.col("_syy") - F.col("_sy") * F.col("_sy") / F.col("_n")
    return agg.select(*by, F.sqrt(F.col("_sse") / F.col("_n")).alias("rmse"),
                      (F.lit(1.0) - F.col("_sse") / sst).alias("r2"), F.col("_n").alias("n"))


def display_score(r2: str = "r2"):
    """K9 as shown: max(0, 100 r2)."""
    return F.greatest(F.lit(0.0), F.col(r2) * 100.0)


def cv_predictions(blocked: DataFrame, models=None, k: int = 3, y: str = "demand") -> DataFrame:
    """K10 input: for fold i, rows of block i predicted from blocks < i, for every model.
    Per (model, key, block) sums come from one aggregation, are spread to every
    later fold and summed again, so each fold's training statistics are small."""
    models = list(models or STANDIN_MODELS)
    entries = [F.struct(F.lit(i).alias("enc"), _key_array(keys).alias("key")) for i, (_, keys, _) in enumerate(models)]
    long = blocked.select("Index", "block", F.col(y).cast("decimal(38,12)").alias("_y"),
                          F.explode(F.array(*entries)).alias("_e")).select("Index", "block", "_y", "_e.enc", "_e.key")
    blk = long.groupBy("enc", "key", "block").agg(F.sum("_y").alias("_bs"), F.count(F.lit(1)).alias("_bn")).persist()
    bound = int(scalar_row(blk.agg(F.count(F.lit(1)).alias("n")))["n"]) * k
    later = F.when(F.col("block") + 1 <= k - 1, F.sequence(F.col("block") + 1, F.lit(k - 1))) \
             .otherwise(F.array().cast("array<int>"))
    spread = blk.select("enc", "key", "_bs", "_bn", F.explode(later).alias("fold"))
    train = spread.groupBy("enc", "key", "fold").agg(F.sum("_bs").alias("_ts"), F.sum("_bn").alias("_tn"))
    gtab = spread.groupBy("enc", "fold").agg((F.sum("_bs").cast("double") / F.sum("_bn")).alias("_g"))
    m = _enc_map(models, lambda mdl: float(mdl[2]))[F.col("enc")]
    test = long.where(F.col("block") >= 0).select("Index", "enc", "key", F.col("block").alias("fold"))
    pred = (F.col("_ts").cast("double") + m * F.col("_g")) / (F.col("_tn") + m)
    return (test.join(checked_broadcast(train, bound=bound), ["enc", "key", "fold"], "left")
                .join(F.broadcast(gtab), ["enc", "fold"], "left")
                .select("Index", _enc_map(models, lambda mdl: mdl[0])[F.col("enc")].alias("model"), "fold",
                        F.greatest(F.coalesce(pred, F.col("_g")), F.lit(0.0)).alias("prediction")))


def cv_summary(fold_scores: DataFrame) -> DataFrame:
    """Unweighted mean of per-fold rmse and r2 per model."""
    return fold_scores.groupBy("model").agg(F.avg("rmse").alias("rmse"), F.avg("r2").alias("r2"))


def inverse_rmse_weights(scores: DataFrame) -> DataFrame:
    """(1/rmse_m) / sum(1/rmse) per model; the model table is tiny (one row per model)."""
    inv = scores.select("model", (F.lit(1.0) / F.col("rmse")).alias("_inv"))
    total = inv.agg(F.sum("_inv").alias("_tot"))
    return inv.crossJoin(F.broadcast(total)).select("model", (F.col("_inv") / F.col("_tot")).alias("weight"))


def blend(avg_preds: DataFrame, weights: DataFrame, defaults: dict[str, float] | None = None) -> DataFrame:
    """K13 + F7: sum of weight x prediction per Index, clipped at zero.

    A model without a saved weight takes its default; without either the job fails.
    """
    fallback = [F.element_at(F.create_map(*[F.lit(x) for kv in defaults.items() for x in kv]), F.col("model"))] if defaults else []
    missing = F.raise_error(F.concat(F.lit("no weight for model "), F.col("model"))).cast("double")
    weighted = checked_broadcast_join(avg_preds, weights)
    return (weighted.withColumn("weight", F.coalesce(F.col("weight"), *fallback, missing))
            .groupBy("Index").agg(F.sum(F.col("weight") * F.col("prediction")).alias("_raw"))
            .select("Index", F.greatest(F.col("_raw"), F.lit(0.0)).alias("demand"), F.col("_raw").alias("raw")))


def checked_broadcast_join(avg_preds: DataFrame, weights: DataFrame) -> DataFrame:
    """Every prediction with its model's weight or null; the weight table is broadcast after a row count."""
    return avg_preds.join(checked_broadcast(weights.select("model", "weight")), "model", "left")


def weights_frame(spark, weights: dict[str, float]) -> DataFrame:
    return spark.createDataFrame(list(weights.items()), "model string, weight double")


def output_checks(sub: DataFrame, expected_rows: int) -> DataFrame:
    """One-row check table; ``ok`` is the conjunction of the checks."""
    r = sub.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("Index").alias("n_unique_index"),
                F.count_if(F.col("demand").isNull()).alias("n_null"),
                F.count_if(F.col("demand") < 0).alias("n_negative"))
    cols_ok = list(sub.columns) == ["Index", "demand"]
    return r.select("*", F.lit(int(expected_rows)).cast("long").alias("expected_rows"),
                    F.lit(cols_ok).alias("columns_ok")).withColumn(
        "ok", (F.col("n_rows") == F.col("expected_rows")) & (F.col("n_unique_index") == F.col("n_rows"))
        & (F.col("n_null") == 0) & (F.col("n_negative") == 0) & F.col("columns_ok"))


def prediction_summary(sub: DataFrame, c: str = "demand") -> DataFrame:
    """Min, max, mean, population std, median of the output."""
    med = exact_quantiles(sub, c, [0.5], ["median"])
    base = sub.agg(F.min(c).alias("min"), F.max(c).alias("max"), exact_avg(c).alias("mean"),
                   F.stddev_pop(c).alias("std_pop"))
    return base.crossJoin(med)


