"""Whole jobs: features, tuning or saved parameters, seed ensemble, blend, checks, committed output.

V1 tunes all three kinds (``successive_halving`` over time folds whose encodings are refitted) and commits its
parameters and inverse-rmse weights in its manifest. V2 and NB resume from a committed manifest, rescale the
parameters by their factors (M10) and blend with V2's fixed weights. With no whole run to resume from, they tune.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandflow.operators import score as S
from demandflow.operators.encode import V1_ENCODINGS, V2_ENCODINGS
from demandflow.plans import models as M
from demandflow.session import cut_lineage
from demandflow.sources import files, manifest

KINDS = ("gbt_categorical", "gbt_deep", "random_forest")
FIXED_WEIGHTS = dict(zip(KINDS, S.FIXED_WEIGHTS_V2.values()))
PARAMS = ("maxIter", "maxDepth", "stepSize", "subsamplingRate", "minInstancesPerNode", "minInfoGain")


def tune(spark: SparkSession, history: DataFrame, future: DataFrame, variant: str, n_trials: int) -> DataFrame:
    """All trials of all kinds on the variant's time folds; the kinds' searches share the cores."""
    folded = M.time_folds(history, future, V1_ENCODINGS if variant == "v1" else V2_ENCODINGS)
    folds = {shared: M.binned_folds(M.fold_vectors(shared, folded)) for shared in dict.fromkeys(map(M.features_of, KINDS))}
    with ThreadPoolExecutor(min(M.searching_threads(spark, own) for own in folds.values())) as pool:
        trials = M.in_parallel(lambda kind: M.successive_halving(spark, kind, folds[M.features_of(kind)], n_trials, pool=pool), KINDS)
    return reduce(DataFrame.unionByName, trials)


def document(best: DataFrame, variant: str, layout: list[str]) -> DataFrame:
    """The manifest of the best trials (a row a model): parameters, scores, inverse-rmse weights, output columns."""
    weights = S.inverse_rmse_weights(best)
    rows = best.join(F.broadcast(weights), "model")  # a row a model
    entry = lambda *c: F.map_from_entries(F.collect_list(F.struct("model", F.struct(*c) if len(c) > 1 else F.col(c[0]))))
    return rows.groupBy().agg(entry(*PARAMS).alias("params"), entry("rmse", "r2").alias("scores"), entry("weight").alias("weights")).select(
        F.lit(variant).alias("variant"), "params", "scores", "weights", F.array(*[F.lit(c) for c in layout]).alias("layout"))


def run_job(spark: SparkSession, folder: str, history: DataFrame, future: DataFrame, variant: str, n_trials: int = 30,
            trials: DataFrame | None = None) -> str:
    """Runs ``variant`` on its feature tables and commits output and manifest under ``folder``; the run's path.

    ``trials``: those of a search that is done already.
    """
    layout = [f.name for f in files.SUBMISSION_SCHEMA.fields]
    history, future = cut_lineage(history), cut_lineage(future)

    def tuned() -> DataFrame:
        return document(M.best_trials(trials if trials is not None else tune(spark, history, future, variant, n_trials)), variant, layout)
    found = cut_lineage(tuned() if variant == "v1" else manifest.resume_or(spark, folder, tuned))
    params = found.select(F.explode("params").alias("model", "p")).select("model", "p.*")
    if variant != "v1":
        params = M.rescale_params(params, variant)
    h, f = M.with_codes(*M.prepare(history, future))
    preds = M.seed_ensemble(KINDS, cut_lineage(h), cut_lineage(f), params=M.tuned(params))
    weights = found.select(F.explode("weights").alias("model", "weight")) if variant == "v1" else S.weights_frame(spark, FIXED_WEIGHTS)
    blended = cut_lineage(S.blend(S.seed_average(preds), weights).select(*layout))
    checks = S.output_checks(blended, future.count()).first()
    if not checks["ok"]:
        raise ValueError(f"the output fails its checks: {checks}")
    own = found.withColumn("variant", F.lit(variant)).withColumn("weights", F.create_map(*[F.lit(x) for kv in FIXED_WEIGHTS.items() for x in kv]) if variant != "v1" else F.col("weights"))
    return manifest.commit_run(spark, folder, blended, own)
