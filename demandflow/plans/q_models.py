"""Registered queries: model jobs (M1-M11) and the variants' whole jobs.

A tree fit has no SQL twin, so each query with an oracle returns what must hold of the fit: predictions of the
future side against its truth, trees kept against the errors, the best trial against all trials.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandflow.operators import score as S
from demandflow.operators.encode import V2_ENCODINGS
from demandflow.plans import inputs as I
from demandflow.plans import jobs as J
from demandflow.plans import models as M
from demandflow.plans.registry import context, query
from demandflow.session import cut_lineage
from demandflow.sources import files, manifest
from demandflow.sources.observations import oracle

#: most trees of a fold's fit, before early stopping, and draws a kind
CV_TREES, TRIALS = 20, 30


def _features(spark, sf, variant):
    return context(spark, sf).get(f"stored_{variant}", lambda: tuple(cut_lineage(side) for side in I.features(spark, sf, variant)))


def _data(spark, sf):
    def build():
        h, f = M.with_codes(*M.prepare(*_features(spark, sf, "v2")))
        return cut_lineage(h), cut_lineage(f)
    return context(spark, sf).get("model_data", build)


def _folds(spark, sf, kind):
    """The time folds of V2's features, encodings refitted in each, as vectors of ``kind``."""
    folded = context(spark, sf).get("folded", lambda: M.time_folds(*_features(spark, sf, "v2"), V2_ENCODINGS))
    return context(spark, sf).get(f"folds_{kind}", lambda: M.fold_vectors(kind, folded))


def _cv(spark, sf, kind):
    return context(spark, sf).get(f"cv_{kind}", lambda: M.cross_validate(spark, kind, _folds(spark, sf, kind), CV_TREES))


def _predict(kind):
    """Fits all history with as many trees as early stopping kept in the folds, and predicts the future side."""
    def fn(spark, sf):
        def build():
            trees = max(1, round(_cv(spark, sf, kind).agg(F.avg("trees")).first()[0]))
            return cut_lineage(M.fit_predict(kind, *_data(spark, sf), 42, trees))
        return context(spark, sf).get(f"pred_{kind}", build)
    return fn


query("m1_gbt_categorical_predict")(_predict("gbt_categorical"))
query("m2_gbt_deep_predict")(_predict("gbt_deep"))
query("m3_random_forest_predict")(_predict("random_forest"))

_CHECK = oracle("select count(*) as n_rows, 0 as n_unknown, 0 as n_null, 0 as n_negative, true as in_reach from future")


def future_check(spark, sf, preds: DataFrame, p: str = "prediction") -> DataFrame:
    """What must hold of predictions of the future side: one a row, none null or below 0, and an rmse below twice
    that of the history's mean (the driver's demand is noise that no model can foresee; tests hold models to data with a signal)."""
    joined = preds.join(I.truth(spark, sf).select("Index", "demand"), "Index", "left")
    mean = I.history(spark, sf).agg(F.avg("demand").alias("mean"))  # one row
    zero = lambda cond: F.count_if(cond).cast("int")
    return joined.crossJoin(F.broadcast(mean)).agg(
        F.count_distinct("Index").alias("n_rows"), zero(F.col("demand").isNull()).alias("n_unknown"), zero(F.col(p).isNull()).alias("n_null"),
        zero(F.col(p) < 0).alias("n_negative"),
        (F.avg(F.pow(F.col(p) - F.col("demand"), 2)) < 4 * F.avg(F.pow(F.col("mean") - F.col("demand"), 2))).alias("in_reach"))


def _checked(kind):
    return lambda spark, sf: future_check(spark, sf, _predict(kind)(spark, sf))


for _n, _kind in ((1, "gbt_categorical"), (2, "gbt_deep"), (3, "random_forest")):
    query(f"m{_n}_{_kind}_check", _CHECK)(_checked(_kind))


@query("m4_early_stopping")
def m4(spark, sf):
    return _cv(spark, sf, "gbt_deep").select("model", "fold", "trees", "rmse")


@query("m4_early_stopping_check", oracle("select unnest(range(3))::integer as fold, true as staged, true as kept_is_best"))
def m4_check(spark, sf):
    """An error a tree, and the trees kept are those with the least error (the fits are shorter than the patience)."""
    return _cv(spark, sf, "gbt_deep").select("fold", (F.size("errors") == CV_TREES).alias("staged"), (F.array_position("errors", F.array_min("errors")) == F.col("trees")).alias("kept_is_best"))


@query("m5_cv_rmse")
def m5(spark, sf):
    return _cv(spark, sf, "gbt_categorical").groupBy("model").agg(F.avg("rmse").alias("rmse"))


@query("m6_cv_r2_rmse")
def m6(spark, sf):
    return S.cv_summary(_cv(spark, sf, "random_forest"))


@query("m7_cv_report")
def m7(spark, sf):
    return _cv(spark, sf, "gbt_deep").select("model", "fold", "trees", "rmse", "r2", S.display_score().alias("shown"))


def _trials(spark, sf):
    """All draws of all kinds through all rungs, on V1's folds: the search of V1's job."""
    return context(spark, sf).get("trials", lambda: cut_lineage(J.tune(spark, *_features(spark, sf, "v1"), "v1", TRIALS)))


@query("m8_param_search")
def m8(spark, sf):
    return _trials(spark, sf)


_RUNG_SIZES = [30, 10, 4]


@query("m8_param_search_check", oracle(
    "select model, rung, n, true as in_range, true as best_go_on from (values " + ", ".join(
        f"('{k}', {r}, {n})" for k in J.KINDS for r, n in enumerate(_RUNG_SIZES)) + ") t(model, rung, n)"))
def m8_check(spark, sf):
    """A rung's number of trials, all draws in their kind's ranges, and no trial that went on is worse than one that did not."""
    within = F.lit(True)
    for kind, ranges in M.RANGES.items():
        for name, (lo, hi) in ranges.items():
            if name != "maxIter":
                within = within & ((F.col("model") != kind) | F.col(name).between(lo, hi))
    worst, best = F.max(F.when(F.col("goes_on"), F.col("rmse"))), F.min(F.when(~F.col("goes_on"), F.col("rmse")))
    return _trials(spark, sf).groupBy("model", "rung").agg(F.count(F.lit(1)).cast("int").alias("n"), F.bool_and(within).alias("in_range"),
                                                           F.coalesce(worst <= best, F.lit(True)).alias("best_go_on"))


@query("m10_param_rescale")
def m10(spark, sf):
    best = M.best_trials(_trials(spark, sf))
    return M.rescale_params(best, "v2").withColumn("variant", F.lit("v2")).unionByName(
        M.rescale_params(best, "nb").withColumn("variant", F.lit("nb")))


@query("m9_seed_ensemble")
def m9(spark, sf):
    """Every kind with its searched parameters, rescaled for V2, once a seed; blended with the fixed weights."""
    params = M.tuned(M.rescale_params(M.best_trials(_trials(spark, sf)), "v2"))
    preds = M.seed_ensemble(J.KINDS, *_data(spark, sf), params=params)
    return S.blend(S.seed_average(preds), S.weights_frame(spark, J.FIXED_WEIGHTS)).select("Index", "demand")


@query("m11_predict")
def m11(spark, sf):
    return _predict("gbt_categorical")(spark, sf)


# --------------------------------------------------------- whole jobs

def _run(spark, sf, variant):
    """The committed run of a variant; V2 and NB resume from V1's."""
    def build():
        folder = context(spark, sf).get("runs", lambda: I.scratch(spark, "runs"))
        if variant != "v1":
            _run(spark, sf, "v1")
        return J.run_job(spark, folder, *_features(spark, sf, variant), variant, TRIALS, trials=_trials(spark, sf) if variant == "v1" else None)
    return context(spark, sf).get(f"run_{variant}", build)


_JOB_CHECK = oracle("select count(*) as n_rows, 0 as n_unknown, 0 as n_null, 0 as n_negative, true as in_reach, 3 as n_models, true as weights_sum_to_one, "
                    "'Index,demand' as layout from future")


def _job(variant):
    def fn(spark, sf):
        run = _run(spark, sf, variant)
        output = files.read_csv(spark, f"{run}/output", files.SUBMISSION_SCHEMA).withColumnRenamed("demand", "prediction")
        total = F.aggregate(F.map_values("weights"), F.lit(0.0), lambda a, x: a + x)
        kept = manifest.read_manifest(spark, run).select(F.size("params").alias("n_models"), (F.abs(total - 1) < 1e-9).alias("weights_sum_to_one"), F.array_join("layout", ",").alias("layout"))
        return future_check(spark, sf, output).crossJoin(F.broadcast(kept))  # 1 x 1
    return fn


for _variant in ("v1", "v2", "nb"):
    query(f"{_variant}_job", _JOB_CHECK)(_job(_variant))
