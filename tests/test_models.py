"""Early stopping, halving, manifests and the whole job, on data whose target has a signal."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from demandflow.plans import jobs as J
from demandflow.plans import models as M
from demandflow.sources import files, manifest


@pytest.fixture(scope="module")
def folds(spark):
    rng = np.random.default_rng(1)
    x, z = rng.random(600), rng.random(600)
    y = np.where(x > 0.5, 1.0, 0.0) + 0.3 * z + rng.normal(0, 0.05, 600)
    df = spark.createDataFrame([(i, float(a), float(b), float(c)) for i, (a, b, c) in enumerate(zip(x, z, y))], "Index long, x double, z double, demand double")
    df = VectorAssembler(inputCols=["x", "z"], outputCol="features").transform(df).select("Index", "demand", "features").cache()
    out = []
    for i in range(2):
        train, test = df.where(f"Index < {200 * (i + 1)}"), df.where(f"Index >= {200 * (i + 1)} and Index < {200 * (i + 2)}")
        out.append({"train": train, "test": test, "bins": 32, "variance": test.agg(F.var_pop("demand")).first()[0], "rows": 200})
    return out


def test_trees_kept_until_patience_runs_out():
    assert M.kept_trees([3.0, 2.0, 1.0]) == 3 and M.kept_trees([1.0, 2.0, 3.0]) == 1 and M.kept_trees([2.0, 1.0, 1.0]) == 2
    assert M.kept_trees([5, 4, 6, 6, 3], patience=2) == 2 and M.kept_trees([5, 4, 6, 6, 3], patience=3) == 5


def test_one_fit_gives_the_error_of_every_prefix(spark, folds):
    found = M.fit_fold("gbt_deep", folds[0], 42, 6, {"subsamplingRate": 1.0})
    assert len(found["errors"]) == 6 and found["errors"][found["trees"] - 1] == min(found["errors"]) and found["r2"] > 0.9
    for trees in (1, 3, 6):  # the error of the prefix is that of a fit with so many trees
        model = M.estimator("gbt_deep", 42, trees, 32, subsamplingRate=1.0).fit(folds[0]["train"])
        mse = model.transform(folds[0]["test"]).agg(F.avg(F.pow(F.col("prediction") - F.col("demand"), 2))).first()[0]
        assert mse == pytest.approx(found["errors"][trees - 1], rel=1e-9)


@pytest.mark.parametrize("kind", ["gbt_categorical", "random_forest"])
def test_halving_keeps_the_best_third(spark, folds, kind):
    rows = M.successive_halving(spark, kind, folds, n_trials=5, rungs=(1, 3)).collect()
    first, last = [r for r in rows if r.rung == 0], [r for r in rows if r.rung == 1]
    assert len(first) == 5 and len(last) == 2 and {r.trial for r in first if r.goes_on} == {r.trial for r in last}
    assert max(r.rmse for r in first if r.goes_on) <= min(r.rmse for r in first if not r.goes_on)
    best = M.best_trials(spark.createDataFrame(rows, M.TRIAL_SCHEMA)).collect()
    assert [b.model for b in best] == [kind] and best[0].rmse == min(r.rmse for r in last) and best[0].rung == 1


def documents(spark, weight):
    best = spark.createDataFrame([("a", 0, 1, 6, 5, 3, 0.1, None, 2, None, 2.0 / weight, 0.5, False), ("b", 1, 1, 6, 7, 4, None, 0.8, 1, 0.0, 2.0, 0.4, False)], M.TRIAL_SCHEMA)
    return J.document(best, "v1", ["Index", "demand"])


def test_manifest_saved_missing_and_half_written(spark, tmp_path):
    folder = str(tmp_path / "runs")
    tuned = []

    def tune():
        tuned.append(1)
        return documents(spark, 1.0)
    assert manifest.latest_run(spark, folder) is None
    assert manifest.resume_or(spark, folder, tune).first().variant == "v1" and tuned == [1]  # missing: tunes
    output = spark.createDataFrame([(1, 0.5), (2, 0.25)], files.SUBMISSION_SCHEMA)
    run = manifest.commit_run(spark, folder, output, documents(spark, 3.0))
    saved = manifest.resume_or(spark, folder, tune).first()
    assert tuned == [1] and saved.weights["a"] == pytest.approx(0.75) and saved.params["b"].subsamplingRate == 0.8 and saved.params["a"].stepSize == 0.1
    assert saved.scores["b"].rmse == 2.0 and saved.layout == ["Index", "demand"]
    assert sorted(map(tuple, files.read_csv(spark, f"{run}/output", files.SUBMISSION_SCHEMA).collect())) == [(1, 0.5), (2, 0.25)]
    # a run whose manifest was never finished, and one that was never renamed, do not count
    output.write.csv(f"{folder}/run-zzz/output")
    documents(spark, 5.0).write.json(f"{folder}/.staging-1/manifest")
    assert manifest.latest_run(spark, folder).endswith(run.rsplit("/", 1)[1])


def test_parameters_reach_the_estimators(spark):
    best = spark.createDataFrame([("gbt_deep", 0, 1, 6, 5, 3, 0.1, 0.7, 2, None, 2.0, 0.5, False)], M.TRIAL_SCHEMA)
    rescaled = M.tuned(M.rescale_params(best, "v2"))
    assert rescaled == {"gbt_deep": {"maxIter": 10, "maxDepth": 3, "stepSize": 0.05, "subsamplingRate": 0.7, "minInstancesPerNode": 2}}


def test_many_levels_become_digits_that_tell_them_apart(spark):
    rng = np.random.default_rng(3)
    n, levels = 4000, 900
    gh, x = rng.integers(0, levels, n), rng.random(n)
    y = (gh % 2) + np.where(x > 0.5, 1.0, 0.0)
    others = [c for c in M.CATEGORY_COLUMNS if c != "geohash"]
    rows = [(i, float(c), f"g{a}", float(b), *["k"] * len(others)) for i, (a, b, c) in enumerate(zip(gh, x, y))]
    df = spark.createDataFrame(rows, f"Index long, demand double, geohash string, x double, {', '.join(f'{c} string' for c in others)}").cache()
    stages = M.build_pipeline("gbt_categorical", df, 42, 5).getStages()
    assert stages[-1].getMaxBins() <= M.LEVELS  # before: a bin a level
    unseen = spark.createDataFrame([(n, 0.0, "new", 0.5, *["k"] * len(others)), (n + 1, 0.0, None, 0.5, *["k"] * len(others))], df.schema)
    out = PipelineModel([s if not hasattr(s, "fit") else s.fit(df) for s in stages[:-1]]).transform(df.union(unseen))
    digits = [c for c in out.columns if c.startswith("geohash_ordered_")]
    found = out.select(F.coalesce("geohash", F.lit("new")).alias("g"), F.array(*digits).alias("d")).distinct()
    assert len(digits) == 2 and found.count() == found.select("d").distinct().count() == len(set(gh.tolist())) + 1
    fitted = M.fit_predict("gbt_categorical", df, df.drop("demand"), 42, 5).join(df.select("Index", "demand"), "Index")
    assert fitted.agg(F.avg(F.pow(F.col("prediction") - F.col("demand"), 2))).first()[0] < 0.1 * float(np.var(y))


@pytest.mark.parametrize("size, sizes", [(200, [200]), (255, [255]), (256, [128, 2]), (21505, [253, 85]), (10_000_000, [255, 255, 154])])
def test_digits_of_a_number(spark, size, sizes):
    own = M.Digits("i", size)
    assert own.sizes == sizes or (len(own.sizes) == len(sizes) and max(own.sizes) <= M.LEVELS)
    numbers = spark.range(0, size, max(1, size // 5000)).select(F.col("id").cast("double").alias("i"))
    rows = own.transform(numbers)
    assert rows.select(*own.names).distinct().count() == rows.count()
    assert all(rows.agg(F.max(c)).first()[0] < n for c, n in zip(own.names, own.sizes))


def test_vectors_have_a_partition_a_core(spark):
    many = spark.range(1000).repartition(64)
    assert M.stored_vectors(many, 1000).rdd.getNumPartitions() == min(64, spark.sparkContext.defaultParallelism)
    assert M.stored_vectors(many, 40 * M.PARTITION_ROWS).rdd.getNumPartitions() == 40
    assert M.fits_at_once(spark, 10) >= 4 and M.fits_at_once(spark, 10 * M.SMALL_FIT) == 4


def test_fits_of_a_search_share_the_cores(spark, folds, monkeypatch):
    cores, seen = spark.sparkContext.defaultParallelism, []
    wide = [fold | {side: fold[side].repartition(cores) for side in ("train", "test")} for fold in folds]

    def fit(kind, fold, seed, trees, params):
        seen.append((kind, trees, fold["train"].rdd.getNumPartitions(), fold["test"].rdd.getNumPartitions()))
        return {"trees": trees, "errors": [1.0], "rmse": params["maxDepth"] + fold["variance"], "r2": 0.0}
    monkeypatch.setattr(M, "fit_fold", fit)
    rows = M.successive_halving(spark, "gbt_deep", wide, n_trials=6, rungs=(1, 3)).collect()
    assert len(seen) == 2 * (6 + 2) and {s[2:] for s in seen} == {(1, 1)}  # before: a partition a core in each of many fits
    assert all(r.rmse == pytest.approx(r.maxDepth + sum(f["variance"] for f in folds) / 2) for r in rows)
    assert M.shared_cores(wide[0]["train"], 200, 2).rdd.getNumPartitions() == cores  # few fits at once: all cores each
    many = spark.range(0, 10, 1, 64)
    assert M.shared_cores(many, 40 * M.PARTITION_ROWS, 4).rdd.getNumPartitions() == max(40, -(-2 * cores // 4))


def test_kinds_with_equal_vectors_share_them(spark, folds, monkeypatch):
    prepared = []
    monkeypatch.setattr(M, "time_folds", lambda *_: None)
    monkeypatch.setattr(M, "fold_vectors", lambda kind, _: prepared.append(kind) or folds)
    monkeypatch.setattr(M, "fit_fold", lambda kind, fold, seed, trees, params: {"trees": trees, "errors": [1.0], "rmse": float(params["maxDepth"]), "r2": 0.0})
    rows = J.tune(spark, None, None, "v1", 9).groupBy("model", "rung").count().collect()
    assert prepared == ["gbt_categorical", "gbt_deep"]  # before: once more for the forest
    assert {tuple(r) for r in rows} == {(kind, rung, n) for kind in J.KINDS for rung, n in enumerate((9, 3, 1))}
