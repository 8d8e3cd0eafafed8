"""Fits of one task against MLlib's own, on rows without equal splits."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from demandflow.plans import jobs as J
from demandflow.plans import models as M
from demandflow.plans import trees as T


def vectors(spark, n, seed, levels=7):
    rng = np.random.default_rng(seed)
    x, z, c = rng.random(n), rng.normal(size=n), rng.integers(0, levels, n)
    y = np.where(x > 0.5, 1.0, 0.0) + 0.3 * z + 0.5 * (c % 3) + rng.normal(0, 0.05, n)
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(zip(x, z, c, y))], "Index long, x double, z double, c double, demand double")
    df = df.withMetadata("c", {"ml_attr": {"name": "c", "type": "nominal", "num_vals": levels + 1}})
    return VectorAssembler(inputCols=["x", "z", "c"], outputCol="features").transform(df).select("Index", "demand", "features").coalesce(1).cache()


@pytest.fixture(scope="module")
def fold(spark):
    train, test = vectors(spark, 900, 1), vectors(spark, 300, 2)
    return {"train": train, "test": test, "bins": 32, "variance": test.agg(F.var_pop("demand")).first()[0], "rows": 300}


@pytest.mark.parametrize("kind, params", [
    ("gbt_categorical", {"maxDepth": 4}), ("gbt_categorical", {"maxDepth": 6, "stepSize": 0.3, "minInstancesPerNode": 9}),
    ("gbt_deep", {"maxDepth": 5, "subsamplingRate": 0.7, "minInstancesPerNode": 15}), ("gbt_deep", {"maxDepth": 7, "subsamplingRate": 1.0, "minInfoGain": 0.002, "minInstancesPerNode": 4})])
def test_one_task_boosts_mllibs_trees(spark, fold, kind, params):
    (own,) = M.binned_folds([fold])
    assert own["binned"][1] == [32, 32, -8]
    expected, found = M.fit_fold(kind, fold, 42, 5, params), M.fit_fold(kind, own, 42, 5, params)  # before: one way only
    assert found["errors"] == pytest.approx(expected["errors"], rel=1e-9) and found["trees"] == expected["trees"]


def test_one_task_grows_a_forest(spark, fold):
    (own,) = M.binned_folds([fold])
    params = {"maxDepth": 7, "minInstancesPerNode": 2}
    found, expected = M.fit_fold("random_forest", own, 42, 12, params), M.fit_fold("random_forest", fold, 42, 12, params)
    assert found["rmse"] == pytest.approx(expected["rmse"], rel=0.25) and found["r2"] > 0.8 and found["trees"] == 12
    assert M.fit_fold("random_forest", own, 42, 12, params) == found != M.fit_fold("random_forest", own, 43, 12, params)


def test_draws_are_those_of_spark(spark):
    for seed, n in ((43, 10_000), (-5, 3), (2024, 1)):
        assert T.uniforms(seed, n).tolist() == [r[0] for r in spark.range(0, n, 1, 1).select(F.rand(seed)).collect()]


def test_cuts():
    assert T.cuts_between(np.array([3.0, 1.0, 1.0, -0.0, 0.0]), 5).tolist() == [0.5, 2.0] and T.cuts_between(np.ones(4), 5).tolist() == []
    cuts = T.cuts_between(np.arange(1000.0), 31)
    assert len(cuts) == 31 and np.ptp(np.diff(cuts)) <= 1.0
    skewed = T.cuts_between(np.array([0.0] * 900 + list(range(1, 101))), 9)
    assert skewed[0] == 0.5 and len(skewed) <= 9


def test_a_larger_childs_sums_are_what_is_left():
    rng = np.random.default_rng(5)
    codes, y, w = rng.integers(0, 9, (3, 500)).astype(np.uint8), rng.random(500), rng.poisson(0.8, 500).astype(float)
    for weight, rows in ((None, np.arange(500)), (w, np.flatnonzero(w))):
        tree = T.grow(codes, [9, 9, -9], rows, y, weight, 6, 3, 0.0)
        own = np.ones(500) if weight is None else weight
        leaf = T.Tree.predict(tree, codes)
        for value in np.unique(leaf[rows]):  # every leaf is the mean of its own rows, none smaller than asked
            at = rows[leaf[rows] == value]
            assert own[at].sum() >= 3 and np.average(y[at], weights=own[at]) == pytest.approx(value, rel=1e-12)
    assert T.grow(codes, [9, 9, -9], np.arange(5), y, None, 6, 3, 0.0).children == [None]


def test_bundled_columns_grow_the_same_tree():
    rng = np.random.default_rng(7)
    bins = [32, 1, -5, 2, 2, 9, 30, -250]
    codes = np.array([rng.integers(0, abs(b), 20_000) for b in bins], dtype=np.uint8)
    y = codes[0] * 0.1 + (codes[2] % 2) + codes[3] * codes[6] * 0.05 + rng.normal(size=20_000)
    bundled = T.bundles(codes, bins, 1024)
    assert sorted(f for b in bundled for f, _, _ in b.members) == [0, 2, 3, 4, 5, 6, 7] and len(bundled) < 5 and all(b.codes.max() < b.width <= 1024 for b in bundled)
    for rows in (np.arange(20_000), np.flatnonzero(rng.random(20_000) < 0.7)):
        one, other = (T.grow(codes, bins, rows, y, None, 3, 50, 0.0, bundled=b) for b in (None, bundled))
        assert one.column == other.column and one.value == pytest.approx(other.value, rel=1e-12)


def test_searches_bin_once_and_only_what_fits_a_task(spark, fold, monkeypatch):
    seen = []
    monkeypatch.setattr(M, "time_folds", lambda *_: None)
    monkeypatch.setattr(M, "fold_vectors", lambda kind, _: [fold])
    own = M.fit_fold
    monkeypatch.setattr(M, "fit_fold", lambda kind, one, *rest: seen.append("binned" in one) or own(kind, one, *rest))
    assert J.tune(spark, None, None, "v1", 2).count() == 3 * (2 + 1 + 1) and set(seen) == {True}  # before: none
    monkeypatch.setattr(T, "TASK_BYTES", 100)
    assert M.binned_folds([fold]) == [fold]


def test_nan_and_unknown_values_are_refused(spark, fold):
    nan = fold["train"].withColumn("demand", F.when(F.col("Index") == 3, float("nan")).otherwise(F.col("demand")))
    with pytest.raises(Exception, match="NaN"):
        T.binned(nan, fold["test"], 900, 32)


def history(spark, n, first=0):
    rng = np.random.default_rng(first + 1)
    x, level = rng.random(n), rng.integers(0, 5, n)
    y = np.where(x > 0.5, 1.0, 0.0) + 0.2 * level + rng.normal(0, 0.05, n)
    rows = [(first + i, float(a), float(b), *[f"k{c}"] * len(M.CATEGORY_COLUMNS), *[float(c)] * len(M.CATEGORY_COLUMNS)) for i, (a, b, c) in enumerate(zip(y, x, level))]
    return spark.createDataFrame(rows, f"Index long, demand double, x double, {', '.join(f'{c} string' for c in M.CATEGORY_COLUMNS)}, {', '.join(f'{c}_code double' for c in M.CATEGORY_COLUMNS)}")


def test_seed_ensemble_in_tasks_and_over_all_cores(spark, monkeypatch):
    train, test = history(spark, 500), history(spark, 60, 10_000).withColumn("Index", F.when(F.col("Index") > 10_001, F.col("Index")))  # null and repeated keys
    test = test.withColumn("Index", F.when(F.col("Index") == 10_003, 10_002).otherwise(F.col("Index"))).coalesce(1)
    test = test.withColumn("x", F.when(F.col("x") < 0.1, float("nan")).when(F.col("x") > 0.95, float("-inf")).otherwise(F.col("x")))  # MLlib predicts them
    params = {kind: {"maxIter": 6, "maxDepth": 4, "stepSize": 0.3} if kind != "random_forest" else {"maxIter": 6, "maxDepth": 4} for kind in J.KINDS}
    calls = []
    own = T.predictions_of
    monkeypatch.setattr(T, "predictions_of", lambda *a: calls.append(1) or own(*a))
    found = M.seed_ensemble(J.KINDS, train, test.drop("demand"), 2, params=params).groupBy("model", "seed", "Index").agg(F.count("*").alias("n"), F.sum("prediction").alias("p")).cache()
    assert len(calls) == 6 and found.agg(F.sum("n")).first()[0] == 6 * 60  # before: no fit in a task
    monkeypatch.setattr(T, "TASK_BYTES", 10)
    wide = M.seed_ensemble(J.KINDS, train, test.drop("demand"), 2, params=params).groupBy("model", "seed", "Index").agg(F.count("*").alias("m"), F.sum("prediction").alias("q"))
    both = found.alias("a").join(wide.alias("b"), (F.col("a.model") == F.col("b.model")) & (F.col("a.seed") == F.col("b.seed")) & F.col("a.Index").eqNullSafe(F.col("b.Index")))
    assert len(calls) == 6 and both.where("n = m").count() == found.count()
    apart = {r["model"]: r["d"] for r in both.groupBy("a.model").agg((F.sum(F.abs(F.col("p") - F.col("q"))) / F.sum("n")).alias("d")).collect()}
    assert apart["gbt_categorical"] < 0.02 and max(apart.values()) < 0.15
