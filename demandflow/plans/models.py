"""Model jobs on Spark MLlib.

The reference's three boosters are single-machine libraries; here they are
re-aimed at distributed MLlib estimators with the same roles:

* M1 ``gbt_categorical``: GBT on indexed categories carrying nominal
  metadata (categorical splits), like a booster with native categories.
* M2 ``gbt_deep``: deeper GBT with row subsampling, on label codes.
* M3 ``random_forest``: level-wise trees, on label codes.

MLlib refuses NaN features, so the lag gets -1 plus a ``lag_missing`` flag.
Which categories are nominal is the caller's choice, never the data's;
maxBins follows from the fitted indexer's exact level counts. A node's search of
a nominal split takes the square of the levels in MLlib, and maxBins holds for
all columns: a column of more than ``LEVELS`` levels becomes nominal digits of
its levels in the order of their mean target (``Digits``).
"""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandflow.operators.encode import CATEGORY_COLUMNS, label_encode, prefix_encodings, with_fold
from demandflow.operators.score import SEEDS
from demandflow.operators.split import time_blocks
from demandflow.operators.stats import exact_avg, scalar_row
from demandflow.plans import trees as T
from demandflow.session import cut_lineage, stored

DROP = ("Index", "timestamp", "demand", "day", "fold", "block", "side", "cv", "role")


def prepare(history: DataFrame, future: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Fill the lag for MLlib and add its missing flag."""
    def fix(df):
        if "lag_demand_1d" not in df.columns:
            return df
        return df.withColumns({"lag_missing": F.col("lag_demand_1d").isNull().cast("int"),
                               "lag_demand_1d": F.coalesce(F.col("lag_demand_1d"), F.lit(-1.0))})
    return fix(history), fix(future)


def numeric_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in DROP and c not in CATEGORY_COLUMNS]


#: what each kind starts from, and the ranges its search draws from: (low, high), whole numbers if both are; step sizes
#: are drawn log-uniformly
DEFAULTS = {
    "gbt_categorical": {"maxDepth": 5, "stepSize": 0.1},
    "gbt_deep": {"maxDepth": 8, "stepSize": 0.1, "subsamplingRate": 0.8},
    "random_forest": {"maxDepth": 8, "subsamplingRate": 0.8},
}
RANGES = {
    "gbt_categorical": {"maxIter": (5, 15), "maxDepth": (3, 7), "stepSize": (0.02, 0.3), "minInstancesPerNode": (1, 20)},
    "gbt_deep": {"maxIter": (5, 15), "maxDepth": (4, 9), "stepSize": (0.02, 0.3), "subsamplingRate": (0.6, 1.0), "minInstancesPerNode": (1, 20), "minInfoGain": (0.0, 0.001)},
    "random_forest": {"maxIter": (5, 15), "maxDepth": (4, 9), "subsamplingRate": (0.6, 1.0), "minInstancesPerNode": (1, 20)},
}
#: Factors on the number of trees for the final fit, by variant
RESCALE = {
    "v2": {"gbt_categorical": 2.5, "gbt_deep": 2.0, "random_forest": 2.0},
    "nb": {"gbt_categorical": 1.5, "gbt_deep": 1.3, "random_forest": 1.3},
}


def estimator(kind: str, seed: int = 42, max_iter: int = 10, max_bins: int = 32, **params):
    """M1-M3 estimators with the label column ``demand``; ``params`` override the kind's defaults."""
    settings = DEFAULTS[kind] | params | dict(featuresCol="features", labelCol="demand", predictionCol="prediction",
                                              seed=seed, maxBins=max_bins)
    if kind == "random_forest":
        return RandomForestRegressor(numTrees=max_iter, **settings)
    return GBTRegressor(maxIter=max_iter, **settings)


#: M1: most values of a nominal column; columns of more levels are split into digits
LEVELS = 255


class Digits(Transformer):
    """Whole numbers below ``size`` as nominal digits of at most ``levels`` values each, ``<column>_0`` first; together they tell all numbers apart."""

    def __init__(self, column: str, size: int, levels: int = LEVELS) -> None:
        super().__init__()
        self.column, self.widths = column, [size]
        while self.widths[-1] > levels:
            self.widths.append(-(-self.widths[-1] // levels))
        self.sizes = [-(-w // n) for w, n in zip(self.widths, self.widths[1:])] + self.widths[-1:]
        self.names = [f"{column}_{i}" for i in range(len(self.sizes))]

    def _transform(self, df: DataFrame) -> DataFrame:
        rest, shown = F.col(self.column).cast("long"), []
        for name, size, width in zip(self.names, self.sizes, [*self.widths[1:], 1]):
            shown.append(F.floor(rest / width).cast("double").alias(name, metadata={"ml_attr": {"name": name, "type": "nominal", "num_vals": size}}))
            rest = rest % width
        return df.select("*", *shown)


def levels_by_target(history: DataFrame, column: str, target: str = "demand") -> list[str]:
    """The values of a column by their mean target, as a tree's nominal split at its root orders them (an indexer holds them on the driver, too)."""
    means = history.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("string").alias("level")).agg(exact_avg(target).alias("mean"))
    return [r["level"] for r in means.sort("mean", "level").collect()]


def build_pipeline(kind: str, history: DataFrame, seed: int = 42, max_iter: int = 10,
                   nominal: Sequence[str] = tuple(CATEGORY_COLUMNS), **params) -> Pipeline:
    """M1 indexes the ``nominal`` categories (default: all) as nominal features; M2/M3 take label codes."""
    num = numeric_columns(history)
    if kind == "gbt_categorical":
        nominal = list(nominal)
        ordinal = [c for c in CATEGORY_COLUMNS if c not in nominal]
        idx = StringIndexer(inputCols=nominal, outputCols=[f"{c}_idx" for c in nominal], handleInvalid="keep").fit(history)
        sizes = {c: len(levels) + 1 for c, levels in zip(nominal, idx.labelsArray)}  # one more for unseen values
        many = [c for c in nominal if sizes[c] > LEVELS]
        by_target = [StringIndexerModel.from_labels(levels_by_target(history, c), inputCol=c, outputCol=f"{c}_ordered", handleInvalid="keep") for c in many]
        digits = [Digits(f"{c}_ordered", sizes[c]) for c in many]
        asm = VectorAssembler(inputCols=num + [f"{c}_idx" for c in nominal if c not in many] + [name for d in digits for name in d.names] + [f"{c}_code" for c in ordinal],
                              outputCol="features", handleInvalid="keep")
        bins = max([32] + [sizes[c] for c in nominal if c not in many] + [n for d in digits for n in d.sizes])
        return Pipeline(stages=[idx, *by_target, *digits, asm, estimator(kind, seed, max_iter, bins, **params)])
    asm = VectorAssembler(inputCols=num + [f"{c}_code" for c in CATEGORY_COLUMNS], outputCol="features",
                          handleInvalid="keep")
    return Pipeline(stages=[asm, estimator(kind, seed, max_iter, 32, **params)])


def with_codes(history: DataFrame, future: DataFrame) -> tuple[DataFrame, DataFrame]:
    """K7 codes next to the original category columns (``<col>_code``)."""
    h2 = history.select("*", *[F.col(c).alias(f"{c}_code") for c in CATEGORY_COLUMNS])
    f2 = future.select("*", *[F.col(c).alias(f"{c}_code") for c in CATEGORY_COLUMNS])
    hc, fc = label_encode(h2, f2, [f"{c}_code" for c in CATEGORY_COLUMNS])
    return hc, fc


def fit_predict(kind: str, train: DataFrame, test: DataFrame, seed: int = 42, max_iter: int = 10,
                **params) -> DataFrame:
    """Fit on ``train``, predict ``test``; predictions clipped at zero."""
    pipe = build_pipeline(kind, train, seed, max_iter, **params)
    ready = PipelineModel([stage if not hasattr(stage, "fit") else stage.fit(train) for stage in pipe.getStages()[:-1]])
    model = pipe.getStages()[-1].fit(stored_vectors(ready.transform(train).select("demand", "features"), train.count()))
    out = model.transform(ready.transform(test).select("Index", "features"))
    return out.select("Index", F.greatest(F.col("prediction"), F.lit(0.0)).alias("prediction"))


#: M4: rounds without a better validation error after which boosting stops
PATIENCE = 30


def kept_trees(errors: Sequence[float], patience: int = PATIENCE) -> int:
    """Trees up to the best error before the first ``patience`` rounds in a row that bring no better one."""
    best = 0
    for i, e in enumerate(errors):
        if e < errors[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def time_folds(history: DataFrame, future: DataFrame, spec, k: int = 3) -> DataFrame:
    """Rows of the expanding time split for models: the features of ``history`` with its encodings refitted for every
    fold (``prefix_encodings``) and label codes; columns cv and role ('train', 'test')."""
    names = [n for n, _, _ in spec]
    h, f = prepare(history.drop(*names), future.drop(*names))
    h, _ = with_codes(h, f)
    rows = cut_lineage(time_blocks(with_fold(h, method="shuffled"), k))
    return cut_lineage(prefix_encodings(rows, spec, k))


def features_of(kind: str) -> str:
    """The first kind with the same vectors: M2 and M3 both take label codes."""
    return "gbt_categorical" if kind == "gbt_categorical" else "gbt_deep"


def fold_vectors(kind: str, folded: DataFrame, k: int = 3) -> list[dict]:
    """For each fold: train and test as (Index, demand, features), prepared once for any number of fits; the folds side by side."""
    def prepared(i):
        train, test = (folded.where((F.col("cv") == i) & (F.col("role") == role)) for role in ("train", "test"))
        pipe = build_pipeline(kind, train)
        ready = PipelineModel([stage if not hasattr(stage, "fit") else stage.fit(train) for stage in pipe.getStages()[:-1]])
        sides = [stored_vectors(ready.transform(side).select("Index", "demand", "features"), side.count()) for side in (train, test)]
        spread = scalar_row(sides[1].agg(F.var_pop("demand").alias("v"), F.count("demand").alias("n")))
        return {"train": sides[0], "test": sides[1], "bins": pipe.getStages()[-1].getMaxBins(), "variance": spread["v"], "rows": spread["n"]}
    return in_parallel(prepared, range(k))


def binned_folds(folds: list[dict]) -> list[dict]:
    """The folds with their rows binned once for all fits of a search (``binned``), where these fit one task."""
    def prepared(fold):
        rows = fold["train"].count()
        if not (rows and fold["rows"] and T.fits_a_task(rows + fold["rows"], fold["train"])):
            return fold
        return fold | {"binned": T.binned(fold["train"], fold["test"], rows, fold["bins"])}
    return in_parallel(prepared, folds)


def fit_fold(kind: str, fold: dict, seed: int, trees: int, params: dict, patience: int = PATIENCE) -> dict:
    """One fit: the test error after each tree (boosting), the trees kept, and the rmse and r2 they give. Binned rows are fitted in one task."""
    own = estimator(kind, seed, trees, fold["bins"], **params)
    if "binned" in fold:
        errors = T.errors_of(fold["binned"], own)
    elif kind == "random_forest":
        squared = F.pow(F.col("prediction") - F.col("demand"), 2)
        errors = [scalar_row(own.fit(fold["train"]).transform(fold["test"]).agg(F.avg(squared).alias("e")))["e"]]
    else:
        errors = list(own.fit(fold["train"]).evaluateEachIteration(fold["test"], "squared"))
    kept = trees if kind == "random_forest" else kept_trees(errors, patience)  # a forest's trees are averaged, in no order: all are kept
    error = errors[min(kept, len(errors)) - 1]
    return {"trees": kept, "errors": errors, "rmse": math.sqrt(error), "r2": 1.0 - error / fold["variance"]}


#: rows up to which a fit leaves most cores idle, and rows of a partition of vectors
SMALL_FIT, PARTITION_ROWS = 1_000_000, 500_000


def stored_vectors(df: DataFrame, rows: int) -> DataFrame:
    """``df`` stored in a partition a core, more if they would be large: every task of a fit sends the statistics of all nodes."""
    return cut_lineage(df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // PARTITION_ROWS))))


def fits_at_once(spark: SparkSession, rows: int) -> int:
    """A fit a core where the fits are small, two where they are half as large (each waits for the driver between its levels),
    4 where one keeps the cores busy."""
    cores = spark.sparkContext.defaultParallelism
    return 4 if rows > SMALL_FIT else max(4, cores if rows > SMALL_FIT // 2 else 2 * cores)


def searching_threads(spark: SparkSession, folds: list[dict]) -> int:
    """Fits of a search at once: two a core where a fit is one task."""
    if all("binned" in fold for fold in folds):
        return 2 * spark.sparkContext.defaultParallelism
    return fits_at_once(spark, searched_rows(folds))


def shared_cores(vectors: DataFrame, rows: int, fits: int) -> DataFrame:
    """Stored vectors for one of ``fits`` fits at once: together they fill the cores, so a fit has few partitions, each of
    which would send the statistics of all nodes once more, a level."""
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    return vectors.coalesce(max(-(-2 * cores // fits), -(-rows // PARTITION_ROWS)))


def in_parallel(work: Callable, items: Sequence, threads: int = 4) -> list:
    """Spark jobs of independent fits, a few at a time."""
    with ThreadPoolExecutor(threads) as pool:
        return list(pool.map(work, items))


FOLD_SCHEMA = "model string, fold int, trees int, rmse double, r2 double, errors array<double>"


def cross_validate(spark: SparkSession, kind: str, folds: list[dict], trees: int, seed: int = 42, **params) -> DataFrame:
    """M4-M7: a row a fold: trees kept by early stopping, rmse and r2 of those, the error after each tree."""
    found = in_parallel(lambda i: fit_fold(kind, folds[i], seed, trees, params), range(len(folds)))
    return spark.createDataFrame([(kind, i, r["trees"], r["rmse"], r["r2"], r["errors"]) for i, r in enumerate(found)], FOLD_SCHEMA)


def sample_params(kind: str, n_trials: int, seed: int = 42) -> list[dict]:
    """M8 draws from the kind's ranges, seeded."""
    rng = random.Random(f"{kind}-{seed}")

    def draw(name, low, high):
        if name == "stepSize":
            return math.exp(rng.uniform(math.log(low), math.log(high)))
        return rng.randint(low, high) if isinstance(low, int) else rng.uniform(low, high)
    return [{"trial": t} | {name: draw(name, *bounds) for name, bounds in RANGES[kind].items()} for t in range(n_trials)]


def searched_rows(folds: list[dict]) -> int:
    return sum(fold["rows"] for fold in folds)


#: M8: trees a trial gets in each rung, and the share of trials that go on to the next
RUNGS, KEEP_ONE_IN = (2, 6, 18), 3
TRIAL_SCHEMA = ("model string, trial int, rung int, trees int, maxIter int, maxDepth int, stepSize double, subsamplingRate double, "
                "minInstancesPerNode int, minInfoGain double, rmse double, r2 double, goes_on boolean")


def successive_halving(spark: SparkSession, kind: str, folds: list[dict], n_trials: int = 30, seed: int = 42, rungs: Sequence[int] = RUNGS,
                       pool: ThreadPoolExecutor | None = None) -> DataFrame:
    """M8: ``n_trials`` draws; after each rung the best third (by mean rmse over all folds) goes on with more trees.

    Every trial is fitted on every fold with early stopping; the features of a fold are prepared once. ``maxIter`` is the
    mean of the trees kept. The best trial is the one with the least rmse in the last rung. ``pool``: threads that
    searches of several kinds share, so that the last fits of a rung leave no cores idle.
    """
    if pool is None:
        with ThreadPoolExecutor(searching_threads(spark, folds)) as pool:
            return successive_halving(spark, kind, folds, n_trials, seed, rungs, pool)
    at_once = fits_at_once(spark, searched_rows(folds))
    # fold i of an expanding split trains on i + 1 blocks and is tested on one
    sides = [fold | {"train": shared_cores(fold["train"], (i + 1) * fold["rows"], at_once), "test": shared_cores(fold["test"], fold["rows"], at_once)} for i, fold in enumerate(folds)]
    trials, rows = sample_params(kind, n_trials, seed), []
    for rung, trees in enumerate(rungs):
        jobs = [(t, i) for i in reversed(range(len(folds))) for t in range(len(trials))]  # the later folds are the larger
        fits = pool.map(lambda job: fit_fold(kind, sides[job[1]], seed, trees, {k: v for k, v in trials[job[0]].items() if k not in ("trial", "maxIter")}), jobs)  # noqa: B023
        found = dict(zip(jobs, fits))
        scored = []
        for t, p in enumerate(trials):
            own = [found[t, i] for i in range(len(folds))]
            scored.append((sum(r["rmse"] for r in own) / len(own), sum(r["r2"] for r in own) / len(own), round(sum(r["trees"] for r in own) / len(own)), p))
        scored.sort(key=lambda x: (x[0], x[3]["trial"]))
        going = len(scored) if rung == len(rungs) - 1 else max(1, -(-len(scored) // KEEP_ONE_IN))
        for place, (rmse, r2, kept, p) in enumerate(scored):
            rows.append((kind, p["trial"], rung, trees, kept, p["maxDepth"], p.get("stepSize"), p.get("subsamplingRate"), p.get("minInstancesPerNode"),
                         p.get("minInfoGain"), rmse, r2, rung < len(rungs) - 1 and place < going))
        trials = [p for *_, p in scored[:going]]
    return spark.createDataFrame(rows, TRIAL_SCHEMA)


def best_trials(trials: DataFrame) -> DataFrame:
    """A row a model: the trial with the least rmse in the last rung."""
    last = trials.withColumn("last", F.max("rung").over(Window.partitionBy("model"))).where("rung = last")  # a few rows a model
    return last.groupBy("model").agg(F.min_by(F.struct(*[c for c in trials.columns if c != "model"]), F.struct("rmse", "trial")).alias("b")).select("model", "b.*")


def rescale_params(params: DataFrame, variant: str, rate_divisor: float = 2.0) -> DataFrame:
    """More trees by the variant's factor for the model, and a smaller step, for the final fit."""
    factor = F.create_map(*[F.lit(x) for kv in RESCALE[variant].items() for x in kv])[F.col("model")]
    return params.withColumns({"maxIter": F.floor(F.col("maxIter") * factor).cast("int"),
                               "stepSize": F.col("stepSize") / rate_divisor})


def tuned(params: DataFrame) -> dict[str, dict]:
    """{model: {maxIter and what else was drawn}} from a row a model."""
    return {r["model"]: {c: r[c] for c in r.asDict() if r[c] is not None and c in ("maxIter", "maxDepth", "stepSize", "subsamplingRate", "minInstancesPerNode", "minInfoGain")}
            for r in params.collect()}  # a row a model


def seed_ensemble(kinds: Sequence[str], train: DataFrame, test: DataFrame, n_seeds: int = len(SEEDS),
                  max_iter: int = 10, params: dict[str, dict] | None = None) -> DataFrame:
    """M9: fit each model once per seed; long table (Index, model, seed, prediction).

    ``params``: by model, from a search (``tuned``). Features are prepared once for all seeds and all kinds that share them.
    """
    jobs, ready_for, rows = [], {}, train.count()
    at_once = min(fits_at_once(train.sparkSession, 2 * rows), max(1, len(kinds) * n_seeds))  # a search's folds train on half the rows
    for kind in kinds:
        if features_of(kind) not in ready_for:
            pipe = build_pipeline(features_of(kind), train)
            ready = PipelineModel([stage if not hasattr(stage, "fit") else stage.fit(train) for stage in pipe.getStages()[:-1]])
            seen, unseen, unseen_rows = ready.transform(train).select("Index", "demand", "features"), ready.transform(test).select("Index", "features"), test.count()
            bins = pipe.getStages()[-1].getMaxBins()
            if rows and T.fits_a_task(rows + unseen_rows, seen):
                ready_for[features_of(kind)] = T.binned(seen, unseen, rows, bins), None, bins
            else:
                ready_for[features_of(kind)] = shared_cores(stored_vectors(seen, rows), rows, at_once), stored_vectors(unseen, unseen_rows), bins
        own = {"maxIter": max_iter} | (params or {}).get(kind, {})
        jobs += [(kind, seed, *ready_for[features_of(kind)], own) for seed in SEEDS[:n_seeds]]

    def fit(job):
        kind, seed, seen, unseen, bins, own = job
        one = estimator(kind, seed, own["maxIter"], bins, **{k: v for k, v in own.items() if k != "maxIter"})
        found = T.predictions_of(seen, one) if unseen is None else one.fit(seen).transform(unseen)
        return found.select("Index", F.lit(kind).alias("model"), F.lit(seed).alias("seed"), F.greatest(F.col("prediction"), F.lit(0.0)).alias("prediction"))
    fitted = reduce(DataFrame.unionByName, in_parallel(fit, jobs, at_once))
    return stored(fitted) if any(unseen is None for _, unseen, _ in ready_for.values()) else fitted  # a fit in a task is done when it is read
