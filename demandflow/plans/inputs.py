"""Shared inputs of the registered queries, memoized per session and scale."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from demandflow.functions.timefeat import with_time_columns
from demandflow.plans.registry import context
from demandflow.session import checkpoint_dir, stored
from demandflow.sources.observations import observations, split_observations


def obs(spark: SparkSession, sf: str) -> DataFrame:
    return context(spark, sf).get("obs", lambda: observations(spark, sf))


def split(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return context(spark, sf).get("split", lambda: split_observations(obs(spark, sf)))


def history(spark, sf) -> DataFrame:
    return split(spark, sf)[0]


def future(spark, sf) -> DataFrame:
    return split(spark, sf)[1]


def truth(spark, sf) -> DataFrame:
    return split(spark, sf)[2]


def stored_split(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``split`` of the observations stored once, for steps that read them several times."""
    return context(spark, sf).get("stored_split", lambda: split_observations(stored(obs(spark, sf))))


def history_t(spark, sf) -> DataFrame:
    return with_time_columns(history(spark, sf))


def future_t(spark, sf) -> DataFrame:
    return with_time_columns(future(spark, sf))


def decoded(spark, sf) -> DataFrame:
    """G2 table (distinct geohash -> centre), broadcast after a size check."""
    from demandflow.functions.geo import geohash_table
    from demandflow.operators.stats import checked_broadcast
    return context(spark, sf).get("decoded", lambda: checked_broadcast(
        geohash_table(list(stored_split(spark, sf)[:2]))))


def cleaned(spark, sf, variant: str = "v2"):
    """Cleaned sides of the stored observations: only row expressions are left to do when they are read."""
    def build():
        from demandflow.plans.features import clean
        h, f, _ = stored_split(spark, sf)
        return clean(h, f, variant, with_center=True, decoded=decoded(spark, sf))
    return context(spark, sf).get(f"clean_{variant}", build)


def features(spark, sf, variant: str = "v2") -> tuple[DataFrame, DataFrame]:
    from demandflow.plans.features import build_features
    return context(spark, sf).get(f"feat_{variant}",
                                  lambda: build_features(*stored_split(spark, sf)[:2], variant))


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder (see ``checkpoint_dir``)."""
    return f"{checkpoint_dir(spark).rstrip('/')}/demandflow-io/{uuid.uuid4().hex}/{name}"
