"""Joins of rows with a lookup some of whose keys hold a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dealt_join(rows: DataFrame, lookup: DataFrame, on: Sequence[str], *, times: str, total: int, spread: str) -> DataFrame:
    """Inner join of ``rows`` with ``lookup``, which has a row a key and in ``times`` how many of the ``total`` rows have it.

    A key with more than a partition's share of the rows is dealt over as many parts as it has shares, by a hash of
    ``spread``, and its lookup row is copied to each. There are fewer such keys than partitions: they are broadcast.
    """
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = lookup.withColumn("__parts", F.ceil(F.col(times) * partitions / max(total, 1)).cast("int"))
    hot = F.broadcast(cut.where("__parts > 1").select(*on, "__parts"))
    dealt = rows.join(hot, list(on), "left").withColumn("__part", F.pmod(F.xxhash64(spread), F.coalesce("__parts", F.lit(1))).cast("int")).drop("__parts")
    copies = cut.withColumn("__part", F.explode(F.sequence(F.lit(0), F.greatest("__parts", F.lit(1)) - 1))).drop("__parts", times)
    return dealt.join(copies, [*on, "__part"]).drop("__part")
