"""Expanding-window time split (K2) over history in (time_order, Index) order.

With n rows and k folds, t = n div (k+1); fold i tests positions
[n-(k-i)t, n-(k-i-1)t) and trains on every earlier position. A row's
``block`` is the fold it tests in, or -1 when it only ever trains, so one
column describes all folds: fold i trains on block < i and tests block == i.

Only the keys at the k cut positions are needed: they come from numbering the
two order columns by range partition, and every row then finds its block by
comparing its own key with k literals, without moving.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandflow.operators.stats import position_keys


def time_blocks(history_t: DataFrame, k: int = 3, order: str = "time_order", tie: str = "Index",
                out: str = "block") -> DataFrame:
    def cuts(n):
        t = F.floor(n / (k + 1))  # 0, with fewer rows than blocks: all train
        return [F.when(t > 0, n - (k - i) * t) for i in range(k)]

    block = F.lit(-1)
    for row in position_keys(history_t, [order, tie], cuts):
        after = (F.col(order) > row[order]) | ((F.col(order) == row[order]) & (F.col(tie) >= row[tie]))
        block = block + F.when(after, 1).otherwise(0)
    return history_t.withColumn(out, block.cast("int"))
