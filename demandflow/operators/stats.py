"""Distributed building blocks shared by the operators.

* ``exact_quantiles``: linear-interpolated quantiles (the pandas/numpy rule)
  without Spark's exact ``percentile`` aggregate, whose final buffer holds
  every distinct value of a group in one task. A sketch brackets each wanted
  rank; only values inside the brackets are ranked.
* ``mode_of``: most frequent non-null value, smallest on ties, as two
  ordinary aggregations (map-side combine, no per-group value buffer).
* ``checked_broadcast``: broadcast a lookup only after counting it.
* ``ordered_row_number``: 0-based row numbers by range partition, without a
  window over rows; ``position_keys`` reads the keys at given positions.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from demandflow.session import cut_lineage

SKETCH_ACCURACY = 100_000
BROADCAST_MAX_ROWS = 2_000_000


SUM_TYPE = "decimal(38,12)"


def exact_sum(c) -> "F.Column":
    """Sum in exact decimal arithmetic: the same result for any partitioning or
    summation order (double sums differ in the last bits between plans)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.sum(col.cast(SUM_TYPE)).cast("double")


def exact_avg(c) -> "F.Column":
    col = F.col(c) if isinstance(c, str) else c
    return exact_sum(col) / F.count(col)


def scalar_row(df: DataFrame) -> Row:
    """The single row of a one-row aggregate (bounded by construction)."""
    rows = df.limit(2).collect()
    if len(rows) != 1:
        raise ValueError(f"expected one row, got {len(rows)}")
    return rows[0]


def checked_broadcast(small: DataFrame, max_rows: int = BROADCAST_MAX_ROWS,
                      bound: float | None = None) -> DataFrame:
    """Broadcast a lookup side only when its row count is known to be under ``max_rows``.

    ``bound`` is an upper bound already established (e.g. from a distinct
    count sketch); without one the side is persisted and counted. Above the
    limit the plain DataFrame is returned and Spark plans a shuffle join
    (AQE may still split skewed partitions).
    """
    if bound is not None:
        return F.broadcast(small) if bound <= max_rows else small
    small = small.persist()
    if small.count() <= max_rows:
        return F.broadcast(small)
    return small


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float],
                    names: Sequence[str] | None = None, by: Sequence[str] = (),
                    max_groups: int | None = None, accuracy: int = SKETCH_ACCURACY) -> DataFrame:
    """One row per group of ``by``: exact quantiles of ``value`` (nulls ignored).

    Position h = (n-1)p; result lerp(v[floor h], v[floor h + 1], h - floor h)
    with numpy's two-sided lerp. Without ``by`` there is always one row.

    Two passes over ``df`` and no shuffle of its values. A mergeable quantile
    sketch, off by at most 1/``accuracy`` of a group's rows, gives each wanted
    rank a bracket of values. The second pass keeps the values inside brackets
    (a few in ``accuracy`` rows, equal ones as one row with a count) and, of all
    others, the count, smallest and largest between one bracket and the next:
    partial aggregation leaves little to shuffle. Running counts over these
    rows are exact ranks. A wanted rank lies inside its bracket or next to it;
    if ever not, the job fails instead of returning another value.
    ``max_groups`` is a proven bound on the number of groups; with it the table
    of brackets is broadcast.
    """
    by = list(by)
    names = list(names) if names else [f"q{i}" for i in range(len(probs))]
    g = by if by else ["_g"]
    base = df.select(*(by or [F.lit(0).alias("_g")]), F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    slack = 2.0 / accuracy
    wanted = [max(p - slack, 0.0) for p in probs] + [min(p + slack, 1.0) for p in probs]
    brackets = base.groupBy(*g).agg(F.percentile_approx("_v", wanted, accuracy).alias("_s"), F.count(F.lit(1)).alias("_tot"))
    if not by or (max_groups is not None and max_groups <= BROADCAST_MAX_ROWS):
        brackets = F.broadcast(brackets)
    lows, highs = ([F.col("_s")[i + side * len(probs)] for i in range(len(probs))] for side in (0, 1))
    inside = reduce(Column.__or__, [(F.col("_v") >= lo) & (F.col("_v") <= hi) for lo, hi in zip(lows, highs)])
    region = reduce(Column.__add__, [(F.col("_v") > hi).cast("int") for hi in highs])
    kept = (base.join(brackets, g)
            .select(*g, "_v", "_tot", F.when(inside, F.col("_v")).alias("_x"), F.when(~inside, region).alias("_r"))
            .groupBy(*g, "_tot", "_x", "_r").agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_mn"), F.max("_v").alias("_mx")))
    before = Window.partitionBy(*g).orderBy("_mn").rowsBetween(Window.unboundedPreceding, -1)
    ranked = kept.withColumn("_lo_rank", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    last = F.col("_lo_rank") + F.col("_n") - 1

    def at(rank: Column) -> Column:
        """The value at ``rank`` if this row holds it."""
        known = (F.when(F.col("_x").isNotNull() | (rank == F.col("_lo_rank")), F.col("_mn")).when(rank == last, F.col("_mx"))
                 .otherwise(F.raise_error(F.lit("a rank lies outside its bracket")).cast("double")))
        return F.max(F.when((F.col("_lo_rank") <= rank) & (rank <= last), known))

    picks, finals = [], []
    for i, p in enumerate(probs):
        h = (F.col("_tot") - 1) * F.lit(float(p))
        r0 = F.floor(h)
        picks += [at(r0).alias(f"_a{i}"), at(F.least(r0 + 1, F.col("_tot") - 1)).alias(f"_b{i}"), F.max(h - r0).alias(f"_t{i}")]
        a, b, t = F.col(f"_a{i}"), F.col(f"_b{i}"), F.col(f"_t{i}")
        finals.append(F.when(t >= 0.5, b - (b - a) * (1 - t)).otherwise(a + (b - a) * t).alias(names[i]))
    out = ranked.groupBy(*g).agg(*picks).select(*g, *finals)
    if not by:
        one = df.sparkSession.range(1).select(F.lit(0).alias("_g"))
        out = one.join(out, "_g", "left").drop("_g")
    return out


def quantile_frame(df: DataFrame, spec: dict[str, dict[str, float]]) -> DataFrame:
    """One row: for each column of ``spec`` its exact quantiles, {output name: probability}.

    The columns are unpivoted to (name, value) and ranked per name: one plan,
    whose number of groups is bounded by ``len(spec)``.
    """
    probs = sorted({float(p) for wanted in spec.values() for p in wanted.values()})
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("name"), F.col(n).cast("double").alias("v")) for n in spec])).alias("x")) \
        .select("x.name", "x.v")
    found = exact_quantiles(long, "v", probs, [f"p{i}" for i in range(len(probs))], by=["name"], max_groups=len(spec))
    return found.agg(*[F.max(F.when(F.col("name") == n, F.col(f"p{probs.index(float(p))}"))).alias(out)
                       for n, wanted in spec.items() for out, p in wanted.items()])


def mode_of(df: DataFrame, value: str, name: str = "mode", by: Sequence[str] = ()) -> DataFrame:
    """Most frequent non-null ``value`` per group of ``by``; ties to the smallest value."""
    by = list(by)
    counts = (df.where(F.col(value).isNotNull())
                .groupBy(*by, value).agg(F.count(F.lit(1)).alias("_n")))
    best = counts.groupBy(*by).agg(F.min(F.struct((-F.col("_n")).alias("k"), F.col(value).alias("v"))).alias("_m"))
    out = best.select(*by, F.col("_m.v").alias(name))
    if not by:
        one = df.sparkSession.range(1).select(F.lit(0).alias("_g"))
        out = one.join(out.withColumn("_g", F.lit(0)), "_g", "left").select(name)
    return out


def ordered_row_number(df: DataFrame, order: Sequence[str | Column], out: str = "row_num",
                       partitions: int | None = None, range_by: int | None = None, total: str | None = None,
                       store: Callable[[DataFrame], DataFrame] = cut_lineage) -> DataFrame:
    """0-based row number in ``order`` (names or sort expressions, unique together).

    Rows go to range partitions and are sorted there; the id they get in that
    order holds their partition and their place in it. The rows are stored, so
    that numbers stay with them, and the counts per partition (one row a
    partition) give each partition its offset. One shuffle; no task holds more
    than its range, and a key of any share is cut at the later order columns.
    ``range_by``: ranges by the first so many columns only (long texts stay out
    of the sampled bounds). ``total``: a column with the number of rows, too.
    """
    parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    placed = store(df.repartitionByRange(parts, *cols[:range_by]).sortWithinPartitions(*cols)
                     .withColumn("__at", F.monotonically_increasing_id()))
    part, place = F.shiftright("__at", 33), F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    counts = placed.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    offsets = counts.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"),
                            F.sum("__n").over(Window.partitionBy()).alias("__total"))
    added = [(F.col("__before") + place).alias(out)] + ([F.col("__total").alias(total)] if total else [])
    return placed.join(F.broadcast(offsets), part == F.col("__part")).select(*df.columns, *added)


def position_keys(df: DataFrame, order: Sequence[str], positions: Callable[[Column], Sequence[Column]]) -> list[Row]:
    """The ``order`` columns of the rows at 0-based positions, in order.

    ``positions`` says where, given the number of rows; as many rows as positions come to the driver.
    """
    numbered = ordered_row_number(df.select(*order), order, "__pos", total="__n")
    return sorted(numbered.where(F.col("__pos").isin(*positions(F.col("__n")))).collect(), key=lambda r: r["__pos"])
