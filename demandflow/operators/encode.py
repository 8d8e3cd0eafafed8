"""Encodings: frequency (A19), fold ids (K1), out-of-fold and full target
encoding (K3-K6), encodings per expanding fold, first-appearance label codes (O7/K7).

Target encoding uses a closed form instead of k passes. With S, N the
target sum and row count of a key, and s_f, n_f those of the key inside
fold f, a history row of fold f gets (S - s_f + m*g) / (N - n_f + m), which
is g when no other fold holds the key. Future rows get (S + m*g) / (N + m).

All key sets of a variant share one aggregation, which leaves a row a key with
its folds' sums in an array. A key set below the byte limit is broadcast; above
it, the keys that hold more than a partition's share of the rows are, and only
the others are joined by shuffle (``attach``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandflow.operators.stats import checked_broadcast, exact_avg, ordered_row_number, position_keys, scalar_row
from demandflow.session import cut_lineage

N_FOLDS = 5
BROADCAST_MAX_BYTES = 64 << 20
SUM_TYPE = "decimal(38,12)"


def fold_id(index: str = "Index", k: int = N_FOLDS, method: str = "mod"):
    """K1: fold of a row. 'mod' is Index mod k (oracle-friendly); 'hash' mixes the bits first."""
    if method == "hash":
        return F.pmod(F.xxhash64(F.col(index)), F.lit(k)).cast("int")
    return F.pmod(F.col(index), F.lit(k)).cast("int")


def shuffled_fold(df: DataFrame, index: str = "Index", k: int = N_FOLDS, seed: int = 42) -> Column:
    """K1: folds of equal size (one row apart at most) in the order of a seeded hash of the index.

    Only the k - 1 keys at the cuts are looked up, by numbering (hash, index) by range partition; a row finds its
    fold by comparing its own hash and index with them.
    """
    turn = F.md5(F.concat(F.lit(f"{seed}:"), F.col(index).cast("string")))
    keys = df.select(turn.alias("turn"), F.col(index).alias("at"))
    fold = F.lit(0)
    for cut in position_keys(keys, ["turn", "at"], lambda n: [F.when(n * i >= k, F.floor(n * i / k)) for i in range(1, k)]):
        fold = fold + F.when((turn > cut["turn"]) | ((turn == cut["turn"]) & (F.col(index) >= cut["at"])), 1).otherwise(0)
    return fold.cast("int")


def with_fold(df: DataFrame, k: int = N_FOLDS, method: str = "mod", name: str = "fold") -> DataFrame:
    """``method``: 'shuffled' (equal folds in the order of a seeded hash), 'mod' or 'hash' (``fold_id``)."""
    return df.withColumn(name, shuffled_fold(df, k=k) if method == "shuffled" else fold_id("Index", k, method))


def global_mean(history: DataFrame, target: str = "demand") -> float:
    """A26."""
    return float(scalar_row(history.agg(exact_avg(target).alias("g")))["g"])


def frequency_encode(df: DataFrame, history: DataFrame, key: str = "geohash",
                     name: str = "geohash_freq", total: int | None = None,
                     bound: float | None = None) -> DataFrame:
    """History rows per key over history rows; unseen keys 0."""
    if total is None:
        total = scalar_row(history.agg(F.count(F.lit(1)).alias("n")))["n"]
    counts = history.groupBy(key).agg(F.count(F.lit(1)).alias("_kc"))
    return (df.join(checked_broadcast(counts, bound=bound), key, "left")
              .withColumn(name, F.coalesce(F.col("_kc"), F.lit(0)) / F.lit(float(total)))
              .drop("_kc"))


def fold_stats(history: DataFrame, keys: Sequence[str], target: str = "demand",
               fold: str = "fold") -> DataFrame:
    """Per (key, fold): target sum and row count (map-side combined)."""
    return history.groupBy(*keys, fold).agg(F.sum(F.col(target).cast("decimal(38,12)")).alias("_fs"),
                                            F.count(target).alias("_fn"))


def _parts(keys: Sequence[str]) -> dict:
    """Columns to join on: a single key itself (null: no encoding), texts for a composite key (null part: 'nan')."""
    return {f"_key{i}": F.col(k) if len(keys) == 1 else F.coalesce(F.col(k).cast("string"), F.lit("nan")) for i, k in enumerate(keys)}


def encoding_lookups(source: DataFrame, keys: Sequence[str], name: str, smoothing: float, g: float,
                     target: str = "demand", fold: str = "fold") -> tuple[DataFrame, DataFrame]:
    """(out-of-fold table on the keys' ``_parts`` and fold, full table on the parts), value column ``name``.

    Rows with a null target count for nothing; null single keys have no entry.
    """
    parts = _parts(keys)
    source, keys = source.withColumns(parts), list(parts)
    m, gl = float(smoothing), F.lit(float(g))
    per_fold = fold_stats(source, keys, target, fold)
    totals = per_fold.groupBy(*keys).agg(F.sum("_fs").alias("_ks"), F.sum("_fn").alias("_kn"))
    # Sums are exact decimals; the rest of the arithmetic is in doubles.
    rest = (F.col("_ks") - F.col("_fs")).cast("double")
    oof = per_fold.join(totals, keys).select(
        *keys, fold, ((rest + m * gl) / (F.col("_kn") - F.col("_fn") + m)).alias(name))
    full = totals.select(*keys, ((F.col("_ks").cast("double") + m * gl) / (F.col("_kn") + m)).alias(name))
    return oof, full


def target_encode(history: DataFrame, future: DataFrame | None, keys: Sequence[str], name: str,
                  smoothing: float, g: float, target: str = "demand", fold: str = "fold",
                  source: DataFrame | None = None, key_bound: float | None = None,
                  fill: bool = True) -> tuple[DataFrame, DataFrame | None]:
    """K3 on history (out of fold) and K4 on future (all history); unseen keys get g.

    ``source`` is the frame the statistics come from (default ``history``);
    pass the persisted base when encodings are chained so that each
    aggregate reads the base, not the growing chain of joins. ``key_bound``
    is an upper bound on the number of distinct keys, if known.
    """
    oof, full = encoding_lookups(source if source is not None else history, keys, name, smoothing, g,
                                 target, fold)
    parts = _parts(keys)
    history, keys = history.withColumns(parts), list(parts)
    future = None if future is None else future.withColumns(parts)
    oof_bound = None if key_bound is None else key_bound * N_FOLDS
    hist_out = history.join(checked_broadcast(oof, bound=oof_bound), [*keys, fold], "left")
    fut_out = None if future is None else future.join(checked_broadcast(full, bound=key_bound), keys, "left")
    if fill:
        hist_out = hist_out.withColumn(name, F.coalesce(F.col(name), F.lit(float(g))))
        if fut_out is not None:
            fut_out = fut_out.withColumn(name, F.coalesce(F.col(name), F.lit(float(g))))
    return hist_out.drop(*parts), None if fut_out is None else fut_out.drop(*parts)


# Key sets and smoothing strengths of the two variants.
V1_ENCODINGS = [
    ("te_geohash", ["geohash"], 10),
    ("te_geohash_4", ["geohash_4"], 20),
    ("te_geohash_5", ["geohash_5"], 15),
    ("te_RoadType", ["RoadType"], 50),
    ("te_hour", ["hour"], 50),
    ("te_geohash_hour", ["geohash", "hour"], 5),
    ("te_roadtype_hour", ["RoadType", "hour"], 20),
]
V2_ENCODINGS = [
    ("te_geohash", ["geohash"], 10),
    ("te_geohash_4", ["geohash_4"], 20),
    ("te_geohash_5", ["geohash_5"], 15),
    ("te_RoadType", ["RoadType"], 50),
    ("te_gh_hour", ["geohash", "hour"], 5),
    ("te_rt_hour", ["RoadType", "hour"], 20),
    ("te_gh_rt", ["geohash", "RoadType"], 10),
    ("te_gh4_hour", ["geohash_4", "hour"], 10),
    ("te_road_weather", ["road_weather"], 30),
    ("te_road_vehicles", ["road_vehicles"], 30),
    ("te_Weather", ["Weather"], 50),
]


def _key_array(keys: Sequence[str]):
    """A key set as one comparable value, an array of the texts of its ``_parts``; a null single key is left out of the tables."""
    return F.array(*[p.cast("string") for p in _parts(keys).values()])


def _long(base: DataFrame, spec, target: str, *keep: str) -> DataFrame:
    """(enc, key, *keep, target in exact decimals) for every key set; encoding -1 holds all rows."""
    entries = [F.struct(F.lit(i).alias("enc"), _key_array(keys).alias("key")) for i, (_, keys, _) in enumerate(spec)]
    entries.append(F.struct(F.lit(-1).alias("enc"), F.array(F.lit("")).alias("key")))
    return base.select(*keep, F.col(target).cast(SUM_TYPE).alias("_y"), F.explode(F.array(*entries)).alias("_e")) \
               .select("_e.enc", "_e.key", *keep, "_y").where(F.get("key", F.lit(0)).isNotNull())


def _key_bytes() -> Column:
    return F.aggregate("key", F.lit(0).cast("long"), lambda n, x: n + F.octet_length(F.coalesce(x, F.lit("")))) + 24


def encoding_tables(base: DataFrame, spec, target: str = "demand", fold: str = "fold") -> tuple[DataFrame, dict]:
    """Statistics of every key set in ONE aggregation: (enc, key, folds: array of (fold, sum, targets), sum, targets, rows).

    Rows are unpivoted to (encoding id, key array, fold) and summed once (partial
    aggregation, so a hot key costs a row a task). The table is stored once. With it
    come scalars: number of keys and their bytes per encoding, history row count
    and the exact global target mean.
    """
    per_fold = _long(base, spec, target, fold).groupBy("enc", "key", fold).agg(F.sum("_y").alias("s"), F.count("_y").alias("n"), F.count(F.lit(1)).alias("r"))
    tables = cut_lineage(per_fold.groupBy("enc", "key").agg(
        F.collect_list(F.struct(F.col(fold).alias("fold"), "s", "n")).alias("folds"), F.sum("s").alias("s"), F.sum("n").alias("n"), F.sum("r").alias("r")))
    sizes = {r["enc"]: r for r in tables.groupBy("enc").agg(F.count(F.lit(1)).alias("keys"), F.sum(_key_bytes()).alias("bytes"),
                                                             F.max("s").alias("s"), F.max("n").alias("n"), F.max("r").alias("r")).collect()}  # a row a key set
    every = sizes[-1]
    return tables, {"keys": {i: r["keys"] for i, r in sizes.items()}, "bytes": {i: r["bytes"] for i, r in sizes.items()},
                    "rows": int(every["r"]), "mean": float(every["s"]) / int(every["n"])}


def out_of_fold(m: Column, g: float, k: int = N_FOLDS) -> Column:
    """Array over folds: the value of a key's rows in that fold, from the targets of the others."""
    def value(f: Column) -> Column:
        own = F.get(F.filter("folds", lambda x: x["fold"] == f), F.lit(0))
        rest = (F.col("s") - F.coalesce(own["s"], F.lit(0).cast(SUM_TYPE))).cast("double")
        return (F.coalesce(rest, F.lit(0.0)) + m * F.lit(float(g))) / (F.col("n") - F.coalesce(own["n"], F.lit(0)) + m)
    return F.transform(F.sequence(F.lit(0), F.lit(k - 1)), value)


def from_all(m: Column, g: float) -> Column:
    """The value of a key from all its targets."""
    return (F.coalesce(F.col("s").cast("double"), F.lit(0.0)) + m * F.lit(float(g))) / (F.col("n") + m)


def attach(df: DataFrame, lookup: DataFrame, keys: Sequence[str], name: str, *, size: int, total: int, limit: int = BROADCAST_MAX_BYTES,
           spread: str = "Index") -> DataFrame:
    """Left join of ``df`` with ``lookup`` (key, value, rows: how many of ``total`` rows have the key), its value as ``name``
    (and its key as ``name``_key).

    ``size``: the lookup's bytes. Above ``limit`` only keys with more than a partition's share of the rows are
    broadcast (fewer keys than partitions); rows that found theirs there, or have none, are spread by ``spread``
    in the shuffle that joins the rest.
    """
    own, lk, lv = _key_array(keys), f"{name}_key", f"{name}_value"
    if size <= limit:
        return df.join(F.broadcast(lookup.select(F.col("key").alias(lk), F.col("value").alias(name))), own == F.col(lk), "left")
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    often = F.col("rows") * parts > total
    hot = F.broadcast(lookup.where(often).select(F.col("key").alias(lk), F.col("value").alias(lv)))
    tail = lookup.where(~often).select(F.col("key").alias("_tk"), F.col("value").alias("_tv"))
    settled = F.col(lk).isNotNull() | F.exists(own, lambda x: x.isNull())
    with_hot = df.join(hot, own == F.col(lk), "left")
    with_hot = with_hot.withColumn("_own", F.when(settled, F.concat(F.array(F.col(spread).cast("string")), own)).otherwise(own))  # no key has as many parts
    return with_hot.join(tail, F.col("_own") == F.col("_tk"), "left").withColumn(name, F.coalesce(lv, "_tv")).drop(lv, "_own", "_tk", "_tv")


def encode_all(history: DataFrame, future: DataFrame | None, spec, g: float | None = None,
               target: str = "demand", fold: str = "fold", source: DataFrame | None = None,
               frequency: tuple[str, int] | None = None, limit: int = BROADCAST_MAX_BYTES) -> tuple[DataFrame, DataFrame | None]:
    """K5/K6: every encoding of a key set; history keeps its fold column.

    ``source`` (default ``history``) is the frame the statistics come from;
    it should be checkpointed by the caller. ``g`` defaults to the exact mean of
    ``source``. ``frequency`` (name, i) adds A19 of encoding i's key from the same table.
    """
    tables, info = encoding_tables(history if source is None else source, spec, target, fold)
    g = info["mean"] if g is None else g
    sides = [history] if future is None else [history, future]
    shown = [[F.col(c) for c in side.columns] for side in sides]
    m = F.create_map(*[x for i, (_, _, strength) in enumerate(spec) for x in (F.lit(i), F.lit(float(strength)))])[F.col("enc")]
    lookups = tables.where("enc >= 0").withColumn("m", m).select(
        "enc", "key", F.struct(out_of_fold(F.col("m"), g).alias("oof"), from_all(F.col("m"), g).alias("full"), "r").alias("value"), F.col("r").alias("rows"))
    for i, (name, keys, _) in enumerate(spec):
        lookup = lookups.where(F.col("enc") == i)
        size = info["bytes"].get(i, 0) + info["keys"].get(i, 0) * 8 * (N_FOLDS + 2)
        for at, side in enumerate(sides):
            sides[at] = attach(side, lookup, keys, f"_e{i}", size=size, total=info["rows"], limit=limit)
            found = F.get(F.col(f"_e{i}.oof"), F.col(fold)) if at == 0 else F.col(f"_e{i}.full")
            shown[at].append(F.coalesce(found, F.lit(float(g))).alias(name))
            if frequency is not None and frequency[1] == i:
                shown[at].append((F.coalesce(F.col(f"_e{i}.r"), F.lit(0)) / F.lit(float(info["rows"]))).alias(frequency[0]))
    sides = [side.select(*columns) for side, columns in zip(sides, shown)]
    return sides[0], None if future is None else sides[1]


def prefix_encodings(blocked: DataFrame, spec, k: int = 3, target: str = "demand", fold: str = "fold", block: str = "block",
                     limit: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """K5/K6 refitted for every fold of the expanding time split, as a long table.

    Fold ``cv`` trains on rows of earlier blocks (``role`` 'train': out-of-fold values) and tests on block ``cv``
    ('test': values of all training rows); global means and all sums come from the training rows alone, so no
    target of the tested or a later block is seen. One aggregation by (key, block, fold), and one of its rows by key,
    give every ``cv`` its statistics; a row takes a key's values of all folds in one lookup before it is dealt to its folds.
    """
    sums = _long(blocked, spec, target, fold, block).groupBy("enc", "key", block, fold).agg(F.sum("_y").alias("s"), F.count("_y").alias("n"), F.count(F.lit(1)).alias("r"))
    zero = F.lit(0).cast(SUM_TYPE)

    def total(column: str, c: int, f: int | None = None) -> Column:
        """The sum over blocks before ``c``, of one fold or of all."""
        seen = (F.col(block) < c) if f is None else (F.col(block) < c) & (F.col(fold) == f)
        return F.sum(F.when(seen, F.col(column)))
    known = [F.coalesce(total("s", c, f), zero).alias(f"s{c}{name}") for c in range(k) for f, name in [(None, ""), *((f, f"_{f}") for f in range(N_FOLDS))]]
    known += [F.coalesce(total("n", c, f), F.lit(0)).alias(f"n{c}{name}") for c in range(k) for f, name in [(None, ""), *((f, f"_{f}") for f in range(N_FOLDS))]]
    tables = cut_lineage(sums.groupBy("enc", "key").agg(*known, F.sum("r").alias("r")))
    every = scalar_row(tables.where("enc = -1"))
    means = [float(every[f"s{c}"]) / every[f"n{c}"] if every[f"n{c}"] else 0.0 for c in range(k)]
    sizes = {r["enc"]: r["bytes"] for r in tables.groupBy("enc").agg(F.sum(_key_bytes() + 8 * (N_FOLDS + 1) * k).alias("bytes")).collect()}  # a row a key set
    rows, shown = blocked, [[] for _ in range(k)]
    for i, (name, keys, m) in enumerate(spec):
        def values(c: int) -> Column:
            smooth = lambda s, n: (s.cast("double") + float(m) * means[c]) / (n + float(m))  # noqa: E731, B023
            s, n = F.col(f"s{c}"), F.col(f"n{c}")
            oof = F.array(*[smooth((s - F.col(f"s{c}_{f}")).cast(SUM_TYPE), n - F.col(f"n{c}_{f}")) for f in range(N_FOLDS)])
            return F.struct(oof.alias("oof"), smooth(s, n).alias("full"))
        lookup = tables.where(F.col("enc") == i).select("key", F.array(*[values(c) for c in range(k)]).alias("value"), F.col("r").alias("rows"))
        rows = attach(rows, lookup, keys, f"_e{i}", size=sizes.get(i, 0), total=every["r"], limit=limit)
        for c in range(k):
            at = F.get(f"_e{i}", F.lit(c))
            shown[c].append(F.coalesce(F.when(F.col(block) < c, F.get(at["oof"], F.col(fold))).otherwise(at["full"]), F.lit(means[c])).alias(name))
    role = F.when(F.col(block) < F.col("cv"), "train").otherwise("test")
    of_fold = F.array(*[F.when(F.col(block) <= c, F.struct(F.lit(c).alias("cv"), *shown[c])) for c in range(k)])
    dealt = rows.select(*blocked.columns, F.explode(of_fold).alias("_r")).where(F.col("_r").isNotNull())
    return dealt.select(*blocked.columns, "_r.cv", *[F.col(f"_r.{name}") for name, _, _ in spec]).select(*blocked.columns, "cv", role.alias("role"), *[name for name, _, _ in spec])


# Categorical columns that get label codes.
CATEGORY_COLUMNS = ["geohash", "RoadType", "Weather", "LargeVehicles", "Landmarks",
                    "geohash_4", "geohash_5", "road_weather", "road_vehicles"]


def appearance_codes(history: DataFrame, future: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, code) for all ``columns`` at once: codes count up from 0 in each column.

    Rows are unpivoted to (column, value); a value's first position is one
    min over a struct (partial aggregation), and the distinct values are
    numbered by range partition in (column, position) order. A column's codes
    start where its first number is.
    """
    def firsts(df: DataFrame, side: int, order: str | None) -> DataFrame:
        t = F.col(order) if order else F.lit(0)
        values = F.array(*[F.struct(F.lit(c).alias("column"), F.coalesce(F.col(c).cast("string"), F.lit("nan")).alias("value"))
                           for c in columns])
        return df.select(F.explode(values).alias("v"), F.struct(F.lit(side).alias("side"), t.cast("int").alias("t"), F.col("Index")).alias("p")) \
                 .select("v.column", "v.value", "p")

    both = firsts(history, 0, "time_order").unionByName(firsts(future, 1, None))
    first = both.groupBy("column", "value").agg(F.min("p").alias("p")).select("column", "value", "p.*")
    numbered = ordered_row_number(first, ["column", "side", "t", "Index", "value"], "n")
    starts = numbered.groupBy("column").agg(F.min("n").alias("start"))  # one row a column
    return numbered.join(F.broadcast(starts), "column").select("column", "value", (F.col("n") - F.col("start")).cast("int").alias("code"))


def firstappearance_codes(history: DataFrame, future: DataFrame, col: str,
                           code: str = "code") -> DataFrame:
    """(value, code) with codes in order of first appearance over history
    in (time_order, Index) order followed by future in Index order."""
    return appearance_codes(history, future, [col]).select("value", F.col("code").alias(code))


def label_encode(history: DataFrame, future: DataFrame,
                 columns: Sequence[str] = CATEGORY_COLUMNS) -> tuple[DataFrame, DataFrame]:
    """K7: replace each category column by its first-appearance code on both sides.

    All columns' codes come from one numbering of the input frames; each
    column's share of it is counted and broadcast below the row limit.
    """
    codes = appearance_codes(history, future, columns).persist()
    sizes = {r["column"]: r["n"] for r in codes.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a column
    for c in columns:
        own = checked_broadcast(codes.where(F.col("column") == c).select("value", F.col("code").alias("_code")), bound=sizes.get(c, 0))

        def apply(df: DataFrame) -> DataFrame:
            keyed = df.withColumn("_val", F.coalesce(F.col(c).cast("string"), F.lit("nan")))
            return keyed.join(own, keyed["_val"] == own["value"], "left") \
                        .withColumn(c, F.col("_code")).drop("_val", "value", "_code")
        history, future = apply(history), apply(future)
    return history, future
