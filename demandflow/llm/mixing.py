"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

1. A source's documents fall into ``blocks`` blocks by a hash of their id, so
   the number of blocks, and with it every table below, does not grow with the
   documents and a hot source is dealt over many tasks.
2. Targets: sources in code point order (null last) weigh 1, 2, 3, repeating.
   The total is shared by weight; no target passes ``most_copies`` times its
   source. With sources sorted by capacity per weight the water level is the
   greatest of the shares that would remain, so no iteration is needed.
3. A source draws its blocks in permuted order, copy after copy, each that
   still fits under its target; the first that did not fit is drawn in part, by
   documents in permuted order, to within half a document.
4. The numbers of drawn blocks (quotas) are split among the output shards: at
   each node of a binary tree the left half takes its share of all blocks
   without replacement, which leaves each source a multivariate hypergeometric
   number (inverse distribution function of a hashed uniform, source by
   source). The leaves' quotas sum exactly to the draws. A source's drawn
   blocks go to the shards by these quotas, in permuted order, without overlap.
5. Rows of a shard are ordered by a hash of id and copy: a local shuffle.

Only DataFrame functions. Everything depends on ``seed`` and the rows, not on
partitioning: reruns agree.

Defined results: a null or empty text has size 0 and takes 0 words (its block
may place it); a null source is a source of its own; repeated rows are separate
documents with the same places; a very long text counts with all its words and
may be passed over when it does not fit; equal turns go by block; an empty table gives an empty result; other
columns stay as they are, except those named like one that is added.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .exact_stats import log_factorial
from .store import materialise


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, most_copies: int = 3) -> DataFrame:
    """(key, source, source_size) with ``target``: the source's share of all words, at most ``most_copies`` times its own."""
    total = Window.partitionBy()
    ranked = sizes.withColumn("weight", (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % 3 + 1)
    ranked = ranked.withColumns({"capacity": (F.col("source_size") * most_copies).cast("double"), "total": F.sum("source_size").over(total).cast("double")})
    by_level = Window.orderBy(F.col("capacity") / F.col("weight"), "key")
    before, after = by_level.rowsBetween(Window.unboundedPreceding, -1), by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.col("total") - F.coalesce(F.sum("capacity").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    return ranked.withColumn("level", level).withColumn("target", F.least("capacity", F.max("level").over(total) * F.col("weight"))).select("key", "source", "source_size", "target")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is written, and worked out, once however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def hypergeometric(population: Column, marked: Column, draws: Column, u: Column) -> Column:
    """Number of marked among ``draws`` without replacement, by inversion of a uniform ``u``; sums run over 12 deviations around the mean.

    Every part is written once: repeated in place, one draw was a tree of thousands of expressions on the driver.
    """
    def bounds(v: Column) -> Column:
        mean = v["draws"] * v["marked"] / F.greatest(v["population"], F.lit(1.0))
        spread = F.sqrt(mean * (1 - v["marked"] / F.greatest(v["population"], F.lit(1.0)))) * 12 + 12
        low = F.ceil(F.greatest(F.lit(0.0), v["draws"] + v["marked"] - v["population"], mean - spread)).cast("double")
        high = F.floor(F.least(v["marked"], v["draws"], mean + spread)).cast("double")
        return _let(F.struct(low.alias("low"), high.alias("high")), lambda b: F.when(b["high"] <= b["low"], b["low"]).otherwise(invert(v, b["low"], b["high"])))

    def invert(v: Column, low: Column, high: Column) -> Column:
        n, k, d = v["population"], v["marked"], v["draws"]

        def search(logs: Column) -> Column:
            at_low = F.exp(logs[0] - logs[1] - logs[2] + logs[3] - logs[4] - logs[5] - logs[6] + logs[7] + logs[8])
            start = _let(at_low, lambda p: F.struct(p.alias("p"), p.alias("cdf"), low.alias("x")))
            places = F.transform(F.sequence(low.cast("long"), F.greatest(low, high - 1).cast("long")), lambda x: x.cast("double"))
            return F.aggregate(places, start, step, lambda acc: F.least(acc["x"], high))

        def step(acc: Column, x: Column) -> Column:
            ratio = (k - x) * (d - x) / ((x + 1) * F.greatest(n - k - d + x + 1, F.lit(1.0)))
            more = _let(acc["p"] * ratio, lambda p: F.struct(p.alias("p"), (acc["cdf"] + p).alias("cdf"), (x + 1).alias("x")))
            return F.when(acc["cdf"] < v["u"], more).otherwise(acc)
        return _let(F.transform(F.array(k, low, k - low, n - k, d - low, n - k - d + low, n, d, n - d), log_factorial), search)

    given = {"population": population, "marked": marked, "draws": draws, "u": u}
    return _let(F.struct(*[x.cast("double").alias(name) for name, x in given.items()]), bounds)


def split_quotas(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """(key, shard, quota) from (key, quota): the splitting tree, level by level."""
    node = quotas.where("quota > 0").groupBy().agg(F.array_sort(F.collect_list(F.struct("key", F.col("quota").cast("double").alias("quota")))).alias("quotas")).select(
        F.lit(0).alias("first"), F.lit(shards).alias("width"), "quotas")
    for level in range(max(shards - 1, 0).bit_length()):
        half = F.floor((F.col("width") + 1) / 2).cast("int")
        total = F.aggregate("quotas", F.lit(0.0), lambda n, q: n + q["quota"])
        u = lambda q: (F.pmod(F.xxhash64(F.lit(seed), F.lit(level), F.col("first"), q["key"]), F.lit(1 << 40)) + 0.5) / float(1 << 40)

        def deal(acc: Column, q: Column) -> Column:
            return _let(hypergeometric(acc["population"], q["quota"], acc["draws"], u(q)), lambda taken: F.struct(
                (acc["population"] - q["quota"]).alias("population"), (acc["draws"] - taken).alias("draws"), F.concat(acc["taken"], F.array(taken)).alias("taken")))

        start = F.struct(F.col("total").alias("population"), F.floor(F.col("total") * F.col("half") / F.col("width")).cast("double").alias("draws"), F.array().cast("array<double>").alias("taken"))
        split = node.withColumn("half", F.when(F.col("width") > 1, half).otherwise(F.col("width"))).withColumn("total", total)
        split = split.withColumn("left", F.when(F.col("width") > 1, F.aggregate("quotas", start, deal, lambda acc: acc["taken"])).otherwise(F.transform("quotas", lambda q: q["quota"])))
        side = F.explode(F.array(
            F.struct(F.col("first"), F.col("half").alias("width"), F.zip_with("quotas", "left", lambda q, n: F.struct(q["key"].alias("key"), n.alias("quota"))).alias("quotas")),
            F.struct((F.col("first") + F.col("half")).alias("first"), (F.col("width") - F.col("half")).alias("width"),
                     F.zip_with("quotas", "left", lambda q, n: F.struct(q["key"].alias("key"), (q["quota"] - n).alias("quota"))).alias("quotas"))))
        node = materialise(split.select(side.alias("n")).select("n.*").where("width > 0"))
    return node.select(F.col("first").alias("shard"), F.explode("quotas").alias("q")).select("q.key", "shard", F.col("q.quota").cast("long").alias("quota"))


def mix(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", shards: int = 16, blocks: int = 1024, most_copies: int = 3, seed: int = 7) -> DataFrame:
    """``docs`` with mix_size, mix_source_size, mix_target and mix_places: an array of (copy, shard, position), one for each time the document is taken.

    ``position`` orders a shard's rows. ``blocks``: blocks a source; ``shards``: output shards.
    """
    key = F.when(F.col(source_col).isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col(source_col).cast("string")))
    own = docs.select(F.struct(F.lit(1).alias("_"), *[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), key.alias("key"), F.col(source_col).cast("string").alias("source"), F.col(id_col).alias("id"),
                      word_count(F.col(text_col)).alias("size")).withColumn("block", F.pmod(F.xxhash64(F.lit(seed), F.col("id")), F.lit(blocks)).cast("int"))
    by_block = materialise(own.groupBy("key", "source", "block").agg(F.sum("size").alias("words")))
    goal = targets(by_block.groupBy("key", "source").agg(F.sum("words").alias("source_size")), most_copies)

    # units: a source's blocks in permuted order, copy after copy, while they fit; the first that did not is drawn in part
    unit = F.struct("copy", F.xxhash64(F.lit(seed), "key", "copy", "block").alias("turn"), "block", "words")
    asked = (by_block.where("words > 0").join(goal.drop("source"), "key").withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(most_copies - 1))))
             .where(F.col("copy") <= F.floor(F.col("target") / F.col("source_size"))).groupBy("key", "target").agg(F.array_sort(F.collect_list(unit)).alias("asked")))
    kind = "struct<copy:int,block:int,words:bigint,limit:double>"
    as_unit = lambda x, limit: F.struct(x["copy"].alias("copy"), x["block"].alias("block"), x["words"].alias("words"), limit.alias("limit")).cast(kind)

    def draw(acc: Column, x: Column) -> Column:
        fits = x["words"] <= acc["rest"]
        return F.struct(F.when(fits, acc["rest"] - x["words"]).otherwise(acc["rest"]).alias("rest"),
                        F.when(fits, F.concat(acc["drawn"], F.array(as_unit(x, x["words"].cast("double"))))).otherwise(acc["drawn"]).alias("drawn"),
                        F.when(fits | acc["skipped"].isNotNull(), acc["skipped"]).otherwise(as_unit(x, F.lit(0.0))).alias("skipped"))

    start = F.struct(F.col("target").alias("rest"), F.array().cast(f"array<{kind}>").alias("drawn"), F.lit(None).cast(kind).alias("skipped"))
    drawn = F.aggregate("asked", start, draw, lambda acc: F.when(acc["skipped"].isNull() | (acc["rest"] <= 0), acc["drawn"]).otherwise(
        F.concat(acc["drawn"], F.array(as_unit(acc["skipped"], acc["rest"])))))
    units = materialise(asked.select("key", F.posexplode(drawn).alias("unit", "u")).select("key", "unit", "u.*"))
    quotas = split_quotas(units.groupBy("key").agg(F.count(F.lit(1)).alias("quota")), shards, seed)
    upto = Window.partitionBy("key").orderBy("shard")
    leaf = quotas.where("quota > 0").withColumn("stop", F.sum("quota").over(upto)).select("key", "shard", F.explode(F.sequence(F.col("stop") - F.col("quota"), F.col("stop") - 1)).alias("unit"))
    placed = units.join(leaf, ["key", "unit"]).groupBy("key", "block").agg(F.array_sort(F.collect_list(F.struct("copy", "shard", "limit", "words"))).alias("units"))

    # documents of a block drawn in part are taken in permuted order while half of the document fits
    within = Window.partitionBy("key", "block").orderBy(F.xxhash64(F.lit(seed + 1), "id"), "id", "size")
    found = own.join(placed, ["key", "block"], "left").join(goal.drop("source"), "key").withColumn("upto", F.sum("size").over(within))
    fits = F.filter(F.coalesce("units", F.array().cast(placed.schema["units"].dataType)), lambda x: (x["limit"] >= x["words"]) | (F.col("upto") - F.col("size") / 2 <= x["limit"]))
    places = F.transform(fits, lambda x: F.struct(x["copy"].alias("copy"), x["shard"].alias("shard"), F.xxhash64(F.lit(seed + 2), F.col("id"), x["copy"]).alias("position")))
    added = {"size": F.col("size"), "source_size": F.col("source_size"), "target": F.col("target"), "places": places}
    return found.select(*[F.col(f"doc.`{c}`") for c in docs.columns if c not in {f"mix_{k}" for k in added}], *[v.alias(f"mix_{k}") for k, v in added.items()])
