"""Sharding by balanced label propagation: linked documents move towards their neighbours' shards under quotas.

Documents are linked by equal values (their texts, or what else the caller
names). Law ``rows``: the shards' numbers of documents are at most one apart.

1. Documents with the same links are interchangeable, so they form a class, and
   the propagated state is (class, shard, number of documents): a text with any
   number of copies takes at most ``shards`` rows, and no join meets a hot key.
   Documents that share no link are free; they even out the shards at the end.
2. Classes start where a hash puts their documents. In each round a join sums,
   for every link, its documents per shard, and a second one gives each class
   the neighbours it would have in each shard. A block (the documents of a class
   in a shard) asks for the shard with the most neighbours among those that
   still have room (a twentieth of their quota); ties are settled by a hash of
   class and shard, alike for all blocks of a class.
3. Quotas: requests are added up by (from, to, power of two of the neighbours).
   From these few numbers the driver admits, for each shard, what fits into
   its room and what leaves it, most neighbours first. A block moves by its
   admitted share, rounded by a hash. Rounds end when nothing moves.
4. Documents are numbered within their class by range partition and dealt to its
   blocks. A second numbering, by shard and then by size of block, sends what is
   over a shard's quota to the free documents, in hash order, and these
   fill all shards exactly. It also gives the slots.

Only DataFrame functions; the driver sees sums per shard and per pair of shards.

Defined results: a null text has no bytes, links with nothing and is free; empty
texts are equal texts; repeated rows are documents of their own (equal texts);
a very long text counts as one document; a null id is kept; an empty table
gives an empty result; other columns are ignored. Reruns over the same files
agree.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandflow.operators.stats import ordered_row_number

from .joins import dealt_join
from .store import materialise

CLASS = ["class1", "class2"]


def _hashes(value: Column, names: Sequence[str]) -> list[Column]:
    """128 bits of a value."""
    return [F.xxhash64(F.lit(n), value).alias(name) for n, name in enumerate(names, 1)]


def admitted(asked: dict[tuple[int, int, int], int], room: Sequence[int]) -> dict[tuple[int, int, int], float]:
    """The share of each request (from, to, level) that is let in: no shard takes more than its room and what leaves it (to some millionths); high levels go first.

    Starts from all requests and withdraws until they fit; what remains after 50 turns must fit into the room alone.
    """
    taken = dict(asked)
    for turn in range(51):
        leaving = defaultdict(int)
        if turn < 50:
            for (source, _, _), n in taken.items():
                leaving[source] += n
        fitting = {}
        for target in range(len(room)):
            left = max(room[target] + leaving[target], 0)
            for level in sorted({lv for _, to, lv in taken if to == target}, reverse=True):
                own = {k: n for k, n in taken.items() if k[1] == target and k[2] == level}
                total = sum(own.values())
                for k, n in own.items():
                    fitting[k] = n if total <= left else n * (left / total)
                left -= min(total, left)
        still = all(taken[k] - n <= 1e-6 * n for k, n in fitting.items())
        taken = fitting
        if still:
            break
    return {k: taken[k] / n for k, n in asked.items() if n}


def propagate(members: DataFrame, state: DataFrame, quotas: Sequence[int], rounds: int, seed: int) -> DataFrame:
    """The state (class1, class2, shard, n) after label propagation over ``members`` (class1, class2, link1, link2)."""
    link, shards = ["link1", "link2"], len(quotas)
    for turn in range(rounds):
        used = {r["shard"]: r["n"] for r in state.groupBy("shard").agg(F.sum("n").alias("n")).collect()}  # a row a shard
        room = [q - used.get(s, 0) for s, q in enumerate(quotas)]
        near = state.join(members, CLASS).groupBy(*link, "shard").agg(F.sum("n").alias("n"))
        pull = near.join(members, link).groupBy(*CLASS, "shard").agg(F.sum("n").alias("links"))
        rank = F.struct("links", F.xxhash64(F.lit(seed), *CLASS, "shard").alias("tie"), "shard")
        open_ = F.col("shard").isin([s for s in range(shards) if room[s] * 20 > quotas[s]])
        ranked = pull.select(*CLASS, "shard", rank.alias("rank"))
        goal = ranked.where(open_).groupBy(*CLASS).agg(F.max("rank").alias("goal"))
        level = F.floor(F.log2(F.col("goal.links"))).cast("int")
        blocks = materialise(state.join(ranked, [*CLASS, "shard"]).join(goal, CLASS, "left").select(
            *CLASS, "shard", "n", F.when(F.col("goal") > F.col("rank"), F.col("goal.shard")).alias("to"), level.alias("level")))
        asked = {(r["shard"], r["to"], r["level"]): r["n"] for r in blocks.where("to IS NOT NULL").groupBy("shard", "to", "level").agg(F.sum("n").alias("n")).collect()}
        shares = [(*k, share) for k, share in admitted(asked, room).items() if share > 0]
        if not shares:
            break
        let_in = F.broadcast(state.sparkSession.createDataFrame(shares, "shard int, to int, level int, share double"))  # pairs of shards by powers of two
        u = (F.pmod(F.xxhash64(F.lit(seed + 1), F.lit(turn), *CLASS, "shard"), F.lit(1 << 40)) + 0.5) / float(1 << 40)
        part = F.least(F.floor(F.col("n") * F.col("share") + u), F.col("n"))
        moving = F.when(F.col("share") < 1, part).when(F.col("share").isNotNull(), F.col("n")).otherwise(0).cast("long")
        moved = blocks.join(let_in, ["shard", "to", "level"], "left").withColumn("moving", moving)
        sides = F.explode(F.array(F.struct("shard", (F.col("n") - F.col("moving")).alias("n")), F.struct(F.col("to").alias("shard"), F.col("moving").alias("n"))))
        state = materialise(moved.select(*CLASS, sides.alias("s")).select(*CLASS, "s.*").where("n > 0").groupBy(*CLASS, "shard").agg(F.sum("n").alias("n")))
    return state


def _labelled(linked: DataFrame, state: DataFrame, total: int) -> DataFrame:
    """(row, class1, class2, shard, n: size of its block) for each linked row: a class's rows, by number, fill its blocks."""
    upto = Window.partitionBy(*CLASS).orderBy("shard")  # at most a row a shard
    blocks = (state.withColumn("upto", F.sum("n").over(upto)).groupBy(*CLASS).agg(F.array_sort(F.collect_list(F.struct("upto", "shard", "n"))).alias("blocks"), F.sum("n").alias("size")))
    numbered = ordered_row_number(linked, [*CLASS, "row"], "at", store=materialise)
    starts = numbered.groupBy(*CLASS).agg(F.min("at").alias("start"))
    block = F.filter("blocks", lambda b: F.col("at") - F.col("start") < b["upto"])[0]
    found = dealt_join(numbered, materialise(blocks.join(starts, CLASS)), CLASS, times="size", total=total, spread="row")
    return found.select("row", *CLASS, block.alias("b")).select("row", *CLASS, "b.shard", "b.n")


def shard_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", links: Sequence[Column] | None = None, shards: int = 16, rounds: int = 12, seed: int = 11) -> DataFrame:
    """A row for each document: (id_col, size: bytes and 1, text_crc32, shard, slot).

    ``links``: columns whose equal values link documents (null: no link); default: the text.
    """
    text = F.col(text_col).cast("string")
    links = [text] if links is None else list(links)
    keys = F.filter(F.array(*[F.when(c.isNotNull(), F.struct(*_hashes(F.struct(F.lit(i), c), ["link1", "link2"]))) for i, c in enumerate(links)]), lambda k: k.isNotNull())
    own = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), (F.octet_length(F.coalesce(text, F.lit(""))) + 1).cast("long").alias("size"),
                      F.crc32(F.coalesce(text, F.lit(""))).alias("crc"), keys.alias("keys"))
    rows = materialise(own.select("*", *_hashes(F.col("keys"), CLASS)))

    # classes that share a link with another document
    classes = materialise(rows.where(F.size("keys") > 0).groupBy(*CLASS).agg(F.count(F.lit(1)).alias("n"), F.first("keys").alias("keys")))
    spelt = classes.select(*CLASS, "n", F.explode("keys").alias("k")).select(*CLASS, "n", "k.*")
    shared = spelt.groupBy("link1", "link2").agg(F.sum("n").alias("n")).where("n > 1").select("link1", "link2")
    members = materialise(spelt.select(*CLASS, "link1", "link2").join(shared, ["link1", "link2"]))
    n_rows = rows.count()
    busy = members.select(*CLASS).distinct().join(classes.select(*CLASS, "n"), CLASS)
    linked = materialise(dealt_join(rows.select("row", *CLASS), busy, CLASS, times="n", total=n_rows, spread="row"))
    quotas = [n_rows * (s + 1) // shards - n_rows * s // shards for s in range(shards)]
    start = linked.groupBy(*CLASS, F.pmod(F.xxhash64(F.lit(seed), "row"), F.lit(shards)).cast("int").alias("shard")).agg(F.count(F.lit(1)).alias("n"))
    state = propagate(members, materialise(start), quotas, rounds, seed)
    labelled = _labelled(linked, state, n_rows)

    # by shard, large blocks first; free documents last, in hash order
    placed = rows.select("row", "id", "size", "crc").join(labelled, "row", "left")
    mixed = F.when(F.col("shard").isNull(), F.xxhash64(F.lit(seed + 2), "row")).otherwise(F.col("class1"))
    order = [F.coalesce("shard", F.lit(shards)), F.coalesce("n", F.lit(0)).desc(), mixed, F.coalesce("class2", F.lit(0)), F.col("row")]
    numbered = ordered_row_number(materialise(placed), order, "at", store=materialise)
    counts = {r["label"]: r["n"] for r in numbered.groupBy(F.coalesce("shard", F.lit(shards)).alias("label")).agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a shard
    begins = [sum(counts.get(s, 0) for s in range(label)) for label in range(shards + 1)]
    kept = [min(counts.get(s, 0), quotas[s]) for s in range(shards)]
    sent = [counts.get(s, 0) - kept[s] for s in range(shards)] + [0]
    ends, filled = [], 0
    for s in range(shards):
        filled += quotas[s] - kept[s]
        ends.append(filled)
    pick = lambda values, at: F.element_at(F.array(*[F.lit(int(v)).cast("long") for v in values]), at + 1)
    label = F.coalesce("shard", F.lit(shards))
    place = F.col("at") - pick(begins, label)
    stays = place < pick([*kept, -1], label)
    turn = place - pick([*kept, 0], label) + pick([sum(sent[:s]) for s in range(shards + 1)], label)
    filling = sum((F.when(turn >= e, 1).otherwise(0) for e in ends), F.lit(0))
    slot = F.when(stays, place).otherwise(pick(kept, filling) + turn - pick([0, *ends[:-1]], filling))
    return numbered.select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.when(stays, label).otherwise(filling).cast("int").alias("shard"), slot.alias("slot"))
