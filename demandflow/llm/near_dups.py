"""Near-duplicate groups from bottom-k sketches of one hash function.

A document's set is its distinct word shingles, each a 64-bit hash. Two sets
are linked if their Jaccard similarity reaches ``threshold``; groups are the
connected components of the links.

1. Sets that are equal become one class, so copies cost one row. A class keeps
   its ``k`` smallest shingle hashes (all of them, if it has fewer).
2. The inverted lists of retained values generate overlaps. The bottom-k sketch
   of a union is a uniform sample of it. Sets at similarity 0.75 share 55 of
   their 64 values on average (deviation below 4), so a pair must share at
   least ``least`` = 32: missed with a probability below 1e-9. Each class is
   therefore listed under all but its ``least - 1`` most frequent retained
   values (prefix filter; sets of n shingles need ``threshold * n`` if that is
   less): values that a third of all documents have make no pairs.
3. In each of ``rounds`` rounds a list pairs one of its classes with the others;
   verified links contract the lists; lists whose classes are all in one
   component are done. Classes of lists that are still open may share much
   without being linked (a common passage): they are paired over their full
   sets, on the rarest quarter of their shingles and where enough others are
   left to share, so no link between components is lost. Different texts of
   one template that are just short of the threshold stay candidates of each
   other there, as nothing less than their full sets tells them apart.
4. Pairs pass the size bound and the union-sketch estimate (at least
   ``likely`` = 0.4, six deviations below 0.75), then the exact Jaccard
   similarity of the full sets.

Defined results: a null or empty text has no shingles and is linked with
nothing (its group is itself); fewer words than a shingle make one shingle;
repeated rows are equal sets; rows with a null id keep n_shingles and get the
group of their set; a very long text has all its shingles; of equal sets the
smallest id stands for all; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops as T
from .store import materialise, ship_code

SLICE_BYTES = 4 << 20
_OTHER = np.uint64(0x5851F42D4C957F2D)


def _shingle_sets(part: pa.Table, shingle: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each row."""
    h, _, _, first = T.words(T.column(part, "text"), T.SPACED, True)
    w = T.mix(T.windows(h, shingle))
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= shingle:
            yield np.unique(w[a:b - shingle + 1])
        elif b > a:
            yield T.mix(T.windows(h[a:b], b - a) + np.uint64(b - a))
        else:
            yield w[:0]


def _sketches(shingle: int, k: int) -> Callable:
    """Of each row: id, size of its set, two hashes of the set and, if ``k``, the sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in T.row_slices(batches, "text", SLICE_BYTES):
            n, one, two, values, ends = [], [], [], [], [0]
            for s in _shingle_sets(part, shingle):
                n.append(len(s))
                one.append(np.bitwise_xor.reduce(T.mix(s ^ _OTHER)) if len(s) else np.uint64(0))
                two.append(s.sum(dtype=np.uint64))
                values.append(s[:k].view(np.int64))
                ends.append(ends[-1] + len(values[-1]))
            signed = [np.array(x, np.uint64).view(np.int64) for x in (one, two)]
            batch = [T.column(part, "id"), pa.array(np.array(n, np.int64)), pa.array(signed[0]), pa.array(signed[1])]
            if k:
                batch.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(values))))
            yield pa.RecordBatch.from_arrays(batch, ["id", "n", "set1", "set2", "sketch"][:len(batch)])
    return run


def _full_sets(shingle: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in T.row_slices(batches, "text", SLICE_BYTES):
            sets = list(_shingle_sets(part, shingle))
            ends = np.append(0, np.cumsum([len(s) for s in sets])).astype(np.int32)
            values = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([T.column(part, "class"), pa.ListArray.from_arrays(pa.array(ends), pa.array(values))], ["class", "shingles"])
    return run


def components(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(class, component): the smallest class reachable over ``edges`` (a, b), for each row of ``nodes`` (class, component).

    Contraction: every component hooks on to its smallest neighbour, pointers
    are shortened until they point to roots, and links inside one component
    fall away. Rounds grow with the logarithm of the size.
    """
    labels = nodes
    while True:
        left = labels.select(F.col("class").alias("a"), F.col("component").alias("x"))
        right = labels.select(F.col("class").alias("b"), F.col("component").alias("y"))
        links = edges.join(left, "a").join(right, "b").where("x <> y").select("x", "y")
        parent = materialise(links.unionAll(links.select(F.col("y").alias("x"), F.col("x").alias("y"))).groupBy("x").agg(F.min("y").alias("y"))
                             .select("x", F.least("x", "y").alias("parent")))
        if parent.isEmpty():
            return labels
        while True:
            up = parent.select(F.col("x").alias("parent"), F.col("parent").alias("upper"))
            parent = materialise(parent.join(up, "parent", "left").select("x", F.coalesce("upper", "parent").alias("parent"), (F.coalesce("upper", "parent") != F.col("parent")).alias("moved")))
            if parent.where("moved").isEmpty():
                break
            parent = parent.select("x", "parent")
        root = parent.select(F.col("x").alias("component"), F.col("parent").alias("root"))
        labels = materialise(labels.join(root, "component", "left").select("class", F.coalesce("root", "component").alias("component")))


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, threshold: float = 0.75, k: int = 64, least: int = 32,
                    likely: float = 0.4, rounds: int = 2, hub_rows: int = 512) -> DataFrame:
    """A row for each document: (id_col, n_shingles, component_id: the smallest id of its group, kept: that id is its own).

    ``hub_rows``: pairs with the same class are verified in groups of about this many.
    """
    ship_code(docs.sparkSession)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = texts.schema["id"].dataType.simpleString()
    head = f"id {id_type}, n long, set1 long, set2 long"
    rows = texts.mapInArrow(_sketches(shingle, 0), head)
    classes = materialise(texts.mapInArrow(_sketches(shingle, k), f"{head}, sketch array<bigint>").where("n > 0 AND id IS NOT NULL").groupBy("set1", "set2").agg(
        F.min("id").alias("class"), F.first("n").alias("n"), F.first("sketch").alias("sketch")))
    sketches = classes.select("class", "n", "sketch")

    # inverted lists, shortened by the prefix filter
    listed = sketches.select("class", "n", F.explode("sketch").alias("value"))
    shared = listed.groupBy("value").agg(F.count(F.lit(1)).alias("freq")).where("freq > 1")
    need = F.least(F.ceil(F.col("n") * threshold), F.lit(least))
    by_class = (listed.join(shared, "value").groupBy("class").agg(F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("freq", "value"))).alias("values"))
                .select("class", "n", F.explode(F.slice("values", F.lit(1), F.greatest(F.size("values") - need.cast("int") + 1, F.lit(0)))).alias("v")))
    lists = materialise(by_class.select("class", "n", F.col("v.value").alias("value")))
    busy = lists.select("class").distinct()
    sets = materialise(texts.join(busy.withColumnRenamed("class", "id"), "id").select(F.col("id").alias("class"), "text")
                       .mapInArrow(_full_sets(shingle), f"class {id_type}, shingles array<bigint>").dropDuplicates(["class"]))
    labels = materialise(busy.select("class", F.col("class").alias("component")))
    tried = None
    for turn in range(rounds + 1):
        current = lists.join(labels, "class")
        open_lists = current.groupBy("value").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi")
        here = current.join(open_lists.select("value", "lo"), "value")
        if turn == rounds:
            found = _rare_pairs(here.select("class", "component").distinct().join(sets, "class"), threshold)
        else:  # one hub a list: the smallest class of its smallest component, then of the others
            hubs = here.where(F.col("component") == F.col("lo") if turn % 2 == 0 else F.col("component") != F.col("lo")).groupBy("value").agg(
                F.min(F.struct(F.col("class").alias("a"), F.col("n").alias("n_a"), F.col("component").alias("of"))).alias("hub")).select("value", "hub.*")
            found = here.join(hubs, "value").where("component <> of")
        sized = found.where((F.least("n", "n_a") >= threshold * F.greatest("n", "n_a")))
        pairs = sized.select(F.least("class", "a").alias("a"), F.greatest("class", "a").alias("b")).distinct()
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = materialise(pairs)
        links = materialise(_verified(pairs, sketches, sets, k, likely, threshold, hub_rows))
        tried = pairs if tried is None else tried.unionAll(pairs)
        labels = components(links, labels)
    groups = classes.select("set1", "set2", "class").join(labels, "class", "left").select("set1", "set2", F.coalesce("component", "class").alias("component"))
    own = rows.join(groups, ["set1", "set2"], "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id")).alias("component_id"))
    return own.withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))


def _rare_pairs(open_sets: DataFrame, threshold: float) -> DataFrame:
    """Pairs between components that share one of their rarest shingles: linked sets of n share more than a set's
    ``threshold * n`` most frequent shingles, hence one of the others (prefix filter on the full sets)."""
    spelt = open_sets.select("class", "component", F.size("shingles").cast("long").alias("n"), F.explode("shingles").alias("shingle"))
    shared = spelt.groupBy("shingle").agg(F.count(F.lit(1)).alias("freq")).where("freq > 1")
    alone = F.col("n") - F.size("own")  # shingles no other open set has come first
    prefix = F.floor(F.col("n") - F.ceil(F.col("n") * threshold) + 1 - alone).cast("int")
    listed = (spelt.join(shared, "shingle").groupBy("class").agg(F.first("component").alias("component"), F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("freq", "shingle"))).alias("own"))
              .select("class", "component", "n", alone.alias("alone"), F.posexplode(F.slice("own", F.lit(1), F.greatest(prefix, F.lit(0)))).alias("at", "s"))
              .select("class", "component", "n", (F.col("n") - F.col("alone") - F.col("at")).alias("rest"), F.col("s.shingle").alias("shingle")))
    listed = materialise(listed)
    other = listed.select("shingle", F.col("class").alias("a"), F.col("n").alias("n_a"), F.col("component").alias("of"), F.col("rest").alias("rest_a"))
    # the first shingle that two sets share leaves both sets only so many others to share
    enough = F.least("rest", "rest_a") >= threshold / (1 + threshold) * (F.col("n") + F.col("n_a")) - 1e-6
    return listed.join(other, "shingle").where((F.col("component") != F.col("of")) & (F.col("class") > F.col("a")) & enough)


def _verified(pairs: DataFrame, sketches: DataFrame, sets: DataFrame, k: int, likely: float, threshold: float, hub_rows: int) -> DataFrame:
    """The pairs (a, b) that are linked. Classes in very many pairs are dealt out in groups of ``hub_rows``."""
    spread = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / hub_rows).alias("parts"))
    dealt = pairs.join(spread, "a").withColumn("part", F.pmod(F.xxhash64("b"), F.col("parts")))

    def copies(of: DataFrame, what: str) -> DataFrame:
        return of.join(spread, of["class"] == spread["a"]).select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), F.col(what).alias(f"{what}_a"))

    # shared values among the k smallest of the union: a sample of the union, as large as both sketches allow
    union = F.slice(F.array_sort(F.array_union("sketch_a", "sketch_b")), 1, k)
    shared = F.size(F.array_intersect(F.array_intersect("sketch_a", "sketch_b"), union))
    passed = (dealt.join(copies(sketches, "sketch"), ["a", "part"]).join(sketches.select(F.col("class").alias("b"), F.col("sketch").alias("sketch_b")), "b")
              .where(shared >= likely * F.size(union)).select("a", "b", "part"))
    both = F.size(F.array_intersect("shingles_a", "shingles_b")).cast("long")
    linked = 100 * both >= 100 * threshold * (F.size("shingles_a") + F.size("shingles_b") - both)
    return (passed.join(copies(sets, "shingles"), ["a", "part"]).join(sets.select(F.col("class").alias("b"), F.col("shingles").alias("shingles_b")), "b")
            .where(linked).select("a", "b"))
