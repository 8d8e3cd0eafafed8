"""Benchmark decontamination by a prefix-filtered set join.

Every benchmark item gives windows of ``window`` consecutive words (an item
with fewer words is one window). A window is a set of word shingles; a text
holds the window only if it holds all of them, so any single one is a
sufficient prefix. Shingles are counted over all documents and each window
joins on its rarest. A match of the prefix shingle fixes where the window
would begin: length and positional bounds discard places outside the document,
then all words of the window are compared.

The benchmark is cut into blocks of at most ``block`` windows. One block is
sent to the tasks at a time, so what is broadcast has a fixed bound whatever
the benchmark's size; documents are never shuffled.

Defined results: a null or empty text has no words and no hits; an item
without words has no window; the same window in several items counts for each
of them; repeated item or document rows change nothing but the number of
rows; null ids stay null; a very long text is searched as a whole; of equally rare
shingles of a window the first is its prefix; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops as T
from .store import materialise, ship_code

SLICE_BYTES = 4 << 20
_FLAG_BITS = 20


class Block:
    """The windows of one block: their words, their items and their shingles."""

    def __init__(self, rows: list, shingle: int) -> None:
        by_window: dict[bytes, list[str]] = {}
        for words, item in rows:
            by_window.setdefault(bytes(words), []).append(item)
        texts = sorted(by_window)
        self.sizes = np.array([len(w) // 8 for w in texts], dtype=np.int64)
        self.items = [sorted(by_window[w]) for w in texts]
        self.words = np.zeros((len(texts), int(self.sizes.max(initial=0))), dtype=np.uint64)
        for i, w in enumerate(texts):
            self.words[i, :len(w) // 8] = np.frombuffer(w, dtype=np.uint64)
        self.shingle = np.minimum(self.sizes, shingle)
        #: (shingle size, hash) of each shingle, its window and its place in it
        parts = []
        for size in np.unique(self.shingle):
            for i in np.flatnonzero(self.shingle == size):
                h = T.windows(self.words[i, :self.sizes[i]], int(size))
                parts.append((np.full(len(h), size), h, np.full(len(h), i), np.arange(len(h))))
        self.size, self.hash, self.window, self.place = (np.concatenate(x) if parts else np.zeros(0, np.int64) for x in (zip(*parts) if parts else ((),) * 4))

    def keys(self) -> dict[int, np.ndarray]:
        return {int(s): np.unique(self.hash[self.size == s]) for s in np.unique(self.size)}

    def keep_rarest(self, count: dict[tuple[int, int], int]) -> None:
        """Only each window's rarest shingle stays (ties: the first)."""
        seen = np.array([count.get((int(s), int(np.uint64(h).astype(np.int64))), 0) for s, h in zip(self.size, self.hash)], dtype=np.int64)
        order = np.lexsort((self.place, seen, self.window))
        first = np.ones(len(order), dtype=bool)
        first[1:] = self.window[order][1:] != self.window[order][:-1]
        pick = order[first]
        self.size, self.hash, self.window, self.place = self.size[pick], self.hash[pick], self.window[pick], self.place[pick]


class _Lookup:
    """Places of sorted keys in an array, after a bit table that most values fail."""

    def __init__(self, keys: np.ndarray) -> None:
        self.keys = keys
        self.flags = np.zeros(1 << _FLAG_BITS, dtype=bool)
        self.flags[(keys & np.uint64((1 << _FLAG_BITS) - 1)).astype(np.int64)] = True

    def find(self, values: np.ndarray, ok: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in values, index of the key) of each value that is a key."""
        at = np.flatnonzero(self.flags[(values & np.uint64((1 << _FLAG_BITS) - 1)).astype(np.int64)] & ok)
        key = np.minimum(np.searchsorted(self.keys, values[at]), len(self.keys) - 1)
        same = self.keys[key] == values[at]
        return at[same], key[same]


def _spans(texts: Iterator[int], size: np.ndarray) -> np.ndarray:
    """0..size-1 for each size, concatenated."""
    return np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)


def _count_shingles(lookups: dict[int, _Lookup]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in T.row_slices(batches, "text", SLICE_BYTES):
            h, _, _, first = T.words(T.column(part, "text"), T.ALNUM, True)
            for size, lookup in lookups.items():
                _, key = lookup.find(T.windows(h, size), T.starts_inside(first, size))
                key, n = np.unique(key, return_counts=True)
                if len(key):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), size, np.int32)), pa.array(lookup.keys[key].view(np.int64)), pa.array(n.astype(np.int64))], ["size", "hash", "n"])
    return run


def _match(block: Block) -> Callable:
    lookups, entries = {}, {}
    for size in np.unique(block.size):
        own = np.flatnonzero(block.size == size)
        own = own[np.argsort(block.hash[own], kind="stable")]
        keys, start = np.unique(block.hash[own], return_index=True)
        lookups[int(size)] = _Lookup(keys)
        entries[int(size)] = (own, np.append(start, len(own)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = 0
        for part in T.row_slices(batches, "text", SLICE_BYTES):
            row_number = (T.column(part, "part")[0].as_py() << 33) + done
            h, _, _, first = T.words(T.column(part, "text"), T.ALNUM, True)
            cover, found = np.zeros(len(h) + 1, dtype=np.int64), []
            for size, lookup in lookups.items():
                at, key = lookup.find(T.windows(h, size), T.starts_inside(first, size))
                own, start = entries[size]
                n = start[key + 1] - start[key]
                entry = own[np.repeat(start[key], n) + _spans(at, n)]
                begin, window = np.repeat(at, n) - block.place[entry], block.window[entry]
                row = np.searchsorted(first, np.repeat(at, n), "right") - 1
                fits = (begin >= first[row]) & (begin + block.sizes[window] <= first[row + 1])
                begin, window, row = begin[fits], window[fits], row[fits]
                same = np.ones(len(begin), dtype=bool)
                for j in range(block.words.shape[1]):
                    inside = same & (j < block.sizes[window])
                    same[inside] = h[begin[inside] + j] == block.words[window[inside], j]
                begin, window, row = begin[same], window[same], row[same]
                np.add.at(cover, begin, 1)
                np.add.at(cover, begin + block.sizes[window], -1)
                found.append(np.stack([row, window], 1))
            hit = np.cumsum(cover[:-1]) > 0
            edge = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
            pairs = np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.int64)
            items = [set() for _ in range(part.num_rows)]
            for row, window in pairs.tolist():
                items[row].update(block.items[window])
            spans = [[] for _ in range(part.num_rows)]
            # a run of hit words never passes a row's end unseen: it is cut there
            for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()):
                row = int(np.searchsorted(first, a, "right")) - 1
                while a < b:
                    stop = min(b, int(first[row + 1]))
                    if a < stop:
                        spans[row].append({"start": a - int(first[row]), "stop": stop - int(first[row])})
                    a, row = stop, row + 1
            yield pa.RecordBatch.from_arrays([
                T.column(part, "id"), pa.array(np.arange(row_number, row_number + part.num_rows)), pa.array(np.diff(first)),
                pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
                pa.array([sorted(x) for x in items], pa.list_(pa.string()))], ["id", "row_number", "n_words", "spans", "items"])
            done += part.num_rows
    return run


def _windows(size: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in T.row_slices(batches, "text", SLICE_BYTES):
            h, _, _, first = T.words(T.column(part, "text"), T.ALNUM, True)
            words, items = [], []
            for item, a, b in zip(T.column(part, "item").to_pylist(), first[:-1].tolist(), first[1:].tolist()):
                for at in range(a, max(b - size, a) + 1 if b > a else a):
                    words.append(h[at:min(at + size, b)].tobytes())
                    items.append(item)
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(items, pa.string())], ["words", "item"])
    return run


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                  window: int = 10, shingle: int = 4, block: int = 250_000) -> DataFrame:
    """A row for each document: (id_col, n_words, spans of hit words [start, stop), items found, sorted as strings).

    ``block``: most benchmark windows that are sent to the tasks at once.
    """
    ship_code(docs.sparkSession)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.spark_partition_id().alias("part"))
    id_type = texts.schema["id"].dataType.simpleString()
    out = f"id {id_type}, row_number long, n_words long, spans array<struct<start:long,stop:long>>, items array<string>"
    pieces = materialise(benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), F.col(item_text_col).cast("string").alias("text"))
                         .mapInArrow(_windows(window), "words binary, item string").distinct())
    n_blocks = max(1, -(-pieces.count() // block))
    found = []
    for k in range(n_blocks):
        part = Block([tuple(r) for r in pieces.where(F.pmod(F.xxhash64("words"), F.lit(n_blocks)) == k).toLocalIterator()], shingle)
        lookups = {size: _Lookup(keys) for size, keys in part.keys().items()}
        counted = texts.select("text").mapInArrow(_count_shingles(lookups), "size int, hash long, n long").groupBy("size", "hash").agg(F.sum("n").alias("n"))
        part.keep_rarest({(r.size, r.hash): r.n for r in counted.toLocalIterator()})
        found.append(texts.mapInArrow(_match(part), out))
    if n_blocks == 1:
        whole = found[0]
    else:  # the blocks' findings of each row meet; hit words are the union of their spans
        merged = F.aggregate(
            F.array_sort(F.flatten(F.collect_list("spans"))), F.array().cast("array<struct<start:long,stop:long>>"),
            lambda acc, s: F.when((F.size(acc) > 0) & (F.element_at(acc, -1)["stop"] >= s["start"]),
                                  F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))),
                                           F.array(F.struct(F.element_at(acc, -1)["start"].alias("start"), F.greatest(F.element_at(acc, -1)["stop"], s["stop"]).alias("stop")))))
            .otherwise(F.concat(acc, F.array(s))))
        whole = reduce(DataFrame.unionAll, found).groupBy("row_number").agg(
            F.first("id").alias("id"), F.first("n_words").alias("n_words"), merged.alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    return whole.select(F.col("id").alias(id_col), "n_words", "spans", "items")
