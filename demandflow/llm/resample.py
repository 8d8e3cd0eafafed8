"""Resampling documents towards a target distribution, with segment deduplication.

A text's features are its runs of 1 to ``max_n`` consecutive words, hashed into
buckets. Every bucket has a gain, the scaled logarithm of its smoothed share
in the target over its smoothed share in the corpus. A document's weight is
the sum of its features' gains; weights plus Gumbel noise from a hash of the id
order the documents, and the first ``percent`` of those with enough words are
drawn: a sample without replacement in proportion to the importance weights.

Segment deduplication: newlines cut texts into lines, and newlines separate
words, so a run of words lies in one line or crosses lines.

1. The corpus's distinct lines come from one aggregation with their numbers of
   occurrences. Each distinct line's features are computed once; bucket
   counts are multiplied by the occurrences. Runs that cross lines are counted
   from the documents and added (there are none for ``max_n`` = 1).
2. With the gains known, each distinct line's gain is summed once.
3. A narrow table holds for each document the 128-bit keys of its lines; it is
   joined with the lines' gains and summed. A line with more than a partition's
   share of all occurrences is dealt over as many parts as it has shares; there
   are at most as many such lines as partitions.

Defined results: a null or empty text has no features, weight 0; repeated rows
and ids are separate documents (equal ids draw equal noise); ties in score go
to the smaller id, null ids last (the noise of a null id is that of the empty
text); a very long text is cut into lines like any other, one long line is one
segment; an empty corpus gives an empty result, an empty target a gain by the
smoothing alone; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandflow.operators.stats import ordered_row_number

from . import textops as T
from .store import materialise, ship_code

SLICE_BYTES = 4 << 20
#: words longer than this are hashed one by one
LONG_WORD = 64


def _crc_table() -> np.ndarray:
    """crc32's table: eight steps of its polynomial for each byte."""
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & np.uint32(1), (c >> np.uint32(1)) ^ np.uint32(0xEDB88320), c >> np.uint32(1))
    return c


_CRC = _crc_table()


def _extend(state: np.ndarray, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """crc32 of what each ``state`` has seen followed by its word ``raw[start:end]`` (byte position by byte position)."""
    state = state ^ np.uint32(0xFFFFFFFF)
    size = ends - starts
    by_size = np.argsort(size, kind="stable")
    sizes = size[by_size]
    short = np.searchsorted(sizes, LONG_WORD, "right")
    for at in range(int(sizes[short - 1]) if short else 0):
        left = by_size[np.searchsorted(sizes, at, "right"):short]
        state[left] = _CRC[(state[left] ^ raw[starts[left] + at]) & np.uint32(255)] ^ (state[left] >> np.uint32(8))
    state ^= np.uint32(0xFFFFFFFF)
    for i in by_size[short:].tolist():
        state[i] = zlib.crc32(raw[starts[i]:ends[i]].tobytes(), int(state[i]))
    return state


def _runs(texts: pa.Array, max_n: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For n = 1 to ``max_n``: (bucket of the run from each word, whether it stays in its row, starts, ends, rows' first words)."""
    _, starts, ends, first = T.words(texts, T.ALNUM, True)
    raw = T.text_buffer(texts)[0]
    raw = np.where((raw >= 65) & (raw <= 90), raw + 32, raw).astype(np.uint8)
    space = np.uint32(32)
    state = _extend(np.zeros(len(starts), np.uint32), raw, starts, ends)
    for n in range(1, max_n + 1):
        if n > 1:
            gone = state[:len(state) - 1] ^ np.uint32(0xFFFFFFFF)
            gone = (_CRC[(gone ^ space) & np.uint32(255)] ^ (gone >> np.uint32(8))) ^ np.uint32(0xFFFFFFFF)
            state = _extend(gone, raw, starts[n - 1:], ends[n - 1:])
        yield (state % np.uint32(buckets)).astype(np.int32), T.starts_inside(first, n), starts, ends, first
        if len(state) <= 1:
            return


def _by_row(values: list[np.ndarray], rows: list[np.ndarray], n_rows: int) -> pa.ListArray:
    """A list for each row: its values."""
    row = np.concatenate(rows)
    order = np.argsort(row, kind="stable")
    ends = np.searchsorted(row[order], np.arange(n_rows + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(values)[order]))


def _line_features(max_n: int, buckets: int) -> Callable:
    """Of each distinct line: its keys, occurrences, number of words and the buckets of its features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in T.row_slices(batches, "line", SLICE_BYTES):
            found, rows = [], []
            for bucket, inside, _, _, first in _runs(T.column(part, "line"), max_n, buckets):
                at = np.flatnonzero(inside)
                found.append(bucket[at])
                rows.append(np.searchsorted(first, at, "right") - 1)
            values = _by_row(found, rows, part.num_rows)
            yield pa.RecordBatch.from_arrays([*[T.column(part, c) for c in ("key1", "key2", "times")], pa.array(np.diff(first)), values], ["key1", "key2", "times", "words", "buckets"])
    return run


def _crossing(max_n: int, buckets: int) -> Callable:
    """Of each document: the buckets of its runs that cross a line end, beside its line keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in T.row_slices(batches, "text", SLICE_BYTES):
            texts = T.column(part, "text")
            newlines = np.append(0, np.cumsum(T.text_buffer(texts)[0] == 10))
            found, rows = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
            for n, (bucket, inside, starts, ends, first) in enumerate(_runs(texts, max_n, buckets), 1):
                at = np.flatnonzero(inside)
                at = at[newlines[starts[at]] != newlines[ends[at + n - 1] - 1]]
                found.append(bucket[at])
                rows.append(np.searchsorted(first, at, "right") - 1)
            values = _by_row(found, rows, part.num_rows)
            yield pa.RecordBatch.from_arrays([*[T.column(part, c) for c in ("row", "id", "lines")], values], ["row", "id", "lines", "crossing"])
    return run


def _summed(keep: list[str], column: str, gains: np.ndarray) -> Callable:
    """``keep``, the sum of gains over the buckets of ``column`` and their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(column)
            ends = lists.offsets.to_numpy()
            total = np.append(0, np.cumsum(gains[lists.values.to_numpy()[ends[0]:ends[-1]]])) if len(lists) else np.zeros(1, np.int64)
            ends = ends - ends[0]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(total[ends[1:]] - total[ends[:-1]]), pa.array(np.diff(ends).astype(np.int64))], [*keep, "gain", "n"])
    return run


def _keys(line: Column) -> Column:
    """A line's 128-bit key."""
    return F.struct(F.xxhash64(F.lit(1), line).alias("key1"), F.xxhash64(F.lit(2), line).alias("key2"))


def _lines(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda x: x != "")


def distinct_lines(texts: DataFrame, max_n: int, buckets: int) -> DataFrame:
    """(key1, key2, times, words, buckets) for each distinct line of ``texts`` (text)."""
    lines = texts.select(F.explode(_lines(F.col("text"))).alias("line")).groupBy("line").agg(F.count(F.lit(1)).alias("times"))
    return lines.select(_keys(F.col("line")).alias("k"), "times", "line").select("k.*", "times", "line").mapInArrow(
        _line_features(max_n, buckets), "key1 long, key2 long, times long, words long, buckets array<int>")


def document_lines(docs: DataFrame, max_n: int, buckets: int) -> DataFrame:
    """(row, id, lines, crossing) for each document of ``docs`` (id, text)."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "id", F.transform(_lines(F.col("text")), _keys).alias("lines"), "text")
    if max_n == 1:  # no run crosses a line end
        return rows.select("row", "id", "lines", F.array().cast("array<int>").alias("crossing"))
    id_type = docs.schema["id"].dataType.simpleString()
    return rows.mapInArrow(_crossing(max_n, buckets), f"row long, id {id_type}, lines array<struct<key1:long,key2:long>>, crossing array<int>")


def bucket_counts(lines: DataFrame, rows: DataFrame, buckets: int) -> np.ndarray:
    """Features of each bucket: those of distinct lines times their occurrences, and those that cross lines."""
    within = lines.select(F.explode("buckets").alias("bucket"), "times")
    across = rows.select(F.explode("crossing").alias("bucket"), F.lit(1).cast("long").alias("times"))
    found = within.unionAll(across).groupBy("bucket").agg(F.sum("times").alias("n")).collect()  # at most one row a bucket
    counts = np.zeros(buckets, np.int64)
    for r in found:
        counts[r["bucket"]] = r["n"]
    return counts


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of each bucket's smoothed share in the target over that in the corpus."""
    b = len(corpus)
    all_s, all_t = float(corpus.sum()) + b, float(target.sum()) + b
    return np.array([math.floor(1000 * math.log((t + 1) * all_s / ((s + 1) * all_t))) for s, t in zip(corpus.astype(float).tolist(), target.astype(float).tolist())], np.int64)


def _line_sums(rows: DataFrame, gains: DataFrame) -> DataFrame:
    """(row, gain, n, words) of each document's occurrences of lines, hot lines dealt over several parts."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = gains.agg(F.coalesce(F.sum("times"), F.lit(0)).alias("t")).first()["t"]
    shares = F.ceil(F.col("times") * parts / max(total, 1)).cast("int")
    cut = gains.withColumn("parts", shares)
    hot = F.broadcast(cut.where("parts > 1").select("key1", "key2", "parts"))  # below ``parts`` rows
    dealt = (rows.select("row", F.explode("lines").alias("k")).select("row", "k.*").join(hot, ["key1", "key2"], "left")
             .withColumn("part", F.pmod(F.xxhash64("row"), F.coalesce("parts", F.lit(1))).cast("int")).drop("parts"))
    copies = cut.select("key1", "key2", "gain", "n", "words", F.explode(F.sequence(F.lit(0), F.greatest("parts", F.lit(1)) - 1)).alias("part"))
    return dealt.join(copies, ["key1", "key2", "part"]).select("row", "gain", "n", "words")


def resample(docs: DataFrame, target: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text", max_n: int = 1, buckets: int = 10_000,
             percent: int = 10, min_words: int = 20, seed: int = 2024) -> DataFrame:
    """A row for each document: (id_col, n_features, weight, score, rank: 1, 2, ... of the drawn, else null)."""
    ship_code(docs.sparkSession)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    wanted = target.select(F.lit(0).alias("id"), F.col(target_text_col).cast("string").alias("text"))
    lines, rows = materialise(distinct_lines(texts, max_n, buckets)), materialise(document_lines(texts, max_n, buckets))
    gains = bucket_gains(bucket_counts(lines, rows, buckets), bucket_counts(distinct_lines(wanted, max_n, buckets), document_lines(wanted, max_n, buckets), buckets))

    id_type = texts.schema["id"].dataType.simpleString()
    line_gains = materialise(lines.mapInArrow(_summed(["key1", "key2", "times", "words"], "buckets", gains), "key1 long, key2 long, times long, words long, gain long, n long"))
    own = rows.mapInArrow(_summed(["row", "id"], "crossing", gains), f"row long, id {id_type}, gain long, n long")
    parts = own.select("row", F.struct("id").alias("head"), "gain", "n", F.lit(0).cast("long").alias("words")).unionAll(
        _line_sums(rows, line_gains).select("row", F.lit(None).cast(f"struct<id:{id_type}>").alias("head"), "gain", "n", "words"))
    scored = parts.groupBy("row").agg(F.max("head").alias("head"), F.sum("gain").alias("weight"), F.sum("n").alias("n_features"), F.sum("words").alias("n_words"))
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("head.id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    scored = scored.select("row", F.col("head.id").alias("id"), "n_features", "weight", (F.col("weight") + noise).alias("score"), "n_words")
    scored = materialise(scored.withColumn("eligible", F.col("n_words") >= min_words))
    drawn = scored.where("eligible").count() * percent // 100
    ranked = ordered_row_number(scored, [F.col("eligible").desc(), F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("row")], "at", store=materialise)
    return ranked.select(F.col("id").alias(id_col), "n_features", "weight", "score", F.when(F.col("at") < drawn, F.col("at") + 1).alias("rank"))
