"""Substring dedup: repeated fixed-length word windows and their maximal intervals.

1. Tasks cut their documents into slices of consecutive rows and hash every
   window of ``window`` words (Rabin-Karp). A slice keeps one entry for each of
   its window hashes, so however often a passage is copied it is sent once a
   slice; windows repeated inside the slice are already known as repeated.
2. The entries are shuffled by a second, independent hash of the window (the
   bucket) as packed arrays: 8 bytes of hash and 2 of position. A bucket counts
   its hashes; those of two slices or more go back to their slices as
   positions. Two windows count as equal if both hashes agree.
3. Slices meet their own text again. Starts of repeated windows merge into
   maximal intervals and the words outside stay.

A slice's rows are numbered by partition and order, so the input must give the
same rows in the same order when it is read twice, as stored tables do; a
mismatch is found and raised. ``slice_bytes`` bounds a task's memory; with
very large corpora larger slices make the packed arrays longer.

Defined results: null and empty texts have no words; texts shorter than a
window lose nothing; repeated document rows are occurrences of their own;
null ids stay null; a very long text is one document with all its windows;
of equal windows none is kept; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops as T
from .store import ship_code

_ENTRIES, _LOCAL, _TEXT = 0, 1, 2
_SECOND = np.uint64(0xA24BAED4963EE407)


def _pack(positions: np.ndarray) -> bytes:
    """Ascending positions as steps of 2 bytes, or 4 if one is too large."""
    steps = np.diff(positions, prepend=0)
    return steps.astype(np.uint16 if len(steps) == 0 or steps.max() < 65536 else np.uint32).tobytes()


def _unpack(data: bytes, n: int) -> np.ndarray:
    return np.cumsum(np.frombuffer(data, np.uint16 if len(data) == 2 * n else np.uint32), dtype=np.int64)


def _slices(batches: Iterator[pa.RecordBatch], slice_bytes: int) -> Iterator[tuple[int, pa.Table]]:
    for k, part in enumerate(T.row_slices(batches, "text", slice_bytes)):
        yield (T.column(part, "part")[0].as_py() << 32) + k, part


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)


def _hash_windows(window: int, buckets: int, slice_bytes: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own, part in _slices(batches, slice_bytes):
            h, _, _, first = T.words(T.column(part, "text"), T.SPACED, False)
            at = np.flatnonzero(T.starts_inside(first, window))
            value = T.windows(h, window)[at]
            order = np.argsort(value, kind="stable")
            new = np.ones(len(order), dtype=bool)
            new[1:] = value[order[1:]] != value[order[:-1]]
            many = np.diff(np.append(np.flatnonzero(new), len(order))) > 1
            local = np.sort(at[order[np.repeat(many, np.diff(np.append(np.flatnonzero(new), len(order))))]])
            one = np.sort(order[new])
            bucket = ((T.windows(T.mix(h ^ _SECOND), window)[at[one]] >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)
            by = np.argsort(bucket, kind="stable")
            one, bucket = one[by], bucket[by]
            edges = np.flatnonzero(np.diff(bucket, prepend=-1, append=buckets + 1))
            rows = [(int(own % buckets), own, _LOCAL, _pack(local), np.array([len(local), part.num_rows, len(h)], np.int64).tobytes())]
            rows += [(int(bucket[a]), own, _ENTRIES, value[one[a:b]].tobytes(), _pack(at[one[a:b]])) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]
            for k in range(0, len(rows), 256):
                yield _batch(rows[k:k + 256], ["bucket", "slice", "kind", "a", "b"], [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary()])
    return run


def _repeated(table: pa.Table) -> pa.Table:
    """Of one bucket: the positions of hashes that several slices have, by slice; slices' own findings pass through."""
    names, types = ["slice", "kind", "a", "b"], [pa.int64(), pa.int32(), pa.binary(), pa.binary()]
    rows = list(zip(*(table.column(n).to_pylist() for n in names)))
    entries = [r for r in rows if r[1] == _ENTRIES]
    out = [r for r in rows if r[1] != _ENTRIES]
    if len(entries) > 1:
        value = np.concatenate([np.frombuffer(r[2], np.uint64) for r in entries])
        order = np.argsort(value, kind="stable")
        same = np.zeros(len(order) + 1, dtype=bool)
        same[1:-1] = value[order[1:]] == value[order[:-1]]
        hit = np.zeros(len(order), dtype=bool)
        hit[order] = same[1:] | same[:-1]
        at = 0
        for own, _, a, b in entries:
            n = len(a) // 8
            positions = _unpack(b, n)[hit[at:at + n]]
            at += n
            if len(positions):
                out.append((own, _ENTRIES, _pack(positions), np.array([len(positions)], np.int64).tobytes()))
    return pa.table([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names)


def _texts(slice_bytes: int) -> Callable:
    codec = "zstd"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own, part in _slices(batches, slice_bytes):
            raw, offsets = T.text_buffer(T.column(part, "text"))
            ids = T.column(part, "id")
            yield pa.RecordBatch.from_arrays([
                pa.array([own], pa.int64()), pa.array([_TEXT], pa.int32()), pa.array([pa.Codec(codec).compress(raw.tobytes(), asbytes=True)], pa.binary()),
                pa.array([offsets.tobytes()], pa.binary()), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)], ["slice", "kind", "a", "b", "ids"])
    return run


def _remove(window: int) -> Callable:
    def run(table: pa.Table) -> pa.Table:
        kinds = table.column("kind").to_pylist()
        text = kinds.index(_TEXT) if _TEXT in kinds else None
        if text is None or kinds.count(_TEXT) != 1:
            raise RuntimeError("the documents came in another order when they were read again; store them first")
        a, b = table.column("a"), table.column("b")
        offsets = np.frombuffer(b[text].as_py(), np.int64)
        raw = pa.Codec("zstd").decompress(a[text].as_py(), decompressed_size=int(offsets[-1]), asbytes=True)
        docs = [raw[i:j].split() for i, j in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
        first = np.concatenate([[0], np.cumsum([len(d) for d in docs])]).astype(np.int64)
        begins = np.zeros(int(first[-1]) + 1, dtype=np.int64)
        for k, kind in enumerate(kinds):
            if kind == _TEXT:
                continue
            head = np.frombuffer(b[k].as_py(), np.int64)
            if kind == _LOCAL and (head[1] != len(docs) or head[2] != first[-1]):
                raise RuntimeError("the documents changed when they were read again; store them first")
            begins[_unpack(a[k].as_py(), int(head[0]))] = 1
        seen = np.cumsum(begins)
        covered = seen.copy()
        covered[window:] -= seen[:-window]
        covered = covered[:-1] > 0
        kept, spans = [], []
        for words, i, j in zip(docs, first[:-1].tolist(), first[1:].tolist()):
            gone = covered[i:j]
            if not gone.any():
                kept.append(b" ".join(words))
                spans.append([])
                continue
            edge = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0)).tolist()
            spans.append([{"start": s, "stop": t} for s, t in zip(edge[::2], edge[1::2])])
            kept.append(b" ".join([w for s, t in zip([0, *edge[1::2]], [*edge[::2], len(words)]) for w in words[s:t]]))
        return pa.table([table.column("ids").combine_chunks()[text].values, pa.array(np.diff(first)), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
                         pa.array(kept, pa.binary()).cast(pa.string())], ["id", "n_words", "removed", "kept_text"])
    return run


def remove_repeated(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = 35, bucket_windows: int = 2_000_000, slice_bytes: int = 8 << 20) -> DataFrame:
    """A row for each document: (id_col, n_words, removed word intervals [start, stop), kept_text: the other words joined by one space).

    ``bucket_windows``: about as many windows are counted by one task at a time, before copies inside slices are taken out.
    """
    spark = docs.sparkSession
    ship_code(spark)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.spark_partition_id().alias("part"))
    id_type = texts.schema["id"].dataType.simpleString()
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // (6 * bucket_windows)))
    found = (texts.select("text", "part").mapInArrow(_hash_windows(window, buckets, slice_bytes), "bucket long, slice long, kind int, a binary, b binary")
             .groupBy("bucket").applyInArrow(_repeated, "slice long, kind int, a binary, b binary")
             .withColumn("ids", F.array().cast(f"array<{id_type}>")))
    whole = texts.mapInArrow(_texts(slice_bytes), f"slice long, kind int, a binary, b binary, ids array<{id_type}>")
    out = f"id {id_type}, n_words long, removed array<struct<start:long,stop:long>>, kept_text string"
    return found.unionByName(whole).groupBy("slice").applyInArrow(_remove(window), out).withColumnRenamed("id", id_col)
