"""Toxicity from class-conditional Kneser-Ney models.

A class's model counts, for each word, the different words that precede it in
the class (Kneser-Ney continuation counts, so repeated lines and copies count
once). Counts are discounted by up to ``discount``; what they lose goes to a
level that both classes share, made of the continuation counts that both show,
so a rare expression is as likely in either class. Toxic texts are ordinary
texts with a small ``share`` of words from the toxic model. A text's evidence
is the difference of its two log-likelihoods, normalised by the square root of
its length, as its noise grows.

Labelled training rows are a bounded sample: up to ``sample`` documents a class
(smallest hashes of the id first) give the counts, and up to ``calibration``
others a logistic curve from evidence to score. Spark makes the counts; those
of the bounded sample go to the tasks.

Labels, language, source and id are no inputs of a score. Defined results: null
and empty texts have no evidence and score as the curve does at 0; a document
with several labels is toxic if one says so; null labels are no labels; if a
class has no training rows, all texts score 0; repeated rows are scored each;
null ids are never trained on; a very long text is scored as a whole; equal texts
score alike; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textops as T
from .store import materialise, ship_code

SLICE_BYTES = 4 << 20
_START = np.uint64(0x94D049BB133111EB)
_FLAG_BITS = 22


def _bigrams(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Hash of each word and the one before it (or the text's start)."""
    before = np.empty_like(h)
    before[1:] = h[:-1]
    before[first[:-1][np.diff(first) > 0]] = _START
    return T.mix(before * np.uint64(0x9E3779B97F4A7C15) + h)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct (class, word, hash of the word and the one before it) of each slice."""
    for part in T.row_slices(batches, "text", SLICE_BYTES):
        h, _, _, first = T.words(T.column(part, "text"), T.ALNUM, True)
        pair = _bigrams(h, first)
        toxic = np.repeat(np.array(T.column(part, "toxic").to_pylist(), np.int64), np.diff(first))
        for kind in (0, 1):
            own, at = np.unique(pair[toxic == kind], return_index=True)
            word = h[toxic == kind][at]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), kind, np.int32)), pa.array(word.view(np.int64)), pa.array(own.view(np.int64))], ["toxic", "word", "pair"])


class KneserNey:
    """Log-likelihood ratios of words from rows (class, word, different words before it in the class)."""

    def __init__(self, toxic: np.ndarray, word: np.ndarray, n: np.ndarray, discount: float, share: float) -> None:
        self.words, at = np.unique(word.view(np.uint64), return_inverse=True)
        c = {kind: np.bincount(at[toxic == kind], weights=n[toxic == kind], minlength=len(self.words)) for kind in (0, 1)}
        both = np.minimum(c[0], c[1])
        shared = (both + 1) / (both.sum() + len(self.words) + 1)
        p = {}
        for kind in (0, 1):
            off = np.minimum(c[kind], discount)
            p[kind] = (c[kind] - off + off.sum() * shared) / c[kind].sum()
        self.gain = np.log1p(share * (p[1] / p[0] - 1))
        self.flags = np.zeros(1 << _FLAG_BITS, dtype=bool)
        self.flags[(self.words & np.uint64((1 << _FLAG_BITS) - 1)).astype(np.int64)] = True

    def evidence(self, texts: pa.Array) -> np.ndarray:
        """Log-likelihood difference of each text over the square root of its number of words."""
        h, _, _, first = T.words(texts, T.ALNUM, True)
        value = np.zeros(len(h))
        at = np.flatnonzero(self.flags[(h & np.uint64((1 << _FLAG_BITS) - 1)).astype(np.int64)])
        key = np.minimum(np.searchsorted(self.words, h[at]), len(self.words) - 1)
        value[at] = np.where(self.words[key] == h[at], self.gain[key], 0.0)
        n = np.diff(first)
        return np.bincount(np.repeat(np.arange(len(n)), n), weights=value, minlength=len(n)) / np.sqrt(np.maximum(n, 1))


def _logistic(x: np.ndarray, y: np.ndarray, steps: int = 40) -> tuple[float, float]:
    """Slope and offset by Newton's method with a little ridge; the slope is kept positive."""
    centre, scale = x.mean(), x.std() + 1e-12
    z = np.stack([(x - centre) / scale, np.ones(len(x))], axis=1)
    beta = np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        grad = z.T @ (y - p) - 0.01 * beta
        beta = beta + np.clip(np.linalg.solve(z.T @ (z * (p * (1 - p))[:, None]) + 0.01 * np.eye(2), grad), -5, 5)
    slope = max(beta[0], 1e-3) / scale
    return float(slope), float(beta[1] - slope * centre)


def _score(model: KneserNey | None, slope: float, offset: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in T.row_slices(batches, "text", SLICE_BYTES):
            evidence = model.evidence(T.column(part, "text")) if model else np.zeros(part.num_rows)
            score = 1 / (1 + np.exp(-np.clip(slope * evidence + offset, -700, 700))) if model else np.zeros(part.num_rows)
            yield pa.RecordBatch.from_arrays([T.column(part, "id"), pa.array(evidence), pa.array(score)], ["id", "evidence", "score"])
    return run


def score_toxicity(docs: DataFrame, labels: DataFrame, train: Column, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = 2500, calibration: int = 4000,
                   discount: float = 2.0, share: float = 0.005) -> DataFrame:
    """A row for each document: (id_col, evidence, score). ``train``: which labels may be learned from, over the columns of ``labels``."""
    spark = docs.sparkSession
    ship_code(spark)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = texts.schema["id"].dataType.simpleString()
    known = labels.where(train & F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("toxic"))
    known = known.withColumn("order", F.xxhash64("id", F.lit("toxicity")))
    for_curve = F.pmod(F.xxhash64("id", F.lit("curve")), F.lit(4)) == 0
    sampled = [known.where(~for_curve & (F.col("toxic") == kind)).orderBy("order", "id").limit(sample) for kind in (0, 1)]
    bounded = materialise(sampled[0].unionAll(sampled[1]).withColumn("curve", F.lit(False)).unionAll(known.where(for_curve).orderBy("order", "id").limit(calibration).withColumn("curve", F.lit(True))))
    # at most 2 * sample + calibration ids are broadcast; texts are not shuffled
    chosen = materialise(texts.join(F.broadcast(bounded.select("id", "toxic", "curve")), "id").dropDuplicates(["id"]))
    pairs = chosen.where("NOT curve").select("text", "toxic").mapInArrow(_pairs, "toxic int, word long, pair long").distinct()
    table = pairs.groupBy("toxic", "word").agg(F.count(F.lit(1)).alias("n")).toArrow()
    toxic, word, n = (table.column(c).to_numpy() for c in ("toxic", "word", "n"))
    out = f"id {id_type}, evidence double, score double"
    if len(set(toxic.tolist())) < 2:
        return texts.mapInArrow(_score(None, 0.0, 0.0), out).withColumnRenamed("id", id_col)
    shared = spark.sparkContext.broadcast(KneserNey(toxic, word, n, discount, share))
    curve = chosen.where("curve").select("id", "text").mapInArrow(lambda batches: _score(shared.value, 1.0, 0.0)(batches), out).join(bounded, "id").select("evidence", "toxic").toPandas()
    slope, offset = _logistic(curve["evidence"].to_numpy(), curve["toxic"].to_numpy()) if curve["toxic"].nunique() == 2 else (1.0, 0.0)
    return texts.mapInArrow(lambda batches: _score(shared.value, slope, offset)(batches), out).withColumnRenamed("id", id_col)
