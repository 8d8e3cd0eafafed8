"""Target resampling against a plain version that counts every run of every text."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from demandflow.llm.resample import resample

SCHEMA = "doc_id long, text string, row long, lines string, gain long, key1 int"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def runs(text, max_n):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return len(words), [" ".join(words[i:i + n]) for n in range(1, max_n + 1) for i in range(len(words) - n + 1)]


def plain(docs, target, max_n, buckets, percent, min_words, seed):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    found = [runs(t, max_n) for _, t in docs]
    s, t = Counter(bucket(f) for _, fs in found for f in fs), Counter(bucket(f) for x in target for f in runs(x, max_n)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in range(buckets)}
    out = []
    for (i, _), (n_words, fs) in zip(docs, found):
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[bucket(f)] for f in fs)
        out.append([i, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n_words])
    able = sorted((r for r in out if r[4] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    rank = {id(r): k + 1 for k, r in enumerate(able[:percent * len(able) // 100])}
    return sorted(((*r[:4], rank.get(id(r))) for r in out), key=repr)


def texts(seed, n=150):
    rng = random.Random(seed)
    vocabulary = ["the", "The", "straße", "ZÜRICH", "a1", "x" * 70, "日本語", "é" * 40 + "B", *(f"w{i}" for i in range(60))]
    line = lambda: " ".join(rng.choices(vocabulary, k=rng.choice([0, 1, 2, 3, 9])))
    shared = [line() for _ in range(6)]
    docs = [(i, "\n".join(rng.choice([shared[0], rng.choice(shared), line()]) for _ in range(rng.randrange(9)))) for i in range(n)]
    return docs + [(n, None), (n + 1, ""), (n + 2, "\n\n \t\n"), (n + 3, "?!"), (3, docs[4][1]), (5, docs[5][1]), (n + 4, " ".join(f"long{i % 300}" for i in range(20_000))), (n + 5, "a-b\rc d\x00e")]


@pytest.mark.parametrize("max_n", [1, 2, 3])
def test_scores_and_ranks_equal_the_plain_version(spark, max_n):
    docs, target = texts(max_n), [t for _, t in texts(9, 12)]
    args = dict(max_n=max_n, buckets=500, percent=30, min_words=8, seed=2024)
    frame = spark.createDataFrame([(*d, 1, "x", 7, 3) for d in docs], SCHEMA).repartition(5)
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    got = sorted((tuple(r) for r in resample(frame, wanted, **args).collect()), key=repr)
    expected = plain(docs, target, **args)
    assert [g[:4] for g in got] == [e[:4] for e in expected]
    assert {g for g in got if g[0] not in (5,)} == {e for e in expected if e[0] not in (5,)}  # which of two equal rows comes first is open
    assert sorted(g[4] for g in got if g[4]) == sorted(e[4] for e in expected if e[4])


def test_null_ids_come_last_among_ties(spark):
    text = "one two three"
    frame = spark.createDataFrame([(None, text), (1, text), (2, text), (2, text)], "doc_id long, text string")
    rows = resample(frame, spark.createDataFrame([], "text string"), percent=100, min_words=1).collect()
    assert sorted(r["rank"] for r in rows) == [1, 2, 3, 4]
    two = [r for r in rows if r.doc_id == 2]
    assert two[0].score == two[1].score and abs(two[0]["rank"] - two[1]["rank"]) == 1


def test_empty_corpus(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert resample(none, none, max_n=2).collect() == []


def test_a_line_that_most_documents_hold_is_dealt_over_parts(spark):
    from demandflow.llm.resample import _line_sums
    from pyspark.sql import functions as F
    rows = spark.range(800).select(F.col("id").alias("row"), F.array(F.struct(F.lit(1).cast("long").alias("key1"), F.when(F.col("id") % 8 > 0, 1).otherwise(F.col("id")).alias("key2"))).alias("lines"))
    lines = rows.select(F.explode("lines").alias("k")).groupBy("k.key1", "k.key2").agg(F.count(F.lit(1)).alias("times"))
    sums = _line_sums(rows, lines.select("*", F.lit(5).cast("long").alias("gain"), F.lit(2).cast("long").alias("n"), F.lit(2).cast("long").alias("words")))
    assert sorted(tuple(r) for r in sums.collect()) == [(i, 5, 2, 2) for i in range(800)]
