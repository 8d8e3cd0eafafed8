"""Sharding: the law, the slots, what stays together, on hot groups, several links and odd rows."""

import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from demandflow.llm.sharding import admitted, shard_documents

SCHEMA = "doc_id long, text string, host string, row long, class1 long, shard string, size int, n int"


def frame(spark, rows, parts=5):
    return spark.createDataFrame([(i, t, h, 1, 2, "x", 3, 4) for i, t, h in rows], SCHEMA).repartition(parts, "doc_id")


def lawful(got, rows, shards):
    by_shard = {}
    for r in got:
        by_shard.setdefault(r.shard, []).append(r.slot)
    sizes = [len(by_shard.get(s, [])) for s in range(shards)]
    assert sum(sizes) == len(rows) and max(sizes) - min(sizes) <= 1 and set(by_shard) <= set(range(shards))
    assert all(sorted(slots) == list(range(len(slots))) for slots in by_shard.values())
    key = lambda r: tuple((x is not None, x or 0) for x in r)
    assert sorted(((r.doc_id, r["size"], r.text_crc32) for r in got), key=key) == sorted(((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _ in rows), key=key)


def together(got, group_of, shards, n):
    """Pairs of equal groups in one shard, over the most that even shards allow a group."""
    quota = -(-n // shards)
    groups = {}
    for r in got:
        if group_of.get(r.doc_id) is not None:
            groups.setdefault(group_of[r.doc_id], Counter())[r.shard] += 1
    pairs = lambda k: k * (k - 1) // 2
    kept = sum(pairs(k) for c in groups.values() for k in c.values())
    best = sum((sum(c.values()) // quota) * pairs(quota) + pairs(sum(c.values()) % quota) for c in groups.values())
    return kept / max(best, 1)


@pytest.mark.parametrize("shards", [1, 3, 16])
def test_rows_are_even_and_equal_texts_stay_together(spark, shards):
    rng = random.Random(shards)
    texts = [None, "", "é" * 30] + [f"text {i} " * rng.randrange(1, 30) for i in range(60)]
    rows = [(i, f"alone {i}" if rng.random() < 0.6 else rng.choice(texts), None) for i in range(700)] + [(None, "no id", None), (5, "repeated id", None), (900, "word " * 50_000, None)]
    got = shard_documents(frame(spark, rows), shards=shards).collect()
    lawful(got, rows, shards)
    group_of = {i: t for i, t, _ in rows if i not in (None, 5)}
    assert together(got, group_of, shards, len(rows)) > 0.97


def test_a_group_of_a_third_of_all_rows_fills_shards(spark):
    rng = random.Random(1)
    rows = [(i, "hot" if i % 3 == 0 else f"group {rng.randrange(150)}" if i % 3 == 1 else f"alone {i}", None) for i in range(1500)]
    got = shard_documents(frame(spark, rows, 9)).collect()
    lawful(got, rows, 16)
    hot = Counter(r.shard for r in got if r.doc_id % 3 == 0)
    assert len(hot) <= 9  # 500 rows, shards of 94
    groups = {}
    for r in got:
        if r.doc_id % 3 == 1:
            groups.setdefault(rows[r.doc_id][1], Counter())[r.shard] += 1
    assert sum(max(c.values()) for c in groups.values()) >= 0.95 * 500


def test_links_other_than_texts_and_several_at_once(spark):
    rng = random.Random(4)
    rows = [(i, f"text {i if i % 2 else i // 40}", f"host {rng.randrange(40)}" if rng.random() < 0.8 else None) for i in range(600)]
    got = shard_documents(frame(spark, rows), links=[F.col("text"), F.col("host")], shards=8).collect()
    lawful(got, rows, 8)
    assert together(got, {i: h for i, _, h in rows}, 8, 600) > 0.3  # half of the hosts' documents are drawn by their texts, too; by chance: 1 in 8
    assert {(r.doc_id, r.shard, r.slot) for r in got} == {(r.doc_id, r.shard, r.slot) for r in shard_documents(frame(spark, rows), links=[F.col("text"), F.col("host")], shards=8).collect()}


def test_empty_table_and_fewer_rows_than_shards(spark):
    assert shard_documents(frame(spark, [])).collect() == []
    rows = [(i, "same", None) for i in range(5)]
    lawful(shard_documents(frame(spark, rows)).collect(), rows, 16)


def test_admitted_requests_fit():
    rng = random.Random(3)
    for _ in range(300):
        shards = rng.randrange(1, 6)
        room = [rng.randrange(-3, 20) for _ in range(shards)]
        asked = {(rng.randrange(shards), rng.randrange(shards), rng.randrange(4)): rng.randrange(1, 30) for _ in range(rng.randrange(12))}
        asked = {k: n for k, n in asked.items() if k[0] != k[1]}
        share = admitted(asked, room)
        moved = {k: share[k] * n for k, n in asked.items()}
        for s in range(shards):
            into, out = sum(n for k, n in moved.items() if k[1] == s), sum(n for k, n in moved.items() if k[0] == s)
            assert into <= max(room[s] + out, 0) + 1e-3
    assert admitted({(0, 1, 3): 10, (2, 1, 1): 10}, [0, 12, 0]) == {(0, 1, 3): 1.0, (2, 1, 1): 0.2}
    assert admitted({(0, 1, 0): 4, (1, 0, 0): 4}, [0, 0]) == {(0, 1, 0): 1.0, (1, 0, 0): 1.0}  # a swap of full shards
