"""Conversation repair: the search against a plain table of all states, and whole tables against a plain version, short and long paths alike."""

import hashlib
import random

import pytest

from demandflow.llm.conversations import FIRST, cheapest_audit, repair_conversations, repaired_turns

SPACE = " \t\n\x0b\f\r"
NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}


def plain(turns):
    """(counts, cost, audit, repaired turns) of sorted (turn, role, text): the cheapest, then least audit of each state, turn by turn."""
    turns = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in turns]
    turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, faults = set(), []
    for _, role, text in turns:
        body = text.strip(SPACE)
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated")
        seen.add((role, text))
    now = {"": (0, "", ())}

    def put(into, state, value):
        if state not in into or value[:2] < into[state][:2]:
            into[state] = value

    def inserts(at):
        for _ in range(4):
            for state, (c, a, out) in list(at.items()):
                new = NEXT[state]
                put(at, new, (c + 2, a + "I", out + (({"u": "user", "a": "assistant"}[new], ""),)))
        return at

    for (_, role, text), fault in zip(turns, faults):
        after, more = {}, fault == "truncated"
        for state, (c, a, out) in inserts(now).items():
            put(after, state, (c + 3, a + "D", out))
            if fault in ("", "truncated"):
                if (state, role[:1]) in {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}:
                    put(after, role[0], (c + more, a + "K", out + ((role, text),)))
                new = NEXT[state]
                put(after, new, (c + 2 + more, a + "R", out + (({"u": "user", "a": "assistant"}[new], text),)))
        now = after
    cost, audit, out = min((now[s] for s in ("", "a") if s in inserts(now)), key=lambda v: v[:2])
    known = [t for t, *_ in turns if t is not None]
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(turns, turns[1:])]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()), out


def sample(seed, n_conv=60, longest=14):
    rng = random.Random(seed)
    rows = []
    for c in [None, *range(n_conv)]:
        for turn in range(rng.randrange(longest)):
            text = rng.choice(["Yes.", "No!", "Why? ", "cut off", "", " \t", None, "é日.", "Done.\x0b\n", f"own {c} {turn}.", f"own {c} {turn}"])
            role = ("user", "assistant")[turn % 2] if rng.random() < 0.7 else rng.choice(["system", "user", "assistant", "tool", "", None, "uncle", "User"])
            row = (c, None if rng.random() < 0.05 else turn * rng.choice([1, 1, 2]), role, text)
            rows += [row] * rng.choice([1, 1, 1, 1, 2])
    return rows + [(900, 1, "user", "word " * 40_000 + "end."), (901, None, None, None)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "conv_id long, turn long, role string, text string, conv long, fault string, at int").repartition(7)


def grouped(rows):
    out = {}
    for c, *rest in rows:
        out.setdefault(c, []).append(tuple(rest))
    return out


def test_search_finds_the_cheapest_and_least_audit():
    rng = random.Random(5)
    for _ in range(4000):
        turns = [(i, rng.choice(["system", "user", "user", "assistant", "assistant", "tool"]), rng.choice(["", f"{i}.", f"{i}.", f"{i}", f"{i}"])) for i in range(rng.randrange(10))]
        letters = bytes(FIRST + 4 * (2 if not t else 0 if t[-1] == "." else 1) + {"s": 0, "u": 1, "a": 2}.get(r[0], 3) for _, r, t in turns)
        assert cheapest_audit(letters) == plain(turns)[0][5:7]


@pytest.mark.parametrize("long_rows", [20_000, 3, 0])
def test_reports_and_turns_equal_the_plain_version(spark, long_rows):
    rows = sample(long_rows)
    expected = {c: plain(turns) for c, turns in grouped(rows).items()}
    got = {r[0]: tuple(r[1:]) for r in repair_conversations(frame(spark, rows), long_rows=long_rows).collect()}
    assert got == {c: report for c, (report, _) in expected.items()}
    found = {}
    for c, position, role, text in sorted(map(tuple, repaired_turns(frame(spark, rows), long_rows=long_rows).collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1])):
        found.setdefault(c, []).append((role, text))
        assert position == len(found[c]) - 1
    assert found == {c: list(out) for c, (_, out) in expected.items() if out}


def test_long_by_bytes_and_empty_tables(spark):
    rows = sample(8, 10)
    expected = {c: plain(turns)[0] for c, turns in grouped(rows).items()}
    assert {r[0]: tuple(r[1:]) for r in repair_conversations(frame(spark, rows), long_bytes=40).collect()} == expected
    assert repair_conversations(frame(spark, [])).collect() == [] and repaired_turns(frame(spark, [])).collect() == []


def test_a_conversation_longer_than_a_piece(spark):
    rng = random.Random(2)
    rows = [(1, i, rng.choice(["user", "assistant"]), f"{i}.") for i in range(20_000)] + [(2, 0, "user", "a.")]
    expected = {c: plain(turns)[0] for c, turns in grouped(rows).items() if c == 2}
    got = {r[0]: tuple(r[1:]) for r in repair_conversations(frame(spark, rows), long_rows=5000).collect()}
    assert got[2] == expected[2]
    assert got == {r[0]: tuple(r[1:]) for r in repair_conversations(frame(spark, rows)).collect()}


def test_damage_covers_every_kind(spark, tmp_path):
    import zlib

    from demandflow.llm.queries import _damaged, op12_conversation_repair
    rows = sample(11, 40) + [(500 + i, i % 3, "user", f"Hi {i}.") for i in range(60)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    damaged = []
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind:
            text = "" if kind == 1 else "".join(x for x in text if x not in ".!?") if kind == 2 else text
            damaged += [(c, t, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    key = lambda r: tuple((v is not None, v or 0) if not isinstance(v, str) else (True, v) for v in r)
    assert sorted(map(tuple, _damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()), key=key) == sorted(damaged, key=key)
    expected = {c: (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest()) for c, *_ in rows} | {c: plain(turns)[0] for c, turns in grouped(damaged).items()}
    assert {r[0]: tuple(r[1:]) for r in op12_conversation_repair(spark, str(tmp_path)).collect()} == expected
