"""Repair of the structure of conversations by the cheapest edits.

A sound conversation's role initials read ``(s?(ua)+)?``. Its turns, in order of
turn number (nulls first; then role and text), may be kept (K, cost 0), given
the role that the place asks for, user or assistant (R, 2), or deleted (D, 3);
empty turns of the asked role may be inserted anywhere (I, 2). Blank turns and
turns whose role and text were seen before must go; a truncated turn that stays
adds 1. The audit is the edits' initials in order: of the cheapest, the least.

The edit lattice has a node for each (turns consumed, state: start, after s,
after u, after a). Two heaps search it, from the start and from the ends; they
go on until their tops add up to more than the best meeting, so that every
node of a cheapest path is settled by one of them. The crossings, edges from
the forward to the reverse side at the best cost, are traced back through the
forward side; then the audit is read off from the start, at each node by the
least letter whose edge lies on a cheapest path. An audit's letters determine
its nodes, and no cheapest path is the beginning of another, so this is the
least concatenation of a forward and a reverse half.

Conversations of at most ``long_rows`` turns and ``long_bytes`` of text are
repaired where they lie, one after the other in sorted partitions. Longer ones
never meet in one task with their texts: their turns are numbered by range
partition, repeated turns found by an aggregation, one letter a turn goes to the
lattice (the audit that comes back is as long), and the edits are joined to the
turns by number. Only the digest reads a long conversation's turns in sequence,
as a stream, since SHA-256 allows no other way.

Defined results: null roles and texts are one space, so the turn is blank (text)
or its role fits nowhere; a null conversation id is a conversation; a null turn
comes first and counts for no gap; repeated rows are turns of their own, the
later a duplicate; a very long text is one turn; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Callable, Iterator
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandflow.operators.stats import ordered_row_number

from .store import materialise, ship_code

START, S, U, A = range(4)
#: state after an inserted or re-roled turn
NEXT = (U, U, A, U)
ROLE = {U: "user", A: "assistant"}
#: kinds of role initials and the state after a kept turn, by state before
KINDS = "sua"
KEEP = {0: {START: S}, 1: {START: U, S: U, A: U}, 2: {U: A}, 3: {}}
LEGAL = {(0, 1), (1, 2), (2, 1)}
FINE, TRUNCATED, BLANK, DUPLICATE = range(4)
#: a turn's letter: A plus 4 * fault plus kind
FIRST = 65
REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_FAR = (1 << 31) - 1


def _letter(role: str, fault: int) -> int:
    return FIRST + 4 * fault + (KINDS.find(role[0]) % 4 if role else 3)


def _edges(letters: bytes, node: int) -> Iterator[tuple[str, int, int]]:
    """(edit, next node, cost) in the edits' order of letters. Node: 4 * turns consumed + state."""
    i, state = divmod(node, 4)
    here = i < len(letters)
    fault, kind = divmod(letters[i] - FIRST, 4) if here else (FINE, 3)
    if here:
        yield "D", node + 4, 3
    yield "I", 4 * i + NEXT[state], 2
    if here and fault < BLANK:
        if state in KEEP[kind]:
            yield "K", 4 * i + 4 + KEEP[kind][state], fault
        yield "R", 4 * i + 4 + NEXT[state], 2 + fault


def _edges_back(letters: bytes, node: int) -> Iterator[tuple[int, int]]:
    """(previous node, cost)."""
    i, state = divmod(node, 4)
    asked = [s for s in range(4) if NEXT[s] == state]
    for s in asked:
        yield 4 * i + s, 2
    if i:
        fault, kind = divmod(letters[i - 1] - FIRST, 4)
        yield node - 4, 3
        if fault < BLANK:
            for before, after in KEEP[kind].items():
                if after == state:
                    yield 4 * i - 4 + before, fault
            for s in asked:
                yield 4 * i - 4 + s, 2 + fault


def cheapest_audit(letters: bytes) -> tuple[int, str]:
    """Cost and audit of the cheapest repair, by a search from both ends."""
    nodes, ends = 4 * len(letters) + 4, (4 * len(letters) + START, 4 * len(letters) + A)
    ahead, back = array("i", [_FAR]) * nodes, array("i", [_FAR]) * nodes
    done_ahead, done_back = bytearray(nodes), bytearray(nodes)
    order, best = [], _FAR
    ahead[START] = 0
    heap, heap_back = [(0, START)], []
    for end in ends:
        back[end] = 0
        heappush(heap_back, (0, end))
    if START in ends:
        best = 0
    while heap and heap_back and heap[0][0] + heap_back[0][0] <= best:
        if heap[0][0] <= heap_back[0][0]:
            d, v = heappop(heap)
            if done_ahead[v]:
                continue
            done_ahead[v] = 1
            order.append(v)
            for _, w, c in _edges(letters, v):
                if d + c < ahead[w]:
                    ahead[w] = d + c
                    heappush(heap, (d + c, w))
                    if back[w] < _FAR:
                        best = min(best, d + c + back[w])
        else:
            d, v = heappop(heap_back)
            if done_back[v]:
                continue
            done_back[v] = 1
            for w, c in _edges_back(letters, v):
                if d + c < back[w]:
                    back[w] = d + c
                    heappush(heap_back, (d + c, w))
                    if ahead[w] < _FAR:
                        best = min(best, d + c + ahead[w])

    leads = bytearray(nodes)  # forward nodes on a cheapest path; settled by (cost, node), so successors come later

    def cheapest(w: int, cost: int) -> bool:
        return (leads[w] and ahead[w] == cost) or ((done_back[w] or w in ends) and cost + back[w] == best)

    for v in reversed(order):
        leads[v] = cheapest(v, ahead[v]) or any(cheapest(w, ahead[v] + c) for _, w, c in _edges(letters, v))
    audit, at, cost = [], START, 0
    while cost < best or at not in ends:
        edit, at, cost = next((e, w, cost + c) for e, w, c in _edges(letters, at) if cheapest(w, cost + c))
        audit.append(edit)
    return best, "".join(audit)


def edits(audit: str, kinds: list[int]) -> Iterator[tuple[int, str, str | None]]:
    """(index of the turn it consumes or precedes, edit, new role) along an audit."""
    i, state = 0, START
    for edit in audit:
        if edit in "IR":
            state = NEXT[state]
        elif edit == "K":
            state = KEEP[kinds[i]][state]
        yield i, edit, ROLE[state] if edit in "IR" else None
        i += edit != "I"


def _report(letters: bytes) -> tuple[list[int], str]:
    """blank, duplicate, truncated, illegal, cost; the audit."""
    faults = [(x - FIRST) // 4 for x in letters]
    kinds = [(x - FIRST) % 4 for x in letters]
    cost, audit = cheapest_audit(letters)
    return [*(faults.count(f) for f in (BLANK, DUPLICATE, TRUNCATED)), sum(p not in LEGAL for p in zip(kinds, kinds[1:])), cost], audit


def _whole(with_turns: bool) -> Callable:
    """Report, digest and, if asked for, repaired turns of each conversation of sorted rows (conv, turn, role, text, fault)."""

    def solved(conv, rows) -> dict:
        seen, letters = set(), bytearray()
        for _, role, text, fault in rows:
            if fault != BLANK and (role, text) in seen:
                fault = DUPLICATE
            seen.add((role, text))
            letters.append(_letter(role, fault))
        counts, audit = _report(bytes(letters))
        known = [r[0] for r in rows if r[0] is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        turns = [(role or rows[i][1], "" if edit == "I" else rows[i][2]) for i, edit, role in edits(audit, [(x - FIRST) % 4 for x in letters]) if edit != "D"]
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest()
        out = dict(zip(["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"], [conv, gaps, *counts, audit, digest]))
        return out | {"turns": [{"role": r, "text": t} for r, t in turns] if with_turns else None}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, rows, out, kept, schema = None, [], [], 0, None
        for batch in batches:
            schema = schema or _schema(batch.schema.field("conv").type)
            columns = [batch.column(c).to_pylist() for c in ("conv", "turn", "role", "text", "fault")]
            for c, *row in zip(*columns):
                if rows and c != conv:
                    out.append(solved(conv, rows))
                    kept += sum(len(r[2]) for r in rows) if with_turns else 0
                    rows = []
                    if len(out) >= 4096 or kept > 1 << 22:
                        yield pa.RecordBatch.from_pylist(out, schema)
                        out, kept = [], 0
                conv = c
                rows.append(row)
        if rows:
            out.append(solved(conv, rows))
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)
    return run


def _schema(id_type: pa.DataType) -> pa.Schema:
    longs = [(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return pa.schema([("conv", id_type), *longs, ("audit", pa.string()), ("repaired_sha256", pa.string()), ("turns", pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())])))])


def turn_facts(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv, turn, role, text, fault: blank, truncated or fine), nulls as one space."""
    trimmed = F.rtrim(F.col("text"), F.lit(" \t\n\x0b\f\r"))
    fault = F.when(trimmed == "", BLANK).when(F.right(trimmed, F.lit(1)).isin(".", "!", "?"), FINE).otherwise(TRUNCATED)
    named = turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"), F.coalesce(F.col(role_col).cast("string"), F.lit(" ")).alias("role"), F.coalesce(F.col(text_col).cast("string"), F.lit(" ")).alias("text"))
    return named.withColumn("fault", fault)


def _sorted_by() -> list[Column]:
    return [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.left("text", F.lit(32)), F.col("text")]


def _pieces() -> Callable:
    """Report of each long conversation (conv, start, letters), and its edits in pieces of 8,192."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for conv, start, letters in zip(batch.column("conv"), batch.column("start").to_pylist(), batch.column("letters").to_pylist()):
                letters = letters.encode()
                counts, audit = _report(letters)
                names = ["blank", "duplicate", "truncated", "illegal", "cost"]
                kind = pa.list_(pa.struct([("at", pa.int64()), ("k", pa.int32()), ("edit", pa.string()), ("role", pa.string())]))
                found, k, first = [], 0, True
                steps = edits(audit, [(x - FIRST) % 4 for x in letters])
                while first or found:
                    found = []
                    for i, edit, role in steps:
                        found.append({"at": start + i, "k": k if edit == "I" else _FAR, "edit": edit, "role": role})
                        k = k + 1 if edit == "I" else 0
                        if len(found) == 8192:
                            break
                    if first or found:
                        values = [pa.array([x], pa.int64()) if first else pa.nulls(1, pa.int64()) for x in counts]
                        yield pa.RecordBatch.from_arrays([pa.array([conv.as_py()], batch.schema.field("conv").type), *values, pa.array([audit if first else None], pa.string()), pa.array([found], kind)],
                                                         ["conv", *names, "audit", "edits"])
                    first = False
    return run


def _digests() -> Callable:
    """sha256 of each conversation's repaired turns, read in order as a stream."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, digest, names = None, None, ["conv", "repaired_sha256"]
        for batch in batches:
            kind = batch.schema.field("conv").type
            for c, role, text in zip(*[batch.column(x).to_pylist() for x in ("conv", "role", "text")]):
                if digest is not None and c != conv:
                    yield pa.RecordBatch.from_arrays([pa.array([conv], kind), pa.array([digest.hexdigest()])], names)
                    digest = None
                if digest is None:
                    digest = hashlib.sha256()
                else:
                    digest.update(b"\n")
                conv = c
                digest.update(f"{role}:{text}".encode())
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([conv], kind), pa.array([digest.hexdigest()])], names)
    return run


def _long(facts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(reports, repaired turns by (conv, at, k)) of conversations too long for one task."""
    id_type = facts.schema["conv"].dataType.simpleString()
    numbered = materialise(ordered_row_number(facts, _sorted_by(), "at", range_by=4, store=materialise))
    seen = [F.xxhash64(F.lit(n), F.length("role"), "role", "text").alias(f"seen{n}") for n in (1, 2)]
    firsts = numbered.select("conv", *seen, "at").groupBy("conv", "seen1", "seen2").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("first"))
    kind = F.pmod(F.instr(F.lit(KINDS), F.left("role", F.lit(1))) - 1, F.lit(4))
    fault = F.when(F.col("first").isNotNull() | (F.col("fault") == BLANK), F.col("fault")).otherwise(DUPLICATE)
    letter = F.char(F.lit(FIRST) + 4 * fault + F.when(F.col("role") == "", 3).otherwise(kind))
    marked = numbered.join(firsts, "at", "left").select("conv", "at", letter.alias("letter"))
    joined = lambda a, b: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(a, b))), lambda x: x[b]), "").alias("letters")
    pieces = marked.groupBy("conv", F.floor(F.col("at") / 8192).alias("piece")).agg(F.min("at").alias("start"), joined("at", "letter"))
    whole = pieces.groupBy("conv").agg(F.min("start").alias("start"), joined("piece", "letters"))
    edit = "array<struct<at:long,k:int,edit:string,role:string>>"
    solved = materialise(whole.mapInArrow(_pieces(), f"conv {id_type}, blank long, duplicate long, truncated long, illegal long, cost long, audit string, edits {edit}"))
    edited = solved.select("conv", F.explode("edits").alias("e")).select("conv", "e.*").where("edit <> 'D'")
    own = numbered.select("at", F.col("role").alias("own"), "text")
    kept = edited.where("edit <> 'I'").join(own, "at").select("conv", "at", "k", F.coalesce("role", "own").alias("role"), "text")
    turns = materialise(kept.unionByName(edited.where("edit = 'I'").select("conv", "at", "k", "role", F.lit("").alias("text"))))
    digests = turns.repartition("conv").sortWithinPartitions("conv", "at", "k").mapInArrow(_digests(), f"conv {id_type}, repaired_sha256 string")
    known = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0))
    gaps = numbered.select("conv", "turn").distinct().groupBy("conv").agg(known.alias("gaps"))
    same = lambda a, b: a["conv"].eqNullSafe(b["conv"])
    reports = solved.where("audit IS NOT NULL").drop("edits")
    reports = reports.join(gaps, same(reports, gaps)).drop(gaps["conv"])
    return reports.join(digests, same(reports, digests), "left").drop(digests["conv"]).fillna(hashlib.sha256().hexdigest(), "repaired_sha256"), turns


def _split(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, long_rows: int, long_bytes: int) -> tuple[DataFrame, DataFrame | None]:
    """The facts of conversations that fit a task, sorted; those of longer ones, if there are any."""
    facts = turn_facts(turns, conv_col, turn_col, role_col, text_col)
    long = materialise(facts.groupBy("conv").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("role") + F.octet_length("text")).alias("bytes"))
                       .where((F.col("n") > long_rows) | (F.col("bytes") > long_bytes)).select("conv"))
    some = not long.isEmpty()
    short = facts.join(long, facts["conv"].eqNullSafe(long["conv"]), "left_anti") if some else facts
    return short.repartition("conv").sortWithinPartitions(*_sorted_by()), facts.join(long, facts["conv"].eqNullSafe(long["conv"]), "left_semi") if some else None


def repair_conversations(turns: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                         long_rows: int = 20_000, long_bytes: int = 64 << 20) -> DataFrame:
    """A row for each conversation: conv_col, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 (``role:text`` lines)."""
    ship_code(turns.sparkSession)
    short, long = _split(turns, conv_col, turn_col, role_col, text_col, long_rows, long_bytes)
    id_type = short.schema["conv"].dataType.simpleString()
    done = short.mapInArrow(_whole(False), f"conv {id_type}, {REPORT}, repaired_sha256 string, turns array<struct<role:string,text:string>>").drop("turns")
    if long is not None:
        done = done.unionByName(_long(long)[0])
    return done.withColumnRenamed("conv", conv_col)


def repaired_turns(turns: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                   long_rows: int = 20_000, long_bytes: int = 64 << 20) -> DataFrame:
    """The repaired turns: (conv_col, position from 0, role, text)."""
    ship_code(turns.sparkSession)
    short, long = _split(turns, conv_col, turn_col, role_col, text_col, long_rows, long_bytes)
    id_type = short.schema["conv"].dataType.simpleString()
    done = short.mapInArrow(_whole(True), f"conv {id_type}, {REPORT}, repaired_sha256 string, turns array<struct<role:string,text:string>>").select(
        F.col("conv").alias(conv_col), F.posexplode("turns").alias("position", "t")).select(conv_col, F.col("position").cast("long"), "t.role", "t.text")
    if long is not None:
        numbered = ordered_row_number(_long(long)[1], [F.col("conv").asc_nulls_first(), F.col("at"), F.col("k")], "n", store=materialise)
        starts = numbered.groupBy("conv").agg(F.min("n").alias("start")).select(F.col("conv").alias("of"), "start")
        done = done.unionByName(numbered.join(starts, F.col("conv").eqNullSafe(F.col("of"))).select(F.col("conv").alias(conv_col), (F.col("n") - F.col("start")).alias("position"), "role", "text"))
    return done
