"""Repair of conversation structure: the cheapest edits that make roles alternate.

A conversation of n rows spans a lattice of n + 1 layers with four states each:
nothing yet, a system row, a user row, an assistant row. Keeping, rerolling or
deleting a row leads one layer on, inserting an empty row stays in its layer. A
forward search from the start and a reverse search from both ends run over
heaps until no path could be cheaper than, or as cheap as, the best one that
crosses; all crossings of that cost are then joined, and the least string of
edit initials is taken. Two equal-cost ways to one node never hold each other
as a prefix, so each node needs only its least string.

Equal role and fault sequences have equal edits, so a worker keeps the answers
of the sequences it met last. Conversations above ``LONG_ROWS`` rows or
``LONG_BYTES`` take another way with the same result: their rows are ranked
over all tasks, blocks of ``BLOCK_ROWS`` rows are searched between every pair of
states, the blocks are joined, and the repaired lines stream through the hash.
Only the edits of a conversation, not its texts, are then held at once.

Decisions: rows of one turn stand by role, then text; repeated rows are
duplicates. Missing roles and texts are one space; a missing conversation id is
a conversation of its own. A role that is empty or has another initial than s,
u, a is never kept; initials are compared as written. Rows marked ``gone`` only
name their conversation. Other columns are not read. An empty table gives no
rows; long texts are only hashed.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import WHITE
from tabwright.operators.order import group_rank
from tabwright.session import written

DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5  # costs
DAMAGE_CASES = 20
LONG_ROWS = 2_000
LONG_BYTES = 16 << 20
BLOCK_ROWS = 256
CACHED = 100_000
CACHED_ROWS = 32  # longer sequences seldom come again
LEGAL = frozenset(("su", "ua", "au"))
ENDS = frozenset(".!?")
BEGIN, SYSTEM, USER, ASSISTANT = range(4)
STATES = (BEGIN, SYSTEM, USER, ASSISTANT)
NEXT = (USER, USER, ASSISTANT, USER)  # state after an inserted or rerolled row
KEEP = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
WORD = re.compile(r"[^\x20\x09-\x0D]")
GONE = "d"  # code of a row that must be deleted

REPAIRED = (
    "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
)


# ---- the lattice -----------------------------------------------------------------------------


def _onward(codes: str, i: int, state: int) -> list[tuple[int, str, int, int]]:
    """(cost, edit, layer, state) of the edits at a node; a code is a role initial, in upper case where truncated."""
    out = [(INSERT, "I", i, NEXT[state])]
    if i < len(codes):
        out.append((DELETE, "D", i + 1, state))
        code = codes[i]
        if code != GONE:
            extra = TRUNCATED if code.isupper() else 0
            kept = KEEP[state].get(code.lower())
            if kept is not None:
                out.append((extra, "K", i + 1, kept))
            out.append((REROLE + extra, "R", i + 1, NEXT[state]))
    return out


def _backward(codes: str, i: int, state: int) -> list[tuple[int, str, int, int]]:
    """(cost, edit, layer, state) of the edits that lead to a node."""
    out = []
    for before in STATES:
        for layer in (i - 1, i):
            if layer >= 0:
                out += [(c, e, layer, before) for c, e, j, s in _onward(codes, layer, before) if (j, s) == (i, state)]
    return out


def bidirectional(codes: str, start: int, ends: tuple[int, ...]) -> tuple[int, str] | None:
    """Least (cost, edits) from ``start`` before the first row to one of ``ends`` after the last; None where no way leads there."""
    n = len(codes)
    fore: dict = {}
    back: dict = {}
    # deeper layers first among equal costs in reverse, since keeping a row costs nothing
    front = [(0, 0, "", start)]
    rear = [(0, -n, "", s) for s in ends]
    heapq.heapify(rear)
    best = None
    while front and rear and (best is None or front[0][0] + rear[0][0] <= best):
        if front[0][0] <= rear[0][0]:
            cost, i, edits, state = heapq.heappop(front)
            if (i, state) in fore:
                continue
            fore[i, state] = (cost, edits)
            for c, e, j, s in _onward(codes, i, state):
                if (j, s) not in fore:
                    heapq.heappush(front, (cost + c, j, edits + e, s))
        else:
            cost, i, edits, state = heapq.heappop(rear)
            i = -i
            if (i, state) in back:
                continue
            back[i, state] = (cost, edits)
            for c, e, j, s in _backward(codes, i, state):
                if (j, s) not in back:
                    heapq.heappush(rear, (cost + c, -j, e + edits, s))
        if (i, state) in fore and (i, state) in back:
            met = fore[i, state][0] + back[i, state][0]
            best = met if best is None else min(best, met)
    crossings = []
    for (i, state), (cost, edits) in fore.items():
        if (i, state) in back:
            far, rest = back[i, state]
            crossings.append((cost + far, edits + rest))
        for c, e, j, s in _onward(codes, i, state):
            if (j, s) in back:
                far, rest = back[j, s]
                crossings.append((cost + c + far, edits + e + rest))
    return min(crossings, default=None)


_cached = lru_cache(maxsize=CACHED)(bidirectional)


def cheapest(codes: str) -> tuple[int, str]:
    """Cost and initials of the edits of a whole conversation."""
    find = _cached if len(codes) <= CACHED_ROWS else bidirectional
    return find(codes, BEGIN, (BEGIN, ASSISTANT))


@lru_cache(maxsize=CACHED // 100)
def block_ways(codes: str) -> list[tuple[int, int, int, str]]:
    """(state before, state after, cost, edits) of a block of rows between every pair of states."""
    found = [(a, b, bidirectional(codes, a, (b,))) for a in STATES for b in STATES]
    return [(a, b, *way) for a, b, way in found if way is not None]


def code_of(role: str, fault: str | None) -> str:
    """One character for a row: what the lattice must know of it."""
    if fault in ("blank", "duplicate"):
        return GONE
    initial = role[:1] if role[:1] in ("s", "u", "a") else "x"
    return initial.upper() if fault == "truncated" else initial


def edited(edits: str, rows: Iterator[tuple[str, str]], state: int = BEGIN) -> Iterator[str]:
    """``role:text`` of every row that the edits leave."""
    names = {USER: "user", ASSISTANT: "assistant"}
    for edit in edits:
        if edit == "I":
            state = NEXT[state]
            yield f"{names[state]}:"
            continue
        role, text = next(rows)
        if edit == "K":
            state = KEEP[state][role[0]]
            yield f"{role}:{text}"
        elif edit == "R":
            state = NEXT[state]
            yield f"{names[state]}:{text}"


# ---- rows ------------------------------------------------------------------------------------


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, gone): rows dropped, emptied, cut, repeated or given to the user by their checksum."""
    spelled = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    case = F.pmod(F.crc32(F.concat_ws(":", *spelled).cast("binary")), F.lit(DAMAGE_CASES))
    rows = conversations.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        case.alias("case"),
    )
    text = F.when(F.col("case") == 1, "").when(F.col("case") == 2, F.regexp_replace("text", "[.!?]", ""))
    copies = F.when(F.col("case") == 3, 2).otherwise(1)
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("case") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.otherwise(F.col("text")).alias("text"),
        (F.col("case") == 0).alias("gone"),
        F.explode(F.array_repeat(F.lit(0), copies)).alias("copy"),
    ).drop("copy")


def _first_fault(role: str, text: str, seen: set) -> str | None:
    if not WORD.search(text):
        fault = "blank"
    elif (role, text) in seen:
        fault = "duplicate"
    else:
        fault = None if text.rstrip(WHITE)[-1] in ENDS else "truncated"
    seen.add((role, text))
    return fault


def _report(rows: list[tuple]) -> tuple:
    """The columns of ``REPAIRED`` for the rows (turn, role, text) of one conversation in order."""
    seen: set = set()
    faults = [_first_fault(role, text, seen) for _, role, text in rows]
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    initials = [role[:1] for _, role, _ in rows]
    illegal = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))
    cost, edits = cheapest("".join(map(code_of, (r for _, r, _ in rows), faults)))
    lines = "\n".join(edited(edits, ((r, t) for _, r, t in rows)))
    return (
        gaps,
        faults.count("blank"),
        faults.count("duplicate"),
        faults.count("truncated"),
        illegal,
        cost,
        edits,
        hashlib.sha256(lines.encode()).hexdigest(),
    )


def _whole(rows: DataFrame) -> DataFrame:
    """Reports of conversations that a task may hold one at a time."""
    kind = rows.schema["conv_id"].dataType.simpleString()

    def work(batches: Iterator) -> Iterator:
        import pyarrow as pa

        schema = None

        def flush(done: list):
            columns = [list(c) for c in zip(*done)]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema)], names)

        names = ["conv_id", *[c.split(" ")[0] for c in REPAIRED.split(", ")]]
        current, held, done = None, None, []
        for batch in batches:
            schema = schema or [batch.schema.field("conv_id").type, *[pa.int64()] * 6, pa.string(), pa.string()]
            for conv, turn, role, text, gone in zip(*[c.to_pylist() for c in batch.columns]):
                if held is None or conv != current:
                    if held is not None:
                        done.append((current, *_report(held)))
                    current, held = conv, []
                if not gone:
                    held.append((turn, role, text))
            if done:
                yield flush(done)
                done = []
        if held is not None:
            yield flush([(current, *_report(held))])

    dealt = rows.repartition("conv_id").sortWithinPartitions(
        F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", "text"
    )
    return dealt.mapInArrow(work, f"conv_id {kind}, {REPAIRED}")


# ---- long conversations ----------------------------------------------------------------------


def _coded(rows: DataFrame) -> DataFrame:
    """(key, at, turn, role, text, fault, code) of the rows of long conversations, ranked over all tasks."""
    # rows of one place in the order are equal, so a rank may fall to either
    placed = written(group_rank(rows, "key", [F.asc_nulls_first("turn"), F.col("role"), F.col("text")], "at"), "repair-rows")
    first = placed.groupBy("key", "role", "text").agg(F.min("at").alias("at")).select("key", "at", F.lit(True).alias("fresh"))
    marked = placed.join(first, ["key", "at"], "left")
    white = r"[\x20\x09-\x0D]"
    fault = (
        F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), "blank")
        .when(F.col("fresh").isNull(), "duplicate")
        .when(~F.col("text").rlike(rf"[.!?]{white}*\z"), "truncated")
    )
    initial = F.substring("role", 1, 1)
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    code = (
        F.when(F.col("fault").isin("blank", "duplicate"), GONE)
        .when(F.col("fault") == "truncated", F.upper(known))
        .otherwise(known)
    )
    return marked.withColumn("fault", fault).withColumn("code", code).drop("fresh")


def _joined_ways(blocks: DataFrame) -> DataFrame:
    """(key, block, state, edits, cost): the way of every block in the least way through the whole conversation."""

    def work(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def close():
            ends = [best[s] for s in (BEGIN, ASSISTANT) if s in best]
            cost, edits, pieces = min(ends)
            out = []
            while pieces is not None:
                pieces, block, state, piece = pieces
                out.append((current, block, state, piece, cost))
            return out

        names = ["key", "block", "state", "edits", "cost"]
        types = [pa.string(), pa.int64(), pa.int32(), pa.string(), pa.int64()]

        def rows_of(done):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(map(list, zip(*done)), types)], names)

        current, best = None, None
        for batch in batches:
            for key, block, codes in zip(*[c.to_pylist() for c in batch.columns]):
                if key != current:
                    if best is not None:
                        yield rows_of(close())
                    current, best = key, {BEGIN: (0, "", None)}
                ahead: dict = {}
                for a, b, cost, edits in block_ways(codes):
                    if a in best:
                        so_far, before, pieces = best[a]
                        way = (so_far + cost, before + edits)
                        if b not in ahead or way < ahead[b][:2]:
                            ahead[b] = (*way, (pieces, block, a, edits))
                best = ahead
        if best is not None:
            yield rows_of(close())

    dealt = blocks.select("key", "block", "codes").repartition("key").sortWithinPartitions("key", "block")
    return dealt.mapInArrow(work, "key string, block long, state int, edits string, cost long")


def _line_places(coded: DataFrame, ways: DataFrame) -> DataFrame:
    """(key, at, part, head, kept): what becomes of each row, and inserted lines after the row at ``at``."""

    def work(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            out = []
            for key, block, state, edits, codes in zip(*[c.to_pylist() for c in batch.columns]):
                at, part = block * BLOCK_ROWS, 0
                for edit in edits:
                    if edit == "I":
                        state, part = NEXT[state], part + 1
                        out.append((key, at, part, "user" if state == USER else "assistant", True))
                        continue
                    code, at, part = codes[at - block * BLOCK_ROWS].lower(), at + 1, 0
                    if edit == "D":
                        out.append((key, at, 0, None, False))
                    elif edit == "K":
                        state = KEEP[state][code]
                        out.append((key, at, 0, None, True))
                    else:
                        state = NEXT[state]
                        out.append((key, at, 0, "user" if state == USER else "assistant", True))
            types = [pa.string(), pa.int64(), pa.int32(), pa.string(), pa.bool_()]
            columns = zip(*out) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(columns, types)], ["key", "at", "part", "head", "kept"]
            )

    both = ways.join(coded, ["key", "block"]).select("key", "block", "state", "edits", "codes")
    return both.mapInArrow(work, "key string, at long, part int, head string, kept boolean")


def _hashed(lines: DataFrame) -> DataFrame:
    """(key, illegal, repaired_sha256) from lines in order; only the running hash is held."""

    def work(batches: Iterator) -> Iterator:
        import pyarrow as pa

        current, digest, begun, last, illegal, done = None, None, False, None, 0, []

        def flush(rows):
            columns = [pa.array(list(c), t) for c, t in zip(zip(*rows), [pa.string(), pa.int64(), pa.string()])]
            return pa.RecordBatch.from_arrays(columns, ["key", "illegal", "repaired_sha256"])

        for batch in batches:
            for key, part, line, role in zip(*[c.to_pylist() for c in batch.columns]):
                if digest is None or key != current:
                    if digest is not None:
                        done.append((current, illegal, digest.hexdigest()))
                    current, digest, begun, last, illegal = key, hashlib.sha256(), False, None, 0
                if line is not None:
                    digest.update(("\n" if begun else "").encode() + line.encode())
                    begun = True
                if part == 0:
                    illegal += last is not None and last + role[:1] not in LEGAL
                    last = role[:1]
            if done:
                yield flush(done)
                done = []
        if digest is not None:
            yield flush([(current, illegal, digest.hexdigest())])

    dealt = lines.repartition("key").sortWithinPartitions("key", "at", "part").select("key", "part", "line", "role")
    return dealt.mapInArrow(work, "key string, illegal long, repaired_sha256 string")


def _in_blocks(rows: DataFrame) -> DataFrame:
    """Reports of long conversations; their rows are not held together."""
    key = F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit("n"))
    coded = written(_coded(rows.withColumn("key", key)), "repair-codes")
    block = F.floor((F.col("at") - 1) / BLOCK_ROWS)
    listed = F.array_sort(F.collect_list(F.struct("at", "code")))  # BLOCK_ROWS at most
    codes = F.array_join(F.transform(listed, lambda x: x["code"]), "")
    blocks = written(coded.groupBy("key", block.alias("block")).agg(codes.alias("codes")), "repair-blocks")
    ways = written(_joined_ways(blocks), "repair-ways")
    places = _line_places(blocks, ways)
    text = F.concat(F.coalesce("head", "role"), F.lit(":"), F.when(F.col("part") == 0, F.col("text")).otherwise(""))
    lines = places.join(coded.select("key", "at", "role", "text"), ["key", "at"], "left").select(
        "key", "at", "part", "role", F.when(F.col("kept"), text).alias("line")
    )
    counts = coded.groupBy("key").agg(
        F.first("conv_id", ignorenulls=True).alias("conv_id"),
        *[F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")],
    )
    turns = coded.filter(F.col("turn").isNotNull()).select("key", "turn").distinct()
    gaps = turns.groupBy("key").agg((F.max("turn") - F.min("turn") + 1 - F.count(F.lit(1))).alias("gaps"))
    pieces = F.array_sort(F.collect_list(F.struct("block", "edits")))  # the edits are one value of the result
    audits = ways.groupBy("key").agg(
        F.first("cost").alias("cost"), F.array_join(F.transform(pieces, lambda x: x["edits"]), "").alias("audit")
    )
    joined = counts.join(gaps, "key", "left").join(audits, "key").join(_hashed(lines), "key")
    return joined.select(
        "conv_id", F.coalesce("gaps", F.lit(0)).alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"
    )


def repair(rows: DataFrame, long_rows: int = LONG_ROWS, long_bytes: int = LONG_BYTES) -> DataFrame:
    """One row per conversation: its faults, the cheapest edits, and the hash of what they leave.

    ``rows`` has conv_id, turn, role, text and gone.
    """
    size = F.sum(F.octet_length("role") + F.octet_length("text"))
    large = rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), size.alias("b"))
    large = written(large.filter((F.col("n") > long_rows) | (F.col("b") > long_bytes)).select("conv_id"), "repair-long")
    if large.isEmpty():
        return _whole(rows)
    same = F.col("conv_id").eqNullSafe(F.col("large"))
    named = large.withColumnRenamed("conv_id", "large")
    there = rows.join(named, same, "left_semi").filter("NOT gone")
    reports = _whole(rows.join(named, same, "left_anti")).unionByName(_in_blocks(there))
    # a long conversation whose rows are all gone still has its line
    gone = large.join(there.select(F.col("conv_id").alias("large")).distinct(), same, "left_anti")
    return reports.unionByName(_whole(gone.selectExpr("conv_id", "0L AS turn", "'' AS role", "'' AS text", "true AS gone")))
