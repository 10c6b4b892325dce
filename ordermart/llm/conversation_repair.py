"""Conversation structure repair by Four-Russians block tables.

A repaired conversation reads, by role initials, ``(s?(ua)+)?``: an optional
system turn, then user and assistant in turn.  Edits a row: Keep (0), Rerole to
user or assistant (1), Delete (2, forced for blank and duplicate rows); an empty
user or assistant row may be Inserted anywhere (5); a truncated row that stays
costs 5 more.  The cheapest edits are found on an automaton of four states
(start, after system, after user, after assistant) over nine row symbols.

The vector of the four costs, less its minimum and with entries of no use cut
to infinity, takes few values.  For every such vector and every block of
``BLOCK`` symbols the next vector and the cost added are tabled once a worker
process, so a conversation goes forward by one look-up a block.  Then its blocks
are expanded backward: the states on some cheapest path are marked at each row,
ties included, and reading the marks forward with the ASCII-least edit first
gives the least of all cheapest edit strings (edits lead from a state to one
state, so equal strings are equal repairs).

An entry is of no use when it exceeds the minimum by more than ``USELESS``: any
state reaches what another does for at most 10 more (F3 <= F0 + 2, F3 <= F1,
F2 <= F3 + 5, F1 <= F2 + 5, F0 <= F1, F0 <= F2 + 5, F1 <= F3 + 10).

Rows are shuffled by conversation twice: without texts for faults and edits (a
conversation is held as three bytes a row), then with texts beside the edits,
folded as a stream in order, so the memory of a task does not grow with a
conversation's texts.

Defined cases: null conv_ids form one conversation; a null role or text is one
space; turns sort null first, ties by the MD5 of role and text; ids without rows
give zeros and empty results; a role counts by its first character, an empty
one as any other role; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from itertools import product

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

BLOCK = 3
USELESS = 10
INF = 99
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5

START, SYSTEM, USER, ASSISTANT = range(4)
ACCEPT = (START, ASSISTANT)
#: Where a user or assistant row leads from each state.
NEXT = (USER, USER, ASSISTANT, USER)
#: Where a kept row of each initial leads; o: any other.
KEPT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}, "o": {}}
#: Row symbols: 0 must go, then (initial, truncated).
SYMBOLS = [None, *product("suao", (False, True))]
CODE = {s: i for i, s in enumerate(SYMBOLS)}

_SPACE = " \t\n\x0b\x0c\r"
_PLAN = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def edges(symbol: int) -> list[tuple[str, int, int, int]]:
    """(edit, from, to, cost) of each edit of a row, ASCII-least edit first."""
    out = [("D", s, s, DELETE) for s in range(4)]
    if SYMBOLS[symbol] is not None:
        initial, truncated = SYMBOLS[symbol]
        more = TRUNCATED if truncated else 0
        out += [("K", s, t, KEEP + more) for s, t in KEPT[initial].items()]
        out += [("R", s, NEXT[s], REROLE + more) for s in range(4)]
    return out


EDGES = [edges(i) for i in range(len(SYMBOLS))]


def closed(costs: list[int]) -> list[int]:
    """Costs with insertions."""
    c = list(costs)
    c[USER] = min(c[USER], min(c[s] for s in (START, SYSTEM, ASSISTANT)) + INSERT)
    c[ASSISTANT] = min(c[ASSISTANT], c[USER] + INSERT)
    return c


def normal(costs: list[int]) -> tuple[tuple[int, ...], int]:
    low = min(costs)
    return tuple(c - low if c - low <= USELESS else INF for c in costs), low


class Tables:
    """The vectors, and their transitions by symbol and by block of symbols."""

    def __init__(self, block: int = BLOCK) -> None:
        self.block = block
        first = normal(closed([0, INF, INF, INF]))[0]
        self.vectors, ids = [first], {first: 0}
        self.one: list[list[tuple[int, int]]] = []  # [vector][symbol] -> (vector, cost)
        while len(self.one) < len(self.vectors):  # every vector that can occur
            v, row = self.vectors[len(self.one)], []
            for es in EDGES:
                costs = [INF] * 4
                for _, s, t, c in es:
                    costs[t] = min(costs[t], v[s] + c)
                to, more = normal(closed(costs))
                if to not in ids:
                    ids[to] = len(self.vectors)
                    self.vectors.append(to)
                row.append((ids[to], more))
            self.one.append(row)
        self.many: list[dict[bytes, tuple[int, int]]] = []  # [vector][block]
        for v in range(len(self.vectors)):
            reach = {b"": (v, 0)}
            for _ in range(block):
                reach = {k + bytes([x]): (self.one[u][x][0], c + self.one[u][x][1]) for k, (u, c) in reach.items() for x in range(len(SYMBOLS))}
            self.many.append(reach)
        self._back: dict[tuple[int, int, int], int] = {}

    def inserted(self, v: int, marks: int) -> int:
        """``marks`` with the states from which an insertion leads there."""
        c = self.vectors[v]
        for s in (ASSISTANT, USER, SYSTEM, START, ASSISTANT):
            if marks >> NEXT[s] & 1 and c[s] < INF and c[s] + INSERT == c[NEXT[s]]:
                marks |= 1 << s
        return marks

    def back(self, v: int, symbol: int, marks: int) -> int:
        """The states before a row on cheapest paths to ``marks`` after it."""
        key = (v, symbol, marks)
        if key not in self._back:
            to, more = self.one[v][symbol]
            a, b = self.vectors[v], self.vectors[to]
            out = 0
            for _, s, t, c in EDGES[symbol]:
                if marks >> t & 1 and a[s] < INF and a[s] + c == b[t] + more:
                    out |= 1 << s
            self._back[key] = self.inserted(v, out)
        return self._back[key]

    def repair(self, symbols: bytes) -> tuple[int, str]:
        """(least cost, ASCII-least cheapest edits) of a conversation."""
        n, b = len(symbols), self.block
        bounds, total = [0], 0  # the vector at each block's begin
        whole = n - n % b
        for i in range(0, whole, b):
            v, more = self.many[bounds[-1]][symbols[i : i + b]]
            bounds.append(v)
            total += more
        last = bounds[-1]
        for x in symbols[whole:]:
            last, more = self.one[last][x]
            total += more
        costs = self.vectors[last]
        best = min(costs[s] for s in ACCEPT)
        at, marks = bytearray(2 * (n + 1)), bytearray(n + 1)  # vector and marks at each row
        at[2 * n : 2 * n + 2] = last.to_bytes(2, "big")
        marks[n] = self.inserted(last, sum(1 << s for s in ACCEPT if costs[s] == best))
        for k in range(len(bounds) - 1, -1, -1):  # expand the blocks backward
            lo, hi = k * b, min(n, k * b + b)
            v = bounds[k]
            for i in range(lo, hi):
                at[2 * i : 2 * i + 2] = v.to_bytes(2, "big")
                v = self.one[v][symbols[i]][0]
            for i in range(hi - 1, lo - 1, -1):
                marks[i] = self.back(int.from_bytes(at[2 * i : 2 * i + 2], "big"), symbols[i], marks[i + 1])
        return total + best, self._read(symbols, at, marks, best)

    def _read(self, symbols: bytes, at: bytearray, marks: bytearray, best: int) -> str:
        out, s, i, n = [], START, 0, len(symbols)
        while True:
            v = int.from_bytes(at[2 * i : 2 * i + 2], "big")
            a = self.vectors[v]
            edit, to = "", s
            if i < n:
                w, more = self.one[v][symbols[i]]
                b = self.vectors[w]
                tight = [(e, t) for e, f, t, c in EDGES[symbols[i]] if f == s and marks[i + 1] >> t & 1 and a[s] + c == b[t] + more]
                edit, to = tight[0] if tight else ("", s)
            elif s in ACCEPT and a[s] == best:
                return "".join(out)
            if edit != "D" and marks[i] >> NEXT[s] & 1 and a[s] + INSERT == a[NEXT[s]]:
                edit, to = "I", NEXT[s]
            out.append(edit)
            i += edit != "I"
            s = to


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, known, turn, role, text, dropped): rows with faults put in by
    crc32 of ``conv_id:turn`` modulo 20.  0 drops the row (marked only, so its
    id stays), 1 empties the text, 2 takes out ``[.!?]``, 3 repeats the row, 4
    sets role user."""
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    what = (F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn")).cast("binary")) % 20).cast("int")
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), text_of("role").alias("role"), text_of("text").alias("text"), what.alias("what"))
    text = F.when(F.col("what") == 1, F.lit("")).when(F.col("what") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("what") == 4, F.lit("user")).otherwise(F.col("role"))
    return rows.select(
        "conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("what") == 0).alias("dropped"),
        F.explode(F.when(F.col("what") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("__copy"),
    ).drop("__copy")


def _ordered(rows: DataFrame) -> DataFrame:
    """Rows with their order keys inside a conversation."""
    return rows.withColumns({
        "known": F.col("turn").isNotNull(), "tie": F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))),
    })


@cache
def tables() -> Tables:
    """The tables of this process (149 vectors by 729 blocks)."""
    return Tables()


def _plans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", *(c.split()[0] for c in _PLAN.split(", "))]
    done: list[tuple] = []
    none = object()
    conv, symbols, counts, illegal, prev, least, turn, distinct = none, bytearray(), [0] * 4, 0, None, None, None, 0

    def close() -> None:
        cost, audit = tables().repair(bytes(symbols))
        done.append((conv, turn - least + 1 - distinct if distinct else 0, *counts[1:], illegal, cost, audit))

    def batch() -> pa.RecordBatch:
        cols = list(zip(*done, strict=True)) or [()] * len(names)
        out = pa.RecordBatch.from_arrays([pa.array(c, pa.string() if k == "audit" else pa.int64()) for c, k in zip(cols, names, strict=True)], names)
        done.clear()
        return out

    for b in batches:
        for c, t, initial, fault, dropped in zip(*(b.column(k).to_pylist() for k in ("conv_id", "turn", "initial", "fault", "dropped")), strict=True):
            if c != conv:
                if conv is not none:
                    close()
                conv, symbols, counts, illegal, prev, least, turn, distinct = c, bytearray(), [0] * 4, 0, None, None, None, 0
            if dropped:
                continue
            if t is not None and t != turn:
                least, turn, distinct = t if least is None else least, t, distinct + 1
            counts[fault] += 1
            illegal += prev is not None and prev + initial not in ("su", "ua", "au")
            prev = initial
            symbols.append(0 if fault in (1, 2) else CODE[initial if initial in ("s", "u", "a") else "o", fault == 3])
        if len(done) >= 10_000:
            yield batch()
    if conv is not none:
        close()
    yield batch()


def plan(rows: DataFrame) -> DataFrame:
    """Faults, least cost and edits of each conversation of ``rows`` (conv_id,
    turn, role, text, dropped)."""
    small = _ordered(rows).select(
        "conv_id", "known", "turn", "tie", "dropped", F.substring("role", 1, 1).alias("initial"),
        F.rtrim(F.col("text"), F.lit(_SPACE)).alias("t"),
    ).select("conv_id", "known", "turn", "tie", "dropped", "initial", (F.col("t") == "").alias("blank"), (~F.substring("t", -1, 1).isin(".", "!", "?")).alias("cut"))
    dealt = small.repartition("conv_id").selectExpr("*", "row_number() OVER (PARTITION BY conv_id, dropped, tie ORDER BY known, turn) > 1 AS again")
    fault = F.when(F.col("blank"), 1).when(F.col("again"), 2).when(F.col("cut"), 3).otherwise(0)
    ordered = dealt.select("conv_id", "known", "turn", "tie", "initial", fault.alias("fault"), "dropped", "again").sortWithinPartitions("conv_id", "known", "turn", "tie", "again")
    return ordered.mapInArrow(_plans, f"conv_id long, {_PLAN}")


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A conversation's edits, then its rows in order -> repaired lines, folded."""
    names = ["conv_id", *(c.split()[0] for c in _PLAN.split(", ")), "repaired_sha256"]
    done: list[tuple] = []
    head, audit, i, state, lines, text = None, "", 0, START, 0, None

    def line(role: str, own: str) -> None:
        nonlocal lines
        text.update(f"{chr(10) if lines else ''}{role}:{own}".encode())
        lines += 1

    def placed() -> str:
        """The role of a row set in place at this state."""
        return "assistant" if state == USER else "user"

    def insertions() -> None:
        nonlocal i, state
        while i < len(audit) and audit[i] == "I":
            line(placed(), "")
            i, state = i + 1, NEXT[state]

    def close() -> None:
        if head is not None:
            insertions()
            done.append((*head, text.hexdigest()))

    def batch() -> pa.RecordBatch:
        cols = list(zip(*done, strict=True)) or [()] * len(names)
        out = pa.RecordBatch.from_arrays([pa.array(c, pa.string() if k in ("audit", "repaired_sha256") else pa.int64()) for c, k in zip(cols, names, strict=True)], names)
        done.clear()
        return out

    for b in batches:
        heads = zip(*(b.column(k).to_pylist() for k in names[:-1]), strict=True)
        for kind, role, own, plan_row in zip(*(b.column(k).to_pylist() for k in ("kind", "role", "text")), heads, strict=True):
            if kind == 0:
                close()
                head, audit, i, state, lines, text = plan_row, plan_row[-1], 0, START, 0, hashlib.sha256()
                continue
            insertions()
            edit, i = audit[i], i + 1
            if edit == "R":
                line(placed(), own)
                state = NEXT[state]
            elif edit == "K":
                line(role, own)
                state = KEPT[role[0]][state]
        if len(done) >= 10_000:
            yield batch()
    close()
    yield batch()


def repair(rows: DataFrame) -> DataFrame:
    """Each conversation of ``rows`` (conv_id, turn, role, text, dropped) with
    its faults, its cheapest edits and the digest of the repaired lines."""
    plans = cut(plan(rows), "repair-plans")
    plan_cols = [c.split()[0] for c in _PLAN.split(", ")]
    none = [F.lit(None).cast(t).alias(c) for c, t in (x.split() for x in _PLAN.split(", "))]
    heads = plans.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("boolean").alias("known"), F.lit(None).cast("long").alias("turn"), F.lit(None).cast("binary").alias("tie"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"), *plan_cols)
    own = _ordered(rows.where("not dropped")).select("conv_id", F.lit(1).alias("kind"), "known", "turn", "tie", "role", "text", *none)
    both = heads.unionByName(own).repartition("conv_id").sortWithinPartitions("conv_id", "kind", "known", "turn", "tie")
    return both.select("conv_id", "kind", "role", "text", *plan_cols).mapInArrow(_apply, f"conv_id long, {_PLAN}, repaired_sha256 string")
