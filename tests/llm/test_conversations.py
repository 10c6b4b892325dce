"""Conversation trie, repair and formatting against plain Python and SQL."""

import hashlib
import math
import os
import random
import re
import sys
import zlib
from collections import defaultdict

import duckdb
import pytest

from ordermart.llm import chat_format, conversation_queries, conversation_repair, conversation_trie

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from parity import key, norm  # noqa: E402

SCHEMA = "conv_id long, turn long, role string, text string"


def digest(role, text):
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def conversations(llm, rows):
    """With extra columns that clash with names used inside."""
    return llm.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' as id", "1 as n", "true as dropped", "'y' as sig", "2 as seq", "'z' as event", "3 as what")


def random_rows(seed, roles, texts, ids=range(-15, 60), longest=14):
    rnd = random.Random(seed)
    return [(i, t, rnd.choice(roles), rnd.choice(texts)) for i in ids for t in rnd.choices([None, *range(12)], k=rnd.randint(1, longest))]


def collected(df):
    return sorted(map(tuple, df.collect()), key=str)


# --- trie --------------------------------------------------------------------

def plain_trie(rows):
    by = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            by[c].append((t is not None, t or 0, digest(r, x), r, x))
    seqs, members, kids = {}, defaultdict(list), defaultdict(int)
    for v in by.values():
        v.sort()
    for c, own in by.items():
        h = zlib.crc32(str(c).encode()) % 9
        seqs[c] = tuple(x[3:] for x in by.get(c - int(math.fmod(c, 5)), [])[:h] + own[h:])
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    for p in members:
        if p:
            kids[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += kids[p] == 0
            saved[p[:d]] += (len(m) - 1) * (len(p[-1][1].encode()) if p else 0)
    ends = lambda p: ",".join(str(c) for c in sorted(members[p]) if len(seqs[c]) == len(p))
    return sorted(((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p], sha(ends(p))) for p, m in members.items()), key=str)


def test_fattest():
    zeros = lambda n: (n & -n).bit_length()
    for low in range(40):
        for high in range(low + 1, 41):
            assert conversation_trie.fattest(low, high) == max(range(low + 1, high + 1), key=zeros)


@pytest.mark.parametrize("batch", [1, 3, 1000])
def test_zfast_trie_finds_every_exit_node(batch):
    rnd = random.Random(batch)
    keys = sorted({b"".join(bytes([rnd.randrange(2)]) * 16 for _ in range(rnd.randint(0, 40))) for _ in range(400)})
    rnd.shuffle(keys)
    trie = conversation_trie.ZFastTrie()
    for i in range(0, len(keys), batch):
        trie.insert_batch([(k, [1] * (len(k) // 16), 1, 0, "") for k in keys[i : i + batch]])
    nodes = {v: trie.path[v][: 16 * trie.end[v]] for v in range(len(trie.path))}
    assert len(set(nodes.values())) == len(nodes)
    extents = {p: v for v, p in nodes.items()}
    assert {conversation_trie.chain(k) for k in keys} <= extents.keys()
    for k in keys:
        assert trie.exit_node(conversation_trie.chain(k)) == extents[conversation_trie.chain(k)]
    for _ in range(300):  # also of sequences that are not there: the deepest edge that they enter
        path = conversation_trie.chain(b"".join(bytes([rnd.randrange(2)]) * 16 for _ in range(rnd.randint(0, 45))))
        common = lambda v: next((d for d in range(min(len(path) // 16, trie.end[v]), 0, -1) if trie.at(v, d) == path[16 * (d - 1) : 16 * d]), 0)  # noqa: E731, B023
        best = max(common(v) for v in nodes)
        got = trie.exit_node(path)
        assert common(got) == best and (trie.top[got] < best or best == 0 == got)


def test_trie(llm):
    rows = random_rows(1, ["u", "a", None], ["", "x", "yé", None], [*range(-20, 80), 10**15, 10**15 + 1, None])
    df = conversations(llm, rows)
    want = plain_trie(rows)
    assert collected(conversation_trie.rebuilt_trie(df)) == want
    settings = {"spark.sql.shuffle.partitions": "23", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: llm.conf.get(k) for k in settings}
    try:  # many ranges: many open nodes
        for k, v in settings.items():
            llm.conf.set(k, v)
        assert collected(conversation_trie.rebuilt_trie(df)) == want
    finally:
        for k, v in before.items():
            llm.conf.set(k, v)


def test_trie_of_copies_and_long_conversations(llm):
    hot = [(c, t, "user", f"t{t}") for c in range(3000) for t in range(3)]
    long = [(c, t, "user", "same" if t % 3 else str(t)) for c in (9_000, 9_001, 9_004) for t in range(700)]
    assert collected(conversation_trie.rebuilt_trie(conversations(llm, hot + long))) == plain_trie(hot + long)


def test_trie_of_nothing(llm):
    assert conversation_trie.rebuilt_trie(conversations(llm, [])).count() == 0
    assert conversation_trie.rebuilt_trie(conversations(llm, [(None, 1, "user", "x")])).count() == 0


# --- repair ------------------------------------------------------------------

def plain_repair(rows):
    """(cost, edits, lines) of (role, text, fault) rows, row by row over the states."""

    def inserted(c):
        c = dict(c)
        for states, to, role in (((0, 1, 3), 2, "user"), ((2,), 3, "assistant")):
            for s in states:
                if s in c:
                    x = (c[s][0] + 5, c[s][1] + "I", c[s][2] + [(role, "")])
                    c[to] = min(c.get(to, x), x)
        return c

    c = inserted({0: (0, "", [])})
    for role, text, fault in rows:
        options = defaultdict(list)
        for s, (cost, edits, lines) in c.items():
            options[s].append((cost + 2, edits + "D", lines))
            if fault in (1, 2):
                continue
            cost += 5 * (fault == 3)
            to = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}.get((s, role[:1]))
            if to is not None:
                options[to].append((cost, edits + "K", lines + [(role, text)]))
            options[3 if s == 2 else 2].append((cost + 1, edits + "R", lines + [("assistant" if s == 2 else "user", text)]))
        c = inserted({s: min(v) for s, v in options.items()})
    return min(c[s] for s in (0, 3) if s in c)


def plain_repairs(rows):
    by = defaultdict(list)
    for c, t, r, x in rows:
        r, x = (" " if v is None else v for v in (r, x))
        what = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        x = "" if what == 1 else re.sub("[.!?]", "", x) if what == 2 else x
        r = "user" if what == 4 else r
        by[c] += [(t is not None, t or 0, digest(r, x), r, x, t)] * (0 if what == 0 else 1 + (what == 3))
    out = []
    for c, v in by.items():
        v.sort(key=lambda z: z[:3])
        seen, faults = set(), []
        for *_, r, x, _ in v:
            bare = x.rstrip(" \t\n\x0b\x0c\r")
            faults.append(1 if not bare else 2 if (r, x) in seen else 3 if bare[-1] not in ".!?" else 0)
            seen.add((r, x))
        turns = [z[5] for z in v if z[5] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[3][:1] + b[3][:1] not in ("su", "ua", "au") for a, b in zip(v, v[1:], strict=False))
        cost, edits, lines = plain_repair([(z[3], z[4], f) for z, f in zip(v, faults, strict=True)])
        out.append((c, gaps, *(faults.count(k) for k in (1, 2, 3)), illegal, cost, edits, sha("\n".join(f"{r}:{x}" for r, x in lines))))
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [1, 2, 3])
def test_block_tables_give_the_least_cost_and_edits(block):
    tables, rnd = conversation_repair.Tables(block), random.Random(block)
    role = {"s": "system", "u": "user", "a": "assistant", "o": "tool"}
    for _ in range(4000):
        symbols = bytes(rnd.randrange(9) for _ in range(rnd.randint(0, 13)))
        rows = [("x", "", 1) if x == 0 else (role[conversation_repair.SYMBOLS[x][0]], "t", 3 * conversation_repair.SYMBOLS[x][1]) for x in symbols]
        assert tables.repair(symbols) == plain_repair(rows)[:2]


def test_long_conversation_is_repaired_in_blocks():
    cost, edits = conversation_repair.tables().repair(bytes([3, 5] * 50_000))
    assert cost == 0 and edits == "K" * 100_000


def test_repair(llm):
    rows = random_rows(2, ["user", "assistant", "system", "tool", "", None, "uncle"], ["a.", "b! \n", "yé", None, "c?", "d.", "e.", "f", "  ", ""], [*range(-20, 150), None])
    rows += [(900, t, "user", "no end") for t in (1, 1, 1, 2)] + [(901, None, "user", None), (902, 5, "assistant", "x" * 200_000 + ".")]
    assert collected(conversation_repair.repair(conversation_repair.damage(conversations(llm, rows)))) == plain_repairs(rows)
    assert conversation_queries.repaired(conversations(llm, [])).count() == 0


# --- formatting --------------------------------------------------------------

BITS = ["\\", "<", ">", "turn", "/turn", "</turn>", "<turn ", " ", "\n", "é", "x", "\\\\", "<turn user>", "### Assistant:"]


def test_rendered_text_reads_back():
    rnd = random.Random(5)
    some = lambda k: "".join(rnd.choices(BITS, k=rnd.randint(0, k)))
    for _ in range(5000):
        turns = [(some(4) if rnd.random() < 0.3 else rnd.choice(["user", "assistant"]), some(8)) for _ in range(rnd.randint(0, 4))]
        text, loss = chat_format.render(turns)
        assert chat_format.parse(text) == turns
        assert [chat_format.unescape(text[a:b]) for a, b in loss] == [t for r, t in turns if r == "assistant"]


def plain_formats(rows):
    by = defaultdict(list)
    for c, t, r, x in [*rows, *((chat_format.PLANTED_ID, i, r, chat_format.PLANTED_TEXT) for i, r in enumerate(["user", "assistant"]))]:
        by[c].append((t is not None, t or 0, r or "", x or ""))
    out = []
    for c, v in by.items():
        turns = [z[2:] for z in sorted(v)]
        loss = "".join(x for r, x in turns if r == "assistant")
        out.append((c, len(v), sha("".join(f"{r}\n{x}\n" for r, x in turns)), len(loss), sha(loss), len(chat_format.render(turns)[0])))
    return sorted(out, key=str)


def test_formats(llm):
    rnd = random.Random(6)
    texts = [None, "", *("".join(rnd.choices(BITS, k=9)) for _ in range(20)), "z" * 1300, "é" * 90_000]
    rows = random_rows(3, ["user", "assistant", "system", "to>ol", "", None], texts, [*range(-20, 150), None])
    assert collected(chat_format.formatted_conversations(conversations(llm, rows))) == plain_formats(rows)
    assert collected(chat_format.formatted_conversations(conversations(llm, []))) == plain_formats([])


def test_events_fold(llm):
    """Deltas, edits, regenerations, copies delivered again, strays."""
    log = [
        (1, 10, "open", 1, "user", "he"), (1, 11, "delta", 1, None, "llo"), (1, 11, "delta", 1, None, "llo"), (1, 20, "open", 2, "assistant", None),
        (1, 21, "delta", 2, None, "bad"), (1, 30, "open", 3, "user", "what?"), (1, 31, "open", 4, "assistant", "sorry"), (1, 40, "regenerate", 2, None, None),
        (1, 41, "delta", 2, None, "good"), (1, 42, "delta", 3, None, "gone"), (1, 43, "edit", 1, None, "hello!"), (1, 44, "delta", 1, None, "!"), (1, 50, "other", 1, None, "-"),
        (1, 60, "open", 3, "user", "thanks"), (2, 5, "delta", 9, None, "stray"), (None, 1, "open", 1, None, "no id"), (None, None, "open", 0, "user", "first"),
    ]
    random.Random(1).shuffle(log)
    df = llm.createDataFrame(log, "conv_id long, seq long, event string, message long, role string, text string").selectExpr("*", "1 as formatted")
    got = {r["conv_id"]: (chat_format.parse(r["formatted"]), [r["formatted"][a:b] for a, b in r["loss"]]) for r in chat_format.format_log(df).collect()}
    assert got == {
        1: ([("user", "hello!!"), ("assistant", "good"), ("user", "thanks")], ["good"]),
        2: ([], []), None: ([("user", "first"), ("", "no id")], []),
    }
    assert chat_format.format_log(df.limit(0)).count() == 0


# --- SQL -----------------------------------------------------------------------

@pytest.mark.parametrize("name", sorted(conversation_queries.oracle_sql()))
def test_queries_equal_their_sql(llm, name):
    from ordermart.llm import queries

    sf = "/root/testdata/sf0.001"
    got = queries.queries()[name](llm, sf)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{sf}/conversations.parquet')")
    rel = con.sql(queries.oracle_sql()[name])
    assert sorted(rel.columns) == sorted(got.columns)
    cols = sorted(got.columns)
    want = sorted((tuple(norm(r[rel.columns.index(c)]) for c in cols) for r in rel.fetchall()), key=key)
    assert sorted((tuple(norm(r[c]) for c in cols) for r in got.collect()), key=key) == want
