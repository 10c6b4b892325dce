"""WARC, fingerprints, packing and sharding against plain Python."""

import base64
import contextlib
import gzip
import hashlib
import io
import itertools
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ordermart.llm import packing, sharding, syncmers, warc, word_bpe

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


# --- WARC -----------------------------------------------------------------------------

def pages(llm, rows):
    return llm.createDataFrame([(i, f"http://h/{i}" if i else None, h) for i, h in rows], "page_id long, url string, html string").selectExpr("*", "'x' as payload", "1 as n")


def test_round_trip(llm):
    rows = [(5, "<a>é</a>"), (3, "<a>é</a>"), (9, None), (8, ""), (1, "solo"), (2, "line\r\n\r\nbreaks"), (None, "solo"), (1, "solo")]
    got = warc.round_trip(pages(llm, rows)).collect()
    digest = lambda b: base64.b32encode(hashlib.sha1(b).digest()).decode()
    first = {}
    for i, h in rows:
        b = (h or "").encode()
        first[b] = min(x for x in (first.get(b), i) if x is not None)
    want = Counter()
    for i, h in rows:
        b = (h or "").encode()
        want[i, len(b), digest(b), "response" if first[b] == i else "revisit", None if first[b] == i else first[b]] += 1
    assert Counter(tuple(r) for r in got) == want
    assert warc.round_trip(pages(llm, [])).count() == 0


def test_headers_decide_before_payloads(llm, tmp_path):
    path = str(tmp_path / "w")
    warc.archive_pages(pages(llm, [(1, "x" * 100_000), (2, "x" * 100_000), (3, "y")]), path)
    df = warc.read_warc(llm, path, "record_id string, record_type string, position long").where("record_type = 'revisit'")
    assert [r["record_id"] for r in df.collect()] == ["<urn:page:2>"]
    files = [os.path.join(path, f) for f in os.listdir(path)]
    assert all(f.endswith(".warc.gz") and not os.path.basename(f).startswith(".") for f in files)

    class Counting:
        def __init__(self, data):
            self.data, self.at, self.used = data, 0, 0

        def seek(self, n):
            self.at = n

        def read(self, n):
            out = self.data[self.at : self.at + n]
            self.at += len(out)
            self.used += len(out)
            return out

    # the members' own lengths let a reader pass over payloads, and any gzip reader reads them
    noise = random.Random(1).randbytes(300_000)
    data = b"".join(warc.record([("WARC-Type", t), ("Content-Type", "text/plain")], noise + t.encode()) for t in ("response", "revisit", "response"))
    assert gzip.decompress(data).count(b"WARC/1.1") == 3
    stream = Counting(data)
    kept = list(warc.read_records(stream, len(data), lambda h: False, True))
    assert kept == [] and stream.used < len(data) / 2
    plain = gzip.decompress(data)
    for whole in (data, plain):
        got = [(h["warc-type"], b) for _, h, b in warc.read_records(Counting(whole), len(whole), lambda h: h["warc-type"] == "response", True)]
        assert got == [("response", noise + b"response")] * 2
    # members without the length are inflated: one for each record, one for all, or as they come
    edge = [m.start() for m in re.finditer(rb"WARC/1\.1\r\n", plain)] + [len(plain)]
    own = [plain[a:b] for a, b in itertools.pairwise(edge)]
    assert b"".join(own) == plain and len(own) == 3
    empty = warc.record([("WARC-Type", "response")], b"")
    for whole in (b"".join(map(gzip.compress, own)), gzip.compress(plain), gzip.compress(own[0]) + gzip.compress(own[1] + own[2]), empty + gzip.compress(plain) + data):
        all_types = [h["warc-type"] for _, h, _ in warc.read_records(Counting(whole), len(whole), lambda h: True, False)]
        assert all_types[-3:] == ["response", "revisit", "response"]
        got = [b for _, h, b in warc.read_records(Counting(whole), len(whole), lambda h: h["warc-type"] == "revisit", True)]
        assert got == [noise + b"revisit"] * (2 if whole.startswith(empty) else 1)
    with open(tmp_path / "one.warc.gz", "wb") as f:
        f.write(gzip.compress(b"".join(gzip.decompress(warc.record([("WARC-Type", "response"), ("WARC-Record-ID", str(k)), ("Content-Type", "text/plain")], b"p" * k)) for k in range(50))))
    rows = warc.read_warc(llm, str(tmp_path / "one.warc.gz"), "record_id string, payload_bytes long").collect()
    assert [(r["record_id"], r["payload_bytes"]) for r in rows] == [(str(k), k) for k in range(50)]


def test_the_query_pushes_the_record_type(llm):
    df = warc.round_trip(pages(llm, [(1, "a"), (2, "a"), (3, "b")]))
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    plan = buf.getvalue()
    assert plan.count("BatchScan warc") >= 2 and "Filter" not in plan.replace("PushedFilters", "").split("BatchScan")[0]
    assert sorted((r["page_id"], r["refers_to"]) for r in df.collect()) == [(1, None), (2, 1), (3, None)]


# --- fingerprints ------------------------------------------------------------------------

def prose(rng, n):
    return " ".join(rng.choice(["ba", "don", "ti", "kel", "mur", "sin"]) + rng.choice(["an", "o", "ert", "ish"]) + str(rng.randrange(99)) for _ in range(n))


def test_edits_and_neighbours(docs):
    rng = random.Random(9)
    rows = [(i * 3, prose(rng, rng.choice([1, 50, 400]))) for i in range(80)] + [(1000, None), (1001, ""), (1002, "x"), (1003, "a " * 5000)]
    rows.append((1004, rows[5][1]))
    rows.append((6, rows[2][1]))  # a repeated row
    got = syncmers.with_next(docs(rows, extra="ord at b")).collect()
    order = sorted(((i, t or "") for i, t in rows))
    want = Counter()
    for k, (i, t) in enumerate(order):
        nxt, half = order[(k + 1) % len(order)][1], len(t) // 2
        want[i, len(t), hashlib.sha256((t[: len(t) - half] + nxt[:half]).encode()).hexdigest()] += 1
    assert Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got) == want
    of = {r["doc_id"]: r for r in got}
    assert of[1004]["fingerprint"] == of[15]["fingerprint"] and of[1000]["fingerprint"] == ""
    long = [r for r in got if r["n_chars"] > 300 and r["doc_id"] < 900]
    assert all(0.25 < r["near_edited"] < 0.8 for r in long)
    assert sum(r["near_next"] > 0.2 for r in long) <= 1
    assert syncmers.with_next(docs([])).count() == 0
    one = syncmers.with_next(docs([(None, "abc")])).collect()
    assert one[0]["near_next"] == 1.0 and one[0]["edited_sha256"] == hashlib.sha256(b"aba").hexdigest()


def test_anchors_are_closed_syncmers():
    """Against the definition, k-mer by k-mer; and context-free."""
    text = prose(random.Random(3), 60)
    h, at = syncmers.anchors(text)
    k, s = syncmers.K, syncmers.S
    points = np.array([ord(c) for c in text], np.uint64) + np.uint64(1)
    inner = [int(syncmers.T.mix((points[i : i + s] * syncmers._C).sum(keepdims=True))[0]) for i in range(len(text) - s + 1)]
    want = [i for i in range(len(text) - k + 1) if min(inner[i : i + k - s + 1]) in (inner[i], inner[i + k - s])]
    assert at.tolist() == want
    moved, where = syncmers.anchors("something before " + text)
    assert set(h.tolist()) <= set(moved.tolist())
    piece = syncmers._PIECE
    try:
        syncmers._PIECE = 37
        again, places = syncmers.anchors(text)
    finally:
        syncmers._PIECE = piece
    assert again.tolist() == h.tolist() and places.tolist() == at.tolist()


def test_rows_of_one_id_are_dealt_to_many_buckets(llm, docs):
    """A third of the rows without an id, many of one id, copies of both."""
    rng = random.Random(41)
    rows = [(rng.choice([None, 7, 7, i]), prose(rng, rng.randrange(0, 4))) for i in range(600)]
    got = syncmers.with_next(docs(rows))
    tie = {r["text"]: r["h"] for r in docs(rows).selectExpr("text", "xxhash64(text) as h").distinct().collect()}
    order = sorted(((i is None, i or 0, tie[t], t) for i, t in rows))
    want = Counter()
    for k, (none, i, _, t) in enumerate(order):
        nxt, half = order[(k + 1) % len(order)][3], len(t) // 2
        want[None if none else i, hashlib.sha256((t[: len(t) - half] + nxt[:half]).encode()).hexdigest()] += 1
    assert Counter((r["doc_id"], r["edited_sha256"]) for r in got.collect()) == want
    at = syncmers._places(np.array([1, 5, 5, 5, 9]), np.array([0, -4, 0, 8, 2]), np.array([1, 2, 5, 5, 5, 7, 9, 9, 12]), np.array([0, 9, -4, -1, 99, 0, 2, 1, 0]))
    assert at.tolist() == [0, 0, 1, 1, 3, 3, 4, 3, 4]


def test_a_passage_in_common_shows_in_long_texts(docs):
    rng = random.Random(40)
    passage = prose(rng, 50)
    a, b = (f"{prose(rng, 20_000)} {passage} {prose(rng, 3_000)}" for _ in range(2))
    got = {r["doc_id"]: r for r in syncmers.with_next(docs([(1, a), (2, b), (3, prose(rng, 20_000))])).collect()}
    assert got[1]["near_next"] > 0.0005 and len(got[1]["fingerprint"]) > 16 * 64 * 20
    # the share in common is estimated to a few hundredths: half of the text was replaced
    assert abs(got[1]["near_edited"] - 0.5) < 0.05


def test_likeness(docs):
    a, b = (syncmers.sketch(prose(random.Random(i), 300)) for i in (1, 2))
    assert syncmers.likeness(a, a) == 1.0 and syncmers.likeness(a, b) < 0.1
    assert (syncmers.decode(syncmers.encode(a)) == a).all()
    none = syncmers.sketch("")
    assert syncmers.likeness(none, none) == 1.0 and syncmers.likeness(a, none) == 0.0
    df = docs([(1, "some text to be seen"), (2, None)])
    got = df.withColumn("f", syncmers.fingerprint(df["text"])).withColumn("l", syncmers.likeness_of("f", "f")).collect()
    assert [r["l"] for r in got] == [1.0, 1.0]


# --- packing ------------------------------------------------------------------------------

def check_pieces(rows, got, width=2048):
    model = Tokenizer.from_file(WORD_BPE)
    full = {i: np.array([*model.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for i, t in rows}
    pieces, sequences = {}, {}
    for r in got:
        pieces.setdefault(r["doc_id"], []).append((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]))
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert pieces.keys() == full.keys()
    for i, parts in pieces.items():
        at = 0
        for start, n, crc, whole in sorted(parts):
            assert start == at and whole == len(full[i]) and crc == zlib.crc32(full[i][at : at + n].tobytes())
            at += n
        assert at == len(full[i])
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= width
    return sequences


def test_packs_every_id_once(docs):
    rng = random.Random(11)
    rows = [(i, prose(rng, rng.choice([0, 3, 100, 1500]))) for i in range(60)] + [(100, None), (101, ""), (102, prose(rng, 9000)), (103, "Nä it's <|endoftext|> 漢字 ﬁ́ \x1c x")]
    got = packing.pack(docs(rows, extra="ids k1"), WORD_BPE, shard_docs=16).collect()
    seqs = check_pieces(rows, got)
    used = sum(n for s in seqs.values() for _, n in s)
    assert used > 0.8 * 2048 * (len(seqs) - 8)
    with_ids = packing.pack(docs(rows[:3]), WORD_BPE, with_ids=True).collect()
    assert all(len(r["ids"]) == r["length"] for r in with_ids)
    assert packing.pack(docs([]), WORD_BPE).count() == 0
    assert packing.pack(docs([(1, "a"), (1, "a"), (None, "b")]), WORD_BPE).count() == 3


def test_seeds_get_their_best_neighbours_of_all_documents(llm, docs):
    """Every seed's list, against BM25 of all pairs by plain loops."""
    import math

    rng = random.Random(21)
    words = [f"{a}{b}" for a in "ba ko mi tu re".split() for b in "la ne si do fu".split()]
    rows = [(i if i % 7 else None, " ".join(rng.choices(words, weights=range(1, 26), k=rng.randrange(0, 60)))) for i in range(240)]
    rows += [(1000, rows[3][1]), (1001, rows[3][1]), (1003, None)]
    tokens = packing.tokenised(docs(rows), WORD_BPE).collect()
    ids = {r["row"]: packing.unpack(bytes(r["ids"])).tolist() for r in tokens}
    seeds = {r["row"] for r in tokens if r["id"] is not None and r["id"] % 10 == 0}
    n, mean, df = len(ids), sum(map(len, ids.values())) / len(ids), Counter(t for x in ids.values() for t in set(x))

    def score(q, d):
        tf = Counter(ids[d])
        return sum(math.log1p((n - df[t] + 0.5) / (df[t] + 0.5)) * tf[t] * 2.2 / (tf[t] + 1.2 * (0.25 + 0.75 * len(ids[d]) / mean)) for t in set(ids[q]) if tf[t])

    frame = llm.createDataFrame(tokens)
    got = {}
    for index_docs in (3, 50, 4096):  # samples of several levels, or none
        lists = {}
        for r in packing.neighbours(frame, seed_every=10, best=5, seed_block=7, index_docs=index_docs).collect():
            lists.setdefault(r["seed"], {})[r["rank"]] = (r["row"], r["score"])
        assert lists == (got or lists)
        got = lists
    assert got.keys() == seeds and len(seeds) > 14
    hits = 0
    for q in seeds:
        want = sorted(((score(q, d), d) for d in ids if d not in seeds), key=lambda x: (-x[0], x[1]))[:5]
        own = [got[q][k] for k in range(1, 6)]
        assert [s for _, s in own] == pytest.approx([s for s, _ in want], abs=0.1)
        assert all(score(q, d) == pytest.approx(s, abs=0.1) for d, s in own)
        hits += len({d for d, _ in own} & {d for _, d in want})
    assert hits >= 0.95 * 5 * len(seeds)  # the rest are ties to 1 / 256


def test_followers_stand_behind_their_seed(docs):
    rng = random.Random(22)
    rows = [(i, " ".join(rng.choices(["alpha", "beta", "gamma", "delta", "omega"], k=rng.randrange(3, 30))) + f" own{i % 40} own{i % 40}") for i in range(400)]
    got = packing.pack(docs(rows), WORD_BPE, width=256, seed_every=50, shard_docs=16).collect()
    place = {r["doc_id"]: (r["sequence_id"], r["offset"]) for r in got if r["start"] == 0}
    order = [i for i, _ in sorted(place.items(), key=lambda x: x[1])]
    assert sorted(order) == list(range(400)) and sum(r["length"] for r in got) == sum({r["doc_id"]: r["doc_tokens"] for r in got}.values())
    tokens = packing.tokenised(docs(rows), WORD_BPE)
    name = {r["row"]: r["id"] for r in tokens.select("row", "id").collect()}
    chains = {}
    for r in sorted(packing.followers(tokens, packing.neighbours(tokens, 50), 256).collect(), key=lambda r: r["rank"]):
        chains.setdefault(name[r["lead"]], []).append(name[r["row"]])
    assert len(chains) >= 3 and sum(map(len, chains.values())) > 16
    for seed, chain in chains.items():
        at = order.index(seed)
        assert order[at + 1 : at + 1 + len(chain)] == chain



def test_batched_merges_give_the_librarys_ids():
    rng = random.Random(23)
    bits = ["a", "Zb", "é", "É", "ß", "ñ", "don't", "DON'T", "'s", "'", "x's", "9", "1,5", "—", "…", "e\u0301", "ﬁ", "漢", ".", ",", "!?", "(", ")", "<|", "|>", "<|endoftext|>", "×", "÷", "….", " ", "\n",
            "\u00a0", "\x01", "İ", "ÀÞ", "l'été", "a" * 50, "b" * 39 + ".", "the", "ration", "Thing"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(0, 30))) for _ in range(2000)] + ["", None, "one " * 5000]
    plain = Tokenizer.from_file(WORD_BPE)
    with open(WORD_BPE, encoding="utf-8") as f:
        content = f.read()
    want = [plain.encode(t or "", add_special_tokens=False).ids for t in texts]
    column = pa.array(texts)
    assert isinstance(packing.encoder(content), word_bpe.WordBpe)
    apart = lambda blocks: [x.tolist() for ids, ends in blocks for x in np.split(ids, ends)[:-1]]
    for most in (100, 1 << 20):  # splits of earlier batches are known in later ones
        assert apart(packing.encoder(content).blocks(column, most)) == want
    assert apart(packing.encoder(content).blocks(column.slice(3, 40))) == want[3:43]
    assert apart(packing.Encoder(content).blocks(pa.array([t.encode() if t else t for t in texts], pa.binary()))) == want
    assert list(packing.encoder(content).blocks(pa.array([], pa.string()))) == []
    forgets = word_bpe.WordBpe(content)
    word_bpe.KNOWN, keep = 50, word_bpe.KNOWN
    try:
        assert apart(forgets.blocks(column, 500)) == want and len(forgets.known) < 2000
    finally:
        word_bpe.KNOWN = keep
    ids, ends = next(packing.encoder(content).blocks(pa.array(["the cat", "", "x"])))
    k1, k2 = packing._keys(ids, ends)
    hashed = lambda x: int(packing.T.mix(np.array([x + 1], np.uint64))[0])
    first = sorted(ids[:2].tolist(), key=hashed)
    assert k1.tolist() == [first[0], -1, int(ids[2])] and k2.tolist() == [hashed(first[1]) >> 33, -1, -1]
    assert not word_bpe.understands(content.replace("Lowercase", "NFKC"))


def test_neighbours_come_from_bm25():
    """The index ranks as the formula does over all terms of the query."""
    rng = np.random.default_rng(1)
    shard = [rng.integers(0, 30, rng.integers(3, 20)).astype(np.uint32) for _ in range(25)]
    index = packing.Index(shard)
    mean = np.mean([len(d) for d in shard])
    for seed in range(len(shard)):
        unused = np.ones(len(shard), bool)
        unused[[seed, (seed + 3) % 25]] = False
        score = {}
        for j, d in enumerate(shard):
            for t in set(shard[seed].tolist()):
                tf = int((d == t).sum())
                df = sum(t in x for x in shard)
                if tf and df > 1 and unused[j]:
                    idf = np.log1p((25 - df + 0.5) / (df + 0.5))
                    score[j] = score.get(j, 0) + idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(d) / mean))
        got = index.neighbours(seed, unused).tolist()
        assert set(got) == set(score)
        assert np.allclose([score[j] for j in got], sorted(score.values(), reverse=True))


# --- sharding -------------------------------------------------------------------------------

def test_shards(docs):
    rng = random.Random(12)
    rows = [(i, prose(rng, rng.choice([1, 20, 200]))) for i in range(300)]
    rows += [(1000 + i, "the same text") for i in range(200)] + [(2000, None), (2001, ""), (None, "x"), (5, rows[5][1])]
    for options in ({}, {"range_groups": 20}):
        got = sharding.assign(docs(rows, extra="size digest n shard"), **options).collect()
        assert len(got) == len(rows)
        text = dict(rows)
        shard_of, slots, load = {}, {}, Counter()
        for r in got:
            body = (text[r["doc_id"]] or "").encode()
            assert r["size"] == len(body) + 1 and r["text_crc32"] == zlib.crc32(body) and r["law"] == "bytes" and r["grown_shard"] is None
            assert shard_of.setdefault(body, r["shard"]) == r["shard"] and 0 <= r["shard"] < 8
            slots.setdefault(r["shard"], []).append(r["slot"])
            load[r["shard"]] += r["size"]
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        assert max(load.values()) - min(load.values()) < 0.02 * sum(load.values()) / 8
        # longest processing time over all groups, whatever the number of ranges
        groups = Counter()
        for r in got:
            groups[(text[r["doc_id"]] or "").encode()] += r["size"]
        want = sharding.schedule([(n, hashlib.md5(b).hexdigest()) for b, n in groups.items()], 8)
        assert all(want[hashlib.md5(b).hexdigest()] == x for b, x in shard_of.items())
    assert sharding.assign(docs([])).count() == 0


@pytest.mark.parametrize("by_heap", [0, 3, 10_000])
def test_sizes_and_counts_give_the_heaps_schedule(monkeypatch, by_heap):
    monkeypatch.setattr(sharding, "_BY_HEAP", by_heap)
    for seed in range(60):
        rng = random.Random(seed)
        shards = rng.choice([1, 2, 3, 8])
        some = rng.choices([1, 2, 3, 5, 8, 13, 400, 401, 10_000, 10**9], k=rng.randrange(1, 90))
        names = sorted(((n, f"{k:04d}") for k, n in enumerate(some)), key=lambda x: (-x[0], x[1]))
        want = sharding.schedule(names, shards)
        count = Counter(some)
        sizes = sorted(count, reverse=True)
        loads = sharding.loads_before(sizes, [count[n] for n in sizes], shards)
        place = Counter()
        for n, name in names:
            row = sizes.index(n)
            _, shard = sharding.levels(loads[row : row + 1], np.array([n]), np.array([place[n]]))
            place[n] += 1
            assert shard[0] == want[name]


def test_longest_first():
    sizes = [(7, "a"), (7, "b"), (6, "c"), (5, "d"), (4, "e"), (1, "f")]
    got = sharding.schedule(sizes, 3)
    load = Counter()
    for n, name in sizes:
        load[got[name]] += n
    assert sorted(load.values()) == [8, 11, 11]
