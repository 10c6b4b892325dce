"""Prefix trie of conversations, built as z-fast tries (Belazzougui, Boldi, Pagh
and Vigna) over ranges of the turn sequences.

A turn is one symbol, the MD5 of its role and text; a prefix is known by the
chained MD5 of its symbols.  Equal sequences are counted together first, then
distinct ones are dealt by range of their symbols, so conversations that begin
alike meet in one task and a common first turn is split further down.  Each
task keeps a compacted trie:

* every compacted node is hashed at its handle, the prefix of two-fattest
  length of its edge;
* a batch of sequences finds its exit nodes by fat binary search over prefix
  lengths (a number of look-ups logarithmic in the length), is ordered by exit
  node and inserted, each search going on from the exit node's parent, which
  stays right while others split edges below it;
* at the end the edges are expanded to one row a depth, with the sums of the
  subtree.

Only prefixes of a task's least and greatest sequence can lie in other tasks
too.  These "open" nodes (two paths a task) come out with partial values and
are merged by prefix; their subtree sums follow by pointer doubling, in
log2(depth) rounds over that small table.

Bounds: a task holds the distinct sequences of its range at about 40 bytes a
turn, one conversation is one row of 24 bytes a turn.  Members of a node are
hashed as a stream in blocks of ids, so a node with any number of copies needs
the memory of one block.

Defined cases: null role and text count as empty; rows without a conv_id belong
to no conversation and are left out; turns sort null first, ties by the turn's
MD5, repeated rows are turns of their own; an empty table has no nodes; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, lookup

#: Ids of one block of a node's members, hashed one after another.
ID_BLOCK = 4096
_W = 16  # bytes of a symbol and of a prefix digest
_ROWS = 20_000  # rows of an output batch

_NODE = "id binary, parent binary, depth long, open boolean, parent_open boolean, n long, conv long, pconv long, bytes long, kids long, leaves long, saved long, ends string"


def sequences(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, symbols, sizes): a conversation's turns in order, each as the
    hex MD5 of role and text and the text's bytes."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    turn = F.col(turn_col)
    rows = conversations.select(
        F.col(conv_col).cast("long").alias("conv_id"), turn.isNotNull().alias("known"), F.coalesce(turn.cast("long"), F.lit(0)).alias("turn"),
        F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("symbol"), F.octet_length(text).cast("long").alias("size"),
    ).where("conv_id is not null")
    ordered = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("known", "turn", "symbol", "size"))).alias("t"))
    return ordered.select("conv_id", F.col("t.symbol").alias("symbols"), F.col("t.size").alias("sizes"))


def graft(seqs: DataFrame, family: int = 5, most: int = 9) -> DataFrame:
    """Each sequence with its first h turns replaced by the first h of the
    sequence ``conv_id - conv_id % family`` (all if fewer, none if absent),
    h = crc32 of the decimal id modulo ``most``."""
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    heads = seqs.select(F.col("conv_id").alias("base"), F.slice("symbols", 1, most).alias("head"), F.slice("sizes", 1, most).alias("head_sizes"))
    own = seqs.select("*", (F.col("conv_id") - F.col("conv_id") % family).alias("base"), h.cast("int").alias("h"))

    def both(head: str, col: str, kind: str) -> Column:
        first = F.coalesce(F.slice(head, F.lit(1), F.col("h")), F.array().cast(f"array<{kind}>"))
        return F.concat(first, F.expr(f"slice({col}, h + 1, greatest(size({col}) - h, 0))"))

    return own.join(heads, "base", "left").select("conv_id", both("head", "symbols", "string").alias("symbols"), both("head_sizes", "sizes", "bigint").alias("sizes"))


def fattest(low: int, high: int) -> int:
    """The number of (low, high] with most trailing zero bits."""
    return high & (-1 << ((low ^ high).bit_length() - 1))


def chain(key: bytes) -> bytes:
    """The prefix digests of a sequence of symbols, one after another."""
    out, last = [], b""
    for i in range(0, len(key), _W):
        last = hashlib.md5(last + key[i : i + _W], usedforsecurity=False).digest()
        out.append(last)
    return b"".join(out)


class ZFastTrie:
    """Compacted trie over prefix digests.  Node 0 is the root, of extent 0."""

    def __init__(self) -> None:
        self.path, self.sizes = [b""], [[]]  # of a sequence through the node
        self.top, self.end, self.up = [0], [0], [-1]  # the edge is (top, end]
        self.own, self.conv, self.ends = [0], [None], [None]  # sequences that end here
        self.handle: dict[bytes, int] = {}
        self.edge: dict[bytes, int] = {}  # first prefix of an edge -> node

    def at(self, node: int, depth: int) -> bytes:
        return self.path[node][_W * (depth - 1) : _W * depth]

    def within(self, node: int, path: bytes) -> bool:
        """Whether the node's whole extent is a prefix of ``path``."""
        e = self.end[node]
        return _W * e <= len(path) and self.at(node, e) == path[_W * (e - 1) : _W * e]

    def exit_node(self, path: bytes, start: int = 0) -> int:
        """The node in whose edge, or at whose extent, ``path`` leaves the
        trie.  ``start``: a node whose extent is known to be a prefix."""
        node, low, high = start, self.end[start], len(path) // _W
        while low < high:
            f = fattest(low, high)
            found = self.handle.get(path[_W * (f - 1) : _W * f])
            if found is None:
                high = f - 1
            elif self.within(found, path):
                node, low = found, self.end[found]
            else:
                return found
        return self.edge.get(path[_W * low : _W * (low + 1)], node)

    def _add(self, path: bytes, sizes: list[int], top: int, end: int, up: int) -> int:
        for values, v in ((self.path, path), (self.sizes, sizes), (self.top, top), (self.end, end), (self.up, up), (self.own, 0), (self.conv, None), (self.ends, None)):
            values.append(v)
        node = len(self.path) - 1
        self.handle[self.at(node, fattest(top, end))] = node
        self.edge[self.at(node, top + 1)] = node
        return node

    def insert(self, path: bytes, sizes: list[int], exit_at: int) -> int:
        """The node whose extent is ``path``, made if it is not there."""
        n, node = len(path) // _W, exit_at
        if node and not self.within(node, path):  # split the edge where the two part
            low, high = self.top[node] + 1, min(n, self.end[node])
            while low < high:
                mid = (low + high + 1) // 2
                low, high = (mid, high) if self.at(node, mid) == path[_W * (mid - 1) : _W * mid] else (low, mid - 1)
            upper = self._add(self.path[node], self.sizes[node], self.top[node], low, self.up[node])
            self.top[node], self.up[node] = low, upper
            self.handle[self.at(node, fattest(low, self.end[node]))] = node
            self.edge[self.at(node, low + 1)] = node
            node = upper
        return node if self.end[node] == n else self._add(path, sizes, self.end[node], n, node)

    def insert_batch(self, rows: list[tuple[bytes, list[int], int, int, str]]) -> None:
        """Insert (key, sizes, count, least conv_id, digest of the members)."""
        batch = [(chain(key), *rest) for key, *rest in rows]
        exits = [self.exit_node(row[0]) for row in batch]
        # a node whose extent is a prefix of the row: the exit node or its parent
        known = [e if self.within(e, row[0]) else self.up[e] for e, row in zip(exits, batch, strict=True)]
        for i in sorted(range(len(batch)), key=exits.__getitem__):
            path, sizes, n, conv, ends = batch[i]
            node = self.insert(path, sizes, self.exit_node(path, known[i]))
            self.own[node], self.conv[node], self.ends[node] = n, conv, ends

    def expand(self, least: bytes, most: bytes) -> Iterator[tuple]:
        """One row (``_NODE``) for each depth of each edge, deepest first.
        Prefixes of the range's ``least`` and ``most`` key are open."""
        order = sorted(range(len(self.path)), key=self.end.__getitem__, reverse=True)
        n, conv = list(self.own), list(self.conv)
        for v in order[:-1]:
            n[self.up[v]] += n[v]
            conv[self.up[v]] = min(x for x in (conv[self.up[v]], conv[v]) if x is not None)
        open_ids = {p[i : i + _W] for p in (chain(least), chain(most)) for i in range(0, len(p), _W)} | {b""}
        kids, leaves, saved = ([0] * len(self.path) for _ in range(3))  # of closed children
        for v in order:
            up = self.up[v]
            k, l, s = kids[v], leaves[v], saved[v]
            for d in range(self.end[v], self.top[v] if v else -1, -1):
                own_id, parent = (self.at(v, d), self.at(v, d - 1) if d > 1 else b"") if d else (b"", None)
                size = self.sizes[v][d - 1] if d else 0
                is_open, last = own_id in open_ids, d == self.end[v]
                if not is_open:
                    l, s = l if k else 1, s + (n[v] - 1) * size
                above = conv[v] if d > self.top[v] + 1 else conv[up] if d else None
                yield own_id, parent, d, is_open, parent in open_ids, n[v], conv[v], above, size, k, l, s, self.ends[v] if last else None
                k, l, s = (0, 0, 0) if is_open else (1, l, s)
            if v:
                kids[up], leaves[up], saved[up] = kids[up] + k, leaves[up] + l, saved[up] + s


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of members, in order of (sig, block) -> one row a sequence."""
    names = ["conv", "n", "ends", "key", "sizes"]
    done: list[tuple] = []
    sig, row, text = None, None, None

    def batch() -> pa.RecordBatch:
        cols = list(zip(*done, strict=True)) or [[]] * 5
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.list_(pa.int64())]
        out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)
        done.clear()
        return out

    for b in batches:
        for s, ids, least, count, key, sizes in zip(*(b.column(c).to_pylist() for c in ("sig", "ids", "least", "count", "key", "sizes")), strict=True):
            if s == sig:
                text.update(b"," + ids.encode())
                row[1] += count
                continue
            if row:
                done.append((row[0], row[1], text.hexdigest(), row[2], row[3]))
            sig, row, text = s, [least, count, key, sizes], hashlib.sha256(ids.encode())
        if len(done) >= _ROWS:
            yield batch()
    if row:
        done.append((row[0], row[1], text.hexdigest(), row[2], row[3]))
    yield batch()


def distinct_sequences(seqs: DataFrame) -> DataFrame:
    """(conv, n, ends, key, sizes): each distinct sequence with its least
    conv_id, its count and the SHA-256 of its conv_ids (ascending, by comma)."""
    keyed = seqs.select("conv_id", F.unhex(F.array_join("symbols", "")).alias("key"), "sizes")
    blocks = keyed.groupBy(F.md5("key").alias("sig"), F.expr(f"conv_id div {ID_BLOCK}").alias("block")).agg(
        F.sort_array(F.collect_list("conv_id")).alias("ids"), F.first("key").alias("key"), F.first("sizes").alias("sizes")
    )
    flat = blocks.select("sig", "block", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"), F.col("ids")[0].alias("least"), F.size("ids").cast("long").alias("count"), "key", "sizes")
    return flat.repartition("sig").sortWithinPartitions("sig", "block").mapInArrow(_members, "conv long, n long, ends string, key binary, sizes array<long>")


def _tries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of one range of sequences -> the nodes of its trie."""
    trie, least, most = ZFastTrie(), None, None
    for b in batches:
        key, sizes, n, conv, ends = (b.column(c).to_pylist() for c in ("key", "sizes", "n", "conv", "ends"))
        trie.insert_batch(list(zip(key, sizes, n, conv, ends, strict=True)))
        least = min(key) if least is None else min(least, *key)
        most = max(key) if most is None else max(most, *key)
    if least is None:
        return
    kinds = [pa.binary(), pa.binary(), pa.int64(), pa.bool_(), pa.bool_(), *[pa.int64()] * 7, pa.string()]
    names = [c.split()[0] for c in _NODE.split(", ")]
    rows: list[tuple] = []

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    for row in trie.expand(least, most):
        rows.append(row)
        if len(rows) == _ROWS:
            yield batch()
            rows.clear()
    if rows:
        yield batch()


def _merged(nodes: DataFrame) -> DataFrame:
    """The open nodes, one row each, with whole counts and subtree sums."""
    one = F.first
    parts = nodes.where("open").groupBy("id").agg(
        one("parent").alias("parent"), one("depth").alias("depth"), F.sum("n").alias("n"), F.min("conv").alias("conv"), one("bytes").alias("bytes"),
        F.sum("kids").alias("kids"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"), F.max("ends").alias("ends"),
    )
    parts = cut(parts, "trie-open")
    more = parts.where("parent is not null").groupBy(F.col("parent").alias("id")).agg(F.count("*").alias("more"))
    above = parts.select(F.col("id").alias("parent"), F.col("conv").alias("pconv"))
    full = parts.join(more, "id", "left").join(above, "parent", "left").select(
        "id", "parent", "depth", "n", "conv", "pconv", "ends", F.col("kids").alias("closed_kids"), (F.col("kids") + F.coalesce("more", F.lit(0))).alias("kids"),
        "leaves", (F.col("saved") + (F.col("n") - 1) * F.col("bytes")).alias("saved"),
    ).withColumn("leaves", F.when(F.col("kids") == 0, F.lit(1)).otherwise(F.col("leaves")))
    full = cut(full, "trie-tree")
    # sums over the subtree: each round doubles the depth below a node that is summed
    state = full.select("id", F.col("parent").alias("up"), "leaves", "saved")
    deepest = full.agg(F.max("depth")).first()[0] or 0
    for _ in range(deepest.bit_length()):
        below = state.where("up is not null").groupBy(F.col("up").alias("id")).agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
        next_up = state.select(F.col("id").alias("up"), F.col("up").alias("next"))
        state = cut(
            state.join(below, "id", "left").join(next_up, "up", "left").select(
                "id", F.col("next").alias("up"), (F.col("leaves") + F.coalesce("l", F.lit(0))).alias("leaves"), (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved")
            ),
            "trie-sums",
        )
    return full.drop("leaves", "saved").join(state.drop("up"), "id")


def prefix_trie(seqs: DataFrame) -> DataFrame:
    """The nodes of the trie of ``seqs`` (conv_id, symbols, sizes): conv_id,
    depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256."""
    ranges = cut(distinct_sequences(seqs), "trie-sequences").repartitionByRange("key")
    nodes = cut(ranges.mapInArrow(_tries, _NODE), "trie-nodes")
    opened = cut(_merged(nodes), "trie-merged")
    closed = nodes.where("not open").select("parent", "parent_open", "depth", "n", "conv", "pconv", "kids", "leaves", "saved", "ends")
    total = opened.agg(F.sum("closed_kids")).first()[0] or 0
    parents = opened.select(F.col("id").alias("parent"), F.col("conv").alias("pconv"), F.col("closed_kids").alias("weight")).where("weight > 0")
    under_open = lookup(closed.where("parent_open").drop("pconv"), parents, "parent", "weight", total)
    cols = ["depth", "n", "conv", "pconv", "kids", "leaves", "saved", "ends"]
    rows = closed.where("not parent_open").select(*cols).unionByName(under_open.select(*cols)).unionByName(opened.select(*cols))
    return rows.select(
        F.col("conv").alias("conv_id"), "depth", F.col("pconv").alias("parent_conv_id"), F.col("n").alias("n_convs"), F.col("kids").alias("n_children"),
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("ends", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )


def rebuilt_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the conversations after ``graft``."""
    return prefix_trie(graft(sequences(conversations)))
