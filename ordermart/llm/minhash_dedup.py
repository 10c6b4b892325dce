"""Near-duplicate groups: bottom-k sketches of one hash function.

Every document has the set of its distinct word shingles (64-bit hashes).
1. Equal sets fall together by a 128-bit digest; one representative goes on.
2. Its sketch is the k smallest hashes.  Inverted lists of the retained values
   give candidates.  Values are taken rarest first and only as many as a pair
   that can reach the similarity must share (prefix filter), so a passage that
   many documents have in common drops out of the lists without a cap.
3. In each list a document is first held against one hub of its size band,
   another one in each list (rows linear in the lists); the sketch of the union
   estimates the similarity, and the likeliest hubs of a document are verified
   on full sets.  That joins most of a group.
4. Lists whose members are still in different components are searched whole,
   in blocks, between components only.  Sets up to 512 shingles are compared
   exactly there and give only the links that join components, so the rows are
   linear in the lists; pairs with a larger set go on to be verified.
Links join the components; the smallest id names each.

A pair at exactly the similarity is lost in step 2 when fewer than
``least_shared`` of the 32 smallest values of its union are common: about
2e-8 for 10 of 32 at 0.75, less above it.  Sets of at most k shingles are
compared without that chance.

Defined cases: null or wordless text has an empty set, n_shingles 0, and is
linked with nothing (its component is its own id).  Repeated rows share one
set, so they are in one group; a null id takes part in the comparison and
never names a group while another id is there.  Empty input gives no rows;
other columns of the input are neither read nor returned.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import textops as T
from .common import components, cut, likely_in, lookup

#: Rows of one inverted list that are held together in one task.
BLOCK = 3072
#: A larger sketch, of the upper 32 bits, sifts the pairs of a list search: of
#: the FINE smallest values of the union at least FINE_LEAST must be shared (a
#: pair at 0.75 fails that with a chance of 2e-7).
FINE, FINE_LEAST = 128, 70
#: A list search holds the WHOLE smallest values of each member.  Sets up to
#: that size are compared exactly there, so only links that join components are
#: given; of larger ones WHOLE_LEAST of the union's must be shared (a pair at
#: 0.75 fails that with a chance of 1e-7).
WHOLE, WHOLE_LEAST = 512, 332
#: A whole set takes the room of so many rows of a few hundred bytes.
SET_ROWS = 16
_TOP = np.iinfo(np.uint64).max


def _signatures(size: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, digest, sketch, fine = [], [], [], []
            for s in T.shingle_sets(*T.as_bytes(batch.column(1)), size):
                n.append(len(s))
                digest.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                sketch.append(s[:k].tobytes())
                fine.append((s[:FINE] >> np.uint64(32)).astype(np.uint32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), *(pa.array(x, pa.binary()) for x in (digest, sketch, fine)), *batch.columns[2:]],
                ["id", "n", "digest", "sketch", "fine", *batch.schema.names[2:]],
            )

    return run


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [s.tobytes() for s in T.shingle_sets(*T.as_bytes(batch.column(1)), size)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["rep", "set"])

    return run


def _values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(rep, n, sketch) -> a row for each retained value."""
    for batch in batches:
        rows = [np.frombuffer(x, np.int64) for x in batch.column(2).to_pylist()]
        take = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([*rows, np.zeros(0, np.int64)])), batch.column(0).take(pa.array(take)), batch.column(1).take(pa.array(take))],
            ["v", "rep", "n"],
        )


def _packed_values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        packed = [np.array(x, np.int64).tobytes() for x in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], ["rep", "prefix"])


def union_estimate(a: np.ndarray, b: np.ndarray, k: int) -> tuple[int, int]:
    """(shared, seen): of the k smallest values of the union, those in both."""
    union = np.union1d(a, b)[:k]
    return int(np.isin(union, a, assume_unique=True).__and__(np.isin(union, b, assume_unique=True)).sum()), len(union)


def _may_link(a: np.ndarray, na: int, b: np.ndarray, nb: int, k: int, num: int, den: int, least: int) -> bool:
    if den * min(na, nb) < num * max(na, nb):
        return False
    shared, seen = union_estimate(a, b, k)
    if na <= k and nb <= k:  # the sketches are the sets
        common = len(np.intersect1d(a, b, assume_unique=True))
        return den * common >= num * (na + nb - common)
    return shared * k >= least * seen


def _estimated(k: int, num: int, den: int, least: int):
    """(a, na, sa, b, nb, sb, m) rows -> those that may link, and how close."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = {f.name: batch.column(i) for i, f in enumerate(batch.schema)}
            na, nb = c["na"].to_pylist(), c["nb"].to_pylist()
            sa, sb = c["sa"].to_pylist(), c["sb"].to_pylist()
            close = []
            for x, p, y, q in zip(sa, na, sb, nb, strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                close.append(union_estimate(x, y, k)[0] * k if _may_link(x, p, y, q, k, num, den, least) else None)
            yield pa.RecordBatch.from_arrays([c["a"], c["b"], c["m"], pa.array(close, pa.int64())], ["a", "b", "m", "close"]).filter(pa.array([x is not None for x in close], pa.bool_()))

    return run


def _verified(num: int, den: int):
    """(a, sa, b, sb) rows with full sets -> the pairs that are links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(1), batch.column(3), strict=True):
                p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if len(p) > len(q):
                    p, q = q, p
                at = np.searchsorted(q, p)
                common = int((q[np.minimum(at, len(q) - 1)] == p).sum()) if len(q) else 0
                keep.append(common > 0 and den * common >= num * (len(p) + len(q) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _shared(both: np.ndarray, k: int | np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For sorted rows that hold two sets each: where a value is met again, and
    how many of the k smallest distinct values are."""
    twice = (both[:, 1:] == both[:, :-1]) & (both[:, 1:] < np.iinfo(both.dtype).max)
    rank = np.arange(1, both.shape[1]) - np.cumsum(twice, axis=1)  # of the union, from 0
    return twice, (twice & (rank < np.reshape(k, (-1, 1)))).sum(axis=1)


def shared_of_union(a: np.ndarray, b: np.ndarray, k: int, flag_a: np.ndarray, flag_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows of sorted values padded with the largest one: how many of the k
    smallest values of the union are in both rows, and the least value that is
    flagged in both (or the padding)."""
    both = np.concatenate([a, b], axis=1)
    order = np.argsort(both, axis=1, kind="stable")
    both = np.take_along_axis(both, order, axis=1)
    twice, shared = _shared(both, k)
    flags = np.take_along_axis(np.concatenate([flag_a, flag_b], axis=1), order, axis=1)
    both_flagged = twice & flags[:, 1:] & flags[:, :-1]
    return shared, np.where(both_flagged, both[:, 1:], np.iinfo(a.dtype).max).min(axis=1)


def _padded(rows: list[bytes], width: int, dtype: type) -> np.ndarray:
    out = np.full((len(rows), width), np.iinfo(dtype).max, dtype)
    for i, r in enumerate(rows):
        x = np.frombuffer(r, dtype)
        out[i, : len(x)] = x
    return out


def _fine_ok(a: np.ndarray, na: np.ndarray, b: np.ndarray, nb: np.ndarray, num: int, den: int) -> np.ndarray:
    """Whether pairs (rows) may link by their larger sketches."""
    exact = (na <= FINE) & (nb <= FINE)  # the sketches are the sets
    _, shared = _shared(np.sort(np.concatenate([a, b], axis=1), axis=1), np.where(exact, 2 * FINE, FINE))
    union = na + nb - shared
    seen = np.minimum(FINE, np.maximum(na, nb))
    return np.where(exact, den * shared >= num * union, shared * FINE >= FINE_LEAST * seen)


def _sifted(num: int, den: int):
    """(a, na, fa, b, nb, fb) rows with larger sketches -> those that may link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 2048):
                c = {f.name: batch.column(i).slice(lo, 2048) for i, f in enumerate(batch.schema)}
                fa, fb = (_padded([x or b"" for x in c[k].to_pylist()], FINE, np.uint32) for k in ("fa", "fb"))
                unknown = np.array(c["fa"].is_null()) | np.array(c["fb"].is_null())
                keep = unknown | _fine_ok(fa, c["na"].to_numpy(), fb, c["nb"].to_numpy(), num, den)
                yield pa.RecordBatch.from_arrays([c["a"], c["b"]], ["a", "b"]).filter(pa.array(keep))

    return run


def _searched(k: int, num: int, den: int, least: int):
    """Rows (v, band, p, q, side, rep, n, root, own, prefix, values), ordered
    by the first four: pairs of a block (p = q) or between two blocks whose
    members are in different components.  A pair is looked at in the list of
    the least value that both have in their prefixes, the likeliest first.  A
    pair of whole sets that is a link is given as sure, and what it joins is
    not looked at again; a pair with a larger set is given if it may link."""

    def pairs(v: int, band: int, rows: list[tuple]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        side, ids, n, root, own = (np.array([r[i] for r in rows], np.int64) for i in range(5))
        names, many = np.unique(root, return_counts=True)
        if len(names) == 1 or side.all():
            return
        # every pair between components has an end outside the largest of them
        some = np.flatnonzero(root != names[many.argmax()])
        sk = _padded([r[6][: 8 * k] for r in rows], k, np.uint64)
        flags = np.zeros(sk.shape, bool)
        for i, r in enumerate(rows):
            flags[i] = np.isin(sk[i], np.frombuffer(r[5], np.uint64))
        held = sk < _TOP
        _, value = np.unique(sk[held], return_inverse=True)
        who = np.nonzero(held)[0]
        in_some = np.zeros(len(rows), bool)
        in_some[some] = True
        wanted = np.zeros(int(value.max(initial=0)) + 1, bool)
        wanted[value[in_some[who]]] = True
        often = (np.bincount(value)[value] > 1) & wanted[value]
        _, value = np.unique(value[often], return_inverse=True)
        rows_of, common = who[often], np.zeros((len(some), len(rows)), np.float32)
        for lo in range(0, int(value.max(initial=-1)) + 1, 4096):  # some values at a time
            at = (value >= lo) & (value < lo + 4096)
            seen = np.zeros((len(rows), 4096), np.float32)
            seen[rows_of[at], value[at] - lo] = 1
            common += seen[some] @ seen.T
        found = []
        for lo in range(0, len(some), 256):  # some members at a time
            part = some[lo : lo + 256]
            small, large = np.minimum.outer(n[part], n), np.maximum.outer(n[part], n)
            # sets within k: the overlap is exact; else at least ``least`` shared
            need = np.where(large <= k, num * (small + large) / (num + den), np.minimum(least, small * num / den))
            ok = (common[lo : lo + 256] >= need - 1e-6) & (root[part][:, None] != root) & (den * small >= num * large)
            ok &= np.minimum.outer(own[part], own) == band  # the next band's own list has its pairs
            if side.any():  # two blocks: across them only
                ok &= side[part][:, None] != side
            ok &= ~in_some | (part[:, None] < np.arange(len(rows)))  # both ends in ``some``: met twice
            i, j = np.nonzero(ok)
            found.append((part[i], j))
        left, right = (np.concatenate([f[i] for f in found]) for i in (0, 1))
        near = []
        for lo in range(0, len(left), 4096):
            i, j = left[lo : lo + 4096], right[lo : lo + 4096]
            shared, first = shared_of_union(sk[i], sk[j], k, flags[i], flags[j])
            union = np.minimum(k, np.maximum(n[i], n[j]))
            go = (first == np.uint64(v & T._M)) & ((np.maximum(n[i], n[j]) <= k) | (shared * k >= least * union))
            near.append((i[go], j[go], shared[go]))
        if not near:
            return
        left, right, shared = (np.concatenate([x[c] for x in near]) for c in range(3))
        order = np.argsort(-shared, kind="stable")
        left, right = left[order], right[order]
        label = np.unique(root, return_inverse=True)[1]  # components as far as joined here
        lo, step = 0, 256
        while lo < len(left):
            i, j = left[lo : lo + step], right[lo : lo + step]
            lo, step = lo + step, min(4096, 2 * step)
            go = label[i] != label[j]
            i, j = i[go], j[go]
            if not len(i):
                continue
            most = np.maximum(n[i], n[j])
            whole = most <= WHOLE
            width = min(WHOLE, int(most.max()))
            own_values = lambda x: _padded([rows[r][6][: 8 * width] for r in x], width, np.uint64)  # noqa: B023, E731
            _, shared = _shared(np.sort(np.concatenate([own_values(i), own_values(j)], axis=1), axis=1), np.where(whole, 2 * WHOLE, WHOLE))
            link = whole & (den * shared >= num * (n[i] + n[j] - shared))
            sure = np.zeros(len(i), bool)
            for x in np.flatnonzero(link):
                one, two = label[i[x]], label[j[x]]
                if one != two:
                    label[label == max(one, two)] = min(one, two)
                    sure[x] = True
            give = sure | (~whole & (shared * WHOLE >= WHOLE_LEAST * np.minimum(WHOLE, most)))
            yield np.minimum(ids[i], ids[j])[give], np.maximum(ids[i], ids[j])[give], sure[give]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []

        def found() -> Iterator[pa.RecordBatch]:
            if len(rows) > 1:
                for a, b, sure in pairs(key[0], key[1], rows):
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(sure)], ["a", "b", "sure"])

        for batch in batches:
            cols = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
            for v, band, p, q, *row in zip(*cols, strict=True):
                if (v, band, p, q) != key:
                    yield from found()
                    key, rows = (v, band, p, q), []
                rows.append(tuple(row))
        yield from found()

    return run


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 5,
    similarity: tuple[int, int] = (75, 100),
    k: int = 32,
    least_shared: int = 10,
    block: int = BLOCK,
) -> DataFrame:
    """(id_col, n_shingles, component_id, kept) for each row of ``docs``."""
    out = _grouped(docs.select(*_id_and_text(id_col, text_col)), size, similarity, k, least_shared, block)
    return out.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def _id_and_text(id_col: str, text_col: str) -> tuple[Column, Column]:
    return F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text")


def _grouped(rows: DataFrame, size: int, similarity: tuple[int, int], k: int, least_shared: int, block: int) -> DataFrame:
    """(id, n, root, component_id) for each row (id, text, ...), and its columns
    beyond these; root is the key of the component, null for an empty set."""
    num, den = similarity
    base = rows.select("id", "text")
    others = [f for f in rows.schema.fields if f.name not in ("id", "text")]
    schema = "id long, n long, digest binary, sketch binary, fine binary" + "".join(f", {f.name} {f.dataType.simpleString()}" for f in others)
    sig = cut(rows.mapInArrow(_signatures(size, k), schema), "signatures")
    own = [f.name for f in others]
    n_docs = sig.count()
    n_sets = SET_ROWS * n_docs  # whole sets are longer rows

    # 1. one representative for each distinct set; r: a dense enough stand-in
    # key, the smallest id, or for sets with null ids only, one below all ids
    classes = cut(
        sig.where("n > 0").groupBy("digest").agg(
            F.min("id").alias("least"), F.count("*").alias("copies"), F.first("n").alias("n"), F.first("sketch").alias("sketch"),
            F.count("id").alias("named"),
        ).withColumn("rep", F.coalesce("least", F.xxhash64("digest"))),
        "classes", n_docs,
    )
    # ids repeated over different texts must not merge them: such classes get a key of their own
    again = classes.groupBy("rep").count().where("count > 1").select("rep").withColumn("clash", F.lit(True))
    classes = cut(
        classes.join(again, "rep", "left").withColumn("rep", F.when(F.col("clash"), F.xxhash64("digest", "rep")).otherwise(F.col("rep"))).drop("clash"),
        "classes", n_docs,
    )

    # 2. inverted lists of the rarest values
    reps = classes.select("rep", "n", "sketch")
    values = cut(reps.mapInArrow(_values, "v long, rep long, n long"), "values")
    n_values = values.count()
    often = cut(values.groupBy("v").agg(F.count("*").alias("f")).where("f > 1"), "often", n_values)
    shared = lookup(values, often, "v", "f", n_values)
    s = F.least(F.col("n"), F.lit(k))
    need = F.when(F.col("n") >= k, F.lit(least_shared)).otherwise(F.least(F.ceil(s * num / den), F.lit(22 * k // 32)))
    postings = cut(
        shared.groupBy("rep", "n").agg(F.sort_array(F.collect_list(F.struct("f", "v"))).alias("l"))
        # values of one document only come first and need no list
        .withColumn("take", F.greatest(F.lit(0), s - need + 1 - (s - F.size("l"))))
        .select("rep", "n", F.explode(F.slice("l", F.lit(1), F.col("take").cast("int"))).alias("e"))
        .select(F.col("e.v").alias("v"), F.col("e.f").alias("f"), "rep", "n", F.floor(F.log(F.col("n")) / float(np.log(den / num)) + 1e-9).alias("band")),
        "postings", n_values,
    )

    # 3. one hub for each list and size band
    fine = sig.where("n > 0 and id is not null").select(F.col("id").alias("rep"), "digest", "fine").join(classes.select("rep", "digest"), ["rep", "digest"])
    fine = fine.groupBy("rep").agg(F.first("fine").alias("fine"))
    near = postings.withColumn("own", F.col("band")).withColumn("band", F.explode(F.array(F.col("band"), F.col("band") - 1)))
    hubs = near.groupBy("v", "band").agg(
        F.min_by("rep", F.when(F.col("own") == F.col("band"), F.xxhash64("rep", "v"))).alias("hub"), F.count("*").alias("m"),
        F.max(F.col("own") == F.col("band")).alias("any"),
    ).where("any and m > 1").drop("any")
    cand = near.join(hubs, ["v", "band"]).where("rep <> hub").groupBy(F.col("rep").alias("a"), F.col("hub").alias("b")).agg(F.min("m").alias("m"))
    left = reps.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    right = reps.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))

    def may_link(pairs: DataFrame) -> DataFrame:
        return pairs.join(left, "a").join(right, "b").mapInArrow(_estimated(k, num, den, least_shared), "a long, b long, m long, close long")

    first = cut(may_link(cand), "first", 2 * n_values)  # each value is listed in two bands
    # of the hubs of a document (at most one a list) the likeliest two
    best = Window.partitionBy("a").orderBy(F.desc("close"), "b")
    likely = first.withColumn("r", F.row_number().over(best)).where("r <= 2").select("a", "b")

    with_id = classes.where("named > 0 and rep = least").select(F.col("rep").alias("id"))
    odd = classes.where("named = 0 or rep <> least").select("rep", "digest")

    def sets_of(ids: DataFrame) -> DataFrame:
        """The full shingle sets of some representatives (distinct)."""
        wanted = cut(ids.select(F.col("rep").alias("id")).join(with_id, "id", "left_semi"), "wanted", n_docs)
        # the join moves texts: few besides those that are wanted
        own = likely_in(base, "id", wanted, "id").join(wanted, "id").select("id", "text").mapInArrow(_sets(size), "rep long, set binary")
        own = own.join(classes.select("rep", "n"), "rep").where(F.length("set") == F.col("n") * 8).drop("n").groupBy("rep").agg(F.first("set").alias("set"))
        if odd.isEmpty():
            return own
        wanted = odd.join(ids, "rep", "left_semi")
        other = (
            base.withColumn("row", F.struct(F.xxhash64("text").alias("rep"), "text"))
            .select("row.*").mapInArrow(_digests(size), "digest binary, set binary").join(wanted, "digest").groupBy("rep").agg(F.first("set").alias("set"))
        )
        return own.unionByName(other)

    def verify(pairs: DataFrame, label: str, n_pairs: int) -> DataFrame:
        ids = pairs.select(F.explode(F.array("a", "b")).alias("rep")).distinct()
        sets = cut(sets_of(ids), "sets", n_sets)
        full = pairs.join(sets.select(F.col("rep").alias("a"), F.col("set").alias("sa")), "a").join(
            sets.select(F.col("rep").alias("b"), F.col("set").alias("sb")), "b"
        ).select("a", "sa", "b", "sb")
        return cut(full.mapInArrow(_verified(num, den), "a long, b long"), label, SET_ROWS * n_pairs)

    links = verify(likely.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links", 2 * n_docs)
    roots = components(links, rows=2 * n_docs)

    # 4. lists whose members are not yet in one component
    rooted = postings.join(roots.withColumnRenamed("node", "rep"), "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    wide = rooted.withColumn("own", F.col("band")).withColumn("band", F.explode(F.array(F.col("band"), F.col("band") - 1)))
    open_lists = (
        wide.groupBy("v", "band").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("m"))
        .where("lo <> hi and m > 2").select("v", "band", F.ceil(F.col("m") / block).alias("blocks"))
    )
    blocked = wide.join(open_lists, ["v", "band"]).withColumn("mine", F.pmod(F.xxhash64("rep"), F.col("blocks")))
    blocked = blocked.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(
        "v", "band", F.least("mine", "other").alias("p"), F.greatest("mine", "other").alias("q"),
        (F.col("mine") > F.col("other")).cast("long").alias("side"), "rep", "n", "root", "own",
    )
    # of each member which of its values have lists, and its smallest values
    prefix = postings.groupBy("rep").agg(F.collect_list("v").alias("vs"))
    prefix = prefix.mapInArrow(_packed_values, "rep long, prefix binary")
    searching = wide.join(open_lists, ["v", "band"], "left_semi").select("rep").distinct()
    smallest = sets_of(searching).select("rep", F.substring("set", 1, 8 * WHOLE).alias("set"))
    members = cut(smallest.join(prefix, "rep").select("rep", "prefix", "set"), "members", n_sets)
    searched = cut(
        blocked.join(members, "rep")
        .select("v", "band", "p", "q", "side", "rep", "n", "root", "own", "prefix", "set")
        .repartition("v", "band", "p", "q").sortWithinPartitions("v", "band", "p", "q")
        .mapInArrow(_searched(k, num, den, least_shared), "a long, b long, sure boolean"),
        "searched",
    )
    # hub pairs of longer lists were met there
    of = lambda c: roots.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}"))
    apart = first.where("m <= 2").join(of("a"), "a", "left").join(of("b"), "b", "left").where(F.coalesce("root_a", "a") != F.coalesce("root_b", "b"))
    apart = apart.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    side = lambda c: reps.select(F.col("rep").alias(c), F.col("n").alias(f"n{c}")).join(fine.select(F.col("rep").alias(c), F.col("fine").alias(f"f{c}")), c, "left")
    apart = apart.join(side("a"), "a").join(side("b"), "b").mapInArrow(_sifted(num, den), "a long, b long")
    n_found = searched.count()
    more = cut(
        apart.unionByName(searched.where("not sure").select("a", "b")).distinct().join(links.select("a", "b"), ["a", "b"], "left_anti"),
        "second", 2 * n_values + n_found,
    )
    sure = searched.where("sure").select("a", "b")
    if not more.isEmpty() or not sure.isEmpty():
        n_more = more.count()
        n_links = 2 * n_docs + n_more + n_found
        links = cut(links.unionByName(verify(more, "links", n_more)).unionByName(sure), "links", n_links)
        roots = components(links, rows=n_links)

    # back to every row: the smallest id of the component
    named = classes.join(roots.withColumnRenamed("node", "rep"), "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    group = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = cut(named.join(group, "root").select("digest", "copies", "root", "component_id"), "named", n_docs)
    n_rows = named.agg(F.sum("copies")).first()[0] or 0
    out = lookup(sig.where("n > 0").select("id", "n", "digest", *own), named, "digest", "copies", n_rows).select("id", "n", "root", "component_id", *own)
    return out.unionByName(sig.where("n = 0").select("id", "n", F.lit(None).cast("long").alias("root"), F.col("id").alias("component_id"), *own))


def _digests(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [s.tobytes() for s in T.shingle_sets(*T.as_bytes(batch.column(1)), size)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([hashlib.blake2b(s, digest_size=16).digest() for s in sets], pa.binary()), pa.array(sets, pa.binary())], ["digest", "set"]
            )

    return run


def drop_near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 5,
    similarity: tuple[int, int] = (75, 100),
    k: int = 32,
    least_shared: int = 10,
    block: int = BLOCK,
) -> DataFrame:
    """``docs`` without the near-duplicates: exactly one row of each group
    stays, with all columns, one with the smallest id.  Rows whose id is null
    stay only if no id names their group.

    A row is found again by its id and text, so texts that share an id, or have
    none, are judged one by one.  Of wordless rows one stays for each id, and
    all whose id is null, as nothing links them."""
    key = F.concat_ws(":", F.md5(F.coalesce(F.col(text_col).cast("binary"), F.lit("").cast("binary"))), F.col(id_col).cast("long").cast("string"))
    rows = _grouped(docs.select(*_id_and_text(id_col, text_col), key.alias("key")), size, similarity, k, least_shared, block)
    # rows of one key have one id and one text, so one group
    each = rows.groupBy("key").agg(F.count("*").alias("__copies"), *[F.first(c).alias(c) for c in ("id", "n", "root", "component_id")])
    named = lambda by, c: F.concat(F.lit(by), F.col(c).cast("string"))
    group = F.when(F.col("n") > 0, named("root:", "root")).when(F.col("id").isNotNull(), named("id:", "id")).otherwise(named("key:", "key"))
    each = cut(each.select("key", "__copies", (F.col("id").isNull() & (F.col("n") == 0)).alias("__all"),
                           F.col("id").eqNullSafe(F.col("component_id")).alias("may"), group.alias("group")), "keys")
    best = each.where("may").groupBy("group").agg(F.min("key").alias("key")).select("key", F.lit(True).alias("__stays"))
    verdict = each.join(best, "key", "left").select(F.col("key").alias("__key"), "__copies", "__all", F.coalesce("__stays", F.lit(False)).alias("__stays"))
    verdict = cut(verdict, "verdict", each.count())
    n_rows = verdict.agg(F.sum("__copies")).first()[0] or 0
    out = lookup(docs.withColumn("__key", key), verdict, "__key", "__copies", n_rows).where("__stays")
    many = "__copies > 1 and not __all"
    if not verdict.where("__stays").where(many).isEmpty():
        out = out.where(f"not ({many})").unionByName(out.where(many).dropDuplicates(["__key"]))
    return out.select(*docs.columns)
