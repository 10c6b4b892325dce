"""Sharding by longest-processing-time scheduling.

Rows with equal text form a group that stays together.  LPT takes groups by
size, largest first (ties by digest), and gives each to the least-loaded shard,
by a heap (``schedule``).  The whole schedule follows from how many groups there
are of each size, so it is the same at every number of groups and nothing but
that histogram comes to the driver: it has at most sqrt(2 * all bytes) sizes,
since they are distinct and sum up to all bytes at most.  The driver keeps the
shards' loads before each size, by the heap for few groups of a size and by
counting for many.  The k-th group of a size then finds its shard from those
loads alone: the shards take groups of one size s at the loads L, L + s, L + 2s,
..., and the k-th smallest of these names the shard.

A group's place among those of its size is its row number in a range of digests
after the ranges before.  Groups of at least 1 / ``HEAVY`` of all bytes or rows
are fewer than 2 * ``HEAVY`` by arithmetic; their rows meet their shard by
broadcast, all others by a shuffle.  Slots number the rows of a shard without a gap: rows are dealt to buckets by
hash of the id, counted, and numbered inside their bucket after the rows of
the buckets before it.  So no shard or group meets in one task.

Defined cases: null text counts as empty and has size 1; rows with equal text,
repeated rows included, share a shard; a null id is dealt as the text 'null';
ties in size go by the group's digest; an empty table gives no rows; only the
id and text are read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut

HEAVY = 4_000
#: Groups of one range of digests and rows of one numbering bucket, about.
RANGE_GROUPS = 200_000
BUCKET_ROWS = 200_000
#: So many groups of a size go through the heap one by one.
_BY_HEAP = 64


def schedule(sizes: list[tuple[int, str]], shards: int) -> dict[str, int]:
    """LPT: (size, name) pairs, largest first, each to the least-loaded shard."""
    heap = [(0, i) for i in range(shards)]
    out = {}
    for size, name in sorted(sizes, key=lambda s: (-s[0], s[1])):
        least, i = heap[0]
        heapq.heapreplace(heap, (least + size, i))
        out[name] = i
    return out


def levels(loads: np.ndarray, size: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(load, shard) at which the k-th of equally large groups is taken, for
    each row: loads (rows, shards), size and k (rows)."""

    def upto(v: np.ndarray) -> np.ndarray:
        """How many groups are taken at loads up to v."""
        return np.maximum((v[:, None] - loads) // size[:, None] + 1, 0).sum(1)

    low, high = loads.min(1), loads.min(1) + size * k
    while (open_ := low < high).any():
        mid = (low + high) // 2
        enough = upto(mid) > k
        high = np.where(open_ & enough, mid, high)
        low = np.where(open_ & ~enough, mid + 1, low)
    nth = k - upto(low - 1)  # among the shards that are at this load
    here = (low[:, None] >= loads) & ((low[:, None] - loads) % size[:, None] == 0)
    return low, np.argmax(np.cumsum(here, 1) > nth[:, None], 1)


def loads_before(sizes: list[int], counts: list[int], shards: int) -> np.ndarray:
    """The shards' loads before each size; sizes falling."""
    load, out = [0] * shards, np.zeros((len(sizes), shards), np.int64)
    for row, (size, count) in enumerate(zip(sizes, counts, strict=True)):
        out[row] = load
        if count <= _BY_HEAP:
            heap = [(x, i) for i, x in enumerate(load)]
            heapq.heapify(heap)
            for _ in range(count):
                least, i = heap[0]
                heapq.heapreplace(heap, (least + size, i))
            for x, i in heap:
                load[i] = x
        else:
            one = lambda x: np.array([x], np.int64)
            v, last = (int(x[0]) for x in levels(out[row : row + 1], one(size), one(count - 1)))
            taken = [max(0, (v - (i > last) - x) // size + 1) for i, x in enumerate(load)]
            load = [x + n * size for x, n in zip(load, taken, strict=True)]
    return out


def _scheduled(sizes: Broadcast, loads: Broadcast):
    """Rows (digest, size, place among the groups of that size): a shard each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, k = (batch.column(i).to_numpy() for i in (1, 2))
            at = np.searchsorted(-sizes.value, -size)  # sizes fall
            _, shard = levels(loads.value[at], size, k)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shard.astype(np.int32))], ["digest", "shard"])

    return run


def assign(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text", range_groups: int = RANGE_GROUPS) -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard) for each row."""
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = cut(
        docs.select(
            F.col(id_col).cast("long").alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
            F.md5(text).alias("digest"),
        ),
        "sizes",
    )
    groups = cut(rows.groupBy("digest").agg(F.sum("size").alias("size"), F.count("*").alias("n")), "groups")
    total = groups.agg(F.sum("size"), F.sum("n"), F.count("*")).first()
    n_bytes, n_rows, n_groups = (x or 0 for x in total)
    is_heavy = (F.col("size") * HEAVY >= n_bytes) | (F.col("n") * HEAVY >= n_rows)
    sc = docs.sparkSession.sparkContext
    histogram = groups.groupBy("size").agg(F.count("*").alias("groups")).toArrow().sort_by([("size", "descending")])
    sizes = histogram.column("size").to_numpy()
    loads = loads_before(sizes.tolist(), histogram.column("groups").to_pylist(), shards)
    # the place of each group among those of its size, by digest
    ranges = max(1, -(-n_groups // range_groups))
    part = (F.conv(F.substring("digest", 1, 8), 16, 10).cast("long") * ranges / (1 << 32)).cast("int")
    dealt = groups.withColumn("part", part)
    in_parts = dealt.groupBy("size", "part").agg(F.count("*").alias("groups"))
    base = in_parts.select("size", "part", F.coalesce(F.sum("groups").over(Window.partitionBy("size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    inside = F.row_number().over(Window.partitionBy("size", "part").orderBy("digest"))
    ranked = dealt.withColumn("inside", inside).join(base, ["size", "part"]).select("digest", "size", (F.col("base") + F.col("inside") - 1).alias("k"))
    placed = cut(ranked.mapInArrow(_scheduled(sc.broadcast(sizes), sc.broadcast(loads)), "digest string, shard int").join(groups, "digest"), "placed")
    of_heavy, by_light = (placed.where(x).select("digest", "shard") for x in (is_heavy, ~is_heavy))
    # heavy groups by broadcast; no other group is large, so the shuffle is even
    dealt = rows.join(F.broadcast(of_heavy), "digest").unionByName(
        rows.join(F.broadcast(of_heavy.select("digest")), "digest", "left_anti").join(by_light, "digest")
    )
    buckets = max(1, -(-n_rows // BUCKET_ROWS), min(64, n_rows // 1_000))
    dealt = cut(dealt.withColumn("bucket", F.pmod(F.xxhash64(F.coalesce(F.col("id").cast("string"), F.lit("null")), "digest", F.col("id")), F.lit(buckets))), "dealt")
    counts = dealt.groupBy("shard", "bucket").count()  # shards * buckets rows, one for each 25,000 input rows or so
    before = counts.withColumn("base", F.sum("count").over(Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))).select(
        "shard", "bucket", F.coalesce("base", F.lit(0)).alias("base")
    )
    inside = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("id", "digest"))
    out = dealt.withColumn("inside", inside).join(before, ["shard", "bucket"])
    return out.select(
        F.col("id").alias(id_col), "size", F.col("text_crc32").cast("long").alias("text_crc32"), F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"), (F.col("base") + F.col("inside") - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
