"""Order ids laid out by hash bucket, so a batch reads only its own buckets.

A store is a folder of generations and batches:

    <root>/upto=K/of=B/id_bucket=b/...    every id accepted before batch K
    <root>/batch=N/of=B/id_bucket=b/...   the ids that batch N accepted

``before(N)`` is the newest whole generation K <= N and the batches K <= n < N,
so a batch that runs again sees what it saw the first time, whatever was
compacted since.  ``lookup`` collects the distinct buckets of the wanted ids
(at most B numbers) and reads those folders only: the scan's partition filter
names them, and of these ids those whose hash cell no wanted id marks are left
out before anything is moved.  Each folder is overwritten as a whole, and counts only when its
``_SUCCESS`` mark is there.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Buckets of a store; more for more ids, so that one bucket is a small read
#: (``ordermart.ids.buckets``).  Kept with the data: stores of another number
#: stay readable.
DEFAULT_BUCKETS = 64


#: Hash cells that wanted ids mark, 64 a word and 64 words a block: the blocks,
#: broadcast, are 2^14 of 700 bytes at most, however many ids are wanted.
CELL_BITS = 26


def likely(ids: DataFrame, wanted: DataFrame) -> DataFrame:
    """``ids`` (order_id) without most of those that are not among ``wanted``."""
    cell = F.pmod(F.xxhash64("order_id"), F.lit(1 << CELL_BITS))
    block, word = F.shiftright(cell, 12), (F.shiftright(cell, 6) % 64).cast("tinyint")
    mark = F.call_function("shiftleft", F.lit(1).cast("long"), (cell % 64).cast("int"))
    words = wanted.where(F.col("order_id").isNotNull()).groupBy(block.alias("_block"), word.alias("_word")).agg(F.bit_or(mark).alias("_marks"))
    # few wide rows: a row a word takes the driver three times the memory
    blocks = words.groupBy("_block").agg(F.collect_list(F.struct("_word", "_marks")).alias("_w")).select("_block", F.col("_w._word").alias("_words"), F.col("_w._marks").alias("_marks"))
    marked = ids.join(F.broadcast(blocks), block == F.col("_block"))
    marks = F.get("_marks", (F.array_position("_words", word) - 1).cast("int"))
    return marked.where(F.col("order_id").isNotNull() & (mark.bitwiseAND(marks) != 0)).select(*ids.columns)


def bucket_of(order_id: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(order_id), F.lit(buckets)).cast("int")


class IdStore:
    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self.buckets = buckets or int(spark.conf.get("ordermart.ids.buckets", str(DEFAULT_BUCKETS)))

    # -- folders ---------------------------------------------------------------

    def _children(self, path: str) -> list[str]:
        """Names in a folder of any file system; none if it is not there."""
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = at.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        return [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []

    def has(self, table: str) -> bool:
        """Whether a written table of that name is there, whole."""
        return "_SUCCESS" in self._children(f"{self.root}/{table}")

    def _whole(self, kind: str) -> list[int]:
        numbers = [int(n.split("=")[1]) for n in self._children(self.root) if n.startswith(f"{kind}=")]
        return sorted(n for n in numbers if self.has(f"{kind}={n}"))

    def generation(self, batch: int) -> int | None:
        return max((k for k in self._whole("upto") if k <= batch), default=None)

    def before(self, batch: int) -> list[str]:
        """The folders whose ids were accepted before ``batch``."""
        k = self.generation(batch)
        log = [n for n in self._whole("batch") if (k is None or n >= k) and n < batch]
        return ([] if k is None else [f"{self.root}/upto={k}"]) + [f"{self.root}/batch={n}" for n in log]

    # -- writing ---------------------------------------------------------------

    def _write(self, ids: DataFrame, name: str) -> None:
        rows = ids.select("order_id", F.lit(self.buckets).alias("of"), bucket_of(F.col("order_id"), self.buckets).alias("id_bucket"))
        # one small file a bucket: ids of a bucket meet, large buckets are split by AQE
        rows.hint("rebalance", "id_bucket").write.mode("overwrite").option("compression", "zstd").partitionBy("of", "id_bucket").parquet(f"{self.root}/{name}")

    def start(self, ids: DataFrame) -> None:
        """The ids accepted before batch 0 (kept if they are there already)."""
        if 0 not in self._whole("upto"):
            self._write(ids, "upto=0")

    def append(self, batch: int, ids: DataFrame) -> None:
        self._write(ids, f"batch={batch}")

    def compact(self, batch: int, every: int = 64) -> None:
        """Fold what was accepted before ``batch`` into one generation, once
        ``every`` batches have come since the last."""
        folders = self.before(batch)
        if sum(f.startswith(f"{self.root}/batch=") for f in folders) > every:
            self._write(self._read(folders, None), f"upto={batch}")

    # -- reading ---------------------------------------------------------------

    def _read(self, folders: list[str], wanted: DataFrame | None) -> DataFrame:
        """Ids of these folders, of the wanted ids' buckets only."""
        layouts: dict[int, list[str]] = {}
        for f in folders:
            for n in self._children(f):
                if n.startswith("of="):
                    layouts.setdefault(int(n.split("=")[1]), []).append(f"{f}/{n}")
        parts = []
        for of, paths in sorted(layouts.items()):
            frames = [self.spark.read.schema("order_id string, id_bucket int").parquet(p) for p in paths]
            ids = reduce(DataFrame.unionByName, frames)
            if wanted is not None:
                mine = [r[0] for r in wanted.select(bucket_of(F.col("order_id"), of)).distinct().collect()]
                ids = ids.where(F.col("id_bucket").isin(mine))
            parts.append(ids.select("order_id") if wanted is None else likely(ids.select("order_id"), wanted))
        return reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], "order_id string")

    def lookup(self, wanted: DataFrame, batch: int = 0) -> DataFrame:
        """Stored ids that may be among ``wanted`` (order_id), as accepted
        before ``batch``: all that are, and few others of their buckets."""
        return self._read(self.before(batch), wanted)
