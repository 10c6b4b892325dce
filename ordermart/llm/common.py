"""Helpers shared by the corpus operators: reading, cutting lineage, joins
that survive hot keys, stable row keys and connected components."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_run_dir, tasks_for

#: A broadcast lookup holds fewer keys than this: only keys that carry at
#: least 1 / HOT_KEYS of the total weight are broadcast, so the count is
#: bounded by arithmetic at every input size.
HOT_KEYS = 20_000
#: 2^CELL_BITS hash cells say which ids may be wanted (``likely_in``).
CELL_BITS = 24
#: A table of few rows is written by so many tasks a core, not by one for each
#: shuffle partition.
TASKS_PER_CORE = 4


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers (once a session)."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    name = os.path.join(tempfile.mkdtemp(prefix="package-"), f"{os.path.basename(top)}.zip")
    with zipfile.ZipFile(name, "w") as z:
        for folder, _, files in os.walk(top):
            for f in sorted(files):
                if f.endswith(".py"):
                    path = os.path.join(folder, f)
                    z.write(path, os.path.relpath(path, os.path.dirname(top)))
    spark.sparkContext.addPyFile(name)
    _SHIPPED.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cut(df: DataFrame, label: str, rows: int | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a lost executor
    recomputes from this table, and its row keys are fixed.

    ``rows``: a number (of rows of a few hundred bytes) that it does not exceed,
    where one is known.  Then the files follow it instead of the shuffle
    partitions: each file costs its executor a file creation, on a local file
    system without Hadoop's native library a forked process."""
    spark = df.sparkSession
    if rows is not None:
        df = df.coalesce(max(TASKS_PER_CORE * spark.sparkContext.defaultParallelism, tasks_for(rows)))
    path = new_run_dir(spark, f"llm-{label}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def crc_mod(id_col: str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n`` (null id: as the empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % n


def likely_in(rows: DataFrame, key: str, ids: DataFrame, id_col: str, bits: int = CELL_BITS) -> DataFrame:
    """``rows`` without most of those whose ``key`` (a long) is not among the
    ids.  An exact inner join with the distinct ids follows and moves few
    others (Spark would run a semi join before this one).  The ids mark 2^``bits`` hash cells, 64 a word; the
    words, 2^(``bits`` - 6) at most at every input size, are broadcast."""
    cell = lambda c: f"pmod(xxhash64(`{c}`), {1 << bits})"
    mark = lambda c: f"shiftleft(1L, cast({cell(c)} % 64 as int))"
    word = lambda c: f"shiftright({cell(c)}, 6)"
    words = ids.where(F.col(id_col).isNotNull()).groupBy(F.expr(word(id_col)).alias("__word")).agg(F.expr(f"bit_or({mark(id_col)})").alias("__marks"))
    with_marks = rows.join(F.broadcast(words), F.expr(word(key)) == F.col("__word"))
    return with_marks.where(F.col(key).isNotNull() & (F.expr(mark(key)).bitwiseAND(F.col("__marks")) != 0)).select(*rows.columns)


def lookup(big: DataFrame, small: DataFrame, key: str, weight: str, total: int, hot_keys: int = HOT_KEYS) -> DataFrame:
    """Inner join ``big`` with ``small`` (one row a key, with its ``weight``:
    the number of rows of ``big`` with that key, or another quantity whose sum
    is ``total``).

    Keys with weight >= total / hot_keys (fewer than ``hot_keys`` + 1 of them)
    are joined by broadcast, all others by a shuffle in which no key is large.
    """
    is_hot = F.col(weight) * hot_keys >= F.lit(total)
    hot, cold = small.where(is_hot), small.where(~is_hot)
    by_hot = big.join(F.broadcast(hot), key)
    by_cold = big.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key)
    return by_hot.unionByName(by_cold)


def components(links: DataFrame, label: str = "cc", max_rounds: int = 60, rows: int | None = None) -> DataFrame:
    """(node, root) for each node of ``links`` (a, b; at most ``rows``, where
    known), root the smallest node of its component.  Large-star / small-star rounds (public algorithm of
    Kiveris et al., 2014); each round is written, so nothing is gathered."""
    both = lambda e: e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))

    def star(edges: DataFrame, large: bool) -> DataFrame:
        """Join each neighbour to the smallest node around its centre."""
        if not large:  # centre: the larger end
            edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
            low = edges.groupBy("a").agg(F.min("b").alias("m"))
            out = edges.join(low, "a").select(F.col("b").alias("x"), "m").unionByName(low.select(F.col("a").alias("x"), "m"))
        else:
            sym = both(edges)
            low = sym.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
            out = sym.where("b > a").join(low, "a").select(F.col("b").alias("x"), "m")
        return out.where("x <> m").distinct().select(F.col("x").alias("a"), F.col("m").alias("b"))

    state = lambda e: tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
    edges = cut(links.select("a", "b").where("a <> b").distinct(), label, rows)
    before = state(edges)
    for _ in range(max_rounds):
        # a star gives at most a row for each edge, and the small one for each centre
        edges = cut(star(star(edges, True), False), label, 2 * before[0])
        after = state(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("connected components did not converge")
    # after convergence every edge is (node, root)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
