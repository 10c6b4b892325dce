"""First-occurrence flag per key, safe for hot keys.

``row_number() OVER (PARTITION BY key ORDER BY arrival)`` sends every row of
one key to one task; if a single key (a blank order id, say) holds a third of
the data, that task holds a third of the data.  Here rows are
first counted by ``CELLS`` hash cells of the key, which needs no shuffle of the
keys.  If no cell holds more than ``split_rows`` rows, no key does: rows are
dealt by key to tasks of ``ROWS_PER_TASK`` and ranked.  Else, and where one task
holds all rows:

1. a count per key (hash aggregation, partial on the map side) finds the hot
   keys: more than ``split_rows`` rows and more than 1 / ``HOT_KEYS`` of all
   rows, so fewer than ``HOT_KEYS`` of them by arithmetic; all are split;
2. the first arrival of each hot key is an aggregation over the hot keys'
   rows only (partial on the map side, one row per hot key out, broadcast);
3. rows of hot keys get a deterministic salt in ``[0, buckets)`` (the same on
   every retry), every other row salt 0; rows are shuffled once on
   (key, salt) and ``row_number()`` runs inside each (key, salt) group.

A key that is not split keeps all its rows in one group, so ``row_number``
is exact for it; a split key is judged against its broadcast first arrival.
Rows of one key that tie in the whole arrival order are told apart by their
content (a hash of all columns).  Rows that are equal throughout share a salt,
so ``row_number`` makes one of them first at every size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import dealt, tasks_for

DEFAULT_SPLIT_ROWS = 2_000_000
#: Keys with more than 1 / HOT_KEYS of all rows are fewer than HOT_KEYS.  Below
#: splitRows x HOT_KEYS rows (2 * 10^12 by default) every key above splitRows
#: is split.
HOT_KEYS = 1_000_000
CELLS = 1 << 13


def _conf_int(df: DataFrame, name: str, default: int) -> int:
    try:
        return int(df.sparkSession.conf.get(name, str(default)))
    except Exception:  # pragma: no cover - conf not readable
        return default


def _sizes(df: DataFrame, key: str) -> tuple[int, int]:
    """The number of rows, and one that no key's rows exceed."""
    cells = df.groupBy(F.pmod(F.xxhash64(key), F.lit(CELLS)).alias("_cell")).agg(F.count(F.lit(1)).alias("_n"))
    return tuple(x or 0 for x in cells.agg(F.sum("_n"), F.max("_n")).first())


def flag_repeats(
    df: DataFrame,
    key: str,
    arrival: Sequence[str],
    flag_col: str = "_is_duplicate",
    split_rows: int | None = None,
    keys: DataFrame | None = None,
) -> DataFrame:
    """Add ``flag_col`` = 1 for every row that is not the first of its key.

    ``arrival`` lists the columns that order rows within a key.  A NULL key is
    a key like any other.  The result has the input columns plus the flag.
    ``keys``: a frame with the key column, counted in place of ``df``, in which
    no key has fewer rows; one that has more may only split what need not be.
    """
    split_rows = split_rows or _conf_int(df, "ordermart.skew.splitRows", DEFAULT_SPLIT_ROWS)
    columns = df.columns
    n_rows, most = _sizes(df if keys is None else keys, key)
    # ties in arrival order: by content, so the first row is one row everywhere
    content = F.xxhash64(*[F.col(c) for c in columns])
    arrival = [*arrival, "_content"]
    if most <= split_rows and tasks_for(n_rows) > 1:
        rank = F.row_number().over(Window.partitionBy(key).orderBy(*[F.col(c) for c in arrival]))
        rows = dealt(df, n_rows, key).withColumn("_content", content)
        return rows.withColumn(flag_col, F.when(rank == 1, 0).otherwise(1).cast("smallint")).select(*columns, flag_col)
    df = df.withColumn("_content", content)
    order: Column = F.struct(*[F.col(c) for c in arrival])

    # 1. hot keys: fewer than HOT_KEYS by arithmetic
    counts = df.groupBy(F.col(key).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    total = df.agg(F.count(F.lit(1)).alias("_all"))
    hot_keys = (
        counts.where((F.col("_n") > split_rows) & (F.col("_n") * HOT_KEYS > total.scalar()))
        .select("_k", F.ceil(F.col("_n") / F.lit(split_rows)).cast("int").alias("_buckets"))
    )
    # 2. first arrival of each hot key, from the hot keys' rows only
    hk = F.broadcast(hot_keys)
    hot_rows = df.join(hk, df[key].eqNullSafe(hk["_k"]), "left_semi")
    hot_first = hot_rows.groupBy(F.col(key).alias("_k")).agg(F.min(order).alias("_first"))
    hot = hot_keys.join(hot_first, hot_keys["_k"].eqNullSafe(hot_first["_k"])).select(
        hot_keys["_k"], "_buckets", "_first"
    )
    # 3. salt hot rows, one shuffle on (key, salt), rank inside each group.
    # The salt follows the arrival key, so rows equal throughout share a group
    # and row_number picks one of them, split or not.
    rows = df.join(F.broadcast(hot), df[key].eqNullSafe(hot["_k"]), "left").drop("_k")
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in arrival]), F.col("_buckets"))
    rows = dealt(rows.withColumn("_salt", F.coalesce(salt, F.lit(0)).cast("int")), n_rows, key, "_salt")
    rank = F.row_number().over(Window.partitionBy(key, "_salt").orderBy(*[F.col(c) for c in arrival]))
    first = F.col("_first").isNull() | order.eqNullSafe(F.col("_first"))
    return rows.withColumn(flag_col, F.when(first & (rank == 1), 0).otherwise(1).cast("smallint")).select(*columns, flag_col)


def first_rows(df: DataFrame, key: str, arrival: Sequence[str], **kw) -> DataFrame:
    """Rows that are the first of their key (the complement of ``flag_repeats``)."""
    return flag_repeats(df, key, arrival, "_rep", **kw).where(F.col("_rep") == 0).drop("_rep")
