"""Session helpers: a local builder for tests and the shared working folder.

On a cluster the session is created by the platform; the library only reads
settings from it.  ``shared_dir`` resolves the folder every executor can see
(``spark.checkpoint.dir``) and sets a local one only when none is configured,
which is the case in unit tests.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings applied only when the session does not already carry a value.
# AQE re-plans joins from runtime sizes (broadcast only under the measured
# threshold) and splits skewed shuffle partitions of sort-merge joins.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "ordermart") -> SparkSession:
    """Builder used by tests and the benchmark (no UI, no server)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scale_settings(input_bytes: int, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Partition sizing for a run over ``input_bytes`` of input.

    Scan splits and shuffle partitions of about ``partition_bytes`` each
    (fits executor memory with room for sort buffers); AQE merges partitions
    that come out smaller and splits skewed join partitions above 4x that.
    For 100 TB this gives ~400k shuffle partitions before AQE coalescing.
    """
    parts = max(8, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    }


def apply_defaults(spark: SparkSession) -> None:
    """Fill in the defaults above where the session has no value yet."""
    for k, v in _DEFAULTS.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)


#: Rows that one task sorts at a time, so that sorts of a few hundred bytes a
#: row stay in memory whatever ``spark.sql.shuffle.partitions`` says.
ROWS_PER_TASK = 250_000


def tasks_for(rows: int) -> int:
    return max(1, -(-rows // ROWS_PER_TASK))


def dealt(df: DataFrame, rows: int, *keys: str, join: bool = False) -> DataFrame:
    """``df`` of ``rows`` rows dealt by ``keys`` to tasks of ``ROWS_PER_TASK``;
    what one task holds is left to Spark, and for a ``join`` (which may be a
    broadcast) what the set number of shuffle partitions holds."""
    n, partitions = tasks_for(rows), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if n <= (partitions if join else 1):
        return df
    return df.repartition(max(n, min(partitions, 2 * n)), *keys)


@contextmanager
def sized(spark: SparkSession, rows: int) -> Iterator[None]:
    """Shuffles of the queries run inside have partitions enough for ``rows``."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    try:
        if tasks_for(rows) > int(before):
            spark.conf.set(name, str(tasks_for(rows)))
        yield
    finally:
        spark.conf.set(name, before)


def session_key(spark: SparkSession) -> str:
    """Identity of the running application (for per-session caches)."""
    app_id = spark.conf.get("spark.app.id", None)
    return app_id or f"session-{id(spark)}"


def shared_dir(spark: SparkSession) -> str:
    """Root folder shared by driver and executors.

    Uses the cluster's ``spark.checkpoint.dir`` (or the context's checkpoint
    dir).  Only when neither is set and the master is local (tests), a fresh
    folder under the system temp dir is made; any other master raises.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # remote session without a local context
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            raise RuntimeError("spark.checkpoint.dir is not set") from None
        return root.rstrip("/")
    root = sc.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="ordermart-")
        sc.setCheckpointDir(root)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def new_run_dir(spark: SparkSession, label: str) -> str:
    """A fresh, never reused sub-folder of the shared dir for one run."""
    root = shared_dir(spark)
    return f"{root}/ordermart/{label}-{uuid.uuid4().hex[:12]}"


def landed(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back."""
    where = new_run_dir(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(where)
    return df.sparkSession.read.schema(df.schema).parquet(where)
