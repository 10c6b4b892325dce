"""Bronze readers: header CSV with a declared all-text schema, optional tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import landed
from . import csv_records

CORRUPT = "_corrupt_record"
# Arrival order of CSV rows: file, split start, position inside the split.
CSV_SEQ = ("_file", "_block", "_row")
# Fields that a short line may lack: the load takes a missing one as NULL.
MAY_LACK = ("quantity", "unit_price", "order_date", "created_at")


class MissingColumnError(ValueError):
    """A needed column is absent from a file's header."""


def read_csv_raw(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """Read header CSV files as text columns plus the arrival sequence.

    The files are read as a dict reader reads them, over any number of splits
    (see ``csv_records``): quoting as in RFC 4180, line breaks inside quotes
    belong to the field, blank lines are no records.  Each file has its own
    header line, in any order of columns: columns are matched by name, extra
    ones are ignored, and a file whose first line lacks a needed name raises
    ``MissingColumnError``.  Fields beyond the header are ignored and missing
    ones at the end are NULL; only a record that lacks a field outside
    ``MAY_LACK``, or is too long to be put together, keeps its text in
    ``_corrupt_record``, and ``split_rejects`` separates those so none is lost.
    Rows come back with ``_file``, ``_block`` and ``_row``, which order them as
    they stand in the files (the meaning of "first").  The lines are landed
    once in the shared folder.
    """
    names = [f.name for f in schema.fields]
    lines = csv_records.land_lines(spark, path, names)
    head = landed(csv_records.headers(lines, names), "csv-heads")
    bad = head.where(F.col("head").isNull() | F.array_contains("at", 0)).select("file").limit(5).collect()
    if bad:
        texts = lines.join(F.broadcast(head), ["file", "row"]).select("file", "line").where(F.col("file").isin([r[0] for r in bad])).limit(5).collect()
        raise MissingColumnError("; ".join(f"{r['file']}: needs columns {names}; its first line is {r['line'][:200]!r}" for r in texts))
    # one short row a file; the driver's own listing holds more of each
    heads = F.broadcast(head.select("file", F.col("row").alias("head_row"), "at"))
    whole, long = csv_records.records(lines)
    parsed = whole.where(F.col("line") != "").join(heads, "file").where(F.col("row") != F.col("head_row")).withColumn("held", csv_records.raw_fields(F.col("line")))
    at = {n: F.col("at")[i] for i, n in enumerate(names)}
    needed = F.greatest(F.lit(0), *[at[n] for n in names if n not in MAY_LACK], F.lit(0))
    position = [F.col("file").alias("_file"), F.col("block").alias("_block"), F.col("row").alias("_row")]
    rows = parsed.select(*[csv_records.unquoted(F.get("held", at[n] - 1)).alias(n) for n in names], F.when(F.size("held") < needed, F.col("line")).alias(CORRUPT), *position)
    return rows.unionByName(long.select(*[F.lit(None).cast("string").alias(n) for n in names], F.col("line").alias(CORRUPT), *position))


def split_rejects(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(well-formed rows, malformed rows: line text, fields as parsed, position)."""
    fields = [c for c in raw.columns if c != CORRUPT and c not in CSV_SEQ]
    good = raw.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    bad = raw.where(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("line"), *fields, *CSV_SEQ)
    return good, bad


def optional_table(spark: SparkSession, name_or_path: str | None, schema: T.StructType) -> DataFrame:
    """A catalog table or parquet path if it exists, else an empty frame."""
    if name_or_path:
        if "/" not in name_or_path and spark.catalog.tableExists(name_or_path):
            return spark.table(name_or_path)
        if "/" in name_or_path:
            try:
                return spark.read.schema(schema).parquet(name_or_path)
            except Exception as exc:  # missing path -> empty source
                if "PATH_NOT_FOUND" not in str(exc) and "does not exist" not in str(exc):
                    raise
    return spark.createDataFrame([], schema)
