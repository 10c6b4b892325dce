"""Silver layer: typed, flagged staging rows.  Nothing is dropped here.

Rule for orders ("flag first, filter later"): a row is a duplicate when its
order id already appeared earlier in arrival order -- app orders first, then
file rows in file order -- even if that earlier row is itself invalid.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clean
from ..schemas import STG_CUSTOMERS_COLS, STG_PRODUCTS_COLS, STG_ORDERS
from .dedup import flag_repeats

SOURCE_RANK = "_source_rank"  # 0 = order entry, 1 = files


_TEXT = ("customer_id", "sku", "quantity", "unit_price", "order_date", "channel")
_TYPED = (("_q", "int"), ("_p", "double"), ("_d", "date"))


def _file_rows(raw: DataFrame, seq: Sequence[str]) -> DataFrame:
    return raw.select(
        clean.strip_or_empty("order_id").alias("order_id"),
        *[F.col(c).cast("string").alias(c) for c in _TEXT],
        *[F.lit(None).cast(t).alias(n) for n, t in _TYPED],
        F.lit(1).alias(SOURCE_RANK),
        *[F.col(c) for c in seq],
    )


def _app_rows(app: DataFrame, like: DataFrame, seq: Sequence[str]) -> DataFrame:
    # Typed values pass through unchanged (their text round-trip is the identity).
    out = app.select(
        clean.strip_or_empty("order_id").alias("order_id"),
        F.col("customer_id").cast("string"),
        F.col("sku").cast("string"),
        *[F.lit(None).cast("string").alias(c) for c in ("quantity", "unit_price", "order_date")],
        F.col("channel").cast("string"),
        F.col("quantity").cast("int").alias("_q"),
        F.col("unit_price").cast("double").alias("_p"),
        F.col("order_date").cast("date").alias("_d"),
        F.lit(0).alias(SOURCE_RANK),
        *[F.lit(None).cast(like.schema[c].dataType).alias(c) for c in seq],
    )
    return out


def stage_orders(
    raw_orders: DataFrame,
    app_orders: DataFrame | None,
    seq: Sequence[str],
    keep_arrival: bool = False,
    order_ids: DataFrame | None = None,
    **skew,
) -> DataFrame:
    """``stg_orders``: app orders + file orders, typed, with the four flags.

    ``seq`` names the columns of ``raw_orders`` giving file order (for files
    read with ``read_csv_raw`` that is ``CSV_SEQ``).  ``order_ids``: a frame
    that is read with less work than ``raw_orders`` and holds every order id
    at least as often; rows are counted by it.

    Only the stripped ``order_id`` and the arrival key are computed before
    the duplicate check's shuffle; the text fields are parsed after it, so
    parsing runs at shuffle parallelism whatever the input layout (a few
    large unsplittable files would otherwise parse in a few tasks).
    """
    rows = _file_rows(raw_orders, seq)
    if app_orders is not None:
        rows = _app_rows(app_orders, rows, seq).unionByName(rows)
    if order_ids is not None:
        ids = [x.select(clean.strip_or_empty("order_id").alias("order_id")) for x in (order_ids, app_orders) if x is not None]
        skew["keys"] = reduce(DataFrame.unionByName, ids)
    flagged = flag_repeats(rows, "order_id", [SOURCE_RANK, *seq], "_is_duplicate", **skew)
    from_app = F.col(SOURCE_RANK) == 0
    typed = flagged.select(
        "order_id",
        clean.strip_or_empty("customer_id").alias("customer_id"),
        clean.strip_or_empty("sku").alias("sku"),
        F.when(from_app, F.col("_q")).otherwise(clean.to_int("quantity")).alias("quantity"),
        F.when(from_app, F.col("_p")).otherwise(clean.to_double("unit_price")).alias("unit_price"),
        F.when(from_app, F.col("_d")).otherwise(clean.to_date("order_date")).alias("order_date"),
        F.lower(clean.strip_or_empty("channel")).alias("channel"),
        "_is_duplicate",
        SOURCE_RANK,
        *seq,
    )
    out = typed.select(
        *[c for c in typed.columns if c not in (SOURCE_RANK, *seq)],
        clean.flag(F.col("quantity") < 0).alias("_negative_qty"),
        clean.flag(F.col("unit_price").isNull()).alias("_null_price"),
        clean.flag(F.col("order_date").isNull()).alias("_invalid_date"),
        SOURCE_RANK,
        *seq,
    )
    cols = [f.name for f in STG_ORDERS.fields]
    if keep_arrival:
        cols += [SOURCE_RANK, *seq]
    return out.select(*cols)


def stage_customers(raw: DataFrame) -> DataFrame:
    """``stg_customers``: stripped text (a missing field reads as empty text), blanks -> 'Unknown', typed date."""
    out = raw.select(
        clean.strip_or_empty("customer_id").alias("customer_id"),
        clean.strip_or_empty("name").alias("name"),
        clean.default_unknown("country").alias("country"),
        clean.default_unknown("segment").alias("segment"),
        clean.to_date("created_at").alias("created_at"),
    )
    return out.select(*STG_CUSTOMERS_COLS)


def stage_products(raw: DataFrame) -> DataFrame:
    """``stg_products``: stripped sku, category default, cost number, 0/1 active."""
    out = raw.select(
        clean.strip_or_empty("sku").alias("sku"),
        clean.default_unknown("category").alias("category"),
        clean.to_double("cost").alias("cost"),
        clean.to_active_flag("active").alias("active"),
    )
    return out.select(*STG_PRODUCTS_COLS)
