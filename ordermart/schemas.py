"""Declared schemas for every layer.  Nothing is inferred and nothing evolves."""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, S, True) for n in names])


ORDER_FIELDS = ("order_id", "customer_id", "sku", "quantity", "unit_price", "order_date", "channel")

# Bronze: raw files, every field text.
ORDERS_RAW = _strings(*ORDER_FIELDS)
CUSTOMERS_RAW = _strings("customer_id", "name", "country", "segment", "created_at")
PRODUCTS_RAW = _strings("sku", "category", "cost", "active")
# A submitted order is the same seven text fields.
CANDIDATES_RAW = _strings(*ORDER_FIELDS)

# Accepted orders written by order entry (typed, all NOT NULL in the source).
NEW_ORDERS = T.StructType(
    [
        T.StructField("order_id", S, False),
        T.StructField("customer_id", S, False),
        T.StructField("sku", S, False),
        T.StructField("quantity", T.IntegerType(), False),
        T.StructField("unit_price", T.DoubleType(), False),
        T.StructField("order_date", T.DateType(), False),
        T.StructField("channel", S, False),
        T.StructField("created_at", T.TimestampType(), False),
    ]
)

# Silver.
STG_ORDERS = T.StructType(
    [
        T.StructField("order_id", S),
        T.StructField("customer_id", S),
        T.StructField("sku", S),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("unit_price", T.DoubleType()),
        T.StructField("order_date", T.DateType()),
        T.StructField("channel", S),
        T.StructField("_is_duplicate", T.ShortType()),
        T.StructField("_negative_qty", T.ShortType()),
        T.StructField("_null_price", T.ShortType()),
        T.StructField("_invalid_date", T.ShortType()),
    ]
)
STG_CUSTOMERS_COLS = ("customer_id", "name", "country", "segment", "created_at")
STG_PRODUCTS_COLS = ("sku", "category", "cost", "active")

# Gold.
FACT_COLS = (
    "order_id",
    "customer_id",
    "sku",
    "quantity",
    "unit_price",
    "order_date",
    "year",
    "month",
    "year_month",
    "channel",
    "revenue",
    "gross_profit",
    "margin_pct",
)
VIEW_COLS = (
    "order_id",
    "order_date",
    "year",
    "month",
    "year_month",
    "channel",
    "quantity",
    "unit_price",
    "revenue",
    "gross_profit",
    "margin_pct",
    "customer_id",
    "customer_name",
    "country",
    "segment",
    "sku",
    "category",
    "product_cost",
    "product_active",
)

FACT = T.StructType(
    [
        T.StructField("order_id", S),
        T.StructField("customer_id", S),
        T.StructField("sku", S),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("unit_price", T.DoubleType()),
        T.StructField("order_date", T.DateType()),
        T.StructField("year", S),
        T.StructField("month", S),
        T.StructField("year_month", S),
        T.StructField("channel", S),
        T.StructField("revenue", T.DecimalType(18, 2)),
        T.StructField("gross_profit", T.DecimalType(18, 2)),
        T.StructField("margin_pct", T.DecimalType(10, 2)),
    ]
)

# Output types shared by every report (money and ratios are exact decimals).
MONEY = T.DecimalType(18, 2)
MONEY_SUM = T.DecimalType(38, 2)  # totals: no overflow at any data size
RATIO = T.DecimalType(18, 2)
MARGIN = T.DecimalType(10, 2)
FLAG = T.ShortType()
COUNT = T.LongType()

# The allowed sales channels of order entry.
VALID_CHANNELS = ("ecommerce", "retail", "wholesale", "export")
