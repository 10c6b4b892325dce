"""Gold layer: dimensions, the order fact and the wide reporting view.

Joins to the dimensions are plain equi-joins: Spark broadcasts a dimension
only when its measured size is under ``spark.sql.autoBroadcastJoinThreshold``
(AQE re-checks at runtime) and otherwise sort-merge joins, where AQE splits a
fact partition that one hot key makes oversized.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.measures import order_measures
from ..schemas import FACT_COLS, STG_CUSTOMERS_COLS, STG_PRODUCTS_COLS, VIEW_COLS
from ..session import dealt

FLAG_COLS = ("_is_duplicate", "_negative_qty", "_null_price", "_invalid_date")


class DuplicateKeyError(ValueError):
    """A dimension would violate its primary key."""


def duplicate_keys(df: DataFrame, key: str, table: str) -> DataFrame:
    """Keys occurring more than once: (table, key, rows).  Partial-aggregated."""
    return (
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias("rows"))
        .where(F.col("rows") > 1)
        .select(F.lit(table).alias("table"), F.col(key).alias("key"), "rows")
    )


def assert_unique(df: DataFrame, key: str, table: str, show: int = 20) -> None:
    """Raise ``DuplicateKeyError`` naming offending keys (at most ``show``)."""
    bad = duplicate_keys(df, key, table).orderBy(F.desc("rows"), "key").limit(show).collect()
    if bad:
        keys = ", ".join(f"{r['key']!r} x{r['rows']}" for r in bad)
        raise DuplicateKeyError(f"{table}: duplicate {key}: {keys}")


def dim_customers(stg_customers: DataFrame) -> DataFrame:
    return stg_customers.select(*STG_CUSTOMERS_COLS)


def dim_products(stg_products: DataFrame) -> DataFrame:
    return stg_products.select(*STG_PRODUCTS_COLS)


def clean_orders(stg_orders: DataFrame, check_dates: bool = True) -> DataFrame:
    """Rows with no flag set (``check_dates=False`` is the older 3-flag rule)."""
    flags = FLAG_COLS if check_dates else FLAG_COLS[:3]
    cond = None
    for f in flags:
        c = F.col(f) == 0
        cond = c if cond is None else cond & c
    return stg_orders.where(cond)


def fact_orders(stg_orders: DataFrame, dim_products_df: DataFrame, check_dates: bool = True, by_month: bool = False, rows: int = 0) -> DataFrame:
    """Clean, first-occurrence orders with date parts and money measures.

    LEFT join to products for the cost: an unknown SKU stays in the fact with
    cost 0.  The flag filter runs below the join (Catalyst pushes it into the
    staging scan).  ``by_month`` lays the rows out to be written by month:
    REBALANCE hashes by month, then AQE splits oversized months and merges small
    ones, so each task writes few, evenly sized files.  Rows move before the
    measures are added to them.  ``rows``: the number of staging rows, where known.
    """
    o = dealt(clean_orders(stg_orders, check_dates), rows, "sku", join=True)
    p = dim_products_df.select(F.col("sku").alias("_p_sku"), F.col("cost").alias("_cost"))
    j = o.join(p, o["sku"] == p["_p_sku"], "left")
    if by_month:
        needed = ("order_id", "customer_id", "sku", "quantity", "unit_price", "order_date", "channel", "_cost")
        # the month as a number: its text would be moved with each row
        j = j.select(*needed, (F.year("order_date") * 12 + F.month("order_date")).alias("_month")).hint("rebalance", "_month")
    m = order_measures(F.col("quantity"), F.col("unit_price"), F.col("_cost"), F.col("order_date"))
    return j.select(
        *[F.col(c) for c in ("order_id", "customer_id", "sku", "quantity", "unit_price", "order_date")],
        m["year"].alias("year"),
        m["month"].alias("month"),
        m["year_month"].alias("year_month"),
        F.col("channel"),
        m["revenue"].alias("revenue"),
        m["gross_profit"].alias("gross_profit"),
        m["margin_pct"].alias("margin_pct"),
    ).select(*FACT_COLS)


def orders_full(fact: DataFrame, dim_customers_df: DataFrame, dim_products_df: DataFrame) -> DataFrame:
    """``v_orders_full``: fact INNER JOIN customers INNER JOIN products (19 columns)."""
    c = dim_customers_df.select(
        F.col("customer_id").alias("_c_id"),
        F.col("name").alias("customer_name"),
        "country",
        "segment",
    )
    p = dim_products_df.select(
        F.col("sku").alias("_p_sku"),
        "category",
        F.col("cost").alias("product_cost"),
        F.col("active").alias("product_active"),
    )
    j = fact.join(c, fact["customer_id"] == c["_c_id"], "inner").join(p, F.col("sku") == p["_p_sku"], "inner")
    return j.select(*VIEW_COLS)
