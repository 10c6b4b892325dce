"""Data-quality reports over staging and gold.

Every report is one pass per input table: conditional counts are summed in a
single aggregation instead of one filtered count per figure.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import COUNT, MONEY_SUM
from .star import duplicate_keys

# QA labels of the four order flags, in report order.
FLAG_LABELS = (
    ("duplicates", "_is_duplicate"),
    ("negative_qty", "_negative_qty"),
    ("null_price", "_null_price"),
    ("invalid_date", "_invalid_date"),
)


def _count_if(cond) -> F.Column:
    return F.sum(F.when(cond, 1).otherwise(0)).cast(COUNT)


def flag_counts(stg_orders: DataFrame) -> DataFrame:
    """(issue, rows): rows with each flag set.  Overlapping flags count twice."""
    sums = stg_orders.agg(*[_count_if(F.col(c) == 1).alias(label) for label, c in FLAG_LABELS])
    pairs = ", ".join(f"'{label}', `{label}`" for label, _ in FLAG_LABELS)
    return sums.select(F.expr(f"stack({len(FLAG_LABELS)}, {pairs}) AS (issue, rows)")).select(
        "issue", F.col("rows").cast(COUNT).alias("rows")
    )


def unknown_customers(stg_customers: DataFrame) -> DataFrame:
    """(country, segment, rows) for customers with an Unknown country or segment."""
    return (
        stg_customers.where((F.col("country") == "Unknown") | (F.col("segment") == "Unknown"))
        .groupBy("country", "segment")
        .agg(F.count(F.lit(1)).cast(COUNT).alias("rows"))
    )


def unknown_products(stg_products: DataFrame) -> DataFrame:
    """(category, rows) for products with an Unknown category."""
    return (
        stg_products.where(F.col("category") == "Unknown")
        .groupBy("category")
        .agg(F.count(F.lit(1)).cast(COUNT).alias("rows"))
    )


def summary(
    stg_orders: DataFrame, fact: DataFrame, dim_customers: DataFrame, dim_products: DataFrame
) -> DataFrame:
    """The eleven QA figures in one row (one aggregation per table)."""
    s = stg_orders.agg(
        F.count(F.lit(1)).cast(COUNT).alias("raw_orders"),
        *[_count_if(F.col(c) == 1).alias(label) for label, c in FLAG_LABELS],
    )
    # Figures of the other tables are scalar subqueries; Spark merges the
    # ones over the same table into one aggregation.
    return s.select(
        "*",
        fact.agg(F.count(F.lit(1)).cast(COUNT)).scalar().alias("clean_orders"),
        fact.agg(F.round(F.sum("revenue"), 2).cast(MONEY_SUM)).scalar().alias("total_revenue"),
        fact.agg(F.round(F.sum("gross_profit"), 2).cast(MONEY_SUM)).scalar().alias("total_gross_profit"),
        dim_customers.agg(_count_if(F.col("country") == "Unknown")).scalar().alias("unknown_country"),
        dim_customers.agg(_count_if(F.col("segment") == "Unknown")).scalar().alias("unknown_segment"),
        dim_products.agg(_count_if(F.col("category") == "Unknown")).scalar().alias("unknown_category"),
    )


def load_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, rows) for each named table."""
    parts = [df.agg(F.count(F.lit(1)).cast(COUNT).alias("rows")).select(F.lit(n).alias("table"), "rows")
             for n, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def dup_dimension_keys(dim_customers: DataFrame, dim_products: DataFrame) -> DataFrame:
    """(table, key, rows) for every dimension key that occurs more than once."""
    return duplicate_keys(dim_customers, "customer_id", "dim_customers").unionByName(
        duplicate_keys(dim_products, "sku", "dim_products")
    ).select("table", "key", F.col("rows").cast(COUNT).alias("rows"))


def fact_key_violations(fact: DataFrame) -> DataFrame:
    """(order_id, rows) for ids occurring more than once in the fact (expected empty)."""
    return (
        fact.groupBy("order_id")
        .agg(F.count(F.lit(1)).cast(COUNT).alias("rows"))
        .where(F.col("rows") > 1)
    )


def null_quantity(stg_orders: DataFrame, fact: DataFrame) -> DataFrame:
    """Unparsable quantities are not flagged; show how many reach the fact."""
    s = stg_orders.agg(_count_if(F.col("quantity").isNull()).alias("staged_null_quantity"))
    return s.select(
        "*",
        fact.agg(_count_if(F.col("quantity").isNull())).scalar().alias("fact_null_quantity"),
        fact.agg(_count_if(F.col("revenue").isNull())).scalar().alias("fact_null_revenue"),
    )


def negative_cost(dim_products: DataFrame) -> DataFrame:
    """Products with a negative cost (their margin exceeds 100 %)."""
    return dim_products.where(F.col("cost") < 0).select("sku", "category", "cost")
