"""Partial sums of the fact that live reports merge with accepted orders.

An accepted order belongs to the fact at once, so every KPI must count it
before the next batch load.  Sums and counts merge, so three small tables of
them, written beside the fact, answer every KPI together with the partial sums
of the orders accepted since; the fact is not read again.

``month``     by month, channel and whether the row is in the wide view
``customer``  by customer
``sku``       by SKU
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEYS = {"month": ("year_month", "channel", "in_view"), "customer": ("customer_id",), "sku": ("sku",)}
MEASURES = ("_rev", "_gp", "_n", "_n_rev", "_units")


def partials(fact: DataFrame, name: str, dim_customers: DataFrame, dim_products: DataFrame) -> DataFrame:
    """One state of ``fact`` (or of accepted orders, which have its columns)."""
    if name == "month":  # the view holds rows whose customer and SKU are known
        c = dim_customers.select("customer_id", F.lit(True).alias("_c"))
        p = dim_products.select("sku", F.lit(True).alias("_p"))
        fact = fact.join(c, "customer_id", "left").join(p, "sku", "left").withColumn("in_view", F.col("_c").isNotNull() & F.col("_p").isNotNull())
    return fact.groupBy(*KEYS[name]).agg(
        F.sum("revenue").alias("_rev"), F.sum("gross_profit").alias("_gp"), F.count("order_id").alias("_n"), F.count("revenue").alias("_n_rev"), F.sum("quantity").alias("_units")
    )


def merged(name: str, *states: DataFrame) -> DataFrame:
    """One state of all rows behind ``states``."""
    out = states[0]
    for s in states[1:]:
        out = out.unionByName(s)
    return out.groupBy(*KEYS[name]).agg(*[F.sum(m).alias(m) for m in MEASURES])
