"""The KPI statements and BI measures over the gold tables.

Conventions taken from the source database: ``ORDER BY x DESC`` puts NULL
first and ``ASC`` puts it last; top-10 lists add the key as a tie-breaker.

Scale notes
* ``order_id`` is the fact's primary key (first occurrence only), so
  ``COUNT(DISTINCT order_id)`` equals ``COUNT(order_id)``; the latter needs no
  shuffle of all ids.  Pass ``unique_ids=False`` for a fact without that
  guarantee.
* Reports by a dimension attribute first reduce the fact to one row per join
  key (partial + final aggregation), then join that to the dimension and
  aggregate again.  The join then sees at most one row per key, so a hot
  customer or SKU cannot skew it, and the shuffle carries partial sums
  instead of order rows.  Exact because the dimension key is unique.
* Grand totals are scalar subqueries (one value, no join).
* Every function also takes the merged partial sums of ``report_states`` in
  place of the fact: month states for the cards and the breakdowns over the
  fact, customer or SKU states for those through a dimension.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.measures import money_sum, pct_of, ratio
from ..schemas import COUNT, MONEY_SUM
from .report_states import MEASURES


def _is_state(fact: DataFrame) -> bool:
    return "_n_rev" in fact.columns


def _orders(fact: DataFrame, unique_ids: bool) -> Column:
    if _is_state(fact):
        return F.coalesce(F.sum("_n"), F.lit(0)).cast(COUNT)
    c = F.count("order_id") if unique_ids else F.countDistinct("order_id")
    return c.cast(COUNT)


def _revenue(fact: DataFrame) -> str:
    return "_rev" if _is_state(fact) else "revenue"


def _profit(fact: DataFrame) -> str:
    return "_gp" if _is_state(fact) else "gross_profit"


# ---- KPI cards ---------------------------------------------------------------


def total_revenue(fact: DataFrame) -> DataFrame:
    return fact.agg(money_sum(_revenue(fact)).alias("total_revenue"))


def total_gross_profit(fact: DataFrame) -> DataFrame:
    return fact.agg(money_sum(_profit(fact)).alias("total_gross_profit"))


def total_orders(fact: DataFrame, unique_ids: bool = True) -> DataFrame:
    return fact.agg(_orders(fact, unique_ids).alias("total_orders"))


def avg_ticket(fact: DataFrame, unique_ids: bool = True) -> DataFrame:
    return fact.agg(ratio(F.sum(_revenue(fact)), _orders(fact, unique_ids)).alias("avg_ticket"))


def overall_margin(fact: DataFrame) -> DataFrame:
    return fact.agg(pct_of(F.sum(_profit(fact)), F.sum(_revenue(fact))).alias("overall_margin_pct"))


def kpi_cards(fact: DataFrame, unique_ids: bool = True) -> DataFrame:
    """All five cards from one scan."""
    return fact.agg(
        money_sum(_revenue(fact)).alias("total_revenue"),
        money_sum(_profit(fact)).alias("total_gross_profit"),
        _orders(fact, unique_ids).alias("total_orders"),
        ratio(F.sum(_revenue(fact)), _orders(fact, unique_ids)).alias("avg_ticket"),
        pct_of(F.sum(_profit(fact)), F.sum(_revenue(fact))).alias("overall_margin_pct"),
    )


# ---- breakdowns over the fact ------------------------------------------------


def sales_by_month(fact: DataFrame, unique_ids: bool = True) -> DataFrame:
    return (
        fact.groupBy("year_month")
        .agg(
            money_sum(_revenue(fact)).alias("revenue"),
            money_sum(_profit(fact)).alias("gross_profit"),
            _orders(fact, unique_ids).alias("orders"),
            pct_of(F.sum(_profit(fact)), F.sum(_revenue(fact))).alias("margin_pct"),
        )
        .orderBy(F.asc_nulls_last("year_month"))
    )


def sales_by_channel(fact: DataFrame, unique_ids: bool = True) -> DataFrame:
    """Share of each channel in the sum of the (rounded) channel revenues."""
    per_channel = fact.groupBy("channel").agg(
        money_sum(_revenue(fact)).alias("revenue"),
        money_sum(_profit(fact)).alias("gross_profit"),
        _orders(fact, unique_ids).alias("orders"),
    )
    # Grand total as a scalar subquery (no join).  The subquery keeps all
    # three per-channel sums alive so its aggregation is the same as the
    # main one and Spark reuses that shuffle: the fact is scanned once.
    grand = (
        per_channel.agg(
            F.struct(
                F.sum("revenue").alias("revenue"),
                F.sum("gross_profit").alias("gross_profit"),
                F.sum("orders").alias("orders"),
            ).alias("totals")
        )
        .scalar()
        .getField("revenue")
    )
    return (
        per_channel.select(
            "channel",
            "revenue",
            "gross_profit",
            "orders",
            pct_of(F.col("revenue"), grand).alias("revenue_share_pct"),
        )
        .orderBy(F.desc_nulls_first("revenue"), F.asc_nulls_last("channel"))
    )


def mom_growth(fact: DataFrame) -> DataFrame:
    """Revenue growth against the previous month present in the data.

    The window has no partition key: it runs on the monthly aggregate, whose
    size is bounded by the calendar (one row per month), never on order rows.
    """
    monthly = fact.groupBy("year_month").agg(F.sum(_revenue(fact)).alias("_rev"))
    prev = F.lag("_rev", 1).over(Window.orderBy("year_month"))
    return (
        monthly.select(
            "year_month",
            F.round(F.col("_rev"), 2).cast(MONEY_SUM).alias("revenue"),
            pct_of(F.col("_rev") - prev, prev).alias("mom_growth_pct"),
        )
        .orderBy(F.asc_nulls_last("year_month"))
    )


# ---- breakdowns through a dimension ------------------------------------------


def _per_key(fact: DataFrame, key: str) -> DataFrame:
    """Partial sums per join key (one row per key)."""
    if _is_state(fact):
        return fact.groupBy(key).agg(*[F.sum(m).alias(m) for m in MEASURES])
    return fact.groupBy(key).agg(
        F.sum("revenue").alias("_rev"),
        F.sum("gross_profit").alias("_gp"),
        F.count("order_id").alias("_n"),
        F.count("revenue").alias("_n_rev"),
        F.sum("quantity").alias("_units"),
    )


def _through(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    return _per_key(fact, key).join(dim, key, "inner")


def margin_by_category(fact: DataFrame, dim_products: DataFrame) -> DataFrame:
    j = _through(fact, dim_products.select("sku", "category"), "sku")
    return (
        j.groupBy("category")
        .agg(
            F.round(F.sum("_rev"), 2).cast(MONEY_SUM).alias("revenue"),
            F.round(F.sum("_gp"), 2).cast(MONEY_SUM).alias("gross_profit"),
            F.sum("_n").cast(COUNT).alias("orders"),
            pct_of(F.sum("_gp"), F.sum("_rev")).alias("margin_pct"),
        )
        .orderBy(F.desc_nulls_first("margin_pct"), F.asc_nulls_last("category"))
    )


def top_customers(fact: DataFrame, dim_customers: DataFrame, n: int = 10) -> DataFrame:
    c = dim_customers.select("customer_id", F.col("name").alias("customer_name"), "country", "segment")
    j = _through(fact, c, "customer_id")
    return (
        j.select(
            "customer_id",
            "customer_name",
            "country",
            "segment",
            F.round("_rev", 2).cast(MONEY_SUM).alias("total_revenue"),
            F.round("_gp", 2).cast(MONEY_SUM).alias("total_gross_profit"),
            F.col("_n").cast(COUNT).alias("orders"),
        )
        .orderBy(F.desc_nulls_first("total_revenue"), F.asc_nulls_last("customer_id"))
        .limit(n)
    )


def top_products(fact: DataFrame, dim_products: DataFrame, n: int = 10) -> DataFrame:
    j = _through(fact, dim_products.select("sku", "category"), "sku")
    return (
        j.select(
            "sku",
            "category",
            F.col("_units").cast(COUNT).alias("units_sold"),
            F.round("_rev", 2).cast(MONEY_SUM).alias("total_revenue"),
            F.round("_gp", 2).cast(MONEY_SUM).alias("total_gross_profit"),
            pct_of(F.col("_gp"), F.col("_rev")).alias("margin_pct"),
        )
        .orderBy(F.desc_nulls_first("total_revenue"), F.asc_nulls_last("sku"))
        .limit(n)
    )


def sales_by_country(fact: DataFrame, dim_customers: DataFrame) -> DataFrame:
    j = _through(fact, dim_customers.select("customer_id", "country"), "customer_id")
    return (
        j.groupBy("country")
        .agg(
            F.round(F.sum("_rev"), 2).cast(MONEY_SUM).alias("revenue"),
            F.round(F.sum("_gp"), 2).cast(MONEY_SUM).alias("gross_profit"),
            F.sum("_n").cast(COUNT).alias("orders"),
        )
        .orderBy(F.desc_nulls_first("revenue"), F.asc_nulls_last("country"))
    )


def sales_by_segment(fact: DataFrame, dim_customers: DataFrame) -> DataFrame:
    j = _through(fact, dim_customers.select("customer_id", "segment"), "customer_id")
    return (
        j.groupBy("segment")
        .agg(
            F.round(F.sum("_rev"), 2).cast(MONEY_SUM).alias("revenue"),
            F.round(F.sum("_gp"), 2).cast(MONEY_SUM).alias("gross_profit"),
            F.sum("_n").cast(COUNT).alias("orders"),
            ratio(F.sum("_rev"), F.sum("_n_rev")).alias("avg_order_value"),
        )
        .orderBy(F.desc_nulls_first("revenue"), F.asc_nulls_last("segment"))
    )


# ---- BI measures over the wide view --------------------------------------------


def bi_measures(
    fact: DataFrame, dim_customers: DataFrame, dim_products: DataFrame, unique_ids: bool = True
) -> DataFrame:
    """Total sales, average ticket and margin ratio over ``v_orders_full``.

    The view is an inner join with unique-keyed dimensions, so its rows are
    the fact rows whose customer and SKU exist: two semi-joins (no dimension
    columns carried) give the same rows.
    """
    if _is_state(fact):
        rows = fact.where("in_view")
    else:
        rows = fact.join(dim_customers.select("customer_id"), "customer_id", "left_semi").join(
            dim_products.select("sku"), "sku", "left_semi"
        )
    return rows.agg(
        money_sum(_revenue(fact)).alias("total_sales"),
        ratio(F.sum(_revenue(fact)), _orders(fact, unique_ids)).alias("average_ticket"),
        ratio(F.sum(_profit(fact)), F.sum(_revenue(fact)), 6).alias("margin_ratio"),
    )
