"""Named queries over the test tables: one entry per report of the survey.

``warehouse(spark, sf_dir)`` runs the batch pipeline once per session and
input folder (raw test tables -> written silver and gold tables); every
report then reads the written tables, as the source system's reports read
its loaded database.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import kpis, orders, quality, star
from ..operators.staging import stage_customers, stage_orders, stage_products
from ..schemas import NEW_ORDERS
from ..session import new_run_dir, session_key
from ..sources import testdata
from ..sources.files import optional_table
from .pipeline import RawInputs, Warehouse, as_new_orders, csv_inputs, id_lookup, live_fact_orders, live_state, run_batch

_LOCK = threading.RLock()
_BUILDS: dict[tuple[str, str], Warehouse] = {}
_PUBLISHED: dict[tuple[str, str], str] = {}
_PLANTED: dict[tuple[str, str], tuple[DataFrame, DataFrame]] = {}
_CSV_BUILDS: dict[tuple[str, str], Warehouse] = {}
_REGISTRATIONS: dict[tuple[str, str], tuple[DataFrame, DataFrame]] = {}


def testdata_inputs(spark: SparkSession, sf_dir: str) -> RawInputs:
    return RawInputs(
        orders=testdata.raw_orders(spark, sf_dir),
        seq=testdata.ORDER_SEQ,
        order_ids=testdata.raw_order_ids(spark, sf_dir),
        customers=testdata.raw_customers(spark, sf_dir),
        products=testdata.raw_products(spark, sf_dir),
        app_orders=testdata.raw_app_orders(spark, sf_dir),
    )


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """Silver and gold tables for ``sf_dir``, built on first use in a session."""
    key = (session_key(spark), sf_dir.rstrip("/"))
    with _LOCK:
        wh = _BUILDS.get(key)
        if wh is None:
            wh = _BUILDS[key] = run_batch(spark, testdata_inputs(spark, sf_dir))
        return wh


def csv_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The warehouse built from CSV files: the raw feeds are written as files
    first, then read, staged and loaded (once a session and folder)."""
    key = (session_key(spark), sf_dir.rstrip("/"))
    with _LOCK:
        wh = _CSV_BUILDS.get(key)
        if wh is None:
            feeds = testdata.write_csv_feeds(spark, sf_dir, new_run_dir(spark, "feeds"))
            raw = csv_inputs(spark, *feeds)
            raw.app_orders = testdata.raw_app_orders(spark, sf_dir)
            wh = _CSV_BUILDS[key] = run_batch(spark, raw)
        return wh


def registration(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Register the test candidates against the loaded warehouse (once per session)."""
    key = (session_key(spark), sf_dir.rstrip("/"))
    with _LOCK:
        out = _REGISTRATIONS.get(key)
        if out is None:
            wh = warehouse(spark, sf_dir)
            app = testdata.raw_app_orders(spark, sf_dir)
            out = orders.register_orders(
                testdata.raw_candidates(spark, sf_dir),
                wh.dim_customers,
                wh.dim_products,
                id_lookup(wh, app),
                checkpoint=True,
            )
            _REGISTRATIONS[key] = out
        return out


def new_orders_after_registration(spark: SparkSession, sf_dir: str) -> DataFrame:
    accepted, _ = registration(spark, sf_dir)
    return as_new_orders(testdata.raw_app_orders(spark, sf_dir)).unionByName(as_new_orders(accepted))


def _wh(fn: Callable[[Warehouse], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: fn(warehouse(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q: dict[str, Callable[[SparkSession, str], DataFrame]] = {
        # silver
        "stg_orders": _wh(lambda w: w.stg_orders),
        "stg_customers": _wh(lambda w: w.stg_customers),
        "stg_products": _wh(lambda w: w.stg_products),
        # the same from CSV files
        "csv_stg_orders": lambda spark, sf: csv_warehouse(spark, sf).stg_orders,
        "csv_stg_customers": lambda spark, sf: csv_warehouse(spark, sf).stg_customers,
        "csv_stg_products": lambda spark, sf: csv_warehouse(spark, sf).stg_products,
        "csv_fact_orders": lambda spark, sf: csv_warehouse(spark, sf).fact_orders,
        # gold
        "dim_customers": _wh(lambda w: w.dim_customers),
        "dim_products": _wh(lambda w: w.dim_products),
        "fact_orders": _wh(lambda w: w.fact_orders),
        "v_orders_full": _wh(lambda w: w.v_orders_full()),
        # KPI statements
        "kpi_total_revenue": _wh(lambda w: kpis.total_revenue(w.fact_orders)),
        "kpi_total_gross_profit": _wh(lambda w: kpis.total_gross_profit(w.fact_orders)),
        "kpi_total_orders": _wh(lambda w: kpis.total_orders(w.fact_orders)),
        "kpi_avg_ticket": _wh(lambda w: kpis.avg_ticket(w.fact_orders)),
        "kpi_overall_margin": _wh(lambda w: kpis.overall_margin(w.fact_orders)),
        "kpi_cards": _wh(lambda w: kpis.kpi_cards(w.fact_orders)),
        "sales_by_month": _wh(lambda w: kpis.sales_by_month(w.fact_orders)),
        "sales_by_channel": _wh(lambda w: kpis.sales_by_channel(w.fact_orders)),
        "margin_by_category": _wh(lambda w: kpis.margin_by_category(w.fact_orders, w.dim_products)),
        "top_customers": _wh(lambda w: kpis.top_customers(w.fact_orders, w.dim_customers)),
        "top_products": _wh(lambda w: kpis.top_products(w.fact_orders, w.dim_products)),
        "sales_by_country": _wh(lambda w: kpis.sales_by_country(w.fact_orders, w.dim_customers)),
        "sales_by_segment": _wh(lambda w: kpis.sales_by_segment(w.fact_orders, w.dim_customers)),
        "mom_growth": _wh(lambda w: kpis.mom_growth(w.fact_orders)),
        "bi_measures": _wh(lambda w: kpis.bi_measures(w.fact_orders, w.dim_customers, w.dim_products)),
        # data quality
        "qa_flag_counts": _wh(lambda w: quality.flag_counts(w.stg_orders)),
        "qa_unknown_customers": _wh(lambda w: quality.unknown_customers(w.stg_customers)),
        "qa_unknown_products": _wh(lambda w: quality.unknown_products(w.stg_products)),
        "qa_summary": _wh(lambda w: quality.summary(w.stg_orders, w.fact_orders, w.dim_customers, w.dim_products)),
        "load_counts": _wh(
            lambda w: quality.load_counts(
                {n: w.table(n) for n in ("stg_orders", "stg_customers", "stg_products",
                                         "dim_customers", "dim_products", "fact_orders")}
            )
        ),
        "dup_dimension_keys": _wh(lambda w: quality.dup_dimension_keys(w.dim_customers, w.dim_products)),
        "fact_key_violations": _wh(lambda w: quality.fact_key_violations(w.fact_orders)),
        "qa_null_quantity": _wh(lambda w: quality.null_quantity(w.stg_orders, w.fact_orders)),
        "qa_negative_cost": _wh(lambda w: quality.negative_cost(w.dim_products)),
        # order entry
        "order_validation_errors": lambda spark, sf: orders.validation_errors(testdata.raw_candidates(spark, sf)),
        "registered_orders": lambda spark, sf: registration(spark, sf)[0],
        "rejected_orders": lambda spark, sf: registration(spark, sf)[1],
        "order_listing": lambda spark, sf: orders.order_listing(new_orders_after_registration(spark, sf)),
        "order_listing_count": lambda spark, sf: orders.order_count(new_orders_after_registration(spark, sf)),
        "fact_orders_live": lambda spark, sf: live_fact_orders(warehouse(spark, sf), registration(spark, sf)[0]),
        # tables and the view in the catalog
        "v_orders_full_published": lambda spark, sf: spark.sql(f"SELECT * FROM {published(spark, sf)}.v_orders_full"),
        "sales_by_month_published": lambda spark, sf: kpis.sales_by_month(spark.table(f"{published(spark, sf)}.fact_orders")),
        # the accepted-orders table, there or not
        "stg_orders_app_path": lambda spark, sf: _staged(spark, sf, _app_table(spark, sf, by_name=False)),
        "stg_orders_app_catalog": lambda spark, sf: _staged(spark, sf, _app_table(spark, sf, by_name=True)),
        "stg_orders_no_app_path": lambda spark, sf: _staged(spark, sf, new_run_dir(spark, "absent")),
        "stg_orders_no_app_table": lambda spark, sf: _staged(spark, sf, "orders_accepted_absent"),
        # the older flag rule
        "fact_orders_three_flags": _wh(lambda w: star.fact_orders(w.stg_orders, w.dim_products, check_dates=False, rows=w.stg_orders.count())),
        # feeds with faults put in
        "planted_dup_dimension_keys": lambda spark, sf: quality.dup_dimension_keys(
            star.dim_customers(stage_customers(testdata.twice(testdata.raw_customers(spark, sf), "customer_id", 50))),
            star.dim_products(stage_products(testdata.twice(testdata.raw_products(spark, sf), "sku", 40))),
        ),
        "planted_fact_key_violations": _wh(lambda w: quality.fact_key_violations(testdata.twice(w.fact_orders, "order_id", 60))),
        "planted_registered_orders": lambda spark, sf: planted_registration(spark, sf)[0],
        "planted_rejected_orders": lambda spark, sf: planted_registration(spark, sf)[1],
    }
    for name, (state, report) in LIVE.items():
        q[f"{name}_live"] = _live(state, report)
    return q


#: KPIs that merge the fact's partial sums with the accepted orders': the state
#: that each reads, and the report over it.
LIVE = {
    "kpi_total_revenue": ("month", lambda s, w: kpis.total_revenue(s)),
    "kpi_total_gross_profit": ("month", lambda s, w: kpis.total_gross_profit(s)),
    "kpi_total_orders": ("month", lambda s, w: kpis.total_orders(s)),
    "kpi_avg_ticket": ("month", lambda s, w: kpis.avg_ticket(s)),
    "kpi_overall_margin": ("month", lambda s, w: kpis.overall_margin(s)),
    "kpi_cards": ("month", lambda s, w: kpis.kpi_cards(s)),
    "sales_by_month": ("month", lambda s, w: kpis.sales_by_month(s)),
    "sales_by_channel": ("month", lambda s, w: kpis.sales_by_channel(s)),
    "mom_growth": ("month", lambda s, w: kpis.mom_growth(s)),
    "bi_measures": ("month", lambda s, w: kpis.bi_measures(s, w.dim_customers, w.dim_products)),
    "margin_by_category": ("sku", lambda s, w: kpis.margin_by_category(s, w.dim_products)),
    "top_products": ("sku", lambda s, w: kpis.top_products(s, w.dim_products)),
    "top_customers": ("customer", lambda s, w: kpis.top_customers(s, w.dim_customers)),
    "sales_by_country": ("customer", lambda s, w: kpis.sales_by_country(s, w.dim_customers)),
    "sales_by_segment": ("customer", lambda s, w: kpis.sales_by_segment(s, w.dim_customers)),
}


def _live(state: str, report: Callable[[DataFrame, Warehouse], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        wh = warehouse(spark, sf_dir)
        return report(live_state(wh, state, registration(spark, sf_dir)[0]), wh)

    return run


def published(spark: SparkSession, sf_dir: str) -> str:
    """The database that the warehouse of ``sf_dir`` is published in."""
    key = (session_key(spark), sf_dir.rstrip("/"))
    with _LOCK:
        if key not in _PUBLISHED:
            name = f"ordermart_{uuid.uuid4().hex[:8]}"
            spark.sql(f"CREATE DATABASE {name} LOCATION '{new_run_dir(spark, 'database')}'")
            warehouse(spark, sf_dir).publish(name)
            _PUBLISHED[key] = name
        return _PUBLISHED[key]


def _app_table(spark: SparkSession, sf_dir: str, by_name: bool) -> str:
    """The accepted orders, written; their path or catalog name."""
    path = new_run_dir(spark, "app-orders")
    testdata.raw_app_orders(spark, sf_dir).write.parquet(path)
    if not by_name:
        return path
    name = f"orders_accepted_{uuid.uuid4().hex[:8]}"
    spark.catalog.createTable(name, path=path, source="parquet")
    return name


def _staged(spark: SparkSession, sf_dir: str, app_orders: str) -> DataFrame:
    return stage_orders(testdata.raw_orders(spark, sf_dir), optional_table(spark, app_orders, NEW_ORDERS), testdata.ORDER_SEQ)


def planted_registration(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Registration of submissions of which some name an id that the fact has,
    and some no time, under a fixed clock."""
    key = (session_key(spark), sf_dir.rstrip("/"))
    with _LOCK:
        if key not in _PLANTED:
            wh = warehouse(spark, sf_dir)
            _PLANTED[key] = orders.register_orders(
                testdata.planted_candidates(spark, sf_dir), wh.dim_customers, wh.dim_products, id_lookup(wh, testdata.raw_app_orders(spark, sf_dir)),
                checkpoint=True, now=F.lit(testdata.PLANTED_CLOCK).cast("timestamp_ntz"),
            )
        return _PLANTED[key]
