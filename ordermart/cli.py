"""Command line: run the batch pipeline and print the reports.

    python -m ordermart.cli run --orders data/orders.csv --customers data/customers.csv \
        --products data/products.csv [--app-orders new_orders] [--out DIR]
    python -m ordermart.cli kpis --warehouse DIR

``run`` writes silver and gold (into ``--out`` or a fresh folder under
``spark.checkpoint.dir``), then prints load counts and the QA summary.
``kpis`` prints every KPI statement over a written warehouse.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .operators import kpis, quality
from .plans.pipeline import SILVER, GOLD, Warehouse, csv_inputs, run_batch
from .session import apply_defaults

REPORTS = {
    "kpi_cards": lambda w: kpis.kpi_cards(w.fact_orders),
    "sales_by_month": lambda w: kpis.sales_by_month(w.fact_orders),
    "sales_by_channel": lambda w: kpis.sales_by_channel(w.fact_orders),
    "margin_by_category": lambda w: kpis.margin_by_category(w.fact_orders, w.dim_products),
    "top_customers": lambda w: kpis.top_customers(w.fact_orders, w.dim_customers),
    "top_products": lambda w: kpis.top_products(w.fact_orders, w.dim_products),
    "sales_by_country": lambda w: kpis.sales_by_country(w.fact_orders, w.dim_customers),
    "sales_by_segment": lambda w: kpis.sales_by_segment(w.fact_orders, w.dim_customers),
    "mom_growth": lambda w: kpis.mom_growth(w.fact_orders),
    "bi_measures": lambda w: kpis.bi_measures(w.fact_orders, w.dim_customers, w.dim_products),
}


def _show(title: str, df) -> None:
    """Every row, a partition at a time."""
    print(f"-- {title}")
    print(" | ".join(df.columns))
    for row in df.toLocalIterator():
        print(" | ".join("" if v is None else str(v) for v in row))


def cmd_run(spark: SparkSession, a: argparse.Namespace) -> Warehouse:
    raw = csv_inputs(spark, a.orders, a.customers, a.products, a.app_orders)
    wh = run_batch(spark, raw, root=a.out)
    print(f"warehouse: {wh.root}")
    _show("load counts", quality.load_counts({t: wh.table(t) for t in (*SILVER, *GOLD)}))
    _show("QA summary", quality.summary(wh.stg_orders, wh.fact_orders, wh.dim_customers, wh.dim_products))
    return wh


def cmd_kpis(spark: SparkSession, a: argparse.Namespace) -> None:
    wh = Warehouse(spark, a.warehouse.rstrip("/"))
    for name, fn in REPORTS.items():
        _show(name, fn(wh))


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="ordermart")
    sub = p.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("run", help="CSV files -> silver and gold tables")
    r.add_argument("--orders", required=True)
    r.add_argument("--customers", required=True)
    r.add_argument("--products", required=True)
    r.add_argument("--app-orders", default=None, help="catalog table or parquet path of accepted orders")
    r.add_argument("--out", default=None, help="warehouse folder (default: new folder in spark.checkpoint.dir)")
    k = sub.add_parser("kpis", help="print the KPI reports of a written warehouse")
    k.add_argument("--warehouse", required=True)
    a = p.parse_args(argv)

    spark = SparkSession.builder.appName("ordermart").getOrCreate()
    apply_defaults(spark)
    if a.cmd == "run":
        cmd_run(spark, a)
    else:
        cmd_kpis(spark, a)


if __name__ == "__main__":
    main()
