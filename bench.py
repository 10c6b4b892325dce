"""Benchmark: the batch pipeline and every report at one scale factor.

Runs on local[$BENCH_CPUS] over $BENCH_SF_DIR (default /root/testdata/sf0.1)
and prints one JSON line:
{"metric": "full_batch_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

``value`` is raw files -> staging -> gold -> all KPI statements once.  Report
times are warm medians of ``BENCH_REPEAT`` runs (each collected to the driver;
results are small).  Registration is timed as a batch and as an
``availableNow`` stream over the same submissions.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from ordermart.operators import kpis, orders  # noqa: E402
from ordermart.operators.staging import stage_orders  # noqa: E402
from ordermart.plans import catalog, pipeline  # noqa: E402
from ordermart.plans.streaming_query import land_candidates  # noqa: E402
from ordermart.session import local_session, new_run_dir  # noqa: E402
from ordermart.sources import testdata  # noqa: E402
from ordermart.streaming.registration import read_outputs, start_registration  # noqa: E402

KPI = {
    "kpi_total_revenue": lambda w: kpis.total_revenue(w.fact_orders),
    "kpi_total_gross_profit": lambda w: kpis.total_gross_profit(w.fact_orders),
    "kpi_total_orders": lambda w: kpis.total_orders(w.fact_orders),
    "kpi_avg_ticket": lambda w: kpis.avg_ticket(w.fact_orders),
    "kpi_overall_margin": lambda w: kpis.overall_margin(w.fact_orders),
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


def _timed(fn):
    t = time.perf_counter()
    out = fn()
    return time.perf_counter() - t, out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "8")),
                          app="ordermart-bench")
    times: dict[str, float] = {}

    # warm-up: JVM, codegen and file listing on a tiny input
    small = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    if os.path.isdir(small):
        pipeline.run_batch(spark, catalog.testdata_inputs(spark, small))

    raw = catalog.testdata_inputs(spark, sf_dir)
    wh = pipeline.Warehouse(spark, new_run_dir(spark, "bench"))
    times["stage_orders"], _ = _timed(lambda: pipeline.load_staging(raw, wh))
    times["build_consumption"], _ = _timed(lambda: pipeline.load_consumption(wh))
    full = times["stage_orders"] + times["build_consumption"]
    for name, fn in KPI.items():
        first, _ = _timed(lambda: fn(wh).collect())
        full += first
        runs = [first] + [_timed(lambda: fn(wh).collect())[0] for _ in range(repeat - 1)]
        times[name] = statistics.median(runs)

    app = testdata.raw_app_orders(spark, sf_dir)
    cands = testdata.raw_candidates(spark, sf_dir)

    def register_batch():
        acc, rej = orders.register_orders(cands, wh.dim_customers, wh.dim_products,
                                          pipeline.existing_order_ids(wh, app), checkpoint=True)
        out = new_run_dir(spark, "bench-reg")
        acc.write.parquet(f"{out}/registered")
        rej.write.parquet(f"{out}/rejected")

    times["register_batch"], _ = _timed(register_batch)

    # Skew: the same staging with one blank order id holding a third of all
    # rows (split at 50,000 rows per task), next to the unskewed run.
    def stage_noop(orders, **kw):
        stage_orders(orders, raw.app_orders, raw.seq, **kw).write.mode("overwrite").format("noop").save()

    hot = raw.orders.withColumn("order_id", F.when(F.col("k1") % 3 == 0, F.lit("")).otherwise(F.col("order_id")))
    times["stage_orders_compute"], _ = _timed(lambda: stage_noop(raw.orders))
    times["stage_orders_hot_key_compute"], _ = _timed(lambda: stage_noop(hot, split_rows=50_000))

    run = new_run_dir(spark, "bench-stream")
    land_candidates(spark, sf_dir, f"{run}/landing")

    def register_stream():
        q = start_registration(spark, f"{run}/landing", f"{run}/out", f"{run}/ckpt",
                               dims=lambda: (wh.dim_customers, wh.dim_products),
                               existing_ids=lambda: pipeline.existing_order_ids(wh, app))
        q.awaitTermination(900)
        if q.exception() is not None:
            raise q.exception()
        return read_outputs(spark, f"{run}/out")[0].count()

    times["register_stream"], _ = _timed(register_stream)

    print(json.dumps({
        "metric": "full_batch_sec",
        "value": round(full, 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in times.items()},
        "sf": os.path.basename(sf_dir).replace("sf", ""),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
