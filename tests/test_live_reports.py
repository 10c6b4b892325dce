"""Live KPIs: partial sums of the fact merged with the accepted orders."""
import contextlib
import io

import pytest
from parity import SF_SMALL
from pyspark.sql import functions as F

from ordermart.plans import catalog, pipeline

ORDERED = {"sales_by_month", "sales_by_channel", "mom_growth", "margin_by_category", "top_products", "top_customers", "sales_by_country", "sales_by_segment"}


@pytest.fixture(scope="module")
def live(spark):
    """A warehouse, and a log that also holds an order that the fact has and
    one of a customer and a SKU that no dimension has."""
    wh = catalog.warehouse(spark, SF_SMALL)
    log = catalog.registration(spark, SF_SMALL)[0].select(*pipeline.FACT_COLS)
    stray = log.limit(1).withColumns({"order_id": F.lit("STRAY"), "customer_id": F.lit("C_NONE"), "sku": F.lit("SKU_NONE"), "revenue": F.lit(None).cast("decimal(18,2)")})
    return wh, log.unionByName(wh.fact_orders.where("order_id like '%7-2'")).unionByName(stray)


@pytest.mark.parametrize("name", sorted(catalog.LIVE))
def test_live_equals_a_full_recompute(live, name):
    wh, log = live
    state, report = catalog.LIVE[name]
    got = report(pipeline.live_state(wh, state, log), wh)
    want = report(pipeline.live_fact_orders(wh, log), wh)
    rows = [sorted(map(str, x.collect())) for x in (got, want)]
    assert rows[0] == rows[1] and rows[0]
    assert got.dtypes == want.dtypes


def test_the_fact_is_not_scanned(live):
    wh, log = live
    wh.ids, wh.state("month")  # laid out once
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        pipeline.live_state(wh, "month", catalog.registration(wh.spark, SF_SMALL)[0]).explain("formatted")
    assert "state_month" in buf.getvalue() and wh.path("fact_orders") not in buf.getvalue()


def test_published_tables_switch_as_a_whole(spark, tmp_path):
    from test_csv_pipeline import CUSTOMERS, ORDERS, PRODUCTS, _write

    c, p = _write(tmp_path, "c.csv", CUSTOMERS), _write(tmp_path, "p.csv", PRODUCTS)
    runs = []
    for k, text in enumerate((ORDERS, ORDERS + "O9,C1,S1,1,7.00,2025-01-05,Retail\n")):
        raw = pipeline.csv_inputs(spark, _write(tmp_path, f"o{k}.csv", text), c, p)
        runs.append(pipeline.run_batch(spark, raw, root=str(tmp_path / f"wh{k}")))
    spark.sql(f"CREATE DATABASE IF NOT EXISTS om_switch LOCATION '{tmp_path}/db'")
    view = lambda: sorted(r[0] for r in spark.sql("SELECT order_id FROM om_switch.v_orders_full").collect())
    months = lambda: sorted(r[0] for r in spark.sql("SELECT DISTINCT year_month FROM om_switch.fact_orders").collect())
    assert "om_switch.v_orders_full" in runs[0].publish("om_switch")
    assert view() == ["O1", "O4"] and months() == ["2024-01", "2024-02"]
    broken = pipeline.Warehouse(spark, str(tmp_path / "never-written"))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        broken.publish("om_switch")
    assert view() == ["O1", "O4"]  # a run that failed leaves the old rows
    runs[1].publish("om_switch")
    assert view() == ["O1", "O4", "O9"] and months() == ["2024-01", "2024-02", "2025-01"]
    assert spark.sql("SHOW TABLES IN om_switch").where("not isTemporary").count() == 7
