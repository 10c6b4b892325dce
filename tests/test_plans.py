"""Physical-plan checks: pruning, pushdown, partial aggregation, bounded
broadcasts and no unpartitioned window over order rows."""
import contextlib
import io

from parity import SF_SMALL

from ordermart.operators import kpis, star
from ordermart.operators.staging import stage_orders
from ordermart.plans import catalog
from ordermart.sources import testdata


def _explain(df, mode):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def _plan(df):
    return _explain(df, "simple")


def _formatted(df):
    return _explain(df, "formatted")


def test_kpi_scans_are_pruned_and_aggregated_in_two_phases(spark):
    wh = catalog.warehouse(spark, SF_SMALL)
    p = _plan(kpis.sales_by_month(wh.fact_orders))
    assert "ReadSchema: struct<order_id:string,revenue:decimal(18,2),gross_profit:decimal(18,2)>" in p
    assert "partial_sum" in p and "Window" not in p


def test_dimension_reports_aggregate_before_the_join(spark):
    wh = catalog.warehouse(spark, SF_SMALL)
    p = _plan(kpis.sales_by_country(wh.fact_orders, wh.dim_customers))
    join_at = p.index("Join")
    # the per-customer aggregation sits below (after, in the tree text) the join
    assert "partial_sum(revenue" in p[join_at:]
    top = _plan(kpis.top_customers(wh.fact_orders, wh.dim_customers))
    assert "TakeOrderedAndProject(limit=10" in top


def test_fact_build_pushes_flag_filters_into_the_scan(spark):
    wh = catalog.warehouse(spark, SF_SMALL)
    p = _formatted(star.fact_orders(wh.stg_orders, wh.dim_products))
    pushed = [ln for ln in p.splitlines() if ln.startswith("PushedFilters") and "_is_duplicate" in ln]
    assert pushed and all(f"EqualTo({c},0)" in pushed[0]
                          for c in ("_is_duplicate", "_negative_qty", "_null_price", "_invalid_date"))


def test_dedup_has_no_unpartitioned_window_and_a_bounded_broadcast(spark):
    raw = catalog.testdata_inputs(spark, SF_SMALL)
    p = _plan(stage_orders(raw.orders, raw.app_orders, raw.seq))
    assert "TakeOrdered" not in p and "Limit" not in p and "Subquery" in p
    for line in p.splitlines():
        if "Window [" in line:
            assert "windowspecdefinition(order_id" in line  # partitioned by key (and salt)


def test_only_calendar_bounded_window_in_reports(spark):
    wh = catalog.warehouse(spark, SF_SMALL)
    p = _plan(kpis.mom_growth(wh.fact_orders))
    window_at = p.index("Window [")
    assert "HashAggregate(keys=[year_month" in p[window_at:]  # window input is the monthly aggregate


def test_no_cross_joins_totals_are_scalar_subqueries(spark):
    from ordermart.operators import quality

    wh = catalog.warehouse(spark, SF_SMALL)
    for df in (kpis.sales_by_channel(wh.fact_orders),
               quality.summary(wh.stg_orders, wh.fact_orders, wh.dim_customers, wh.dim_products),
               quality.null_quantity(wh.stg_orders, wh.fact_orders)):
        p = _plan(df)
        assert "Subquery" in p
        assert "NestedLoopJoin" not in p and "CartesianProduct" not in p


def test_the_month_is_moved_as_a_number(spark):
    wh = catalog.warehouse(spark, SF_SMALL)
    p = _plan(star.fact_orders(wh.stg_orders, wh.dim_products, by_month=True))
    above, below = p.split("REBALANCE_PARTITIONS_BY_COL", 1)
    assert "yyyy-MM," in above and "yyyy-MM," not in below


def _tables(path, order_keys):
    """lineitem and orders of some rows; line 3 has no order."""
    import duckdb

    duckdb.sql(f"""copy (select k::bigint l_orderkey, (k % 5)::bigint l_partkey, 1::bigint l_suppkey, (k % 2)::int l_linenumber, 2.0::double l_quantity, 9.5::double l_extendedprice,
        timestamp '2024-01-05 10:00:00' l_shipdate from (values (0), (0), (1), (2), (3), (null)) t(k)) to '{path}/lineitem.parquet' (format parquet)""")
    duckdb.sql(f"copy (select k::bigint o_orderkey, 1::bigint o_custkey, 5.0::double o_totalprice, timestamp '2024-01-01' o_orderdate from (values {order_keys}) t(k)) to '{path}/orders.parquet' (format parquet)")
    return str(path)


def test_order_ids_are_counted_without_the_join(spark, tmp_path):
    sf = _tables(tmp_path, "(0), (1), (2), (null), (null)")
    ids, raw = testdata.raw_order_ids(spark, sf), testdata.raw_orders(spark, sf)
    assert "Join" not in _plan(ids)
    here, there = (dict(map(tuple, x.groupBy("order_id").count().collect())) for x in (ids, raw))
    assert there == {"O0-0": 2, "O1-1": 1, "O2-0": 1} and all(here[k] >= n for k, n in there.items())
    assert {r["order_date"] for r in raw.collect()} == {"2024-01-05", "not-a-date"}  # the text rules of lines are kept
    app = testdata.raw_app_orders(spark, sf)
    plain = stage_orders(raw, app, testdata.ORDER_SEQ)
    for split in (1, 10):
        counted = stage_orders(raw, app, testdata.ORDER_SEQ, order_ids=ids, split_rows=split)
        assert sorted(map(str, counted.collect())) == sorted(map(str, plain.collect()))


def test_order_ids_are_not_counted_by_lines_if_order_keys_repeat(spark, tmp_path):
    assert testdata.raw_order_ids(spark, _tables(tmp_path, "(0), (1), (1)")) is None
