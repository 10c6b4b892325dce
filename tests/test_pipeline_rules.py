"""Edge-case rows of FIXTURES.md §4 through staging, fact, view and reports."""
import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermart.operators import kpis, star
from ordermart.operators.staging import stage_customers, stage_orders, stage_products
from ordermart.schemas import CUSTOMERS_RAW, NEW_ORDERS, ORDERS_RAW, PRODUCTS_RAW

CUSTOMERS = [
    ("C1", "Ana", "Ecuador", "Retail", "2023-01-01"),
    ("C2", "Bo", " ", "Corporate", "2023-02-01 08:00:00"),
    ("C3", "", "Peru", "", "bad"),
]
PRODUCTS = [
    ("S1", "Luxury", "0", "TRUE"),
    ("S2", "", "", " true "),
    ("S3", "Gift Box", "-6.94", "1"),
    ("S4", "Standard", "2.5", ""),
]


def _orders(spark, rows):
    # rows: (order_id, customer_id, sku, quantity, unit_price, order_date, channel); n = file position
    data = [r + (i,) for i, r in enumerate(rows)]
    schema = T.StructType(list(ORDERS_RAW.fields) + [T.StructField("n", T.IntegerType())])
    return spark.createDataFrame(data, schema)


def _build(spark, order_rows, app_rows=None):
    raw = _orders(spark, order_rows)
    app = spark.createDataFrame(app_rows or [], NEW_ORDERS)
    stg = stage_orders(raw, app, ["n"], split_rows=2)
    dim_c = star.dim_customers(stage_customers(spark.createDataFrame(CUSTOMERS, CUSTOMERS_RAW)))
    dim_p = star.dim_products(stage_products(spark.createDataFrame(PRODUCTS, PRODUCTS_RAW)))
    fact = star.fact_orders(stg, dim_p)
    return stg, fact, dim_c, dim_p


def _by_id(df):
    return {r["order_id"]: r for r in df.collect()}


def test_bad_first_row_removes_the_order(spark):  # D1
    stg, fact, *_ = _build(spark, [
        ("O1", "C1", "S1", "-1", "10", "2024-01-05", "retail"),
        ("O1", "C1", "S1", "1", "10", "2024-01-05", "retail"),
    ])
    assert [r["_is_duplicate"] for r in stg.orderBy("quantity").collect()] == [0, 1]
    assert fact.count() == 0


def test_app_row_wins(spark):  # D2
    app = [("O1", "C1", "S1", 7, 3.0, dt.date(2024, 1, 2), "ecommerce", dt.datetime(2024, 1, 2, 9, 30))]
    _, fact, *_ = _build(spark, [("O1", "C1", "S1", "1", "10", "2024-01-05", "retail")], app)
    f = _by_id(fact)["O1"]
    assert (f["quantity"], f["unit_price"], f["channel"]) == (7, 3.0, "ecommerce")


def test_half_cent_and_unknown_sku(spark):  # D3, D9
    _, fact, dim_c, dim_p = _build(spark, [
        ("O1", "C1", "S1", "3", "1.005", "2024-01-05", "retail"),
        ("O2", "C1", "NOPE", "2", "5", "2024-01-05", "retail"),
        ("O3", "CX", "S1", "2", "5", "2024-01-05", "retail"),
    ])
    f = _by_id(fact)
    assert f["O1"]["revenue"] == Decimal("3.02")
    assert f["O2"]["gross_profit"] == Decimal("10.00")  # unknown sku: cost 0, kept
    view = _by_id(star.orders_full(fact, dim_c, dim_p))
    assert set(f) == {"O1", "O2", "O3"} and set(view) == {"O1"}


def test_unparsable_quantity_reaches_fact(spark):  # D4, D17
    stg, fact, *_ = _build(spark, [
        (f"O{i}", "C1", "S4", q, "10", "2024-01-05", "retail") for i, q in enumerate(["5.0", "1e3", "abc", ""])
    ])
    assert stg.where("_negative_qty = 1").count() == 0
    rows = fact.collect()
    assert len(rows) == 4
    assert all(r["quantity"] is None and r["revenue"] is None and r["margin_pct"] == Decimal("75.00") for r in rows)


def test_zero_and_negative_price(spark):  # D5
    _, fact, *_ = _build(spark, [
        ("O1", "C1", "S4", "0", "10", "2024-01-05", "retail"),
        ("O2", "C1", "S4", "1", "0", "2024-01-05", "retail"),
        ("O3", "C1", "S4", "1", "-1", "2024-01-05", "retail"),
    ])
    f = _by_id(fact)
    assert set(f) == {"O1", "O2", "O3"}
    assert f["O1"]["margin_pct"] == Decimal("75.00") and f["O2"]["margin_pct"] is None and f["O3"]["margin_pct"] is None


def test_cost_null_and_negative(spark):  # D6
    _, fact, *_ = _build(spark, [
        ("O1", "C1", "S2", "1", "10", "2024-01-05", "retail"),
        ("O2", "C1", "S3", "1", "10", "2024-01-05", "retail"),
    ])
    f = _by_id(fact)
    assert f["O1"]["gross_profit"] == Decimal("10.00")
    assert f["O2"]["margin_pct"] > 100


def test_blank_ids_and_free_channel(spark):  # D7, D8
    stg, fact, *_ = _build(spark, [
        ("", "C1", "S1", "1", "10", "2024-01-05", "web"),
        (" ", "C1", "S1", "1", "10", "2024-01-05", "web"),
        (None, "C1", "S1", "1", "10", "2024-01-05", "WEB"),
    ])
    assert sorted(r["_is_duplicate"] for r in stg.collect()) == [0, 1, 1]
    assert [(r["order_id"], r["channel"]) for r in fact.collect()] == [("", "web")]


def test_dates_and_flags(spark):  # D16
    stg, *_ = _build(spark, [
        ("O1", "C1", "S1", "1", "10", "2024-1-5", "retail"),
        ("O2", "C1", "S1", "1", "10", "2024-01-05 10:00:00", "retail"),
        ("O3", "C1", "S1", "1", "10", "2024-02-30", "retail"),
        ("O4", "C1", "S1", "1", "10", "2024-01-05T10:00:00", "retail"),
        ("O5", "C1", "S1", "1", "nan", "2024-01-05", "retail"),
    ])
    s = _by_id(stg)
    assert s["O1"]["order_date"] == s["O2"]["order_date"] == dt.date(2024, 1, 5)
    assert s["O3"]["_invalid_date"] == 1 and s["O4"]["_invalid_date"] == 1
    assert s["O5"]["_null_price"] == 1


def test_customers_and_products_staging(spark):  # D15, D20
    c = _by_id(stage_customers(spark.createDataFrame(CUSTOMERS, CUSTOMERS_RAW)).withColumnRenamed("customer_id", "order_id"))
    assert c["C2"]["country"] == "Unknown" and c["C3"]["segment"] == "Unknown" and c["C3"]["name"] == ""
    assert c["C2"]["created_at"] == dt.date(2023, 2, 1) and c["C3"]["created_at"] is None
    p = {r["sku"]: r for r in stage_products(spark.createDataFrame(PRODUCTS, PRODUCTS_RAW)).collect()}
    assert [p[k]["active"] for k in ("S1", "S2", "S3", "S4")] == [1, 1, 0, 0]
    assert p["S2"]["category"] == "Unknown" and p["S2"]["cost"] is None


def test_duplicate_dimension_key_raises(spark):  # D19
    dup = spark.createDataFrame(CUSTOMERS + [("C1", "Other", "X", "Y", "2023-01-01")], CUSTOMERS_RAW)
    with pytest.raises(star.DuplicateKeyError, match="C1"):
        star.assert_unique(stage_customers(dup), "customer_id", "dim_customers")


def test_null_revenue_customer_ranks_first(spark):  # D10, D11
    _, fact, dim_c, _ = _build(spark, [
        ("O1", "C1", "S1", "2", "10", "2024-01-05", "retail"),
        ("O2", "C2", "S1", "x", "10", "2024-01-05", "retail"),
        ("O3", "C3", "S1", "1", "20", "2024-01-05", "retail"),
    ])
    top = [r["customer_id"] for r in kpis.top_customers(fact, dim_c, n=3).collect()]
    assert top == ["C2", "C1", "C3"]  # NULL first, then a tie broken by id


def test_month_gap_and_zero_previous_month(spark):  # WN-1, FN-17
    _, fact, *_ = _build(spark, [
        ("O1", "C1", "S1", "1", "10", "2024-01-05", "retail"),
        ("O2", "C1", "S1", "1", "30", "2024-03-05", "retail"),
        ("O3", "C1", "S1", "0", "30", "2024-04-05", "retail"),
        ("O4", "C1", "S1", "1", "5", "2024-05-05", "retail"),
    ])
    g = {r["year_month"]: r["mom_growth_pct"] for r in kpis.mom_growth(fact).collect()}
    assert g == {"2024-01": None, "2024-03": Decimal("200.00"), "2024-04": Decimal("-100.00"), "2024-05": None}


def test_channel_shares_sum_to_100(spark):
    _, fact, *_ = _build(spark, [
        (f"O{i}", "C1", "S1", "1", str(7 + i), "2024-01-05", ch)
        for i, ch in enumerate(["retail", "export", "export", "wholesale", "ecommerce", "retail", "export"])
    ])
    shares = [r["revenue_share_pct"] for r in kpis.sales_by_channel(fact).collect()]
    assert abs(sum(shares) - 100) <= Decimal("0.02")


def test_order_of_input_does_not_matter(spark):  # metamorphic: repartitioning keeps results
    rows = [(f"O{i % 5}", "C1", "S1", str(i % 3 - 1), "10", "2024-01-05", "retail") for i in range(40)]
    stg, fact, *_ = _build(spark, rows)
    raw = _orders(spark, rows).repartition(7)
    stg2 = stage_orders(raw, None, ["n"])
    cols = ["order_id", "quantity", "_is_duplicate", "_negative_qty"]
    assert sorted(map(tuple, stg.select(cols).collect())) == sorted(map(tuple, stg2.select(cols).collect()))
