"""Order entry: field rules, lookup order, first valid submission wins (D25)."""
import datetime as dt

from ordermart.operators import orders
from ordermart.schemas import NEW_ORDERS

CAND = "order_id string, customer_id string, sku string, quantity string, unit_price string, " \
       "order_date string, channel string, seq long"


def _dims(spark):
    c = spark.createDataFrame([("C1", "Ana", "EC", "Retail", dt.date(2023, 1, 1))],
                              "customer_id string, name string, country string, segment string, created_at date")
    p = spark.createDataFrame([("S1", "Luxury", 2.0, 1)], "sku string, category string, cost double, active smallint")
    return c, p


def _errors(spark, rows):
    df = spark.createDataFrame([r + (i,) for i, r in enumerate(rows)], CAND)
    out = {}
    for r in orders.validation_errors(df).collect():
        out.setdefault(r["seq"], {})[r["field"]] = r["code"]
    return out


def test_field_rules(spark):
    e = _errors(spark, [
        ("N1", "C1", "S1", "2", "9.5", "2024-01-05", " Retail "),       # valid
        ("", " ", "", "", "", "", ""),                                 # all required
        ("N3", "C1", "S1", "2.5", "abc", "2024-01-05 10:00:00", "web"),
        ("N4", "C1", "S1", "0", "-1", "2024/01/05", "EXPORT"),
        ("N5", "C1", "S1", "+3", "1e2", "2024-1-5", "wholesale"),       # valid
    ])
    assert 0 not in e and 4 not in e
    assert e[1] == {f: "required" for f in ("order_id", "customer_id", "sku", "quantity", "unit_price",
                                             "order_date", "channel")}
    assert e[2] == {"quantity": "not_integer", "unit_price": "not_numeric", "order_date": "bad_date_format",
                    "channel": "invalid_channel"}
    assert e[3] == {"quantity": "not_positive", "unit_price": "not_positive", "order_date": "bad_date_format"}


def test_rejected_then_valid_same_id_is_accepted(spark):  # D25 and rejection order
    c, p = _dims(spark)
    rows = [
        ("N1", "C1", "S1", "x", "5", "2024-01-05", "retail"),      # field error
        ("N1", "CX", "S1", "1", "5", "2024-01-05", "retail"),      # unknown customer
        ("N1", "C1", "SX", "1", "5", "2024-01-05", "retail"),      # unknown sku
        ("N1", "C1", "S1", "2", "5", "2024-01-05", "retail"),      # accepted
        ("N1", "C1", "S1", "3", "5", "2024-01-05", "retail"),      # duplicate in batch
        ("N2", "CX", "SX", "1", "5", "2024-01-05", "retail"),      # customer reported, not sku
        ("N9", "C1", "S1", "1", "5", "2024-01-05", "retail"),      # id already registered
    ]
    cands = spark.createDataFrame([r + (i,) for i, r in enumerate(rows)], CAND)
    existing = spark.createDataFrame([("N9",)], "order_id string")
    acc, rej = orders.register_orders(cands, c, p, existing, split_rows=1)
    a = acc.collect()
    assert [(r["order_id"], r["quantity"]) for r in a] == [("N1", 2)]
    assert str(a[0]["revenue"]) == "10.00" and str(a[0]["margin_pct"]) == "60.00"
    got = sorted((r["seq"], r["field"], r["code"]) for r in rej.collect())
    assert got == [(0, "quantity", "not_integer"), (1, "customer_id", "unknown_customer"),
                   (2, "sku", "unknown_sku"), (4, "order_id", "duplicate_order_id"),
                   (5, "customer_id", "unknown_customer"), (6, "order_id", "duplicate_order_id")]


def test_checkpointed_registration_equals_lazy(spark):
    c, p = _dims(spark)
    rows = [(f"N{i % 4}", "C1", "S1", str(i % 3), "5", "2024-01-05", "retail") for i in range(12)]
    cands = spark.createDataFrame([r + (i,) for i, r in enumerate(rows)], CAND)
    existing = spark.createDataFrame([("N3",)], "order_id string")
    lazy = orders.register_orders(cands, c, p, existing)
    ck = orders.register_orders(cands, c, p, existing, checkpoint=True)
    for x, y in zip(lazy, ck):
        assert sorted(map(tuple, x.drop("created_at").collect())) == sorted(map(tuple, y.drop("created_at").collect()))


def test_listing_newest_first(spark):
    df = spark.createDataFrame([
        ("A", "C1", "S1", 3, 1.005, dt.date(2024, 1, 1), "retail", dt.datetime(2024, 1, 1, 10, 5, 59)),
        ("B", "C1", "S1", 1, 2.0, dt.date(2024, 1, 2), "retail", dt.datetime(2024, 1, 3, 8, 0)),
    ], NEW_ORDERS)
    out = orders.order_listing(df).collect()
    assert [r["order_id"] for r in out] == ["B", "A"]
    assert str(out[1]["line_total"]) == "3.02" and out[1]["registered_at"] == "2024-01-01 10:05"
