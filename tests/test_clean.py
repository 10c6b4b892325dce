"""Cleaning expressions against the Python text rules they reproduce."""
import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from ordermart.functions import clean, measures


def _one(spark, expr, values, typ="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, s {typ}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("s"))).collect()]


def test_strip_matches_python(spark):
    vals = ["\t a \n", " x", "y　", " z ", "", "   ", "in ner", "\x1cq\x1f"]
    assert _one(spark, clean.strip, vals) == [v.strip() for v in vals]


def test_strip_or_empty_null(spark):
    assert _one(spark, clean.strip_or_empty, [None, " a "]) == ["", "a"]


def test_to_int(spark):
    vals = [" 5 ", "+5", "007", "-3", "5.0", "1e3", "", "abc", "None", "99999999999"]
    assert _one(spark, clean.to_int, vals) == [5, 5, 7, -3, None, None, None, None, None, None]


def test_to_double(spark):
    vals = ["12.50", ".5", "5.", "1e3", "-2", "1.0d", "1.0f", "nan", "inf", "", "abc"]
    assert _one(spark, clean.to_double, vals) == [12.5, 0.5, 5.0, 1000.0, -2.0] + [None] * 6


def test_to_date_batch_and_entry(spark):
    vals = ["2024-1-5", "2024-01-05 10:00:00", "2024-02-30", "2024/01/05", "2024-01-05T10:00:00",
            "24-01-05", "0000-01-01", "12024-01-05", "2024-001-05", " 2024-01-05 ", ""]
    d = dt.date(2024, 1, 5)
    assert _one(spark, clean.to_date, vals) == [d, d, None, None, None, None, None, None, None, d, None]
    entry = _one(spark, lambda c: clean.to_date(c, first_token=False), vals)
    assert entry == [d, None, None, None, None, None, None, None, None, d, None]


def test_default_unknown_and_active(spark):
    assert _one(spark, clean.default_unknown, ["", " ", None, " Retail "]) == ["Unknown", "Unknown", "Unknown", "Retail"]
    assert _one(spark, clean.to_active_flag, ["TRUE", " true ", "1", "", None, "False"]) == [1, 1, 0, 0, 0, 0]


def test_half_cent_revenue_is_decimal_first(spark):
    df = spark.createDataFrame([(3, 1.005, 0.0)], "q int, p double, c double")
    r = df.select(measures.revenue(F.col("q"), F.col("p")).alias("r"),
                  measures.gross_profit(F.col("q"), F.col("p"), F.col("c")).alias("g")).first()
    assert r["r"] == Decimal("3.02") and r["g"] == Decimal("3.02")


def test_margin_null_unless_price_positive(spark):
    df = spark.createDataFrame([(0.0, 1.0), (-1.0, 1.0), (10.0, None), (10.0, -6.94)], "p double, c double")
    got = [r[0] for r in df.select(measures.margin_pct(F.col("p"), F.col("c"))).collect()]
    assert got == [None, None, Decimal("100.00"), Decimal("169.40")]
