"""Property test: the Spark parsers equal Python's own text rules on random
strings (one Spark job per generated batch).  Documented divergences --
'_' digit separators, non-ASCII digits, nan/inf words, 32-bit overflow --
are mapped to their documented result."""
import datetime as dt
import math

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ordermart.functions import clean

TOKENS = ["0", "1", "5", "9", "12", "2024", "007", "30", "02", "13", "-", "+", ".", "e", "E", " ", "\t", "\n",
          "　", "\xa0", "nan", "inf", "x", ":", "/", "T", " 00:00:00", "2024-01-05", "2024-1-5", "0000",
          "99999999999", "-01-", "- 5"]
texts = st.lists(st.lists(st.sampled_from(TOKENS), max_size=6).map("".join), min_size=50, max_size=120)


def py_int(s):
    try:
        v = int(s.strip())
    except ValueError:
        return None
    return v if -2**31 <= v < 2**31 else None


def py_float(s):
    t = s.strip()
    try:
        v = float(t)
    except ValueError:
        return None
    if math.isnan(v) or math.isinf(v):
        return None  # the nan / inf words, and what a double cannot hold, are not numbers here
    return v


@settings(max_examples=6, deadline=None)
@given(texts)
def test_parsers_equal_python(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    got = df.orderBy("i").select(clean.strip("s"), clean.to_int("s"), clean.to_double("s")).collect()
    for v, r in zip(values, got):
        assert r[0] == v.strip(), v
        assert r[1] == py_int(v), v
        assert r[2] == py_float(v), v


@settings(max_examples=6, deadline=None)
@given(st.lists(st.dates(), min_size=10, max_size=40))
def test_built_dates_are_read_and_damaged_ones_are_not(spark, days):
    rows = []  # (text, date by its first token, date of the whole text)
    for d in days:
        year, iso = f"{d.year:04d}", f"{d.year:04d}-{d.month:02d}-{d.day:02d}"
        rows += [(t, d, d) for t in (iso, f"{year}-{d.month}-{d.day}", f" \t{iso}\n")]
        rows += [(f"{iso} 10:30:00", d, None)]
        rows += [(t, None, None) for t in (iso.replace("-", "/"), f"{iso}x", f"x{iso}", f"{year}-13-{d.day}", f"{year}-0-{d.day}",
                                           f"{year}-{d.month}-32", f"{year}-{d.month}-0", f"0000-{d.month}-{d.day}", f"-{iso}", year)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, s string, a date, b date")
    same = clean.to_date("s").eqNullSafe(F.col("a")) & clean.to_date(F.col("s"), first_token=False).eqNullSafe(F.col("b"))
    assert [r["s"] for r in df.where(~same).collect()] == []


keys = st.sampled_from(["a", "b", "c", "", None, "hot"])


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(keys, st.integers(0, 1), st.integers(0, 5)), min_size=20, max_size=150),
       st.integers(1, 8))
def test_dedup_equals_row_number(spark, rows, split_rows):
    from pyspark.sql import Window

    from ordermart.operators.dedup import flag_repeats

    data = [(k, r, s, i) for i, (k, r, s) in enumerate(rows)]
    df = spark.createDataFrame(data, "k string, r int, s int, i int")
    got = {x["i"]: x["d"] for x in
           flag_repeats(df, "k", ["r", "s", "i"], "d", split_rows=split_rows).collect()}
    w = Window.partitionBy("k").orderBy("r", "s", "i")
    want = {x["i"]: int(x["n"] > 1) for x in df.withColumn("n", F.row_number().over(w)).collect()}
    assert got == want
