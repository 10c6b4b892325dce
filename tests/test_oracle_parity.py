"""Every catalogue query equals its DuckDB SQL on the sf0.001 test tables
(row count, column names and order-insensitive values)."""
import importlib

import duckdb
import pytest

from parity import SF_SMALL, TABLES, key, norm

entry = importlib.import_module("__spark_entry__")
#: The corpus operators are tested in their own folder.
NAMES = sorted(n for n in entry.queries() if not n.startswith("op") or not n[2:3].isdigit())
NAMES = [n for n in NAMES if n != "pipeline"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    yield con
    con.close()


def test_every_query_has_oracle_sql():
    assert set(NAMES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=key)
    rel = duck.sql(entry.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    idx = [rel.columns.index(c) for c in cols]
    want = sorted((tuple(norm(r[i]) for i in idx) for r in rel.fetchall()), key=key)
    assert got == want


def test_entry_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["year_month", "revenue", "gross_profit", "orders", "margin_pct"]
    assert df.count() == 83


def test_fixture_counts_sf0001(spark):
    q = entry.queries()
    s = q["qa_summary"](spark, SF_SMALL).first()
    assert (s["raw_orders"], s["duplicates"], s["negative_qty"], s["null_price"], s["invalid_date"],
            s["clean_orders"]) == (6030, 1416, 167, 162, 140, 4271)
    assert str(s["total_revenue"]) == "5629251064.32" and str(s["total_gross_profit"]) == "5543485670.16"
    assert (s["unknown_country"], s["unknown_segment"], s["unknown_category"]) == (4, 4, 7)
    assert q["v_orders_full"](spark, SF_SMALL).count() == 4187
    assert q["registered_orders"](spark, SF_SMALL).count() == 542
