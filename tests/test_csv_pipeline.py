"""CSV files -> written silver and gold: file order, ragged lines, re-runs."""
from ordermart.operators import kpis
from ordermart.plans.pipeline import csv_inputs, run_batch

ORDERS = """order_id,customer_id,sku,quantity,unit_price,order_date,channel
O1,C1,S1,2,10.00,2024-01-05,Retail
O2,C1,S2,1,,2024-01-06,retail
O1,C2,S1,5,99.00,2024-01-07,export
O3,C2,S1,-1,5,2024-02-01,export
4,q
O4,C1,S2,3,2.50,2024-02-03 00:00:00, wholesale
5,q,w,x,y,z,a,extra
O3,C1,S1,1,1,2024-02-04,ecommerce
"""
CUSTOMERS = """customer_id,name,country,segment,created_at
C1,Ana,Ecuador,Retail,2023-01-01
C2,Bo,,Corporate,2023-02-01
"""
PRODUCTS = """sku,category,cost,active
S1,Luxury,4.00,True
S2,,-6.94,False
"""


def _write(tmp_path, name, text):
    p = tmp_path / name
    p.write_text(text, encoding="utf-8")
    return str(p)


def test_csv_pipeline_and_rerun(spark, tmp_path):
    o = _write(tmp_path, "orders.csv", ORDERS)
    c = _write(tmp_path, "customers.csv", CUSTOMERS)
    p = _write(tmp_path, "products.csv", PRODUCTS)
    raw = csv_inputs(spark, o, c, p, app_orders=str(tmp_path / "missing_new_orders"))
    wh = run_batch(spark, raw, root=str(tmp_path / "wh"))
    stg = wh.stg_orders
    assert stg.count() == 7  # the line with a field too many is staged without it
    assert sorted(r["line"] for r in wh.table("rejects_orders").collect()) == ["4,q"]
    flags = {(r["order_id"], r["quantity"]): r["_is_duplicate"] for r in stg.collect()}
    assert flags[("O1", 2)] == 0 and flags[("O1", 5)] == 1  # file order decides
    assert flags[("O3", -1)] == 0 and flags[("O3", 1)] == 1  # bad first row still blocks
    fact = {r["order_id"]: r for r in wh.fact_orders.collect()}
    assert sorted(fact) == ["O1", "O4"]
    assert fact["O4"]["channel"] == "wholesale" and str(fact["O4"]["gross_profit"]) == "28.32"
    cards = kpis.kpi_cards(wh.fact_orders).first()
    assert str(cards["total_revenue"]) == "27.50" and cards["total_orders"] == 2

    again = run_batch(spark, csv_inputs(spark, o, c, p), root=str(tmp_path / "wh2"))
    for t in ("stg_orders", "dim_customers", "dim_products", "fact_orders"):
        assert sorted(map(tuple, again.table(t).collect())) == sorted(map(tuple, wh.table(t).collect()))


def test_columns_by_header_name_and_quotes(spark, tmp_path):
    from ordermart.schemas import PRODUCTS_RAW
    from ordermart.sources.files import MissingColumnError, read_csv_raw, split_rejects
    import pytest

    p = _write(tmp_path, "products.csv",
               'active,extra,cost,sku,category\nTrue,x,"1,5",S1,"Gift ""Box"""\nFalse,y,2,S2,\n')
    good, bad = split_rejects(read_csv_raw(spark, p, PRODUCTS_RAW))
    rows = {r["sku"]: r for r in good.collect()}
    assert rows["S1"]["category"] == 'Gift "Box"' and rows["S1"]["cost"] == "1,5" and rows["S1"]["active"] == "True"
    assert bad.count() == 0
    q = _write(tmp_path, "bad.csv", "sku,category\nS1,A\n")
    with pytest.raises(MissingColumnError, match="cost"):
        read_csv_raw(spark, q, PRODUCTS_RAW)


def test_duplicate_dimension_key_stops_before_gold(spark, tmp_path):  # D19
    import os

    import pytest

    from ordermart.operators.star import DuplicateKeyError

    o = _write(tmp_path, "orders.csv", ORDERS)
    c = _write(tmp_path, "customers.csv", CUSTOMERS + "C1,Other,Peru,Retail,2023-03-01\n")
    p = _write(tmp_path, "products.csv", PRODUCTS)
    root = tmp_path / "wh"
    with pytest.raises(DuplicateKeyError, match="C1"):
        run_batch(spark, csv_inputs(spark, o, c, p), root=str(root))
    assert (root / "stg_customers").exists() and (root / "stg_orders").exists()
    assert not any((root / t).exists() for t in ("dim_customers", "dim_products", "fact_orders"))
    assert os.listdir(root)


def test_app_orders_from_catalog_table(spark, tmp_path):  # SRC-4
    import datetime as dt

    from ordermart.schemas import NEW_ORDERS

    spark.createDataFrame(
        [("O1", "C2", "S2", 9, 1.5, dt.date(2024, 1, 1), "export", dt.datetime(2024, 1, 1, 12, 0))], NEW_ORDERS
    ).createOrReplaceTempView("om_new_orders")
    o = _write(tmp_path, "orders.csv", ORDERS)
    c = _write(tmp_path, "customers.csv", CUSTOMERS)
    p = _write(tmp_path, "products.csv", PRODUCTS)
    wh = run_batch(spark, csv_inputs(spark, o, c, p, app_orders="om_new_orders"), root=str(tmp_path / "wh"))
    fact = {r["order_id"]: r for r in wh.fact_orders.collect()}
    assert fact["O1"]["quantity"] == 9 and fact["O1"]["channel"] == "export"  # the app row wins


def test_short_and_long_lines_and_line_breaks(spark, tmp_path):
    from ordermart.schemas import CUSTOMERS_RAW
    from ordermart.sources.files import read_csv_raw, split_rejects

    head = "customer_id,name,country,segment,created_at\n"
    c = _write(tmp_path, "customers.csv", head + 'C1,"Bo, Jr",PE,Retail\nC2,Ana,PE\nC3,"a ""b"", c",PE,Retail,2024-01-01,more,"x,y"\n')
    good, bad = split_rejects(read_csv_raw(spark, c, CUSTOMERS_RAW))
    rows = {r["customer_id"]: r for r in good.collect()}
    assert set(rows) == {"C1", "C3"} and good.count() == 2
    assert rows["C1"]["name"] == "Bo, Jr" and rows["C1"]["created_at"] is None
    assert rows["C3"]["name"] == 'a "b", c' and rows["C3"]["created_at"] == "2024-01-01"
    assert [r["line"] for r in bad.collect()] == ["C2,Ana,PE"]
    m = _write(tmp_path, "more.csv", head + 'C4,"Li\nLu",PE,Retail,2024-01-01\n')
    good, bad = split_rejects(read_csv_raw(spark, m, CUSTOMERS_RAW))
    assert [r["name"] for r in good.collect()] == ["Li\nLu"] and bad.count() == 0


def test_each_file_is_read_by_its_own_header(spark, tmp_path):
    import pytest

    from ordermart.schemas import PRODUCTS_RAW
    from ordermart.sources.files import MissingColumnError, read_csv_raw, split_rejects

    a = _write(tmp_path, "a.csv", "sku,category,cost,active\nS1,A,1,True\n")
    b = _write(tmp_path, "b.csv", '\ufeff"category",sku,cost,active\r\n"B\r\nb",S2,2,False\r\n')
    c = _write(tmp_path, "c.csv", "active,note,cost,sku,category\nTrue,,3,S3\nTrue,\"x\n,y\",4,S4,D\n")
    _write(tmp_path, "empty.csv", "")
    good, bad = split_rejects(read_csv_raw(spark, [a, b, c, str(tmp_path / "empty.csv")], PRODUCTS_RAW))
    assert sorted(tuple(r)[:4] for r in good.collect()) == [("S1", "A", "1", "True"), ("S2", "B\nb", "2", "False"), ("S4", "D", "4", "True")]
    assert [r["line"] for r in bad.collect()] == ["True,,3,S3"]
    d = _write(tmp_path, "d.csv", "sku,category,cost\nS1,A,1\n")
    with pytest.raises(MissingColumnError, match="active"):
        read_csv_raw(spark, [a, d], PRODUCTS_RAW)


def _python_reads(paths, names):
    """(well-formed rows, others) as Python's dict reader gives them."""
    import csv

    from ordermart.sources.files import MAY_LACK

    good, bad = [], 0
    for p in paths:
        with open(p, encoding="utf-8") as f:
            for row in csv.DictReader(f):
                if any(row[n] is None for n in names if n not in MAY_LACK):
                    bad += 1
                else:
                    good.append(tuple(row[n] for n in names))
    return good, bad


def test_records_over_many_splits_equal_pythons_reader(spark, tmp_path):
    """Generated files with quotes at all places, read in splits of a few bytes."""
    import random

    from ordermart.schemas import CUSTOMERS_RAW
    from ordermart.sources.files import CSV_SEQ, read_csv_raw, split_rejects

    names = [f.name for f in CUSTOMERS_RAW.fields]
    rnd = random.Random(11)
    bits = ["a", "b", " ", ",", '"', '""', "\n", "\r\n", "é", "x y", '"p,\nq"', '"l1\nl2\n\nl3"']
    paths = []
    for k in range(6):
        order = rnd.sample(names, len(names)) + ["more"]
        rows = ["".join(rnd.choices(bits, weights=[9, 9, 4, 9, 1, 1, 3, 1, 2, 2, 1, 1], k=rnd.randint(1, 14))) for _ in range(60)]
        tame = [",".join(rnd.choice(["v", "", '"q ""z"""', '"a\nb"', 'c"d', '"e"f']) for _ in range(rnd.randint(2, 8))) for _ in range(120)]
        body = "\n".join(tame[:60] + (rows if k % 2 else []) + tame[60:]) + ("" if k % 2 else "\n")
        paths.append(_write(tmp_path, f"{k:02d}.csv", ",".join(order) + "\n" + body))
    want, n_bad = _python_reads(paths, names)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "211")
        raw = read_csv_raw(spark, paths, CUSTOMERS_RAW)
        good, bad = split_rejects(raw)
        got = [tuple(r)[: len(names)] for r in good.orderBy(*CSV_SEQ).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len({r["_block"] for r in raw.select("_block").collect()}) > 10
    assert got == want and bad.count() == n_bad


def test_a_quote_never_closed_keeps_its_lines(spark, tmp_path):
    from ordermart.sources import csv_records

    text = "k,v\n1,a\n2,\"open\n" + "\n".join(f"{i},x" for i in range(200))
    path = _write(tmp_path, "open.csv", text)
    lines = csv_records.land_lines(spark, path, ["k", "v"])
    whole, long = csv_records.records(lines, max_record=100)
    assert [r["line"] for r in whole.orderBy("row").collect()] == ["k,v", "1,a"] and long.count() == 201
    whole, long = csv_records.records(lines)
    assert whole.count() == 3 and long.count() == 0


def test_an_accepted_order_loaded_by_a_batch_counts_once(spark, tmp_path):
    from ordermart.plans.pipeline import live_fact_orders

    o = _write(tmp_path, "orders.csv", ORDERS)
    c = _write(tmp_path, "customers.csv", CUSTOMERS)
    p = _write(tmp_path, "products.csv", PRODUCTS)
    wh = run_batch(spark, csv_inputs(spark, o, c, p), root=str(tmp_path / "wh"))
    from pyspark.sql import functions as F

    log = wh.fact_orders.where("order_id = 'O1'").unionByName(wh.fact_orders.where("order_id = 'O4'").withColumn("order_id", F.lit("N1")))
    log.write.parquet(str(tmp_path / "log"))
    live = live_fact_orders(wh, spark.read.schema(log.schema).parquet(str(tmp_path / "log")))
    assert sorted(r["order_id"] for r in live.collect()) == ["N1", "O1", "O4"]


def test_windows_of_a_large_split_hold_one_chunk(spark, tmp_path, monkeypatch):
    """Records over chunk ends, some over whole chunks: the same as one group a split."""
    import csv

    from ordermart.schemas import PRODUCTS_RAW
    from ordermart.sources import csv_records
    from ordermart.sources.files import CSV_SEQ, read_csv_raw

    monkeypatch.setattr(csv_records, "CHUNK_BITS", 2)
    body = "".join(f'S{i},"a{chr(10) * (i % 11)}""b",{i},True\n' if i % 3 else f"S{i},plain,{i},False\n" for i in range(90))
    path = _write(tmp_path, "products.csv", "sku,category,cost,active\n" + body)
    want = [tuple(r) for r in list(csv.reader(open(path, encoding="utf-8", newline="")))[1:]]
    got = [tuple(r)[:4] for r in read_csv_raw(spark, path, PRODUCTS_RAW).orderBy(*CSV_SEQ).collect()]
    assert got == want
    lines = csv_records.land_lines(spark, path, [])
    assert csv_records._open_chunks(lines).select("chunk").distinct().count() > 10


def test_written_tables_are_compressed_well(spark, tmp_path):
    from ordermart.operators.id_index import IdStore
    from ordermart.plans.pipeline import Warehouse
    from ordermart.session import landed

    df = spark.createDataFrame([(f"O{i}", i % 3) for i in range(50)], "order_id string, k int")
    Warehouse(spark, str(tmp_path)).write("t", df, partition_by="k")
    IdStore(spark, str(tmp_path / "ids")).start(df)
    files = [*tmp_path.rglob("*.parquet")]
    assert files and all(f.name.endswith(".zstd.parquet") for f in files)
    kept = landed(df, "t")
    assert sorted(kept.collect()) == sorted(df.collect()) and all(".zstd." in f for f in kept.inputFiles())


def test_records_are_parsed_once_for_both_readers(spark, tmp_path):
    o = _write(tmp_path, "orders.csv", ORDERS)
    c = _write(tmp_path, "customers.csv", CUSTOMERS)
    p = _write(tmp_path, "products.csv", PRODUCTS)
    raw = csv_inputs(spark, o, c, p)
    for df in (raw.orders, raw.customers, raw.products, *raw.rejects.values()):
        plan = df._jdf.queryExecution().toString()
        assert "regexp_extract_all" not in plan and "split(" not in plan
    assert raw.orders.count() == 7 and [r["line"] for r in raw.rejects["orders"].collect()] == ["4,q"]
    assert run_batch(spark, raw, root=str(tmp_path / "wh")).table("bronze_orders").count() == 7


def test_records_that_end_in_their_chunk_are_not_moved_again(spark, tmp_path, monkeypatch):
    from ordermart.sources import csv_records

    kept = {}
    monkeypatch.setattr(csv_records, "landed", lambda df, label, f=csv_records.landed: kept.setdefault(label, f(df, label)))
    path = _write(tmp_path, "a.csv", "k,v\n" + "".join(f'{i},"a\nb\n{"x" * (i % 7)}"\n' for i in range(300)))
    whole, long = csv_records.records(csv_records.land_lines(spark, path, ["k", "v"]))
    assert [r["line"] for r in whole.orderBy("row").collect()] == ["k,v", *(f'{i},"a\nb\n{"x" * (i % 7)}"' for i in range(300))]
    assert long.count() == 0
    part = kept["csv-part"]
    assert part.count() == 300 + 3 and part.where("NOT ended").count() == 3  # the lines of the last one
