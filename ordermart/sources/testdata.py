"""Raw inputs derived from the TPC-H-style test tables (FIXTURES.md §2).

The generated tables become the raw order, customer, product, app-order and
order-candidate feeds, with the dirt (blank fields, bad numbers, bad dates,
duplicates, unknown keys) placed row by row.  Only the columns the mapping
needs are read, so the parquet scans are pruned.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ROWS_PER_TASK, dealt, sized


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pad(c: Column, prefix: str) -> Column:
    return F.concat(F.lit(prefix), F.lpad(c.cast("string"), 7, "0"))


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _t(spark, sf_dir, "customer")
    n = _t(spark, sf_dir, "nation")
    k = F.col("c_custkey")
    return c.join(n, c.c_nationkey == n.n_nationkey).select(
        _pad(k, "C").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.when(k % 40 == 0, F.lit("")).otherwise(F.col("n_name")).alias("country"),
        F.when(k % 40 == 7, F.lit(" ")).otherwise(F.col("c_mktsegment")).alias("segment"),
        F.date_add(F.lit("2022-01-01").cast("date"), (k % 900).cast("int")).cast("string").alias("created_at"),
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _t(spark, sf_dir, "part")
    k = F.col("p_partkey")
    return p.select(
        _pad(k, "SKU").alias("sku"),
        F.when(k % 30 == 0, F.lit("")).otherwise(F.col("p_type")).alias("category"),
        F.when(k % 20 == 3, F.lit("-6.94"))
        .when(k % 20 == 9, F.lit(""))
        .otherwise(F.col("p_retailprice").cast("string"))
        .alias("cost"),
        F.when(F.col("p_size") % 5 == 0, F.lit("False")).otherwise(F.lit("True")).alias("active"),
    )


def _line_id() -> Column:
    return F.concat(F.lit("O"), F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"))


def raw_order_ids(spark: SparkSession, sf_dir: str) -> DataFrame | None:
    """The ``order_id`` of every order line, its order there or not: no id
    stands here less often than in ``raw_orders``.  None if an order key
    repeats, when the join has more rows than there are lines."""
    o = _t(spark, sf_dir, "orders").where(F.col("o_orderkey").isNotNull())
    n = o.count()
    with sized(spark, n):
        most = o.groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
    if (most or 0) > 1:
        return None
    return _t(spark, sf_dir, "lineitem").select(_line_id().alias("order_id"))


def _order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The numbers and the day that one raw order line is made of."""
    li = _t(spark, sf_dir, "lineitem")
    o = _t(spark, sf_dir, "orders")
    # a date is moved, not a time of which only the date is used
    li = li.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", F.col("l_shipdate").cast("date").alias("_day"))
    li = dealt(li, li.count(), "l_orderkey", join=True)
    return li.join(o, li.l_orderkey == o.o_orderkey).select(*li.columns, "o_custkey")


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV-like order lines; k1..k4 is the arrival order inside one order id."""
    return _order_texts(_order_lines(spark, sf_dir))


def _order_texts(lines: DataFrame, *others: str) -> DataFrame:
    """The raw columns of order ``lines``, and ``others`` as they are."""
    ok, pk, ln = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_linenumber")
    qty_txt = F.col("l_quantity").cast("int").cast("string")
    day = F.col("_day").cast("string")
    return lines.select(
        _line_id().alias("order_id"),
        F.when(ok % 97 == 0, F.lit("C_NONE")).otherwise(_pad(F.col("o_custkey"), "C")).alias("customer_id"),
        F.when(ok % 101 == 0, F.lit("SKU_NONE")).otherwise(_pad(pk, "SKU")).alias("sku"),
        F.when((pk + ok) % 37 == 0, F.concat(F.lit("-"), qty_txt))
        .when((pk + ok) % 211 == 0, F.lit("x"))
        .otherwise(qty_txt)
        .alias("quantity"),
        F.when((pk + 2 * ok) % 41 == 0, F.lit(""))
        .otherwise(F.col("l_extendedprice").cast("decimal(18,2)").cast("string"))
        .alias("unit_price"),
        F.when((pk + 3 * ok) % 43 == 0, F.lit("not-a-date"))
        .when(ok % 5 == 0, F.concat(day, F.lit(" 00:00:00")))
        .otherwise(day)
        .alias("order_date"),
        F.when(ln % 4 == 0, F.lit("ecommerce"))
        .when(ln % 4 == 1, F.lit(" Retail "))
        .when(ln % 4 == 2, F.lit("WHOLESALE"))
        .otherwise(F.lit("export"))
        .alias("channel"),
        pk.alias("k1"),
        F.col("l_suppkey").alias("k2"),
        F.col("l_extendedprice").alias("k3"),
        F.col("l_quantity").alias("k4"),
        *others,
    )


ORDER_SEQ = ("k1", "k2", "k3", "k4")


def raw_app_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders already accepted by order entry (typed, like its table)."""
    o = _t(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.where(k % 50 == 1).select(
        F.concat(F.lit("O"), k.cast("string"), F.lit("-1")).alias("order_id"),
        _pad(F.col("o_custkey"), "C").alias("customer_id"),
        _pad(k % 200, "SKU").alias("sku"),
        F.lit(1).cast("int").alias("quantity"),
        F.col("o_totalprice").alias("unit_price"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.lit("ecommerce").alias("channel"),
        F.col("o_orderdate").alias("created_at"),
    )


def raw_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Submitted order records (text fields) with their arrival ``seq``."""
    e = _t(spark, sf_dir, "events")
    i = F.col("event_id")
    return e.select(
        F.when(i % 29 == 0, F.lit(""))
        .when(i % 31 == 0, F.concat(F.lit("N"), (i - 1).cast("string")))
        .otherwise(F.concat(F.lit("N"), i.cast("string")))
        .alias("order_id"),
        F.when(i % 23 == 0, F.lit("C_NONE")).otherwise(_pad(F.col("user_id"), "C")).alias("customer_id"),
        F.when(i % 19 == 0, F.lit("SKU_NONE")).otherwise(_pad(i % 200, "SKU")).alias("sku"),
        F.when(i % 13 == 0, F.lit(""))
        .when(i % 13 == 1, F.lit("0"))
        .when(i % 13 == 2, F.lit("x"))
        .otherwise((i % 13).cast("string"))
        .alias("quantity"),
        F.when(i % 17 == 0, F.lit("abc"))
        .otherwise(F.col("value").cast("decimal(18,2)").cast("string"))
        .alias("unit_price"),
        F.when(i % 37 == 0, F.lit("2024/01/05")).otherwise(F.col("ts").cast("date").cast("string")).alias("order_date"),
        F.when(i % 11 == 0, F.lit("web"))
        .when(i % 11 == 1, F.lit(" Retail "))
        .when(i % 11 == 2, F.lit("EXPORT"))
        .when(i % 11 == 3, F.lit("wholesale"))
        .otherwise(F.lit("ecommerce"))
        .alias("channel"),
        F.col("ts").alias("created_at"),
        i.alias("seq"),
    )


def twice(rows: DataFrame, key: str, one_in: int) -> DataFrame:
    """``rows`` with those of one key in ``one_in`` standing twice."""
    return rows.unionByName(rows.where(F.crc32(F.col(key).cast("binary")) % one_in == 0))


#: Fixed value: the clock of the planted submissions.
PLANTED_CLOCK = "2025-06-01 12:00:00"


def planted_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Submissions of which every third names an id of an order line and every
    fifth says no time."""
    i = F.col("seq")
    taken = F.concat(F.lit("O"), (i % 5000 + 1).cast("string"), F.lit("-"), (i % 4 + 1).cast("string"))
    rows = raw_candidates(spark, sf_dir)
    return rows.withColumns({
        "order_id": F.when(i % 3 == 0, taken).otherwise(F.col("order_id")),
        "created_at": F.when(i % 5 != 0, F.col("created_at")),
    })


def _quoted(c: Column) -> Column:
    return F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))


def _feed(rows: DataFrame, layouts: list[tuple[str, Column]], order: list[Column], bucket: Column, files: int, path: str, texts: Callable[..., DataFrame] | None = None) -> str:
    """Write ``rows`` as ``files`` CSV files in the order of their buckets, each
    with the header and line format of one layout in turn.  ``texts`` makes the
    columns of the layouts from ``rows`` (and passes others on) once these are
    moved, since they are longer."""
    spark = rows.sparkSession
    k = F.col("bucket") % len(layouts)
    line = F.coalesce(*[F.when(k == i, text) for i, (_, text) in enumerate(layouts)])
    heads = spark.createDataFrame([(b, layouts[b % len(layouts)][0]) for b in range(files)], "bucket int, head string")
    keys = [f"o{i}" for i in range(len(order))]
    body = rows.withColumn("bucket", F.least(bucket, F.lit(files - 1)).cast("int"))
    both = heads.unionByName(body, allowMissingColumns=True).repartitionById(files, F.col("bucket"))
    # sorted by the folder's own column, so the writer keeps this order
    both = both.withColumn("part", F.format_string("%05d", "bucket"))
    both = texts(both, "bucket", "part", "head") if texts else both
    both = both.withColumns(dict(zip(keys, order, strict=True))).withColumn("is_line", F.col(keys[0]).isNotNull())
    dealt = both.sortWithinPartitions("part", "is_line", *keys)
    dealt.select("part", F.coalesce("head", line).alias("value")).write.partitionBy("part").text(path)
    return path


def write_csv_feeds(spark: SparkSession, sf_dir: str, root: str, files: int = 6) -> tuple[str, str, str]:
    """The raw feeds as CSV files, in arrival order: three layouts of columns,
    quoted fields, line breaks inside quotes, short lines (a missing price is
    left out) and lines with more fields than the header."""
    o = _order_lines(spark, sf_dir)
    last, n_orders = o.agg(F.max("l_partkey"), F.count("*")).first()
    last = last or 0
    # a task writes one file, so there are more of them for more rows
    some = lambda n: max(files, -(-n // ROWS_PER_TASK))
    spread = lambda c, top: (c * some(n_orders) / F.lit(top + 1)).cast("int")
    plain = lambda *names: F.concat_ws(",", *[F.col(n) for n in names])
    note = _quoted(F.concat(F.lit('said "'), F.col("sku"), F.lit('",\nthen left')))
    priceless = F.when(F.col("unit_price") == "", F.lit("")).otherwise(F.concat(F.lit(","), F.col("unit_price"), F.when(F.col("k2") % 3 == 0, F.lit(',more,"x,y"')).otherwise(F.lit(""))))
    orders = _feed(o, [
        ("order_id,customer_id,sku,quantity,unit_price,order_date,channel", plain("order_id", "customer_id", "sku", "quantity", "unit_price", "order_date", "channel")),
        ("channel,order_id,customer_id,sku,quantity,order_date,unit_price", F.concat(_quoted(F.concat("channel", F.lit("\n"))), F.lit(","), plain("order_id", "customer_id", "sku", "quantity", "order_date"), priceless)),
        ('sku,note,channel,"unit_price",quantity,order_date,customer_id,order_id', F.concat_ws(",", F.col("sku"), note, F.col("channel"), F.col("unit_price"), F.col("quantity"), _quoted(F.col("order_date")), F.col("customer_id"), F.col("order_id"))),
    ], [F.col(c) for c in ORDER_SEQ], spread(F.col("l_partkey"), last), some(n_orders), f"{root}/orders", _order_texts)
    c = raw_customers(spark, sf_dir)
    n_customers = some(c.count())
    customers = _feed(c, [
        ("customer_id,name,country,segment,created_at", F.concat(F.col("customer_id"), F.lit(","), _quoted(F.concat("name", F.lit(" \r\n "))), F.lit(","), plain("country", "segment", "created_at"))),
        ("segment,created_at,country,name,customer_id,comment", F.concat(plain("segment", "created_at", "country", "name", "customer_id"), F.lit(',5" pipe'))),
    ], [F.col("customer_id")], F.crc32(F.col("customer_id").cast("binary")) % n_customers, n_customers, f"{root}/customers")
    p = raw_products(spark, sf_dir)
    n_products = some(p.count())
    products = _feed(p, [
        ("sku,category,cost,active", F.concat(plain("sku", "category", "cost"), F.lit(","), _quoted(F.col("active")))),
        ("active,cost,category,sku", F.concat(plain("active", "cost"), F.lit(","), _quoted(F.concat(F.lit("\n"), "category")), F.lit(","), F.col("sku"))),
    ], [F.col("sku")], F.crc32(F.col("sku").cast("binary")) % n_products, n_products, f"{root}/products")
    return orders, customers, products
