"""The hot-key-safe first-occurrence flag equals row_number() on every input."""
import contextlib
import io

from pyspark.sql import Window
from pyspark.sql import functions as F

from ordermart.operators.dedup import first_rows, flag_repeats


def _fixture(spark):
    # one key holds a third of the rows, two more are hot, a NULL key repeats
    data = []
    for i in range(600):
        k = "HOT" if i % 3 == 0 else ("WARM" if i % 7 == 0 else ("TEPID" if i % 11 == 0 else f"k{i % 97}"))
        data.append((k, i % 2, (i * 7919) % 1000, i))
    data += [(None, 1, 5, 1000), (None, 0, 9, 1001), ("", 1, 1, 1002), ("", 1, 0, 1003)]
    return spark.createDataFrame(data, "k string, rank int, s int, id int")


def _brute(df):
    w = Window.partitionBy("k").orderBy("rank", "s", "id")
    return {r["id"]: int(r["rn"] > 1) for r in df.withColumn("rn", F.row_number().over(w)).collect()}


def test_matches_row_number_unsplit(spark):
    df = _fixture(spark)
    got = {r["id"]: r["dup"] for r in flag_repeats(df, "k", ["rank", "s", "id"], "dup").collect()}
    assert got == _brute(df)


def test_matches_row_number_with_salted_hot_keys(spark):
    df = _fixture(spark)
    out = flag_repeats(df, "k", ["rank", "s", "id"], "dup", split_rows=20)
    got = {r["id"]: r["dup"] for r in out.collect()}
    assert got == _brute(df)
    assert out.count() == df.count()


def test_hot_list_is_bounded_and_broadcast(spark):
    df = _fixture(spark)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        flag_repeats(df, "k", ["rank", "s", "id"], "dup", split_rows=20).explain()
    plan = buf.getvalue()
    # no limit: keys above a share of the rows, which a scalar subquery counts
    assert "Limit" not in plan and "TakeOrdered" not in plan and "Subquery" in plan
    assert "BroadcastExchange" in plan


def test_first_rows(spark):
    df = _fixture(spark)
    firsts = first_rows(df, "k", ["rank", "s", "id"], split_rows=20)
    assert firsts.count() == df.select("k").distinct().count()


def test_hot_key_is_spread_over_tasks(spark):
    """A blank id holding a third of all rows is split across partitions."""
    from pyspark.sql import functions as F2

    n = 3000
    data = [("" if i % 3 == 0 else f"O{i}", 1, i % 17, i) for i in range(n)]
    df = spark.createDataFrame(data, "k string, rank int, s int, id int")
    prev = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = flag_repeats(df, "k", ["rank", "s", "id"], "dup", split_rows=100)
        per_part = (out.where(F2.col("k") == "").groupBy(F2.spark_partition_id().alias("p"))
                    .count().collect())
        got = {r["id"]: r["dup"] for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", prev)
    assert got == _brute(df)
    assert sum(r["count"] for r in per_part) == n // 3
    assert len(per_part) > 1 and max(r["count"] for r in per_part) < n // 3


def test_split_path_equals_default_on_test_tables(spark):
    """Real staging with every repeated id split equals the default run."""
    from parity import SF_SMALL

    from ordermart.operators.staging import stage_orders
    from ordermart.plans import catalog

    raw = catalog.testdata_inputs(spark, SF_SMALL)
    base = stage_orders(raw.orders, raw.app_orders, raw.seq)
    split = stage_orders(raw.orders, raw.app_orders, raw.seq, split_rows=1)
    a = sorted(map(tuple, base.collect()), key=str)
    b = sorted(map(tuple, split.collect()), key=str)
    assert a == b and sum(r[7] for r in a) == 1416


def test_rows_are_dealt_to_tasks_by_their_number(spark, monkeypatch):
    """No plan for hot keys where there are none, and as many tasks as the rows
    need, however few shuffle partitions are set."""
    from ordermart import session

    monkeypatch.setattr(session, "ROWS_PER_TASK", 20)
    df = _fixture(spark)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        out = flag_repeats(df, "k", ["rank", "s", "id"], "dup")
        out.explain()
    assert "REPARTITION_BY_NUM" in buf.getvalue() and "Join" not in buf.getvalue()
    assert out.rdd.getNumPartitions() >= df.count() // 20
    assert {r["id"]: r["dup"] for r in out.collect()} == _brute(df)
