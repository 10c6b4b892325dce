"""The id store: buckets read, generations, replays."""
import contextlib
import io

from ordermart.operators.id_index import IdStore, bucket_of


def _ids(spark, names):
    return spark.createDataFrame([(n,) for n in names], "order_id string")


def _found(store, wanted, batch):
    return sorted(r["order_id"] for r in store.lookup(wanted, batch).join(wanted, "order_id", "left_semi").collect())


def test_a_batch_reads_only_its_buckets(spark, tmp_path):
    store = IdStore(spark, str(tmp_path / "ids"), buckets=32)
    store.start(_ids(spark, [f"F{i}" for i in range(2000)]))
    store.append(0, _ids(spark, ["A1", "A2"]))
    wanted = _ids(spark, ["F7", "A2", "new"])
    mine = {r[0] for r in wanted.select(bucket_of(wanted["order_id"], 32)).collect()}
    found = store.lookup(wanted, 1)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        found.explain()
    assert "PartitionFilters: [id_bucket" in buf.getvalue() and len(mine) <= 3
    held = {r[0] for r in found.select(bucket_of(found["order_id"], 32)).distinct().collect()}
    assert held <= mine and found.count() < 400
    assert _found(store, wanted, 1) == ["A2", "F7"]
    assert _found(store, wanted, 0) == ["F7"]  # batch 0 does not see its own ids
    assert store.lookup(_ids(spark, []), 1).count() == 0


def test_generations_and_replays(spark, tmp_path):
    store = IdStore(spark, str(tmp_path / "ids"), buckets=4)
    assert store.lookup(_ids(spark, ["x"]), 5).count() == 0  # nothing there yet
    for n in range(6):
        store.append(n, _ids(spark, [f"B{n}", None]))
    wanted = _ids(spark, [f"B{n}" for n in range(9)])
    before = {n: _found(store, wanted, n) for n in range(8)}
    assert before[3] == ["B0", "B1", "B2"]
    store.compact(4, every=3)
    assert store.generation(3) is None and store.generation(4) == 4 and len(store.before(6)) == 3
    assert {n: _found(store, wanted, n) for n in range(8)} == before  # batches that run again see the same
    store.append(2, _ids(spark, ["B2"]))
    assert {n: _found(store, wanted, n) for n in range(8)} == before
    other = IdStore(spark, str(tmp_path / "ids"), buckets=16)  # another number of buckets later on
    other.append(6, _ids(spark, ["B6"]))
    assert _found(other, wanted, 7) == [f"B{n}" for n in range(7)]


def test_streaming_log_is_compacted_and_exact(spark, tmp_path):
    from ordermart.streaming.registration import make_batch_writer, read_outputs
    from test_streaming import BATCH_A, BATCH_B, _cands, _dims

    c, p = _dims(spark)
    existing = _ids(spark, ["E1"])
    out = str(tmp_path / "out")
    write = make_batch_writer(out, lambda: (c, p), lambda: lambda wanted: existing, compact_every=1)
    for n, batch in enumerate((BATCH_A, BATCH_B, BATCH_A, BATCH_B)):
        write(_cands(spark, batch), n)
    assert IdStore(spark, f"{out}/ids").generation(3) == 2
    assert sorted(r["order_id"] for r in read_outputs(spark, out)[0].collect()) == ["N1", "N2"]


def test_ids_that_nobody_wants_are_left_out_before_they_are_moved(spark, tmp_path):
    store = IdStore(spark, str(tmp_path / "ids"), buckets=4)
    store.start(_ids(spark, [*(f"F{i}" for i in range(5000)), None]))
    wanted = _ids(spark, [*(f"F{i}" for i in range(0, 5000, 50)), "F0", "new", None])
    found = [r["order_id"] for r in store.lookup(wanted, 0).collect()]
    assert {f"F{i}" for i in range(0, 5000, 50)} <= set(found) and len(found) == len(set(found)) <= 110


def _broadcast_rows(df):
    """Rows of each broadcast of the plan that ``df`` ran by."""
    df.collect()
    nodes, rows = [df._jdf.queryExecution().executedPlan().executedPlan()], []
    while nodes:
        node = nodes.pop()
        if node.nodeName().endswith("QueryStage"):
            nodes.append(node.plan())
        elif node.nodeName() == "BroadcastExchange":
            rows.append(node.metrics().apply("numOutputRows").value())
        nodes += [node.children().apply(i) for i in range(node.children().size())]
    return rows


def test_many_wanted_ids_are_broadcast_in_few_rows(spark, tmp_path):
    from pyspark.sql import functions as F

    store = IdStore(spark, str(tmp_path / "ids"), buckets=2)
    name = F.concat(F.lit("F"), F.col("id").cast("string")).alias("order_id")
    store.start(spark.range(150_000).select(name))
    wanted = spark.range(100_000, 200_000).select(name)
    found = store.lookup(wanted)
    assert found.join(wanted, "order_id", "left_semi").count() == 50_000
    assert found.distinct().count() < 50_600
    [rows] = _broadcast_rows(found)
    assert 0 < rows <= 1 << 14
