"""Streaming registration: equals the batch rules across micro-batches and
replaying a micro-batch does not register anything twice."""
import datetime as dt

from ordermart.operators import orders
from ordermart.streaming.registration import (LANDING_SCHEMA, TS_FORMAT, make_batch_writer, read_outputs,
                                              start_registration)


def _dims(spark):
    c = spark.createDataFrame([("C1",), ("C2",)], "customer_id string")
    p = spark.createDataFrame([("S1", 2.0), ("S2", None)], "sku string, cost double")
    return c, p


def _cands(spark, rows):
    data = [(o, c, s, q, pr, d, ch, dt.datetime(2024, 1, 1, 0, 0, 0, 123456) + dt.timedelta(minutes=n), n)
            for n, (o, c, s, q, pr, d, ch) in rows]
    return spark.createDataFrame(data, LANDING_SCHEMA)


BATCH_A = [(1, ("N1", "C1", "S1", "1", "5", "2024-01-05", "retail")),
           (2, ("N2", "C1", "S1", "x", "5", "2024-01-05", "retail")),
           (3, ("N1", "C2", "S2", "2", "5", "2024-01-05", "retail")),
           (4, ("E1", "C2", "S2", "2", "5", "2024-01-05", "retail"))]
BATCH_B = [(5, ("N2", "C1", "S1", "3", "5", "2024-01-06", "export")),
           (6, ("N1", "C1", "S1", "4", "5", "2024-01-06", "export")),
           (7, ("N3", "C9", "S1", "4", "5", "2024-01-06", "export"))]


def test_two_micro_batches_equal_batch(spark, tmp_path):
    c, p = _dims(spark)
    existing = spark.createDataFrame([("E1",)], "order_id string")
    land, out, ck = str(tmp_path / "landing"), str(tmp_path / "out"), str(tmp_path / "ck")
    for i, batch in enumerate((BATCH_A, BATCH_B)):
        _cands(spark, batch).coalesce(1).write.option("timestampNTZFormat", TS_FORMAT).json(f"{land}/part{i}")
    # one file per trigger, files processed in landing order
    q = start_registration(spark, f"{land}/*", out, ck, lambda: (c, p), lambda: existing, max_files_per_trigger=1)
    q.awaitTermination(300)
    assert q.exception() is None
    acc, rej = read_outputs(spark, out)
    b_acc, b_rej = orders.register_orders(_cands(spark, BATCH_A + BATCH_B), c, p, existing)
    assert sorted(map(tuple, acc.collect())) == sorted(map(tuple, b_acc.collect()))
    assert sorted(map(tuple, rej.collect())) == sorted(map(tuple, b_rej.collect()))
    assert sorted(r["order_id"] for r in acc.collect()) == ["N1", "N2"]


def test_replayed_batch_is_idempotent(spark, tmp_path):
    c, p = _dims(spark)
    existing = spark.createDataFrame([("E1",)], "order_id string")
    out = str(tmp_path / "out")
    write = make_batch_writer(out, lambda: (c, p), lambda: existing)
    write(_cands(spark, BATCH_A), 0)
    write(_cands(spark, BATCH_B), 1)
    first = sorted(map(tuple, read_outputs(spark, out)[0].collect()))
    write(_cands(spark, BATCH_B), 1)  # replay after a failure before the commit
    write(_cands(spark, BATCH_A), 0)
    again = sorted(map(tuple, read_outputs(spark, out)[0].collect()))
    assert first == again and len(first) == 2


def test_processing_time_trigger_picks_up_new_files(spark, tmp_path):
    import time

    c, p = _dims(spark)
    existing = spark.createDataFrame([("E1",)], "order_id string")
    land, out, ck = str(tmp_path / "landing"), str(tmp_path / "out"), str(tmp_path / "ck")
    _cands(spark, BATCH_A).coalesce(1).write.option("timestampNTZFormat", TS_FORMAT).json(f"{land}/a")
    q = start_registration(spark, f"{land}/*", out, ck, lambda: (c, p), lambda: existing,
                           available_now=False, processing_time="1 second")
    try:
        q.processAllAvailable()
        _cands(spark, BATCH_B).coalesce(1).write.option("timestampNTZFormat", TS_FORMAT).json(f"{land}/b")
        deadline = time.time() + 120
        while time.time() < deadline:
            q.processAllAvailable()
            if read_outputs(spark, out)[1].count() == 5:
                break
            time.sleep(1)
    finally:
        q.stop()
    acc, rej = read_outputs(spark, out)
    assert sorted(r["order_id"] for r in acc.collect()) == ["N1", "N2"]
    assert rej.count() == 5
