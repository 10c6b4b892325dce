"""Helpers that the corpus operators share."""

import glob
import random

from ordermart.llm import common, kneser_ney
from ordermart.llm.common import likely_in
from ordermart.llm.minhash_dedup import near_duplicates


def test_rows_of_wanted_ids_stay_and_few_others(llm):
    rows = llm.createDataFrame([(i if i % 7 else None, f"text {i}") for i in range(2000)] + [(5, "again"), (-3, "below 0")], "id long, text string")
    ids = llm.createDataFrame([(i,) for i in (5, 5, 8, -3, 1999, 5000, None)], "id long")
    few = likely_in(rows, "id", ids, "id")
    assert few.columns == rows.columns
    wanted = rows.join(ids, "id", "left_semi").collect()
    assert sorted(wanted) == sorted(few.collect()) and len(wanted) == 5
    # with few cells others stay, and none that is wanted goes
    coarse = likely_in(rows, "id", ids, "id", bits=7).collect()
    assert set(wanted) <= set(coarse) and len(coarse) < 300
    assert likely_in(rows, "id", ids.where("id < -9"), "id").count() == 0


def _moved(run):
    """Rows that the joins of texts move, as the plan counts them."""
    seen = []

    def spy(rows, key, ids, id_col, **kw):
        out = likely_in(rows, key, ids, id_col, **kw)
        seen.append((rows.count(), out.count()))
        return out

    run(spy)
    return seen


def test_the_quality_model_moves_trusted_texts_only(docs, llm, monkeypatch):
    rows = [(i, f"some plain text number {i}") for i in range(400)]
    labels = llm.createDataFrame([(i, int(i % 10 == 0)) for i in range(400)], "doc_id long, quality int")

    def run(spy):
        monkeypatch.setattr(kneser_ney, "likely_in", spy)
        assert kneser_ney.perplexity(docs(rows), labels).count() == 400

    assert _moved(run) == [(400, 40)]


def test_the_plan_of_the_trusted_join_is_one_at_every_size(llm):
    base = llm.createDataFrame([(1, "a", "en"), (2, "b", "en"), (2, "c", "de"), (None, "d", "en")], "id long, text string, lang string")
    marked = llm.createDataFrame([(2, True), (9, True)], "id long, trusted boolean")
    trusted = kneser_ney._trusted(base, marked)
    assert sorted(r["text"] for r in trusted.collect()) == ["b", "c"]
    assert trusted.columns == base.columns
    plan = trusted._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    # texts are moved for the outer join, after the inner one has left most of them out
    assert plan.index("SortMergeJoin") < plan.index("BroadcastHashJoin")


def test_near_duplicates_move_texts_of_candidates_only(docs, monkeypatch):
    from ordermart.llm import minhash_dedup

    words = [" ".join(f"w{i}-{k}" for k in range(40)) for i in range(200)]
    rows = list(enumerate(words)) + [(500 + i, words[i] + " and more") for i in range(10)]

    def run(spy):
        monkeypatch.setattr(minhash_dedup, "likely_in", spy)
        found = {r["doc_id"]: r["component_id"] for r in near_duplicates(docs(rows)).collect()}
        assert all(found[500 + i] == i for i in range(10)) and len(set(found.values())) == 200

    assert max(after for _, after in _moved(run)) <= 20


def test_tables_of_few_rows_have_few_files(llm, docs, monkeypatch):
    rng = random.Random(31)
    texts = [" ".join(rng.choices(["oak", "elm", "fir", "ash", "yew", "box"], k=40)) for _ in range(300)]
    texts += [t + " more" for t in texts[:150]] + texts[:50]
    folders = []
    new = common.new_run_dir
    monkeypatch.setattr(common, "new_run_dir", lambda spark, label: folders.append(new(spark, label)) or folders[-1])
    monkeypatch.setattr(common, "TASKS_PER_CORE", 1)
    set_to = {"spark.sql.shuffle.partitions": "61", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: llm.conf.get(k) for k in set_to}
    for k, v in set_to.items():
        llm.conf.set(k, v)
    try:
        got = {r["doc_id"]: r["component_id"] for r in near_duplicates(docs(list(enumerate(texts)))).collect()}
    finally:
        for k, v in before.items():
            llm.conf.set(k, v)
    assert all(got[300 + i] == got[i] for i in range(150)) and all(got[450 + i] == got[i] for i in range(50))
    files = {f.rsplit("/", 1)[1]: len(glob.glob(f"{f.removeprefix('file:')}/part-*")) for f in folders}
    assert len(files) > 10
    assert max(files.values()) <= llm.sparkContext.defaultParallelism, files
