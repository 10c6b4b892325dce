"""The corpus pipeline, stage by stage, against plain Python on what each got."""

import os
import random
import re
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
import corpus_pipeline  # noqa: E402

from ordermart.llm import minhash_dedup, packing, quality_rules, toxicity  # noqa: E402


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents with copies, near copies, toxic and repetitive texts, a null id
    and a null text; labels for most of them."""
    rng = random.Random(31)
    words = [f"{a}{b}{c}" for a in "ba ko mi tu re".split() for b in "la ne si do fu".split() for c in "n r s".split()]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    texts = [prose(rng.randrange(40, 120)) + "." for _ in range(240)]
    toxic = set(range(0, 240, 6))
    for i in toxic:
        at = rng.randrange(len(texts[i]) // 2)
        texts[i] = f"{texts[i][:at]} vilewort snidewort {texts[i][at:]}"
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(300 + k, texts[k]) for k in (1, 2, 3)] + [(310, texts[5].replace(texts[5].split()[20], "changed", 1)), (400, "same words here " * 60), (401, "few words"), (402, None), (None, prose(60) + ".")]
    folder = str(tmp_path_factory.mktemp("sf"))
    full = [(i, t, "en", "s", len(t or ""), 7) for i, t in rows]
    spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, extra int").write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, int(i in toxic)) for i in range(240) if i % 9]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, dict(rows), toxic


def shingles(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)})) if w]
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_stages_keep_what_their_operators_say(llm, folder):
    path, text, toxic = folder
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "toxicity", "minhash_dedup", "packing"]
    docs = llm.read.parquet(f"{path}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:3]:
        out = stage(llm, docs, path)
        assert out.columns == columns
        before, after = ({(r["doc_id"], r["text"]) for r in x.collect()} for x in (docs, out))
        assert after < before
        if name == "quality_rules":
            assert before - after >= {(400, text[400]), (401, text[401]), (402, None)} and len(before - after) < 12
            kept = {r["doc_id"] for r in quality_rules.divergence(docs).where("kept").collect()}
            assert {i for i, _ in after} == kept
        elif name == "toxicity":
            gone = {i for i, _ in before - after}
            assert gone == {i for i, _ in before if i in toxic}
            marked = {r["doc_id"] for r in toxicity.score(docs, llm.read.parquet(f"{path}/labels.parquet")).where("predicted = 1").collect()}
            assert gone == marked
        else:
            sets = {i: shingles(t) for i, t in before}
            alike = lambda a, b: 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
            kept = [i for i, _ in after]
            assert not any(alike(a, b) for a in kept for b in kept if a is not b)
            assert all(any(alike(i, k) for k in kept) for i, _ in before - after)
            assert {i for i, _ in before - after} == {r["doc_id"] for r in minhash_dedup.near_duplicates(docs).where("not kept").collect()}
        written = f"{path}/{name}.parquet"
        out.write.parquet(written)
        docs = llm.read.parquet(written)
    pieces = corpus_pipeline.STAGES[3][1](llm, docs, path).collect()
    whole = packing.pack(docs, corpus_pipeline.WORD_BPE).collect()
    total = lambda rows: sorted((str(r["doc_id"]), r["doc_tokens"]) for r in rows if r["start"] == 0)
    assert total(pieces) == total(whole) and sorted(str(i) for i, _ in after) == [i for i, _ in total(pieces)]
    assert sum(r["length"] for r in pieces) == sum(n for _, n in total(pieces))


def test_run_goes_through_all_stages(llm, folder):
    path, text, toxic = folder
    ids = {r["doc_id"] for r in corpus_pipeline.run(llm, path).collect()}
    assert not ids & (toxic | {300, 301, 302, 303, 310, 400, 401, 402}) and None in ids and len(ids) > 180
    assert corpus_pipeline.ORACLE_SQL is None
