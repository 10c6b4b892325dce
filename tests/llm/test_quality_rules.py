"""Quality rules against counts by plain Python."""

import random
import re
from collections import Counter

from ordermart.llm.quality_rules import divergence, keep_good


def base(text):
    text = text or ""
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", text) if x]
    seen = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {i + k for i in range(len(w) - 7) if seen[tuple(w[i : i + 8])] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def prose(rng, n):
    common = ["the", "of", "and", "to", "in", "is", "it"]
    return " ".join(rng.choice(common) if rng.random() < 0.5 else f"{rng.choice('bcdfg')}{rng.choice('aeiou')}n{rng.randrange(50)}e" for _ in range(n))


def test_counts_and_verdicts(docs):
    rng = random.Random(3)
    rows = [(i, prose(rng, rng.choice([5, 19, 20, 60, 300]))) for i in range(60)]
    line = prose(rng, 12)
    odd = [
        None, "", " ", "\n\n", "a", "\t\x0b\x0cx\r\ny ", (line + "\n") * 9, "x " * 500, "a b c d e f g h " * 3 + prose(rng, 80),
        prose(rng, 8) + "\nq\n \nq\nq#*|\n", "é ü ñ 漢字 😀 " * 30, " word two " * 20, " ".join(str(i) for i in range(7)),
        "one two three four five six seven eight one two three four five six seven eight one", "A" * 100_000, prose(rng, 30_000),
    ]
    rows += [(100 + i, t) for i, t in enumerate(odd)]
    rows += [(200, "SHOUT!! " + " ".join(f"{rng.choice('BCD')}{rng.randrange(10**5)}###" for _ in range(200)))]
    rows += [(7, dict(rows)[7])]  # a repeated row
    got = divergence(docs(rows, extra="hist ref upper")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r[c] for c in COLUMNS) == base(dict(rows)[r["doc_id"]]), r["doc_id"]
        assert not (r["kept"] and r["base_failed"])
        assert r["n_words"] >= 50 or r["word_js"] is None
    kept = {r["doc_id"]: r["kept"] for r in got}
    assert not kept[200]
    assert all(kept[i] for i, t in rows[:60] if len(t.split()) >= 20)


def tongue(rng, name, n):
    """Clean text of a made-up language with function words of its own."""
    common = [f"{name}{v}" for v in ("a", "e", "i", "on", "ur", "ost", "el")]
    return " ".join(rng.choice(common) if rng.random() < 0.5 else f"{rng.choice('bcdfg')}{rng.choice('aeiou')}n{rng.randrange(50)}e" for _ in range(n))


def test_clean_text_of_rare_and_unknown_languages_is_kept(docs):
    rng = random.Random(9)
    rows = [(i, prose(rng, 300), "en") for i in range(2600)]
    rows += [(3000 + i, tongue(rng, "q", 300), "qq") for i in range(12)]  # under 1 / 200, with a reference
    rows += [(4000, tongue(rng, "z", 300), "zz"), (4001, tongue(rng, "v", 300), None)]  # without
    rows += [(5000, " ".join(f"{k}##" for k in range(300)), "qq"), (5001, "word two " * 60, "zz"), (5002, "word two " * 60, None)]
    got = divergence(docs(rows)).collect()
    assert sorted(r["doc_id"] for r in got if not r["kept"]) == [5000, 5001, 5002]
    assert all((r["word_js"] is None) == (r["doc_id"] in (4001, 5002)) for r in got)


def test_distance_by_hand(docs):
    """Two texts of equal length: the reference is the mean of both."""
    a, b = "ab " * 200, "AB " * 200
    rows = {r["doc_id"]: r for r in divergence(docs([(1, a), (2, b)]), min_words=1, min_chars=1).collect()}
    # letters: 2/3 lower against a reference of 1/3 lower and 1/3 upper
    import math

    def term(p, q):
        half = lambda x: x * math.log2(2 * x / (p + q)) / 2 if x else 0.0
        return half(p) + half(q)

    want = math.sqrt(term(2 / 3, 1 / 3) + term(0, 1 / 3))
    assert abs(rows[1]["char_js"] - want) < 1e-9 and abs(rows[2]["char_js"] - want) < 1e-9


def test_word_distance_by_hand(docs):
    """The two commonest words and the rest: 1/2, 1/4, 1/4 and 1/4, 1/2, 1/4
    against their mean 3/8, 3/8, 1/4."""
    import math

    rows = divergence(docs([(1, "a a b c " * 50), (2, "a b b d " * 50)]), common=2, min_words=1, min_chars=1).collect()
    half = lambda x, m: x * math.log2(x / m) / 2
    want = math.sqrt(sum(half(p, (p + q) / 2) + half(q, (p + q) / 2) for p, q in ((1 / 2, 3 / 8), (1 / 4, 3 / 8), (1 / 4, 1 / 4))))
    assert all(abs(r["word_js"] - want) < 1e-9 for r in rows) and len(rows) == 2


def test_empty_table_and_columns(docs):
    df = docs([], extra="hist")
    assert divergence(df).count() == 0 and keep_good(df).columns == df.columns
    rng = random.Random(5)
    df = docs([(1, prose(rng, 100)), (1, "bad"), (None, prose(rng, 90)), (2, None)], extra="__n kept")
    out = keep_good(df)
    assert out.columns == df.columns
    assert sorted((r["doc_id"] or -1) for r in out.collect()) == [-1, 1]


def test_no_python_in_the_plan(docs):
    plan = divergence(docs([(1, "a b c")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
