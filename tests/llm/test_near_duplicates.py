"""Near-duplicate groups against brute force over all pairs."""

import random

import numpy as np

from ordermart.llm.minhash_dedup import drop_near_duplicates, near_duplicates, union_estimate


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                parent[find(i)] = find(j)
    group = {}
    for i, (doc, _) in enumerate(rows):
        group.setdefault(find(i), []).append(doc)
    return {doc: (len(sets[i]), min(group[find(i)])) for i, (doc, _) in enumerate(rows)}


def result(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


def edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"new{rng.randrange(10**6)}"
    return out


def test_equals_brute_force(docs):
    rng = random.Random(1)
    vocab = [f"w{i}" for i in range(400)]
    common = [rng.choice(vocab) for _ in range(60)]
    rows = []
    for g in range(12):
        base = [rng.choice(vocab) for _ in range(rng.choice([4, 9, 40, 200]))]
        for c in range(6):
            rows.append((len(rows), " ".join(edited(rng, base, rng.choice([0, 1, 2, 5]) if len(base) > 9 else c % 2))))
    # one large group of near copies, of which many pairs are no links
    base = [rng.choice(vocab) for _ in range(150)]
    rows += [(len(rows) + i, " ".join(edited(rng, base, rng.randrange(1, 8)))) for i in range(120)]
    # a passage in unrelated texts
    rows += [(len(rows) + i, " ".join(common + [f"u{i}-{k}" for k in range(80)])) for i in range(40)]
    rows += [(len(rows), None), (len(rows) + 1, ""), (len(rows) + 2, " \n\t"), (len(rows) + 3, "Alone"), (len(rows) + 4, "ALONE\n")]
    rng.shuffle(rows)
    assert result(near_duplicates(docs(rows, extra="digest rep band"))) == brute(rows)
    # small blocks give the same
    assert result(near_duplicates(docs(rows), block=16)) == brute(rows)


def test_defined_cases(docs):
    assert near_duplicates(docs([])).count() == 0
    text = "one two three four five six seven"
    got = near_duplicates(docs([(3, text), (3, text), (None, text), (9, None), (None, "")])).collect()
    assert sorted((r["doc_id"] or -1, r["component_id"] or -1, r["kept"]) for r in got) == [(-1, -1, True), (-1, 3, False), (3, 3, True), (3, 3, True), (9, 9, True)]
    # an id that two different texts share does not join them
    other = "entirely different words stand here in this text"
    got = near_duplicates(docs([(1, text), (1, other), (2, other)])).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in got) == [(1, 1), (1, 1), (2, 1)]


def test_one_of_each_group_stays_with_all_columns(docs):
    text = "one two three four five six seven eight"
    df = docs([(5, text), (2, text.upper()), (2, text.upper()), (7, "another short text"), (8, "")], extra="kept")
    out = drop_near_duplicates(df)
    assert out.columns == df.columns
    assert sorted(r["doc_id"] for r in out.collect()) == [2, 7, 8]


def test_null_ids_and_shared_ids_lose_no_text(docs):
    """One row of each group, whatever the ids: none, shared, or repeated."""
    text = [" ".join(f"w{g}x{k}" for k in range(60)) for g in range(8)]
    near = lambda t: t + " tail"
    rows = [(None, t) for t in text[:4]] + [(None, text[0]), (None, near(text[1]))]  # four groups without an id
    rows += [(1, text[4]), (None, near(text[4])), (1, text[5]), (2, near(text[5]))]  # id 1 over two texts
    rows += [(3, text[6]), (3, near(text[6])), (3, text[7]), (3, text[7])]
    rows += [(None, ""), (None, None), (9, ""), (9, " "), (3, "")]
    out = [(r["doc_id"], r["text"]) for r in drop_near_duplicates(docs(rows, extra="key root n")).collect()]
    groups = [(i, next(g for g, x in enumerate(text) if t.startswith(x))) for i, t in out if (t or "").strip()]
    assert sorted((i or 0, g) for i, g in groups) == [(0, 0), (0, 1), (0, 2), (0, 3), (1, 4), (1, 5), (3, 6), (3, 7)]
    assert sorted(i or 0 for i, t in out if not (t or "").strip()) == [0, 0, 3, 9]


def test_union_estimate():
    a, b = np.arange(0, 40, dtype=np.uint64), np.arange(10, 50, dtype=np.uint64)
    assert union_estimate(a[:32], b[:32], 32) == (22, 32)
