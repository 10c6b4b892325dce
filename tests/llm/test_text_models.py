"""Classifiers, language models and the codec against brute force."""

import itertools
import math
import random
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from ordermart.llm import kneser_ney, lattice_lm, sentencepiece_codec, toxicity

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


# --- toxicity -----------------------------------------------------------------

def talk(rng, n, bad=()):
    words = [f"{rng.choice('bdgkl')}{rng.choice('aeiou')}{rng.choice('mnrs')}{rng.randrange(9)}o".replace("0", "z") for _ in range(n)]
    for b in bad:
        words.insert(rng.randrange(len(words) + 1), b)
    return " ".join(words)


@pytest.fixture(scope="module")
def labelled():
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(600):
        bad = i % 4 == 0
        # an identity term stands in half of the toxic texts and few others
        group = ["muslims"] if (bad and i % 8 == 0) or i % 50 == 1 else []
        rows.append((i, talk(rng, 30, (["vilewort", "snidewort"] if bad else []) + group) + "."))
        labels.append((i, 1, int(bad)))
    return rows, labels


def test_held_out_accuracy(docs, llm, labelled):
    rows, labels = labelled
    got = toxicity.score(docs(rows + [(900, None), (901, "")], extra="toxic score"), llm.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert len(got) == len(rows) + 2
    of = {r["doc_id"]: r for r in got}
    for i, _, bad in labels:
        assert of[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert of[i]["predicted"] == bad == int(of[i]["score"] >= 0.5)
    assert of[900]["score"] == of[901]["score"] < 0.5


def test_swaps_take_weight_off_identity_terms(labelled):
    rows, labels = labelled
    feats = [toxicity._features(toxicity.words_of(t)) for _, t in rows]
    marks = np.array([b for _, _, b in labels]) > 0
    swaps = [s for _, t in rows for s in toxicity.counterfactuals(t, toxicity.IDENTITY_TERMS)]
    assert swaps
    term, others = (toxicity._features({w}) for w in ("muslims", "christians"))
    def gap(m):
        return abs(m.logit(term) - m.logit(others))
    free, held = toxicity.fit(feats, marks, swaps, penalty=0.0), toxicity.fit(feats, marks, swaps, penalty=20.0)
    assert gap(held) < 0.2 * gap(free)
    assert toxicity.counterfactuals("No such group here.", toxicity.IDENTITY_TERMS) == []


def test_border_prefers_clean_documents():
    z = np.array([-3.0, -2.0, -1.0, 1.0, 2.0])
    assert toxicity.border(z, np.array([False, False, False, True, True])) == 0.0
    # a toxic row without evidence does not pull the border among the clean ones
    assert toxicity.border(z, np.array([True, False, False, True, True])) == 0.0
    assert toxicity.border(z, np.zeros(5, bool)) > 2.0
    assert toxicity.border(np.full(4, 1.5), np.array([True, False, False, False])) > 1.5


def test_chance_features_are_not_learned(labelled):
    rows, labels = labelled
    feats = [toxicity._features(toxicity.words_of(t)) for _, t in rows]
    marks = np.array([b for _, _, b in labels]) > 0
    model = toxicity.fit(feats, marks, [])
    told = toxicity._features({"vilewort", "snidewort", "muslims"})
    assert 2 <= len(model.keys) <= len(told) + 2
    none = toxicity.fit(feats, np.random.default_rng(0).permutation(marks), [])
    assert len(none.keys) <= 2


def test_features_chosen_on_the_cluster_are_those_chosen_at_hand(docs, llm, labelled):
    rows, labels = labelled
    fold = [i for i, *_ in labels if zlib.crc32(str(i).encode()) % 5]
    text = dict(rows)
    feats = [toxicity._features(toxicity.words_of(text[i])) for i in fold]
    swaps = [x for i in fold for x in toxicity.counterfactuals(text[i], toxicity.IDENTITY_TERMS)]
    here = toxicity.fit(feats, np.array([i % 4 == 0 for i in fold]), swaps)
    there = toxicity.train(docs(rows), llm.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert list(here.keys) == list(there.keys) and np.allclose(here.weights, there.weights, atol=1e-6)


def test_descent_ends_where_the_gradient_vanishes():
    """Against the gradient of the stated loss, by finite differences."""
    rng = np.random.default_rng(3)
    n, width = 200, 6
    x = rng.random((n, width)) < 0.4
    toxic = rng.random(n) < 1 / (1 + np.exp(1 - 2.0 * x[:, 0] - 1.0 * x[:, 1]))
    row, col = np.nonzero(x)
    swaps = [(np.array([0]), np.array([2])), (np.array([1, 3]), np.array([4]))]
    rate = toxic.mean()

    def loss(w, b):
        z = b + x @ w
        weigh = np.where(toxic, 0.5 / rate, 0.5 / (1 - rate))
        pairs = sum((w[c].sum() - w[g].sum()) ** 2 for g, c in swaps) / len(swaps)
        return (weigh * (np.logaddexp(0, z) - toxic * z)).mean() + toxicity.RIDGE / 2 * (w @ w) + 3.0 * pairs

    w, b = toxicity.descend(row, col, width, toxic, swaps, 3.0, 3000)
    for k in range(width + 1):
        step = np.zeros(width + 1)
        step[k] = 1e-5
        up, down = (loss(w + s * step[:-1], b + s * step[-1]) for s in (1, -1))
        assert abs(up - down) / 2e-5 < 0.05


def test_texts_of_one_id_and_an_empty_table(docs, llm):
    labels = llm.createDataFrame([(i, 1, i % 2) for i in range(40)], "doc_id long, quality int, toxic int")
    many = [(i, "vile words here" if i % 2 else "kind words here") for i in range(40)] + [(1, "kind words here")] * 30 + [(None, "x " * 200_000)]
    got = toxicity.score(docs(many), labels).collect()
    assert len(got) == 71 and {r["predicted"] for r in got if r["doc_id"] not in (None, 1)} == {0, 1}
    assert toxicity.score(docs([]), labels).count() == 0 and toxicity.drop_toxic(docs([]), labels).count() == 0


def test_without_labels_of_both_kinds(docs, llm):
    none = llm.createDataFrame([], "doc_id long, quality int, toxic int")
    got = toxicity.score(docs([(1, "a b"), (None, None)]), none).collect()
    assert [r["predicted"] for r in got] == [0, 0]
    df = docs([(1, "a b"), (2, "c")], extra="x")
    out = toxicity.drop_toxic(df, none)
    assert out.columns == df.columns and out.count() == 2


# --- lattice language model -----------------------------------------------------

def test_lattice_is_the_sum_over_all_segmentations():
    pieces, final = lattice_lm.pieces_of(WORD_BPE)
    rng = np.random.default_rng(0)
    logp = np.stack([lattice_lm.from_counts(rng.random(len(pieces))) for _ in range(2)])
    lattice, place = lattice_lm.Lattice(pieces, final, logp), {(p, f): i for i, (p, f) in enumerate(zip(pieces, final, strict=True))}
    assert np.abs(np.exp(logp).sum(1) - 1).max() < 1e-9
    words = [b"the", b"thatre", b"unging,", "né".encode(), b"x", b"tionthed", "漢".encode()]
    z = np.array([0, 1, 0, 1, 1, 0, 1])
    for w, own, got in zip(words, z, lattice.score(words, z), strict=True):
        total = 0.0
        for cuts in itertools.product([0, 1], repeat=len(w) - 1):
            at = [0, *(i + 1 for i, c in enumerate(cuts) if c), len(w)]
            ids = [place.get((w[a:b], b == len(w))) for a, b in itertools.pairwise(at)]
            total += 0.0 if None in ids else math.exp(sum(logp[own][i] for i in ids))
        assert abs(got - math.log(total)) < 1e-9 and abs(lattice._long(w, own) - got) < 1e-9
    count = np.zeros(logp.size)
    for w, own in zip(words, z, strict=True):
        lattice._long(w, own, count)
    assert np.abs(count.reshape(logp.shape) - lattice.expected(words, z)).max() < 1e-9


def test_long_words_go_stretch_by_stretch(monkeypatch):
    pieces, final = lattice_lm.pieces_of(WORD_BPE)
    lattice = lattice_lm.Lattice(pieces, final, lattice_lm.from_counts(np.random.default_rng(1).random(len(pieces))))
    rng, zero = random.Random(9), np.zeros(1, int)
    word = bytes(rng.choice(b"abcdeinorst-") for _ in range(lattice_lm._VECTOR))
    whole, uses = lattice.score([word], zero)[0], lattice.expected([word], zero).ravel()
    monkeypatch.setattr(lattice_lm, "_STRETCH", 37)
    count = np.zeros(lattice.n)
    assert abs(lattice._long(word, 0, count) - whole) < 1e-8 and np.abs(count - uses).max() < 1e-8
    monkeypatch.undo()
    began = time.time()
    assert lattice.score([word * 5000], zero)[0] < -1e6  # two million bytes
    assert time.time() - began < 60


@pytest.mark.parametrize("hot_words", [3, 1 << 18])
def test_scores(docs, hot_words):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(["The", "of", "and", f"w{rng.randrange(60)}"]) for _ in range(rng.randrange(1, 40))), rng.choice(["en", "de", None])) for i in range(150)]
    rows += [(500, None), (501, ""), (502, "x" * 3000), (None, "the of"), (3, rows[3][1], rows[3][2])]
    got = lattice_lm.score(docs(rows, extra="word z known"), WORD_BPE, hot_words=hot_words).collect()
    assert len(got) == len(rows)
    held = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 10 == 0
    c, ends = Counter(), 0
    for i, t, *_ in rows:
        if not held(i):
            c.update((t or "").lower().split())
            ends += 1
    n, v = sum(c.values()) + ends, len(c) + 1
    flat = lambda x: math.log10((x + 0.1) / (n + 0.1 * (v + 1)))
    want = Counter()
    for i, t, *_ in rows:
        w = (t or "").lower().split()
        want[i, held(i), len(w) + 1, sum(c[x] > 0 for x in w) + 1, n, round(sum(flat(c[x]) for x in w) + flat(ends), 6)] += 1
    assert Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == want
    assert all(r["score"] < 0 for r in got)


def plain_scores(rows, hot_words, lang_bytes):
    """The final score of each row, by plain loops."""
    pieces, final = lattice_lm.pieces_of(WORD_BPE)
    place = {(p, f): i for i, (p, f) in enumerate(zip(pieces, final, strict=True))}
    longest = max(map(len, pieces))
    held = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 10 == 0
    text = [(i, (t or "").lower().encode().split(), lang) for i, t, lang in rows]
    size = Counter()
    for i, t, lang in rows:
        if not held(i):
            size[lang] += len((t or "").encode())
    langs = sorted(x for x in size if x is not None and size[x] >= lang_bytes)
    model = lambda lang: langs.index(lang) if lang in langs else len(langs)
    train, seen, ends = [Counter() for _ in range(len(langs) + 1)], Counter(), Counter()
    for i, words, lang in text:
        seen.update(words)
        if not held(i):
            train[model(lang)].update(words)
            ends[model(lang)] += 1

    def edges(w):
        return [(i, j, place[w[i:j], j == len(w)]) for j in range(1, len(w) + 1) for i in range(max(0, j - longest), j) if (w[i:j], j == len(w)) in place]

    def forward(w, p):
        a = [1.0] + [0.0] * len(w)
        for i, j, k in edges(w):
            a[j] += a[i] * p[k]
        return a

    def step(ps, words):
        out = []
        for c, p in zip(train, ps, strict=True):
            uses = np.zeros(len(pieces))
            for w in words & c.keys():
                a, es = forward(w, p), edges(w)
                back = [0.0] * len(w) + [1.0]
                for i, j, k in reversed(es):
                    back[i] += p[k] * back[j]
                for i, j, k in es:
                    uses[k] += a[i] * p[k] * back[j] / a[-1]
            out.append((uses + 0.01) / (uses + 0.01).sum())
        return out

    known = {w for c in train for w in c}
    hot = {w for w in known if seen[w] * hot_words >= sum(seen.values())}
    rank = 1 / np.arange(2, len(pieces) + 2) + 0.01
    ps = [rank / rank.sum()] * len(train)
    for words in (hot, hot, known):
        ps = step(ps, words)
    out = Counter()
    for i, words, lang in text:
        c, p, n_end = train[model(lang)], ps[model(lang)], ends[model(lang)]
        n1, n2 = (sum(x == k for x in c.values()) for k in (1, 2))
        n, d = (sum(c.values()) + n_end, n1 / (n1 + 2 * n2) if n1 and n2 else 0.5) if c else (1, 0.5)
        left, end = (d * len(c) / n, n_end / n) if c else (0.5, 0.5)
        total = math.log10(end) + sum(math.log10(max(c[w] - d, 0) / n + left * forward(w, p)[-1]) for w in words)
        out[i, round(total, 5)] += 1
    return out


@pytest.mark.parametrize("hot_words", [20, 1 << 18])
def test_score_equals_plain_loops(docs, hot_words):
    rng = random.Random(8)
    vocabulary = [*"the of and é漢 a".split(), *(f"{rng.choice(['thing', 'ration', 'un', 'qz'])}{rng.choice(['s', 'ed', '', '.'])}{k % 7}" for k in range(60))]
    rows = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(1, 40))), rng.choice(["en", "de", "xx", None])) for i in range(120)]
    rows += [(500, None, "en"), (501, "", "de"), (502, "onlyhere", "zz")]
    got = lattice_lm.score(docs(rows), WORD_BPE, hot_words=hot_words, lang_bytes=4000).collect()
    assert Counter((r["doc_id"], round(r["score"], 5)) for r in got) == plain_scores(rows, hot_words, 4000)


def test_lm_on_nothing(docs):
    assert lattice_lm.score(docs([]), WORD_BPE).count() == 0


# --- Kneser-Ney -------------------------------------------------------------------

def test_probabilities_of_a_context_sum_to_one(docs, llm):
    texts = llm.createDataFrame([("abracadabra abba",), ("the cat sat on the mat",), ("banana",)], "text string")
    model = kneser_ney.train(texts).toPandas()
    floor = float(model.lg[model.n == 0].iloc[0]) - math.log(int(((model.n == 1) & model.lp.notna()).sum()) + 1)
    scorer = kneser_ney.Scorer(model.g.tolist(), model.n.to_numpy(), model.lp.to_numpy(float), model.lg.to_numpy(float), floor, True)
    letters = sorted({c for c in "abracadabra abba the cat sat on the mat banana"})
    for before in ("ab", "the ", "zzz", "na", ""):
        whole, n = log_prob(scorer, before)
        end = math.exp(whole - inner(scorer, before))
        total = end + sum(math.exp(inner(scorer, before + c) - inner(scorer, before)) for c in [*letters, "香"])
        assert abs(total - 1) < 1e-6, (before, total)
        assert n == len(before) + 1


def log_prob(scorer, text):
    """(log probability, characters and end) of one text."""
    total, ends, rest = scorer.log_probs([text])
    assert rest == []
    return float(total[0]), int(ends[0])


def plain_kneser_ney(texts):
    """A function that gives the log probability of a text, by plain loops."""
    top = Counter(p[i : i + 4] for t in texts for p in ["\x02" * 3 + t + "\x03"] for i in range(len(p) - 3))
    counts = {4: top}
    for n in (3, 2, 1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])
    seen, left = {}, {}
    for n in (1, 2, 3, 4):
        own = {g: c for g, c in counts[n].items() if not g.endswith("\x02")}
        of = [sum(c == k for c in own.values()) for k in (1, 2, 3, 4)]
        y = of[0] / (of[0] + 2 * of[1]) if of[0] else 0.0
        d = [min(0.95 * k, max(0.05, k - (k + 1) * y * of[k] / of[k - 1])) if of[k - 1] and of[k] else 0.5 for k in (1, 2, 3)]
        total, freed, kinds = Counter(), Counter(), Counter()
        for g, c in own.items():
            total[g[:-1]] += c
            freed[g[:-1]] += d[min(c, 3) - 1]
            kinds[g[:-1]] += 1
        for x in total:
            left[x] = freed[x] / total[x]
        for g, c in own.items():
            lower = 1 / (kinds[""] + 1) if n == 1 else prob(seen, left, g[1:])
            seen[g] = (c - d[min(c, 3) - 1]) / total[g[:-1]] + left[g[:-1]] * lower
        if n == 1:
            seen[""] = left[""] / (kinds[""] + 1)

    def score(text):
        p = "\x02" * 3 + text + "\x03"
        return sum(math.log(prob(seen, left, p[i : i + 4])) for i in range(len(p) - 3)) / (len(p) - 3)

    return score


def prob(seen, left, g):
    if g in seen:
        return seen[g]
    return left.get(g[:-1], 1.0) * prob(seen, left, g[1:]) if len(g) > 1 else seen[""]


@pytest.mark.parametrize("model_ngrams", [1 << 20, 60, 1])
def test_perplexity_equals_plain_loops_however_few_ngrams_are_sent(docs, llm, model_ngrams):
    rng = random.Random(16)
    good = [(i, " ".join(rng.choice(["the", "cat", "sät", "mat", "on", "is", "red"]) for _ in range(rng.randrange(0, 30)))) for i in range(60)]
    other = [(100 + i, "".join(rng.choice("thecasmonird äqx\x02漢") for _ in range(rng.randrange(0, 90)))) for i in range(30)] + [(500, None), (501, ""), (None, good[3][1])]
    labels = llm.createDataFrame([(i, 1, 0) for i, _ in good], "doc_id long, quality int, toxic int")
    got = kneser_ney.perplexity(docs(good + other, extra="g row grams total"), labels, model_ngrams=model_ngrams).collect()
    score = plain_kneser_ney([t for _, t in good])
    assert Counter((r["doc_id"], r["n_chars"], round(r["log_perplexity"], 6)) for r in got) == Counter((i, len(t or ""), round(-score(t or ""), 6)) for i, t in good + other)


def test_perplexity_of_nothing_and_of_a_very_long_text(docs, llm):
    labels = llm.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    assert kneser_ney.perplexity(docs([]), labels).count() == 0
    got = {r["doc_id"]: r for r in kneser_ney.perplexity(docs([(1, "the cat"), (2, "the cat sat. " * 200_000)]), labels).collect()}
    assert got[2]["n_chars"] == 2_600_000 and got[2]["log_perplexity"] > 0


def inner(scorer, text):
    """Log probability of the characters without the end."""
    if not text:
        return 0.0
    with_x, _ = log_prob(scorer, text + "袈")
    end = log_prob(scorer, text + "袈")[0] - with_x
    return end + prefix(scorer, text)


def prefix(scorer, text):
    points = kneser_ney._points(text)[:-1]
    keep = kneser_ney._points
    try:
        kneser_ney._points = lambda _: points
        return log_prob(scorer, "")[0]
    finally:
        kneser_ney._points = keep


def test_junk_is_less_likely(docs, llm):
    rng = random.Random(6)
    good = [(i, " ".join(rng.choice(["the", "cat", "sat", "mat", "on", "is", "red"]) for _ in range(40))) for i in range(120)]
    junk = [(200 + i, "".join(chr(rng.randrange(33, 300)) for _ in range(200))) for i in range(10)]
    labels = llm.createDataFrame([(i, 1, 0) for i, _ in good], "doc_id long, quality int, toxic int")
    got = kneser_ney.perplexity(docs(good + junk + [(400, None), (401, "")], extra="trusted n"), labels).collect()
    kept = {r["doc_id"]: r["kept"] for r in got}
    assert len(got) == 132 and all(kept[i] for i, _ in good) and not any(kept[i] for i, _ in junk) and kept[400]
    nothing = kneser_ney.perplexity(docs(good), labels.where("false")).collect()
    assert all(r["kept"] for r in nothing)


def test_thresholds_count_all_trusted_documents(docs, llm):
    """A language has its own threshold by its trusted documents, however few of
    them are in the sample that the model is fitted on."""
    rng = random.Random(12)
    text = lambda words: " ".join(rng.choice(words) for _ in range(40))
    rows = [(i, text(["the", "cat", "sat", "mat", "on", "is", "red"]), "en") for i in range(500)]
    rows += [(600 + i, text([f"{a}{b}q{c}" for a in "xyz" for b in "uvw" for c in "jk"]), "qq") for i in range(70)]
    labels = llm.createDataFrame([(r[0], 1, 0) for r in rows], "doc_id long, quality int, toxic int")
    got = kneser_ney.perplexity(docs(rows + [(900, rows[0][1], None)]), labels, trusted_rows=100).collect()
    assert len(got) == len(rows) + 1
    limit = {r["lang"]: r["threshold"] for r in got}
    assert limit["en"] < limit["qq"] and limit["qq"] != limit[None] != limit["en"]


# --- SentencePiece ------------------------------------------------------------------

def test_streaming_viterbi_equals_the_whole_search():
    codec = sentencepiece_codec.Codec(PIECE_BPE)
    model = codec.model

    def whole(text):
        x = sentencepiece_codec.normalise(text)
        best, back = [0.0], [0]
        for j in range(1, len(x) + 1):
            top, at = best[j - 1] + model.unknown_score, j - 1
            for i in range(max(0, j - model.longest), j):
                got = model.scores.get(x[i:j])
                if got and (best[i] + got[0], -i) > (top, -at):
                    top, at = best[i] + got[0], i
            best.append(top)
            back.append(at)
        cuts = [len(x)]
        while cuts[-1]:
            cuts.append(back[cuts[-1]])
        return [k for a, b in itertools.pairwise(cuts[::-1]) for k in model.ids_of(x[a:b])]

    rng = random.Random(8)
    texts = ["", "Hello world", "a  b   c\n\nd\t", "漢字😀 né", "   ", " lead", "x" * 700, "thetioning" * 90, "".join(chr(rng.randrange(32, 500)) for _ in range(900))]
    for t in texts:
        ids = [i for word in codec.encode(t) for i in word]
        assert ids == whole(t) and codec.decode(ids) == t
    search = sentencepiece_codec.StreamingViterbi(model)
    text = "▁" + "thetioninganduber" * 900
    assert [*search.feed(text), *search.close()] == whole(text[1:])
    assert search.widest < 300  # a window, not the text


def test_no_worse_than_the_library():
    """The same vocabulary as a unigram model of the library: its search gives
    a lower total on the third text, so the best total is at least its own."""
    pb = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    import sentencepiece

    proto = pb.ModelProto()
    with open(PIECE_BPE, "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = pb.TrainerSpec.UNIGRAM
    library = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    codec = sentencepiece_codec.Codec(PIECE_BPE)
    value = lambda ids: sum(proto.pieces[i].score for i in ids)
    for t in ("The quick brown fox", "straßen und häuser", "reentering the ation thwh", "la émentelletion éen"):
        ids = [i for word in codec.encode(t) for i in word]
        assert value(ids) >= value(library.encode(t))


def test_ids_are_those_of_the_library(docs):
    """The model is a BPE model: its ids, not a search over its merge ranks."""
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
    rng = random.Random(10)
    texts = ["the house", "The quick  brown fox\n\tjumps", "straßen und häuser", "漢字😀 né", "   ", " lead", "x" * 700, "thetioning" * 90, "aaaab" * 50, "trail "]
    texts += ["".join(chr(rng.randrange(32, 500)) for _ in range(900)), " ".join("".join(rng.choices("etaoinshr", k=rng.randrange(1, 40))) for _ in range(300))]
    own = sentencepiece_codec.codec(PIECE_BPE)
    for t in texts:
        assert [i for word in own.encode(t) for i in word] == library.encode(t), t
    got = {r["doc_id"]: list(r["ids"]) for r in sentencepiece_codec.encode(docs(list(enumerate(texts))), PIECE_BPE).collect()}
    assert got == {i: library.encode(t) for i, t in enumerate(texts)}


def test_streamed_merges_have_a_bounded_window(docs):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
    model = sentencepiece_codec.Model(PIECE_BPE)
    rng = random.Random(19)
    for text in ("thetioninganduber" * 900, "".join(rng.choices("etaoinshr漢", k=20_000)), "a" * 5_000, "".join(rng.choices(["ation", "en", "der", "x", "é"], k=6_000))):
        search = sentencepiece_codec.MergeViterbi(model)
        whole = "▁" + text
        ids = []
        for lo in range(0, len(whole), 777):
            ids += search.feed(whole[lo : lo + 777])
        ids += search.close()
        assert ids == library.encode(text)
        assert search.widest < sentencepiece_codec._STRIDE + 20 * model.longest
    codec = sentencepiece_codec.codec(PIECE_BPE)
    for text in ("one two", " lead", "trail ", "two  gaps", "", "ends\n", "mixed " * 50):
        assert np.frombuffer(codec.packed(text), "<u4").tolist() == library.encode(text)
    got = {r["doc_id"]: r for r in sentencepiece_codec.round_trip(docs([(1, "a\u2581b"), (2, "a b"), (3, None)]), PIECE_BPE).collect()}
    assert [got[k]["round_trip"] for k in (1, 2, 3)] == [False, True, True]
    assert got[1]["ids_crc32"] == got[2]["ids_crc32"]
    assert sentencepiece_codec.round_trip(docs([]), PIECE_BPE).count() == 0


def test_only_pieces_that_a_word_ends_with_are_tried():
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
    search = sentencepiece_codec.MergeViterbi(sentencepiece_codec.Model(PIECE_BPE))
    rng = random.Random(23)
    words = ["▁" + "".join(rng.choices("etaoinshrdé漢", k=rng.randrange(1, 40))) for _ in range(400)]
    asked = []

    class Known(dict):
        def get(self, pair, none=None):
            asked.append(pair)
            return super().get(pair, none)

    search.apart = Known()
    for w in words:
        pieces = search.short(w)
        assert "".join(pieces) == w
        assert [i for p in pieces for i in search.model.ids_of(p)] == library.encode(w[1:])
    scores = search.model.scores
    assert all(piece in scores or len(piece) == 1 for _, piece in asked)
    # no look at each of up to 16 texts before each character
    assert len(asked) < 3 * sum(map(len, words))
    longest, shorter = sentencepiece_codec.endings(["a", "ab", "b", "xab", "abc"])
    assert longest == {"": "", "a": "a", "ab": "ab", "b": "b", "x": "", "xa": "a", "xab": "xab", "abc": "abc"}
    assert shorter == {"ab": "b", "xab": "ab", "abc": "c"}


def test_codec_frames(docs):
    rows = [(1, "one two"), (2, None), (None, "trois ñ"), (1, "one two")]
    ids = sentencepiece_codec.encode(docs(rows, extra="ids"), PIECE_BPE)
    back = sentencepiece_codec.decode(ids, PIECE_BPE).collect()
    assert Counter((r["doc_id"], r["text"]) for r in back) == Counter((i, t or "") for i, t in rows)
    assert all(r["round_trip"] for r in sentencepiece_codec.round_trip(docs(rows), PIECE_BPE).collect())
    assert sentencepiece_codec.encode(docs([]), PIECE_BPE).count() == 0


def test_the_quality_model_counts_every_trusted_text(docs, llm, monkeypatch):
    """No bound on the rows that the query's model is fitted on."""
    import inspect

    assert inspect.signature(kneser_ney.perplexity).parameters["trusted_rows"].default is None
    seen = []
    train = kneser_ney.train
    monkeypatch.setattr(kneser_ney, "train", lambda texts: (seen.append(texts.count()), train(texts))[1])
    rows = [(i, f"text {i}") for i in range(70)]
    labels = llm.createDataFrame([(i, int(i < 60), 0) for i, _ in rows], "doc_id long, quality int, toxic int")
    assert kneser_ney.perplexity(docs(rows), labels).count() == 70 and seen == [60]
