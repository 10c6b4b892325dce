"""Toxicity by a counterfactual-regularised linear classifier.

Features are the distinct words of a text and the prefixes of its words
(hashed), so inflected forms share evidence.  The model is a logistic
regression fitted on a bounded sample of labelled rows.  For every sentence of
the sample that holds an identity term, each swap by another term of its group
gives a pair that should score alike; the squared change of the logit is
added to the loss, so neutral mentions of a group carry no weight.

Words are scored where they stand: a worker keeps the model's weight table,
sums over the distinct features of the whole text, and never sees labels,
language, source or id.

The sample stays in the shared folder: its features are counted and chosen on
the cluster, and the driver gets the chosen ones alone.

Defined cases: null, empty and wordless texts get the score of the bias alone;
repeated rows get equal scores; of an id with several texts, the least by MD5 is
fitted; ids that carry several labels count once for each label row; without
labelled rows of both kinds the score is the base rate (0 when nothing is
labelled); very long texts are scored whole, by their distinct words; an empty
table gives no rows; ``score`` returns its own columns only, ``drop_toxic`` all
columns of the documents (a column ``__score`` must not be among them).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textops as T
from .common import crc_mod, cut

#: Labelled rows fitted at most: those of smallest hash of the id.
SAMPLE_ROWS = 20_000
#: Features kept at most, and their least rows.  Chance puts a feature's labels
#: this far from the base rate with p <= exp(-df * KL(share || rate)) (Chernoff);
#: those are kept of which at most FALSE_SHARE are due to chance (Benjamini and
#: Hochberg's step-up rule over all features).
FEATURES = 50_000
MIN_ROWS = 4
FALSE_SHARE = 0.1
#: How much more a clean document marked weighs than a toxic one missed, as
#: shares of their kind, when the border is set.
CLEAN_WEIGHT = 10.0
PREFIX = 5
COUNTERFACTUAL = 5.0
RIDGE = 2e-4

#: Groups of identity terms that may stand for one another.
IDENTITY_TERMS = [
    ["women", "men", "girls", "boys", "people"],
    ["woman", "man", "girl", "boy", "person"],
    ["muslims", "christians", "jews", "hindus", "buddhists", "atheists"],
    ["muslim", "christian", "jewish", "hindu", "buddhist", "atheist"],
    ["gay", "lesbian", "straight", "bisexual", "transgender", "queer"],
    ["black", "white", "asian", "hispanic", "african", "european"],
    ["immigrants", "refugees", "foreigners", "natives", "citizens"],
    ["disabled", "blind", "deaf", "old", "young"],
    ["frauen", "männer", "mädchen", "jungen"],
    ["muslime", "christen", "juden", "hindus"],
    ["femmes", "hommes", "filles", "garçons"],
    ["musulmans", "chrétiens", "juifs", "hindous"],
    ["mujeres", "hombres", "niñas", "niños"],
    ["musulmanes", "cristianos", "judíos", "hindúes"],
]

_WORD = re.compile(r"[^\W\d_]+")
_SENTENCE = re.compile(r"[.!?\n]+")


def _features(words: set[str]) -> np.ndarray:
    """Sorted distinct feature hashes of some words."""
    tokens = sorted(words | {f"{w[:PREFIX]}*" for w in words if len(w) > PREFIX})
    if not tokens:
        return np.zeros(0, np.uint64)
    col = pa.array([t.encode() for t in tokens], pa.binary())
    data, offsets = T.as_bytes(col)
    return np.unique(T.hashes(data, offsets[:-1], offsets[1:], fold=False))


def words_of(text: str | None) -> set[str]:
    return set(_WORD.findall((text or "").lower()))


def counterfactuals(text: str | None, groups: list[list[str]]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(removed, added) features for each swap in a sentence of ``text``."""
    other = {t: [x for x in g if x != t] for g in groups for t in g}
    out = []
    if not words_of(text) & other.keys():
        return out
    for sentence in _SENTENCE.split((text or "").lower()):
        own = set(_WORD.findall(sentence))
        for term in sorted(own & other.keys()):
            for swap in other[term]:
                if swap not in own:
                    a, b = _features(own), _features(own - {term} | {swap})
                    out.append((np.setdiff1d(a, b), np.setdiff1d(b, a)))
    return out


@dataclass
class Model:
    keys: np.ndarray  # sorted feature hashes
    weights: np.ndarray
    bias: float

    def logit(self, features: np.ndarray) -> float:
        if not len(self.keys) or not len(features):
            return self.bias
        at = np.minimum(np.searchsorted(self.keys, features), len(self.keys) - 1)
        return self.bias + float(self.weights[at][self.keys[at] == features].sum())


def gains(df: np.ndarray, a: np.ndarray, rate: float) -> np.ndarray:
    """How far the labels of features (``a`` toxic of ``df`` rows) lie from the
    base rate: df * KL(share || rate), 0 for too few rows."""
    part = lambda x, share: x * np.log(np.maximum(x, 1e-300) / np.maximum(df * share, 1e-300))
    return np.where(df < MIN_ROWS, 0.0, part(a, rate) + part(df - a, 1 - rate))


def least_gain(ranked: np.ndarray, of: int) -> float:
    """The step-up rule: the least gain kept, given the largest of the gains of
    ``of`` features in falling order."""
    enough = np.flatnonzero(ranked >= np.log(of / (FALSE_SHARE * np.arange(1, len(ranked) + 1))))
    return float(ranked[enough[-1]]) if len(enough) else np.inf


def descend(row: np.ndarray, col: np.ndarray, width: int, toxic: np.ndarray, swaps: list[tuple[np.ndarray, np.ndarray]], penalty: float, steps: int) -> tuple[np.ndarray, float]:
    """(weights, bias) of the logistic regression with a ridge and the
    counterfactual penalty; entries (row, col) are the features of the rows,
    ``swaps`` the columns that a swap takes out and brings in."""
    n, rate = len(toxic), float(toxic.mean())
    # the pairs as signed entries: added minus removed
    pair = np.concatenate([np.repeat(np.arange(len(swaps)), [len(x[side]) for x in swaps]) for side in (0, 1)]) if swaps else np.zeros(0, int)
    pcol = np.concatenate([x[side] for side in (0, 1) for x in swaps]).astype(int) if swaps else np.zeros(0, int)
    sign = np.repeat([-1.0, 1.0], [sum(len(x[side]) for x in swaps) for side in (0, 1)])
    # both labels weigh alike: the rare one is not drawn to the base rate
    weigh = np.where(toxic, 0.5 / rate, 0.5 / (1 - rate))
    w, b = np.zeros(width), 0.0
    m, v = np.zeros(width + 1), np.zeros(width + 1)
    for step in range(1, steps + 1):  # Adam on the full sample
        z = b + np.bincount(row, w[col], n)
        miss = weigh * (1 / (1 + np.exp(-np.clip(z, -40, 40))) - toxic)
        g = np.bincount(col, miss[row], width) / n + RIDGE * w
        if swaps:
            change = np.bincount(pair, sign * w[pcol], len(swaps))
            g += 2 * penalty / len(swaps) * np.bincount(pcol, sign * change[pair], width)
        g = np.append(g, miss.mean())
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        move = 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return w, float(b)


def one_label(rate: float) -> Model:
    """The model where all rows have one label, or there are none."""
    return Model(np.zeros(0, np.uint64), np.zeros(0), 40.0 if rate else -40.0)


def fit(rows: list[np.ndarray], toxic: np.ndarray, swaps: list[tuple[np.ndarray, np.ndarray]], penalty: float = COUNTERFACTUAL, steps: int = 400) -> Model:
    """The model of rows at hand: what ``train`` does over a table."""
    rate = float(toxic.mean()) if len(toxic) else 0.0
    if not 0 < rate < 1:
        return one_label(rate)
    who = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    keys, where = np.unique(np.concatenate(rows), return_inverse=True)
    df = np.bincount(where, minlength=len(keys)).astype(float)
    gain = gains(df, np.bincount(where, toxic[who], len(keys)), rate)
    gain[gain < least_gain(np.sort(gain[df >= MIN_ROWS])[::-1], int((df >= MIN_ROWS).sum()))] = 0
    gain[np.isin(keys, np.concatenate([x for s in swaps for x in s] or [keys[:0]]))] = np.inf
    chosen = np.sort(np.argsort(-gain, kind="stable")[:FEATURES])
    chosen = chosen[gain[chosen] > 0]
    new = np.full(len(keys), -1)
    new[chosen] = np.arange(len(chosen))
    col, held = new[where], keys[chosen]
    weights, bias = descend(who[col >= 0], col[col >= 0], len(held), toxic, [(_columns(held, a), _columns(held, b)) for a, b in swaps], penalty, steps)
    return Model(held, weights, bias)


def _columns(keys: np.ndarray, features: np.ndarray) -> np.ndarray:
    """Places of the ``features`` that are among the sorted ``keys``."""
    if not len(keys):
        return np.zeros(0, np.int32)
    at = np.minimum(np.searchsorted(keys, features), len(keys) - 1)
    return at[keys[at] == features].astype(np.int32)


def border(z: np.ndarray, toxic: np.ndarray, clean_weight: float = CLEAN_WEIGHT) -> float:
    """The logit that parts unseen toxic from clean rows at least cost (share
    of toxic rows below it, plus ``clean_weight`` times the share of clean ones
    above), in the middle of the widest such gap."""
    order = np.argsort(z, kind="stable")
    z, bad = z[order], toxic[order]
    edges = np.concatenate([[z[0] - 2.0], z, [z[-1] + 2.0]])
    missed = np.concatenate([[0], np.cumsum(bad)]) / max(1, bad.sum())
    marked = 1 - np.concatenate([[0], np.cumsum(~bad)]) / max(1, (~bad).sum())
    width = np.diff(edges)
    cost = np.where(width > 1e-9, missed + clean_weight * marked, np.inf)
    best = np.flatnonzero(cost <= cost.min() + 1e-12)
    at = best[np.argmax(width[best])]
    return float((edges[at] + edges[at + 1]) / 2)


def _sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, held_out_mod: int, sample_rows: int, groups: list[list[str]]) -> DataFrame:
    """The features of the labelled rows that are fitted, written once: (id,
    toxic, border, features, gone, came).  ``border``: a fifth, for the border."""
    marked = labels.select(F.col(id_col).alias("id"), F.col("toxic").cast("double").alias("toxic")).where("toxic is not null and id is not null")
    chosen = marked.where(crc_mod("id", held_out_mod) != 0).orderBy(F.xxhash64("id"), "id", "toxic").limit(sample_rows)
    text = F.coalesce(F.col("text"), F.lit(""))
    # one text an id, the least by digest: at most sample_rows of them
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen.select("id").distinct()), "id")
    texts = own.groupBy("id").agg(F.min(F.struct(F.md5(text), text.alias("text"))).alias("t")).select("id", "t.text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column("text").to_pylist()
            pairs = [counterfactuals(t, groups) for t in text]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"), pa.array([_features(words_of(t)).tobytes() for t in text], pa.binary()),
                    pa.array([[a.tobytes() for a, _ in p] for p in pairs], pa.list_(pa.binary())),
                    pa.array([[b.tobytes() for _, b in p] for p in pairs], pa.list_(pa.binary())),
                ],
                ["id", "features", "gone", "came"],
            )

    found = texts.mapInArrow(run, "id long, features binary, gone array<binary>, came array<binary>").join(F.broadcast(chosen), "id")
    return cut(found.withColumn("border", F.pmod(F.xxhash64("id", F.lit("border")), F.lit(5)) == 0), "toxic-sample")


def _counts(sample: DataFrame) -> DataFrame:
    """Rows and toxic rows of each feature, in all rows and outside the border
    fifth: (f, df, a, df_in, a_in), written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = [np.frombuffer(x, np.uint64) for x in batch.column("features").to_pylist()]
            each = [len(x) for x in flat]
            keys, where = np.unique(np.concatenate(flat), return_inverse=True) if flat else (np.zeros(0, np.uint64), np.zeros(0, int))
            toxic = np.repeat(np.array(batch.column("toxic").to_pylist(), float) > 0.5, each)
            inside = np.repeat(~np.array(batch.column("border").to_pylist(), bool), each)
            sums = [np.bincount(where, x, len(keys)).astype(np.int64) for x in (np.ones(len(where)), toxic, inside, toxic & inside)]
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), *map(pa.array, sums)], ["f", "df", "a", "df_in", "a_in"])

    parts = sample.select("features", "toxic", "border").mapInArrow(run, "f long, df long, a long, df_in long, a_in long")
    return cut(parts.groupBy("f").agg(*[F.sum(c).alias(c) for c in ("df", "a", "df_in", "a_in")]), "toxic-counts")


def _chosen(counts: DataFrame, df: str, a: str, rate: float, always: np.ndarray) -> np.ndarray:
    """The features that are fitted, by the step-up rule over all of them."""
    n, k = F.col(df).cast("double"), F.col(a).cast("double")
    part = lambda x, share: F.when(x > 0, x * F.log(x / (n * F.lit(share)))).otherwise(0.0)
    # the terms of swaps stay, those that some row has
    swapped = counts.where((n > 0) & F.col("f").isin(always.view(np.int64).tolist())).select("f").toArrow() if len(always) else None
    always = np.sort(swapped.column("f").to_numpy().view(np.uint64)) if swapped is not None else always
    enough = counts.where(n >= MIN_ROWS).select("f", (part(k, rate) + part(n - k, 1 - rate)).alias("gain"))
    of = enough.count()
    # below log(1 / FALSE_SHARE) no rank passes; 16 bytes a feature come here
    best = enough.where(F.col("gain") >= float(-np.log(FALSE_SHARE))).toArrow()
    f, gain = best.column("f").to_numpy().view(np.uint64), best.column("gain").to_numpy()
    order = np.lexsort((f, -gain))
    f, gain = f[order], gain[order]
    f = f[(gain >= least_gain(gain, of)) & (gain > 0)]
    f = f[~np.isin(f, always)][: max(0, FEATURES - len(always))]
    return np.unique(np.concatenate([always, f]))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_out_mod: int = 5,
          sample_rows: int = SAMPLE_ROWS, groups: list[list[str]] = IDENTITY_TERMS, penalty: float = COUNTERFACTUAL, steps: int = 400) -> Model:
    """Fit on labelled rows outside the held-out fold, at most ``sample_rows``.
    Features are counted and chosen on the cluster; of the sample, only the
    chosen features come to the driver, as 32-bit columns."""
    sample = _sample(docs, labels, id_col, text_col, held_out_mod, sample_rows, groups)
    bad, inside = F.col("toxic") > 0.5, ~F.col("border")
    n, a, n_in, a_in = sample.agg(*[F.coalesce(F.sum(F.when(c, 1).otherwise(0)), F.lit(0)) for c in (F.lit(True), bad, inside, bad & inside)]).first()
    if not 0 < a < n:
        return one_label(a / n if n else 0.0)
    in_swaps = sample.select(F.explode(F.concat("gone", "came")).alias("x")).distinct().collect()  # terms of the groups
    always = np.unique(np.concatenate([np.zeros(0, np.uint64), *[np.frombuffer(bytes(r["x"]), np.uint64) for r in in_swaps]]))
    counts = _counts(sample)
    fits = [_chosen(counts, "df", "a", a / n, always)]
    if 0 < a_in < n_in and a_in < a and n_in - a_in < n - a:  # both labels on both sides
        fits.append(_chosen(counts, "df_in", "a_in", a_in / n_in, always))
    keys = np.unique(np.concatenate(fits))
    sent = docs.sparkSession.sparkContext.broadcast(keys)  # 2 * FEATURES * 8 bytes at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cols = lambda x: _columns(sent.value, np.frombuffer(x, np.uint64)).tobytes()
        for batch in batches:
            out = [pa.array([cols(x) for x in batch.column("features").to_pylist()], pa.binary())]
            out += [pa.array([[cols(x) for x in xs] for xs in batch.column(c).to_pylist()], pa.list_(pa.binary())) for c in ("gone", "came")]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("toxic"), batch.column("border"), *out], ["id", "toxic", "border", "cols", "gone", "came"])

    found = sample.select("id", "toxic", "border", "features", "gone", "came").mapInArrow(run, "id long, toxic double, border boolean, cols binary, gone array<binary>, came array<binary>").toArrow()
    found = found.sort_by([("id", "ascending"), ("toxic", "ascending")])
    as_cols = lambda x: np.frombuffer(x, np.int32)
    rows = [as_cols(x) for x in found.column("cols").to_pylist()]
    toxic, part = found.column("toxic").to_numpy() > 0.5, np.array(found.column("border").to_pylist(), bool)
    swaps = [(as_cols(x), as_cols(y)) for g, c in zip(found.column("gone").to_pylist(), found.column("came").to_pylist(), strict=True) for x, y in zip(g, c, strict=True)]
    del found

    def fitted(own: np.ndarray, use: np.ndarray) -> Model:
        """The model of the rows ``use`` with the features ``own``."""
        new = np.full(len(keys), -1, np.int32)
        new[np.searchsorted(keys, own)] = np.arange(len(own), dtype=np.int32)
        mine = lambda x: (y := new[x])[y >= 0]
        picked = [mine(r) for r, u in zip(rows, use, strict=True) if u]
        who = np.repeat(np.arange(len(picked), dtype=np.int32), [len(r) for r in picked])
        weights, bias = descend(who, np.concatenate([np.zeros(0, np.int32), *picked]), len(own), toxic[use], [(mine(x), mine(y)) for x, y in swaps], penalty, steps)
        return Model(own, weights, bias)

    model = fitted(fits[0], np.ones(len(rows), bool))
    if len(fits) > 1:  # the border: set on a fifth that a second fit has not seen
        trial = fitted(fits[1], ~part)
        z = np.array([trial.logit(keys[r]) for r, p in zip(rows, part, strict=True) if p])
        model.bias -= border(z, toxic[part])
    return model


def scorer(docs: DataFrame, model: Model):
    """A function of the text column that gives the score."""
    sent = docs.sparkSession.sparkContext.broadcast((model.keys, model.weights, model.bias))  # FEATURES * 16 bytes

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        keys, weights, bias = sent.value
        table = dict(zip(keys.tolist(), weights.tolist(), strict=True))
        known: dict[str, tuple[int, int]] = {}  # word -> its feature hashes

        def learn(words: list[str]) -> None:
            if len(known) > 200_000:
                known.clear()
            own = [w.encode() for w in words] + [f"{w[:PREFIX]}*".encode() for w in words]
            data, off = T.as_bytes(pa.array(own, pa.binary()))
            h = T.hashes(data, off[:-1], off[1:], fold=False).tolist()
            for i, w in enumerate(words):
                a, b = h[i], h[len(words) + i] if len(w) > PREFIX else 0
                known[w] = (a if a in table else 0, b if b in table else 0)

        for batch in texts:
            out = np.empty(len(batch))
            for i, text in enumerate(batch):
                words = words_of(text)
                new = [w for w in words if w not in known]
                if new:
                    if len(known) + len(new) > 200_000:
                        known.clear()
                        new = list(words)
                    learn(new)
                use = set()
                for w in words:
                    use.update(known[w])
                use.discard(0)
                z = bias + sum(sorted(table[f] for f in use))
                out[i] = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
            yield pd.Series(out)

    return score


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(id, held_out, score, predicted) for each row of ``docs``."""
    model = train(docs, labels, id_col, text_col, **options)
    rated = docs.select(F.col(id_col), F.col(text_col).alias("__text")).withColumn("score", scorer(docs, model)(F.col("__text")))
    return rated.select(id_col, (crc_mod(id_col, options.get("held_out_mod", 5)) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5, **options) -> DataFrame:
    """``docs`` without the rows scored at ``threshold`` or more."""
    model = train(docs, labels, id_col, text_col, **options)
    rated: Column = scorer(docs, model)(F.col(text_col))
    return docs.withColumn("__score", rated).where(F.col("__score") < threshold).drop("__score")
