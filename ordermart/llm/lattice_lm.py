"""Language-model score of a text: marginal likelihood over a subword lattice.

The tokens of a text are its words and one end.  Each language (by the
language column, when it has ``LANG_BYTES`` of training text; the rest together)
has its own model: the probability of a word is
    (c - D) / N  [if it was seen c > 0 times]  +  D * V / N * L(word)
(absolute discounting), where L is the sum over all segmentations of the word
into pieces of an existing vocabulary, each the product of unigram piece
probabilities: word-inner pieces and one word-final piece.  L is computed by
the forward recursion in log space and sums to one over all words, as piece
probabilities do; so the whole is a proper distribution.

The piece scores start from the order of the vocabulary and are re-estimated
on the training words by expectation (forward-backward): once on the common
words, once on all distinct words.  Counts cover every training document.

Sharding: word counts are summed by a shuffle.  Words that carry at least
1 / ``HOT_WORDS`` of all tokens (so fewer than that many) and are at most
``HOT_BYTES`` long are broadcast with their scores; all others meet their score
in a shuffle join in which no word is large.

Defined cases: null counts as empty: one end token; repeated rows are scored
alike and each counts in training; a null id is crc32('') = 0, so held out;
a language with nothing to train on gives words probability L / 2 and the end 1 / 2.
"""

from __future__ import annotations

import json
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops as T
from .common import crc_mod, cut

HOT_WORDS = 1 << 18
HOT_BYTES = 64
#: Words up to this length go through the recursion together, so many bytes of
#: them at a time.
_VECTOR = 400
_BLOCK = 1 << 18
_STRETCH = 1 << 16  # bytes of a longer word handled at a time
_FLUSH = 200_000
#: Languages with so many bytes of training text have a model of their own, at
#: most the LANGS - 1 with most of it (a model is a row of the piece table).
LANG_BYTES = 1 << 18
LANGS = 20


def pieces_of(path: str) -> tuple[list[bytes], list[bool]]:
    """(bytes, word-final) of each piece of a byte-level BPE file with word
    ends, in the order of its ids."""
    with open(path, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    # fixed rule of byte-level vocabularies: printable bytes stand for themselves, the rest follow from 256
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
    out = []
    for piece, _ in sorted(vocab.items(), key=lambda kv: kv[1]):
        final = piece.endswith("</w>")
        body = piece.removesuffix("</w>")
        if body and all(c in of for c in body):
            out.append((bytes(of[c] for c in body), final))
    out = list(dict.fromkeys(out))
    return [p for p, _ in out], [f for _, f in out]


class Lattice:
    """All segmentations of words under unigram piece probabilities, those of
    one model a language (rows of ``logp``).  A word comes with its model."""

    def __init__(self, pieces: list[bytes], final: list[bool], logp: np.ndarray):
        self.n, self.longest = len(pieces), max(map(len, pieces))
        self.logp = np.atleast_2d(logp)
        data, off = T.as_bytes(pa.array(pieces, pa.binary()))
        h = self._salt(T.hashes(data, off[:-1], off[1:], fold=False), np.array(final))
        self.order = np.argsort(h)
        self.hashes = h[self.order]
        # 22 bits of a hash say whether a piece may be there; 20 bits, where it is
        self.may = np.zeros(1 << 22, bool)
        self.may[h >> np.uint64(42)] = True
        self.first = np.searchsorted(self.hashes >> np.uint64(44), np.arange((1 << 20) + 1)).astype(np.int32)
        self.depth = int(np.diff(self.first).max())

    @staticmethod
    def _salt(h: np.ndarray, final) -> np.ndarray:
        return T.mix(h + np.where(final, np.uint64(0x51ED), np.uint64(0)))

    def _find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places in ``h`` of hashes of pieces, ids of those pieces)."""
        rows = np.flatnonzero(self.may[h >> np.uint64(42)])
        h = h[rows]
        at = self.first[h >> np.uint64(44)]
        found = np.full(len(h), -1)
        for d in range(self.depth):
            place = np.minimum(at + d, self.n - 1)
            hit = self.hashes[place] == h
            found[hit] = self.order[place[hit]]
        ok = found >= 0
        return rows[ok], found[ok]

    @staticmethod
    def _substrings(total: np.ndarray, inverse: np.ndarray, i, j) -> np.ndarray:
        """Hash of the bytes i to j, by sums over the bytes up to each place."""
        size = np.asarray(j - i, np.uint64) * T._COEF[63]
        return T.mix((total[j] - total[i]) * inverse[i] + size)

    # -- words of up to _VECTOR bytes: many at a time ----------------------------

    def _edges(self, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
        """Every piece in some words that stand one after another: (word, from,
        to, piece, groups).  A word of n bytes has n + 1 places; ``from`` and
        ``to`` count the places of all words.  Edges are in order of the byte
        where they end in their word; a group ends at one place of a word at
        most once."""
        power, inverse = T._powers(len(data) + 1)
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(T._BYTE[data] * power[: len(data)], out=total[1:])
        word = np.repeat(np.arange(len(size), dtype=np.int32), size)
        end = np.repeat(start + size, size)
        alive, found = np.arange(len(data)), []
        for n in range(1, self.longest + 1):
            alive = alive[alive + n <= end[alive]]
            if not len(alive):
                break
            rows, ids = self._find(self._salt(self._substrings(total, inverse, alive, alive + n), alive + n == end[alive]))
            found.append((alive[rows], np.full(len(rows), n), ids))
        i, n, ids = (np.concatenate(x) for x in zip(*found, strict=True))
        w = word[i]
        key = ((i - start[w] + n) * 64 + n).astype(np.uint16)
        order = np.argsort(key, kind="stable")
        key, i, n, ids, w = key[order], i[order], n[order], ids[order], w[order]
        edge = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, int)
        return w, i + w, i + w + n, ids, list(zip(edge.tolist(), np.append(edge[1:], len(key)).tolist(), strict=False))

    @staticmethod
    def _forward(source: np.ndarray, target: np.ndarray, lp: np.ndarray, groups: list, begin: np.ndarray, places: int) -> np.ndarray:
        """Log of the sum over the segmentations of the bytes up to each place."""
        alpha = np.full(places, -np.inf)
        alpha[begin] = 0
        for lo, hi in groups:
            t = target[lo:hi]
            alpha[t] = np.logaddexp(alpha[t], alpha[source[lo:hi]] + lp[lo:hi])
        return alpha

    def _blocks(self, words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(rows, bytes, starts, sizes) of the short words, some at a time."""
        size = np.array([len(w) for w in words], np.int64)
        rows = np.flatnonzero(size <= _VECTOR)
        for part in np.split(rows, np.searchsorted(np.cumsum(size[rows]), np.arange(_BLOCK, size[rows].sum(), _BLOCK))):
            if len(part):
                own = size[part]
                yield part, np.frombuffer(b"".join([words[r] for r in part.tolist()]), np.uint8), np.cumsum(own) - own, own

    # -- long words: a stretch of one at a time ----------------------------------

    def _stretch(self, data: np.ndarray, lo: int, hi: int, lp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(i, j, piece) of every piece that ends in (lo, hi], in order of j."""
        begin, n = max(0, lo - self.longest), len(data)
        power, inverse = T._powers(hi - begin + 1)
        total = np.zeros(hi - begin + 1, np.uint64)
        np.cumsum(T._BYTE[data[begin:hi]] * power[: hi - begin], out=total[1:])
        found = []
        for size in range(1, self.longest + 1):
            j = np.arange(max(lo + 1, begin + size), hi + 1) - begin
            if len(j):
                rows, ids = self._find(self._salt(self._substrings(total, inverse, j - size, j), j + begin == n))
                found.append((j[rows] - size + begin, j[rows] + begin, ids))
        i, j, ids = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((i, j))
        return i[order], j[order], ids[order]

    def _run(self, source: np.ndarray, target: np.ndarray, lp: np.ndarray, alpha: np.ndarray) -> None:
        """The recursion over edges that are grouped by target, in the order in
        which sources are complete."""
        edge = np.flatnonzero(np.concatenate([[True], target[1:] != target[:-1]])) if len(target) else target
        begin, end, at = edge.tolist(), np.append(edge[1:], len(target)).tolist(), target[edge].tolist()
        source, lp, exp, log = source.tolist(), lp.tolist(), math.exp, math.log
        base = min(min(source), min(at)) if at else 0
        top = max(max(source), max(at)) if at else 0
        a = alpha[base : top + 1].tolist()
        for b, e, t in zip(begin, end, at, strict=True):
            terms = [a[source[k] - base] + lp[k] for k in range(b, e)]
            high = max(terms)
            if high > -math.inf:
                a[t - base] = high + log(sum([exp(x - high) for x in terms]))
        alpha[base : top + 1] = a

    def _long(self, word: bytes, z: int, count: np.ndarray | None = None) -> float:
        """One long word, ``_STRETCH`` bytes at a time: 8 bytes of memory a
        byte of it, twice that with ``count``."""
        data, n, logp = np.frombuffer(word, np.uint8), len(word), self.logp[z]
        alpha = np.full(n + 1, -np.inf)
        alpha[0] = 0
        for lo in range(0, n, _STRETCH):
            i, j, ids = self._stretch(data, lo, min(n, lo + _STRETCH), logp)
            self._run(i, j, logp[ids], alpha)
        if count is not None and alpha[n] > -np.inf:
            beta = np.full(n + 1, -np.inf)
            beta[n] = 0
            for lo in reversed(range(0, n, _STRETCH)):
                # edges that begin here; those of the next stretch that begin in it as well
                i, j, ids = self._stretch(data, lo, min(n, lo + _STRETCH + self.longest), logp)
                own = np.flatnonzero((i >= lo) & (i < lo + _STRETCH))
                own = own[np.lexsort((j[own], -i[own]))]
                i, j, ids = i[own], j[own], ids[own]
                self._run(j, i, logp[ids], beta)
                np.add.at(count, z * self.n + ids, np.exp(alpha[i] + logp[ids] + beta[j] - alpha[n]))
        return float(alpha[n])

    # -- both ----------------------------------------------------------------------

    def score(self, words: list[bytes], z: np.ndarray) -> np.ndarray:
        """Natural log of L of each word, under its model."""
        out = np.empty(len(words))
        for rows, data, start, size in self._blocks(words):
            w, source, target, ids, groups = self._edges(data, start, size)
            begin = start + np.arange(len(size))
            alpha = self._forward(source, target, self.logp[z[rows][w], ids], groups, begin, len(data) + len(size))
            out[rows] = alpha[begin + size]
        for r, word in enumerate(words):
            if len(word) > _VECTOR:
                out[r] = self._long(word, int(z[r]))
        return out

    def expected(self, words: list[bytes], z: np.ndarray) -> np.ndarray:
        """Expected uses of each piece over the words, by model."""
        count = np.zeros(self.logp.size)
        for rows, data, start, size in self._blocks(words):
            w, source, target, ids, groups = self._edges(data, start, size)
            begin, places = start + np.arange(len(size)), len(data) + len(size)
            own = z[rows][w]
            lp = self.logp[own, ids]
            alpha = self._forward(source, target, lp, groups, begin, places)
            beta = np.full(places, -np.inf)
            beta[begin + size] = 0
            for lo, hi in reversed(groups):
                i = source[lo:hi]
                beta[i] = np.logaddexp(beta[i], lp[lo:hi] + beta[target[lo:hi]])
            with np.errstate(invalid="ignore"):
                gain = np.exp(alpha[source] + lp + beta[target] - alpha[(begin + size)[w]])
            count += np.bincount(own * self.n + ids, np.nan_to_num(gain), len(count))
        for r, word in enumerate(words):
            if len(word) > _VECTOR:
                self._long(word, int(z[r]), count)
        return count.reshape(self.logp.shape)


def from_counts(count: np.ndarray) -> np.ndarray:
    """Log probabilities; every piece keeps a little."""
    p = count + 0.01
    return np.log(p / p.sum())


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(z, held, text) -> partial (word, z, train, seen) counts, in bounded memory."""
    counts: dict[tuple[int, bool], Counter] = {}

    def flush() -> pa.RecordBatch:
        word, at, train, seen = [], [], [], []
        for z in sorted({k[0] for k in counts}):
            a, b = counts.get((z, False), Counter()), counts.get((z, True), Counter())
            own = list(a.keys() | b.keys())
            word += own
            at += [z] * len(own)
            train += [a[w] for w in own]
            seen += [a[w] + b[w] for w in own]
        counts.clear()
        return pa.RecordBatch.from_arrays([pa.array(word, pa.binary()), pa.array(at, pa.int32()), pa.array(train, pa.int64()), pa.array(seen, pa.int64())], ["word", "z", "train", "seen"])

    size = 0
    for batch in batches:
        for z, held, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            text = text.as_py() or b""
            c = counts.setdefault((z, held), Counter())
            c.update(text.lower().split())  # bytes: folds A-Z and splits at ASCII white space only
            size += len(text)
            if size > 1 << 26 or len(c) > _FLUSH:
                size = 0
                yield flush()
    yield flush()


def score(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", held_out_mod: int = 10, hot_words: int = HOT_WORDS,
    lang_bytes: int = LANG_BYTES,
) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) for
    each row; ``vocabulary``: path of a byte-level BPE file with word ends."""
    sc = docs.sparkSession.sparkContext
    lang = F.col(lang_col).cast("string")
    by_lang = docs.where(crc_mod(id_col, held_out_mod) != 0).groupBy(lang.alias("l")).agg(F.sum(F.octet_length(F.col(text_col).cast("binary"))).alias("bytes"))
    langs = sorted(r[0] for r in by_lang.where(F.col("l").isNotNull() & (F.col("bytes") >= lang_bytes)).orderBy(F.desc("bytes"), "l").limit(LANGS - 1).collect())
    z = F.lit(len(langs))
    for i, x in enumerate(langs):
        z = F.when(lang == x, F.lit(i)).otherwise(z)
    zs = range(len(langs) + 1)
    base = docs.select(
        F.col(id_col).cast("long").alias("id"), z.cast("int").alias("z"), (crc_mod(id_col, held_out_mod) == 0).alias("held"), F.col(text_col).cast("binary").alias("text")
    )
    one = lambda c, i: F.sum(F.when(F.col("z") == i, F.col(c)).otherwise(F.lit(0)))
    words = cut(
        base.select("z", "held", "text").mapInArrow(_counted, "word binary, z int, train long, seen long").groupBy("word").agg(
            F.sum("train").alias("train"), F.sum("seen").alias("seen"),
            F.array(*[one("train", i) for i in zs]).alias("trains"), F.array(*[one("seen", i) for i in zs]).alias("seens"),
        ),
        "words",
    )
    facts = words.agg(
        F.sum("seen"), F.sum("train"), F.count_if(F.col("train") > 0),
        *[f(F.col("trains")[i]) for i in zs for f in (F.sum, lambda c: F.count_if(c > 0), lambda c: F.count_if(c == 1), lambda c: F.count_if(c == 2))],
    ).first()
    seen, n_words, v_words, *own = (x or 0 for x in facts)
    trained = base.where("not held").groupBy("z").count()
    ends = {r["z"]: r["count"] for r in trained.collect()}
    end = sum(ends.values())
    n, v = n_words + end, v_words + (end > 0)
    total, discount, left, end_p = np.ones(len(zs)), np.full(len(zs), 0.5), np.full(len(zs), 0.5), np.full(len(zs), 0.5)
    for i in zs:
        words_i, types, n1, n2 = own[4 * i : 4 * i + 4]
        if words_i:
            total[i] = words_i + ends[i]
            discount[i] = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
            left[i] = discount[i] * types / total[i]
            end_p[i] = ends[i] / total[i]
    is_hot = (F.col("seen") * hot_words >= seen) & (F.octet_length("word") <= HOT_BYTES)

    pieces, final = pieces_of(vocabulary)
    vocab = sc.broadcast((pieces, final))  # the size of the vocabulary

    def learned(logp: np.ndarray, some: DataFrame) -> np.ndarray:
        """One step of expectation and maximisation in every language."""
        sent = sc.broadcast(logp)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            lattice, count = None, np.zeros(logp.shape)
            for batch in batches:
                lattice = lattice or Lattice(*vocab.value, sent.value)
                word = batch.column(0).to_pylist()
                row, model = np.nonzero(np.array(batch.column(1).to_pylist()).reshape(len(word), -1) > 0)
                count += lattice.expected([word[r] for r in row.tolist()], model)
            at = np.flatnonzero(count.ravel() > 1e-6)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(count.ravel()[at])], ["piece", "uses"])

        uses = some.select("word", "trains").mapInArrow(run, "piece long, uses double").groupBy("piece").agg(F.sum("uses").alias("uses")).collect()
        count = np.zeros(logp.size)
        for r in uses:
            count[r["piece"]] = r["uses"]
        return np.stack([from_counts(c) for c in count.reshape(logp.shape)])

    logp = np.stack([from_counts(1 / np.arange(2, len(pieces) + 2))] * len(zs))
    for _ in range(2):
        logp = learned(logp, words.where(is_hot & (F.col("train") > 0)))
    logp = learned(logp, words.where("train > 0"))
    sent = sc.broadcast(logp)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = None
        for batch in batches:
            lattice = lattice or Lattice(*vocab.value, sent.value)
            word = batch.column(0).to_pylist()
            c = batch.column(1).to_numpy().astype(float)
            trains, seens = (np.array(batch.column(k).to_pylist(), float).reshape(len(word), len(total)) for k in (3, 4))
            model = np.full(trains.shape, -300.0)  # a language that never has the word never asks
            row, i = np.nonzero(seens > 0)
            logl = lattice.score([word[r] for r in row.tolist()], i)
            seen_p = np.maximum(trains[row, i] - discount[i], 0) / total[i]
            with np.errstate(divide="ignore"):  # in logs: a very long word is below what a double holds
                model[row, i] = np.logaddexp(np.log(seen_p), np.log(left)[i] + logl) / math.log(10)
            flat = np.log10((c + 0.1) / (n + 0.1 * (v + 1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(flat), pa.array(model.tolist(), pa.list_(pa.float64()))], ["word", "train", "seen", "base", "model"]
            )

    rated = cut(words.select("word", "train", "seen", "trains", "seens").mapInArrow(scored, "word binary, train long, seen long, base double, model array<double>"), "rated")
    hot = rated.where(is_hot).select("word", (F.col("train") > 0).alias("known"), "base", "model").toArrow()
    table = sc.broadcast(
        (hot.column("word").to_pylist(), *(hot.column(c).to_numpy().astype(float) for c in ("known", "base")),
         np.array(hot.column("model").to_pylist(), float).reshape(hot.num_rows, len(zs)).T.copy())
    )

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, known, flat, model = table.value
        place = {w: i for i, w in enumerate(names)}
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            out: list[tuple] = []
            for z, text in zip(batch.column(1).to_pylist(), batch.column(3), strict=True):
                tokens = (text.as_py() or b"").lower().split()
                at = [place.get(w, -1) for w in tokens]
                idx = np.array(at, np.int64)
                rest = Counter(w for w, i in zip(tokens, at, strict=True) if i < 0) if (idx < 0).any() else {}
                idx = idx[idx >= 0]
                out.append((row, len(tokens) + 1, float(known[idx].sum()), float(flat[idx].sum()), float(model[z][idx].sum()), list(rest), list(rest.values())))
                row += 1
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.list_(pa.binary()), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), *(pa.array([r[i] for r in out], k) for i, k in enumerate(kinds))],
                ["id", "z", "held", "row", "n_tokens", "known", "base", "model", "words", "times"],
            )

    first = cut(
        base.mapInArrow(summed, "id long, z int, held boolean, row long, n_tokens long, known double, base double, model double, words array<binary>, times array<long>"), "sums"
    )
    rest = first.select("row", "z", F.explode(F.arrays_zip("words", "times")).alias("e")).select("row", "z", F.col("e.words").alias("word"), F.col("e.times").alias("times"))
    tail = rest.join(rated.where(~is_hot).select("word", (F.col("train") > 0).cast("double").alias("known"), "base", "model"), "word").select(
        "row", *[(F.col("times") * c).alias(k) for k, c in (("known", F.col("known")), ("base", F.col("base")), ("model", F.get("model", F.col("z"))))]
    )
    none = [F.lit(None).cast(t).alias(c) for c, t in (("id", "long"), ("z", "int"), ("held", "boolean"), ("n_tokens", "long"))]
    both = first.select("row", "known", "base", "model", "id", "z", "held", "n_tokens").unionByName(tail.select("row", "known", "base", "model", *none))
    sums = both.groupBy("row").agg(F.max("id").alias("id"), F.max("z").alias("z"), F.max("held").alias("held"), F.max("n_tokens").alias("n_tokens"), *[F.sum(c).alias(c) for c in ("known", "base", "model")])
    end_base = math.log10((end + 0.1) / (n + 0.1 * (v + 1)))
    end_model = F.element_at(F.array(*[F.lit(float(x)) for x in np.log10(end_p)]), F.col("z") + 1)
    return sums.select(
        F.col("id").alias(id_col), F.col("held").alias("held_out"), "n_tokens", (F.col("known") + int(end > 0)).cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"), (F.col("base") + end_base).alias("base_score"), (F.col("model") + end_model).alias("score"),
    )
