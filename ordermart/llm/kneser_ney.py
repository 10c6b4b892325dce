"""Quality classifier: interpolated modified Kneser-Ney over characters.

1. Trusted text: all labelled documents of quality 1 (``trusted_rows``: at most
   so many of them, by hash of the id).
2. Its character n-grams up to ``ORDER`` are counted in partial sums and a
   shuffle.  Continuation counts, discounts by counts of counts, context totals
   and the interpolation with the next lower order are joins of these count
   tables, sharded by n-gram or context.
3. The ``MODEL_NGRAMS`` most used n-grams are sent to the tasks that score every
   whole text.  If the model has more, a character whose longest n-gram is not
   among them is left open; the open n-grams (distinct in a text, with their
   times) meet the whole model in shuffle joins, so nothing is pruned.
4. Thresholds are quantiles by language over all documents of quality 1 (those
   that ``trusted_rows`` left out, where there are ``LEAST_TRUSTED`` of them): the
   median of the log perplexity and ``SPREAD`` times the way from there to the
   ``QUANTILE``; a short text gets room for its noise.

Defined cases: null and empty texts have the end symbol only and are kept if
the guard leaves them (fewer than ``MIN_CHARS`` characters: kept); languages
with fewer than ``LEAST_TRUSTED`` trusted documents, and null, use the
threshold of all; repeated rows get equal rows; with no trusted text nothing is
rejected.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops as T
from .common import cut, likely_in, lookup

ORDER = 4
MODEL_NGRAMS = 1 << 20
_CHARS = 1 << 20  # characters scored at a time
QUANTILE, SPREAD = 0.99, 2.0
MIN_CHARS = 50
ROOM = 1.0
LEAST_TRUSTED = 50
START, END = "\x02", "\x03"
_C = T._fixed(ORDER, 4242) | np.uint64(1)


def _points(text: str | None) -> np.ndarray:
    return np.frombuffer((START * (ORDER - 1) + (text or "") + END).encode("utf-32-le", "surrogatepass"), np.uint32)


def _hashes(points: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n-gram that ends at each of the places ``at``."""
    h = np.full(len(at), n, np.uint64)
    for j in range(n):
        h += (points[at - j].astype(np.uint64) + np.uint64(1)) * _C[j]
    return T.mix(h)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts -> partial counts of n-grams of the highest order."""
    for batch in batches:
        some: list[np.ndarray] = []
        size = 0
        rows = batch.column(0).to_pylist()
        for i, text in enumerate(rows):
            p = _points(text)
            some.append(np.lib.stride_tricks.sliding_window_view(p, ORDER))
            size += len(p)
            if size > 1 << 21 or i == len(rows) - 1:
                grams = np.concatenate(some)
                raw = np.ascontiguousarray(grams).view(f"V{4 * ORDER}").ravel()
                # count by hash, then name each by one of its occurrences
                h = T.mix(sum((grams[:, j].astype(np.uint64) + np.uint64(1)) * _C[j] for j in range(ORDER)))
                _, first, n = np.unique(h, return_index=True, return_counts=True)
                names = [bytes(x).decode("utf-32-le", "surrogatepass") for x in raw[first]]
                some, size = [], 0
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(n, pa.int64())], ["g", "c"])


def train(texts: DataFrame) -> DataFrame:
    """(n, g, c, lp, lg): natural log of the interpolated probability of each
    seen n-gram, and of the weight it leaves to lower orders as a context."""
    top = cut(texts.mapInArrow(_counted, "g string, c long").groupBy("g").agg(F.sum("c").alias("c")), "ngrams")
    counts = {ORDER: top}
    for n in range(ORDER - 1, 0, -1):  # continuation counts: distinct characters before
        counts[n] = cut(counts[n + 1].groupBy(F.substring("g", 2, n).alias("g")).agg(F.count("*").alias("c")), f"ngrams{n}")
    below, model = None, None
    for n in range(1, ORDER + 1):
        own = counts[n].where(~F.col("g").endswith(START))
        n1, n2, n3, n4 = (x or 0 for x in own.agg(*[F.count_if(F.col("c") == k) for k in (1, 2, 3, 4)]).first())
        y = n1 / (n1 + 2 * n2) if n1 else 0.0
        d = [min(0.95 * k, max(0.05, k - (k + 1) * y * b / a)) if a and b else 0.5 for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
        off = F.when(F.col("c") == 1, d[0]).when(F.col("c") == 2, d[1]).otherwise(d[2])
        context = F.substring("g", 1, n - 1) if n > 1 else F.lit("")
        own = own.withColumn("ctx", context).withColumn("off", off)
        of_ctx = own.groupBy("ctx").agg(F.sum("c").alias("total"), F.sum("off").alias("freed"), F.count("*").alias("kinds"))
        seen = own.join(of_ctx, "ctx").withColumn("left", F.col("freed") / F.col("total"))
        if n == 1:  # and with the uniform distribution over the characters seen and one more
            seen = seen.withColumn("p", (F.col("c") - F.col("off")) / F.col("total") + F.col("left") / (F.col("kinds") + 1))
        else:
            lower = below.select(F.col("g").alias("suffix"), F.col("p").alias("q"))
            seen = seen.withColumn("suffix", F.substring("g", 2, n - 1)).join(lower, "suffix")
            seen = seen.withColumn("p", (F.col("c") - F.col("off")) / F.col("total") + F.col("left") * F.col("q"))
        below = cut(seen.select("g", "c", "p"), f"kn{n}")
        gamma = of_ctx.select(F.col("ctx").alias("g"), F.log(F.col("freed") / F.col("total")).alias("lg"), (F.lit(n - 1)).alias("n"), F.col("total").alias("uses"))
        part = below.select("g", F.log("p").alias("lp"), F.lit(None).cast("double").alias("lg"), F.lit(n).alias("n"), F.col("c").alias("uses"))
        part = part.unionByName(gamma.withColumn("lp", F.lit(None).cast("double")).select("g", "lp", "lg", "n", "uses"))
        model = part if model is None else model.unionByName(part)
    return model.groupBy("n", "g").agg(F.max("lp").alias("lp"), F.max("lg").alias("lg"), F.max("uses").alias("uses"))


class Scorer:
    """Log probabilities of texts by the n-grams at hand.  ``whole``: these are
    all of the model; else a place whose longest n-gram is not at hand is left
    open."""

    def __init__(self, grams: list[str], n: np.ndarray, lp: np.ndarray, lg: np.ndarray, floor: float, whole: bool):
        self.floor, self.whole, self.tables = floor, whole, []
        for k in range(ORDER + 1):
            at = np.flatnonzero(n == k)
            padded = "".join("\0" * (ORDER - k) + (grams[i][-k:] if k else "") for i in at)
            points = np.frombuffer(padded.encode("utf-32-le", "surrogatepass"), np.uint32)
            h = _hashes(points, np.arange(len(at)) * ORDER + ORDER - 1, k)
            order = np.argsort(h)
            bits = max(1, min(22, len(at).bit_length() + 3))
            shift = np.uint64(64 - bits)
            first = np.searchsorted(h[order] >> shift, np.arange((1 << bits) + 1)).astype(np.int32)
            self.tables.append((h[order], np.append(lp[at][order], np.nan), np.append(lg[at][order], np.nan), shift, first, int(np.diff(first).max(initial=0))))

    def _find(self, k: int, h: np.ndarray) -> np.ndarray:
        """Places in the table of order ``k``; its length where there is none."""
        keys, _, _, shift, first, depth = self.tables[k]
        out = np.full(len(h), len(keys))
        slot = h >> shift
        at, end = first[slot], first[slot + np.uint64(1)]
        live = np.flatnonzero(at < end)
        for d in range(depth):
            place = at[live] + d
            hit = keys[place] == h[live]
            out[live[hit]] = place[hit]
            live = live[~hit]
            live = live[at[live] + d + 1 < end[live]]
        return out

    def log_probs(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, list[tuple[int, str, int]]]:
        """(sums of natural logs, numbers of characters and ends, (text, n-gram,
        times) of what is open)."""
        points = [_points(t) for t in texts]
        size = np.array([len(p) for p in points])
        x, begin = np.concatenate(points), np.cumsum(size) - size
        at = np.flatnonzero(np.arange(len(x)) - np.repeat(begin, size) >= ORDER - 1)
        lp = self.tables[ORDER][1][self._find(ORDER, _hashes(x, at, ORDER))]
        miss = np.flatnonzero(np.isnan(lp))
        rest = []
        if self.whole:  # back off, only where the longer n-gram was not seen
            lp[miss] = 0.0
            for k in range(ORDER - 1, -1, -1):
                if not len(miss):
                    break
                left = self.tables[k][2][self._find(k, _hashes(x, at[miss] - 1, k))]
                own = self.tables[k][1][self._find(k, _hashes(x, at[miss], k))] if k else np.full(len(miss), self.floor)
                # the floor holds what the empty context leaves
                lp[miss] += np.where(np.isnan(left) | (k == 0), 0.0, left) + np.nan_to_num(own)
                miss = miss[np.isnan(own)]
        elif len(miss):
            text = np.searchsorted(begin, at[miss], "right") - 1
            grams = np.lib.stride_tricks.sliding_window_view(x, ORDER)[at[miss] - ORDER + 1]
            h = T.join_hashes([_hashes(x, at[miss], ORDER), text.astype(np.uint64)])
            _, one, times = np.unique(h, return_index=True, return_counts=True)
            names = [bytes(g).decode("utf-32-le", "surrogatepass") for g in np.ascontiguousarray(grams[one]).view(f"V{4 * ORDER}").ravel()]
            rest = list(zip(text[one].tolist(), names, times.tolist(), strict=True))
            lp[miss] = 0.0
        ends = size - (ORDER - 1)
        return np.add.reduceat(lp, np.cumsum(ends) - ends) if len(texts) else lp, ends, rest


def resolved(model: DataFrame, grams: DataFrame, floor: float, k: int = ORDER) -> DataFrame:
    """(g, lp) of distinct n-grams of order ``k`` by joins with the whole model."""
    own = model.where((F.col("n") == k) & F.col("lp").isNotNull()).select("g", "lp")
    if k == 1:
        return grams.join(own, "g", "left").select("g", F.coalesce("lp", F.lit(floor)).alias("lp"))
    left = model.where((F.col("n") == k - 1) & F.col("lg").isNotNull()).select(F.col("g").alias("ctx"), "lg")
    lower = resolved(model, grams.select(F.substring("g", 2, k - 1).alias("g")).distinct(), floor, k - 1).select(F.col("g").alias("suffix"), F.col("lp").alias("q"))
    cut_up = grams.select("g", F.substring("g", 1, k - 1).alias("ctx"), F.substring("g", 2, k - 1).alias("suffix"))
    return cut_up.join(own, "g", "left").join(left, "ctx", "left").join(lower, "suffix").select("g", F.coalesce("lp", F.coalesce("lg", F.lit(0.0)) + F.col("q")).alias("lp"))


def _trusted(base: DataFrame, marked: DataFrame) -> DataFrame:
    """The rows of ``base`` whose id is ``marked`` (distinct ids).  The join
    moves their texts and few others, by the same plan at every size."""
    return likely_in(base, "id", marked, "id").join(marked.select("id").hint("merge"), "id")


def perplexity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
               trusted_rows: int | None = None, quantile: float = QUANTILE, spread: float = SPREAD, model_ngrams: int = MODEL_NGRAMS) -> DataFrame:
    """(id, lang, n_chars, log_perplexity, threshold, kept) for each row."""
    sc = docs.sparkSession.sparkContext
    good = cut(labels.where(F.col("quality") == 1).select(F.col(id_col).cast("long").alias("id")).where("id is not null").distinct(), "good")
    marked = good if trusted_rows is None else cut(good.orderBy(F.xxhash64("id"), "id").limit(trusted_rows), "trusted")
    marked = marked.withColumn("trusted", F.lit(True))
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    model = cut(train(_trusted(base, marked).select("text")), "model")
    n_grams, kinds, lg0 = model.agg(F.count("*"), F.count_if((F.col("n") == 1) & F.col("lp").isNotNull()), F.max(F.when(F.col("n") == 0, F.col("lg")))).first()
    # a character never seen: what the empty context leaves, over the kinds and one more
    floor = (lg0 or 0.0) - math.log(kinds + 1)
    kept = model.orderBy(F.desc("uses"), "n", "g").limit(model_ngrams).select("n", "g", "lp", "lg").toArrow()
    as_float = lambda c: kept.column(c).to_numpy().astype(float)
    sent = sc.broadcast((kept.column("g").to_pylist(), kept.column("n").to_numpy(), as_float("lp"), as_float("lg"), floor, n_grams <= model_ngrams))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer, row = None, TaskContext.get().partitionId() << 40
        for batch in batches:
            scorer = scorer or Scorer(*sent.value)
            texts = batch.column(2).to_pylist()
            total, ends, rest = [], [], [[] for _ in texts]
            lo, chars = 0, 0
            for hi in range(1, len(texts) + 1):
                chars += len(texts[hi - 1] or "")
                if chars >= _CHARS or hi == len(texts):
                    s, n, some = scorer.log_probs(texts[lo:hi])
                    total += s.tolist()
                    ends += n.tolist()
                    for i, g, times in some:
                        rest[lo + i].append((g, times))
                    lo, chars = hi, 0
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(row, row + len(texts)), pa.int64()), batch.column(0), batch.column(1), pa.array(ends, pa.int64()), pa.array(total, pa.float64()),
                    pa.array([[g for g, _ in x] for x in rest], pa.list_(pa.string())), pa.array([[t for _, t in x] for x in rest], pa.list_(pa.int64())),
                ],
                ["row", "id", "lang", "ends", "total", "grams", "times"],
            )
            row += len(texts)

    schema = "row long, id long, lang string, ends long, total double, grams array<string>, times array<long>"
    rated = cut(base.select("id", "lang", "text").mapInArrow(run, schema), "perplexity")
    if n_grams > model_ngrams:
        uses = cut(rated.select("row", F.explode(F.arrays_zip("grams", "times")).alias("e")).select("row", F.col("e.grams").alias("g"), F.col("e.times").alias("times")), "open-grams")
        grams = cut(uses.groupBy("g").agg(F.count("*").alias("rows")), "grams")
        known = resolved(model, grams.select("g"), floor).join(grams, "g")
        more = lookup(uses, known, "g", "rows", uses.count()).groupBy("row").agg(F.sum(F.col("times") * F.col("lp")).alias("more"))
        rated = rated.join(more, "row", "left").withColumn("total", F.col("total") + F.coalesce("more", F.lit(0.0)))
    rated = rated.select("id", "lang", (F.col("ends") - 1).alias("n_chars"), (-F.col("total") / F.col("ends")).alias("log_perplexity"))
    if n_grams > model_ngrams:
        rated = cut(rated, "whole-perplexity")
    # scores of all documents of quality 1, without their texts
    sure = rated.where(F.col("n_chars") >= MIN_CHARS).join(good.join(marked, "id", "left"), "id").withColumn("outside", F.col("trusted").isNull())
    at = lambda x, q: F.percentile_approx(x, q, 10_000)
    bound = lambda x: at(x, 0.5) * (1 - spread) + at(x, quantile) * spread
    unseen, whole = bound(F.when(F.col("outside"), F.col("log_perplexity"))), bound(F.col("log_perplexity"))
    best = F.when(F.count_if("outside") >= LEAST_TRUSTED, unseen)
    by_lang = sure.where("lang is not null").groupBy("lang").agg(best.when(F.count("*") >= LEAST_TRUSTED, whole).alias("own"))
    overall = sure.agg(best.otherwise(whole).alias("x")).first()[0]
    known = rated.where("lang is not null")
    langs = cut(known.groupBy("lang").agg(F.count("*").alias("rows")).join(by_lang, "lang", "left"), "thresholds")
    n_rows = langs.agg(F.sum("rows")).first()[0] or 0
    rows = lookup(known, langs, "lang", "rows", n_rows).unionByName(rated.where("lang is null"), allowMissingColumns=True)
    rows = rows.withColumn("threshold", F.coalesce("own", F.lit(overall).cast("double")))
    above = F.col("log_perplexity") > F.col("threshold") + ROOM / F.sqrt(F.greatest(F.col("n_chars"), F.lit(1)))
    return rows.select(
        F.col("id").alias(id_col), "lang", "n_chars", "log_perplexity", "threshold",
        F.coalesce((F.col("n_chars") < MIN_CHARS) | ~above, F.lit(True)).alias("kept"),
    )
