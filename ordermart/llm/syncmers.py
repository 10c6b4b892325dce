"""Document fingerprints of closed syncmers.

A k-mer of code points is an anchor when its smallest inner s-mer (by hash)
lies at its first or last place.  That depends on the k-mer alone, so equal
passages have equal anchors wherever they stand.  The n-th occurrence of an
anchor is an element of its own, so long repetitions weigh by their length.  A
fingerprint holds every element whose hash is below ``SHARE`` of all hashes, and
the ``SKETCH`` smallest at least, each with its position, as hex text (8 digits
of hash, 8 of position); so it grows with the text, and passages in common show
however long the texts around them are.

Likeness of two fingerprints: among the elements up to a hash that both cover
(the larger of ``SHARE`` and the ``SKETCH``-th of their union), those in both and
in the same order (longest chain of rising positions) estimate the Jaccard
similarity J; the likeness is 2 J / (1 + J), the share in common.

Defined cases: null counts as empty, whose fingerprint is the empty string; a
text without an anchor has its whole text as the one anchor; two empty texts
are alike (1), an empty and another are not (0).  In ``with_next`` rows are
ordered by id, nulls last, ties by a hash of the text, then by the text; a single
row is its own next; an empty table gives no rows; only the id and text are read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textops as T

K, S, SKETCH = 12, 5, 64
SHARE = 1 / 16
_LIMIT = int(SHARE * (1 << 32))  # elements are 32-bit hashes
#: Code points hashed at a time.
_PIECE = 1 << 20
_C = T._fixed(S, 1234) | np.uint64(1)


def anchors(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(hash, position) of the closed syncmers of a whole text, in order."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    hs, at = [], []
    w = K - S + 1
    for lo in range(0, max(0, len(points) - K + 1), _PIECE):
        x = points[lo : lo + _PIECE + K - 1].astype(np.uint64) + np.uint64(1)
        n = len(x) - S + 1
        s = x[:n] * _C[0]
        for j in range(1, S):
            s += x[j : j + n] * _C[j]
        s = T.mix(s)
        low, span = s, 1
        while span < w:  # smallest of w neighbours by doubling
            step = min(span, w - span)
            low = np.minimum(low[: len(low) - step], low[step:])
            span += step
        m = len(low)
        pick = np.flatnonzero((low == s[:m]) | (low == s[w - 1 : w - 1 + m]))
        # three s-mers cover the k-mer
        hs.append(T.join_hashes([s[pick], s[pick + S], s[pick + K - S]]))
        at.append(pick + lo)
    h = np.concatenate(hs) if hs else np.zeros(0, np.uint64)
    if not len(h) and len(points):
        whole = int.from_bytes(hashlib.blake2b(points.tobytes(), digest_size=8).digest(), "little")
        return np.array([whole], np.uint64), np.zeros(1, np.int64)
    return h, np.concatenate(at) if at else np.zeros(0, np.int64)


def sketch(text: str | None, size: int = SKETCH) -> np.ndarray:
    """(hash, position) rows, by hash."""
    h, at = anchors(text or "")
    order = np.argsort(h, kind="stable")
    h, at = h[order], at[order]
    begins = np.concatenate([[True], h[1:] != h[:-1]]) if len(h) else np.zeros(0, bool)
    nth = np.arange(len(h)) - np.maximum.accumulate(np.where(begins, np.arange(len(h)), 0)) if len(h) else at
    own = (T.mix(h + nth.astype(np.uint64) * _C[0]) >> np.uint64(32)).astype(np.uint32)
    near = max(int((own < _LIMIT).sum()), size * 2)
    low = np.argpartition(own, near)[:near] if len(own) > near else np.arange(len(own))
    low = low[np.argsort(at[low], kind="stable")]
    own, first = np.unique(own[low], return_index=True)
    keep = max(size, int(np.searchsorted(own, _LIMIT)))
    return np.stack([own[:keep], at[low][first][:keep].astype(np.uint32)], axis=1)


def encode(sk: np.ndarray) -> str:
    return sk.astype(">u4").tobytes().hex()


def decode(text: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(text), ">u4").reshape(-1, 2).astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray, size: int = SKETCH) -> float:
    if not len(a) and not len(b):
        return 1.0
    if not len(a) or not len(b):
        return 0.0
    union = np.union1d(a[:, 0], b[:, 0])
    union = union[: max(size, int(np.searchsorted(union, _LIMIT)))]
    common, i, j = np.intersect1d(a[:, 0], b[:, 0], assume_unique=True, return_indices=True)
    seen = common <= union[-1]
    order = np.argsort(a[i[seen], 1], kind="stable")
    chain: list[int] = []
    for p in b[j[seen], 1][order].tolist():  # longest rising chain
        q = bisect_left(chain, p)
        chain[q : q + 1] = [p]
    jaccard = len(chain) / len(union)
    return 2 * jaccard / (1 + jaccard)


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text column."""

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: encode(sketch(t)), na_action=None)

    return run(text)


def likeness_of(a: Column, b: Column) -> Column:
    """The likeness of two fingerprint columns."""

    @F.pandas_udf("double")
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([likeness(decode(p or ""), decode(q or "")) for p, q in zip(x, y, strict=True)], dtype=float)

    return run(a, b)


def _places(ords: np.ndarray, ties: np.ndarray, ord_: np.ndarray, tie: np.ndarray) -> np.ndarray:
    """For each (ord, tie) the last of the sorted bounds (ords, ties) that is
    not above it."""
    high = np.searchsorted(ords, ord_, "right") - 1
    low = np.searchsorted(ords, ord_, "left") - 1  # the last bound of a smaller ord
    while (open_ := low < high).any():  # among bounds of this very ord
        mid = (low + high + 1) // 2
        fits = ties[mid] <= tie
        low, high = np.where(open_ & fits, mid, low), np.where(open_ & ~fits, mid - 1, high)
    return low


def _paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (bucket, own, id, text) in order; a row that is not ``own`` only
    ends its bucket."""
    names = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    held = None  # (bucket, id, text, sketch) that waits for its next
    out: list[tuple] = []

    def flush() -> pa.RecordBatch:
        rows = out.copy()
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names)

    for batch in batches:
        for bucket, own, doc, text in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            waiting = held is not None and held[0] == bucket
            if not waiting and not own:
                continue  # a second end row
            sk = sketch(text)
            if waiting:
                _, first, before, a = held
                half = len(before) // 2
                edited = before[: len(before) - half] + text[:half]
                b = sketch(edited)
                sha = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
                out.append((first, len(before), sha, encode(a), encode(b), likeness(a, b), likeness(a, sk)))
                if len(out) >= 512:
                    yield flush()
            held = (bucket, doc, text, sk) if own else None
    yield flush()


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text and of the text whose last half is replaced
    by the start of the next document.

    One shuffle of the texts.  Buckets are ranges of (id, hash of the text), so
    also the rows of one id, or without one, are dealt to many; they are taken
    from a range partitioning of these keys alone, and each begins at a row that
    is there.  That first row also goes to the bucket before.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    base = base.withColumns({"ord": F.coalesce("id", F.lit((1 << 63) - 1)), "tie": F.xxhash64("text")})
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = base.select("ord", "tie").repartitionByRange(parts, "ord", "tie").groupBy(F.spark_partition_id()).agg(F.min(F.struct("ord", "tie")).alias("first"))
    first = ranges.select("first.ord", "first.tie").toArrow().sort_by([("ord", "ascending"), ("tie", "ascending")])
    bounds = spark.sparkContext.broadcast((first.column("ord").to_numpy(), first.column("tie").to_numpy()))  # 16 bytes a bucket

    @F.pandas_udf("long")
    def place(ord_: pd.Series, tie: pd.Series) -> pd.Series:
        """Twice the bucket, and one for a row that begins it."""
        ords, ties = bounds.value
        at = _places(ords, ties, ord_.to_numpy(), tie.to_numpy())
        return pd.Series(2 * at + ((ords[at] == ord_.to_numpy()) & (ties[at] == tie.to_numpy())))

    last = max(0, first.num_rows - 1)
    places = base.withColumn("place", place("ord", "tie")).withColumns({"at": (F.col("place") / 2).cast("int"), "starts": F.col("place") % 2 == 1})
    # (bucket, late): the lowest row of all ends the last bucket
    before = F.when(F.col("at") > 0, F.struct((F.col("at") - 1).alias("b"), F.lit(0).alias("late"), F.lit(False).alias("own"))).otherwise(
        F.struct(F.lit(last).alias("b"), F.lit(1).alias("late"), F.lit(False).alias("own"))
    )
    here = F.struct(F.col("at").alias("b"), F.lit(0).alias("late"), F.lit(True).alias("own"))
    rows = places.withColumn("p", F.explode(F.when(F.col("starts"), F.array(here, before)).otherwise(F.array(here))))
    rows = rows.select(F.col("p.b").alias("b"), F.col("p.own").alias("own"), "id", "text", F.col("p.late").alias("late"), "ord", "tie")
    order = ["b", "late", "ord", "tie", F.desc("own"), "text"]
    rows = rows.repartition(max(1, parts // 4), "b").sortWithinPartitions(*order).select("b", "own", "id", "text")
    schema = "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return rows.mapInArrow(_paired, schema).withColumnRenamed("id", id_col)
