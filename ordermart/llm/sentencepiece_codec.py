"""SentencePiece encoding and decoding by the method of the model file.

Pieces and scores come from a SentencePiece model file.  A text is normalised
as that model says (dummy prefix, spaces to U+2581).

Segmentations are found from left to right by a streaming Viterbi search.  Only
a window of about the longest piece's length is live: whenever the backpointers
of all live positions pass one boundary, the pieces before it are final and are
given out at once, so memory does not grow with the text.

For a unigram model the best last piece at a position is the one of highest
total score; a character no piece covers costs the lowest score less 10 and is
given as byte pieces (``StreamingViterbi``).

The scores of a BPE model are merge ranks, no log probabilities: its ids are
those of its merges, the best-ranked pair of neighbours first and of equal ones
the leftmost.  Pieces are such a segmentation exactly if the merges of every two
neighbours, taken alone, leave the two apart; so a piece may follow another only
then, each position has one surviving last piece, and the search gives the ids of
the merges (``MergeViterbi``).

No piece crosses from a word to the next (checked when the model is read), so
every word border is such a boundary; segmentations of short words are
remembered.  Ties go to the earlier boundary (the longer last piece).

Defined cases: null and empty texts have no ids; repeated rows get equal rows;
other columns are not read; an empty table gives no rows.  Texts are encoded
as they are; decoding gives the normalised text back, byte for byte, with a space
for each U+2581, so ``round_trip`` is false for a text that holds one itself.
"""

from __future__ import annotations

import hashlib
import itertools
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
_UNKNOWN_COST = 10.0
#: Live boundaries are compared every so many characters.
_STRIDE = 64
CACHE_WORDS = 500_000
_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
#: Pairs of pieces of which it is known whether they follow each other.
PAIRS = 500_000
_CACHE_CHARS = 32
#: Characters held while a word border is looked for.
_CHUNK = 1 << 16


def content_of(model: str | bytes) -> bytes:
    """A model file's content, given that or its path."""
    if isinstance(model, bytes):
        return model
    with open(model, "rb") as f:
        return f.read()


class Model:
    def __init__(self, model: str | bytes):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=content_of(model))
        n = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        self.byte = {}
        self.of_id: list[bytes] = []
        self.scores: dict[str, tuple[float, int]] = {}
        for i, p in enumerate(self.pieces):
            if sp.is_byte(i):
                self.byte[int(p[3:5], 16)] = i
                self.of_id.append(bytes([int(p[3:5], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.of_id.append(b"")
            else:
                self.scores[p] = (sp.get_score(i), i)
                self.of_id.append(p.encode())
        self.unknown = sp.unk_id()
        self.longest = max(map(len, self.scores))
        self.unknown_score = min(s for s, _ in self.scores.values()) - _UNKNOWN_COST
        # a piece with a space inside would let a word border be no boundary
        self.by_word = not any(SPACE in p.lstrip(SPACE) for p in self.scores)

    def ids_of(self, piece: str) -> list[int]:
        got = self.scores.get(piece)
        if got:
            return [got[1]]
        return [self.byte.get(b, self.unknown) for b in piece.encode("utf-8", "surrogatepass")]


class StreamingViterbi:
    """``feed`` characters, get ids as they become final; ``close`` at the end."""

    def __init__(self, model: Model):
        self.model = model
        self.widest = 0  # characters held at most so far
        self.start()

    def start(self) -> None:
        self.text = ""  # characters from the last final boundary on
        self.best = [0.0]  # score at each boundary since then
        self.back = [0]  # where the best last piece begins

    def feed(self, chars: str) -> Iterator[int]:
        get, longest = self.model.scores.get, self.model.longest
        for c in chars:
            self.text += c
            j = len(self.text)
            text, best = self.text, self.best
            top, at = best[j - 1] + self.model.unknown_score, j - 1
            for i in range(max(0, j - longest), j):
                got = get(text[i:j])
                if got is not None:
                    s = best[i] + got[0]
                    if s > top or (s == top and i < at):
                        top, at = s, i
            best.append(top)
            self.back.append(at)
            if j % _STRIDE == 0:
                yield from self._commit()
            self.widest = max(self.widest, len(self.text))

    def _path(self, end: int) -> list[int]:
        cuts = [end]
        while cuts[-1]:
            cuts.append(self.back[cuts[-1]])
        return cuts[::-1]

    def _commit(self) -> Iterator[int]:
        """Give out the pieces before the last boundary of all live paths."""
        j = len(self.text)
        common = None
        for end in range(max(0, j - self.model.longest + 1), j + 1):
            cuts = set(self._path(end))
            common = cuts if common is None else common & cuts
        at = max(common)
        if at:
            yield from self._ids(at)
            self.text, self.best = self.text[at:], [b - self.best[at] for b in self.best[at:]]
            # boundaries before ``at`` are no longer on any live path
            self.back = [0, *(max(0, b - at) for b in self.back[at + 1 :])]

    def _ids(self, end: int) -> Iterator[int]:
        cuts = self._path(end)
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield from self.model.ids_of(self.text[a:b])

    def close(self) -> Iterator[int]:
        yield from self._ids(len(self.text))
        self.start()


def merged(run: str, scores: dict[str, tuple[float, int]]) -> list[str]:
    """The pieces that merges leave: the best-ranked pair first, the leftmost
    of equal ones."""
    get, none = scores.get, (-np.inf, -1)
    parts = list(run)
    pairs = [get(a + b, none)[0] for a, b in itertools.pairwise(parts)]
    while pairs:
        top = max(pairs)
        if top == none[0]:
            break
        i = pairs.index(top)
        parts[i] += parts.pop(i + 1)
        del pairs[i]
        if i:
            pairs[i - 1] = get(parts[i - 1] + parts[i], none)[0]
        if i < len(pairs):
            pairs[i] = get(parts[i] + parts[i + 1], none)[0]
    return parts


def endings(pieces: Iterable[str]) -> tuple[dict[str, str], dict[str, str]]:
    """For each beginning of a piece, and the empty text, the longest piece that
    it ends with (empty: none); and for each piece the next shorter one that it
    ends with, at least its last character."""
    same = {p: p for p in pieces}  # one object a piece, whose hash is known
    longest = {p[:n]: "" for p in same for n in range(len(p) + 1)}
    for text in longest:
        longest[text] = next((same[text[i:]] for i in range(len(text)) if text[i:] in same), "")
    return longest, {p: next((same[p[i:]] for i in range(1, len(p)) if p[i:] in same), p[-1]) for p in same if len(p) > 1}


class MergeViterbi(StreamingViterbi):
    """The search for a BPE model: the last piece of each prefix."""

    def __init__(self, model: Model):
        self.apart: dict[tuple[str, str], bool] = {}
        self.ending, self.shorter = endings(model.scores)
        super().__init__(model)

    def start(self) -> None:
        super().start()
        self.last = ""  # the piece before the window

    def _follows(self, a: str, b: str) -> bool:
        """Whether merges leave the pieces ``a`` and ``b`` apart."""
        got = self.apart.get((a, b))
        if got is None:
            if len(self.apart) >= PAIRS:
                self.apart.clear()
            got = self.apart[a, b] = merged(a + b, self.model.scores) == [a, b]
        return got

    def feed(self, chars: str) -> Iterator[int]:
        scores, longest, known, follows = self.model.scores, self.model.longest, self.apart.get, self._follows
        for c in chars:
            self.text += c
            text, back = self.text, self.back
            j = len(text)
            for i in range(max(0, j - longest), j):
                piece = text[i:j]
                if piece in scores or i == j - 1:
                    before = text[back[i] : i] if i else self.last
                    free = not before or known((before, piece))
                    if free or free is None and follows(before, piece):
                        back.append(i)
                        break
            if j % _STRIDE == 0:
                yield from self._commit()
            self.widest = max(self.widest, len(self.text))

    def short(self, word: str) -> list[str]:
        """The pieces of a word within which nothing would be given out: the
        same search, without the window.  Only pieces that the text so far ends
        with are tried, the longest first."""
        ending, shorter, known, follows = self.ending, self.shorter, self.apart.get, self._follows
        last, held = [""], ""  # held: the longest beginning of a piece that the text ends with
        for j, c in enumerate(word, 1):
            held += c
            piece = ending.get(held)
            while piece is None:
                held = held[1:]
                piece = ending.get(held)
            piece = piece or c
            while (i := j - len(piece)) > 0:
                free = known((last[i], piece))
                if free or free is None and follows(last[i], piece):
                    break
                piece = shorter.get(piece)
            last.append(piece)
        pieces, j = [], len(word)
        while j:
            pieces.append(last[j])
            j -= len(last[j])
        return pieces[::-1]

    def _commit(self) -> Iterator[int]:
        j = len(self.text)
        common = set.intersection(*(set(self._path(end)) for end in range(max(0, j - self.model.longest + 1), j + 1)))
        at = max(common)
        if at:
            yield from self._ids(at)
            self.last = self.text[self.back[at] : at]
            self.text, self.back = self.text[at:], [0, *(max(0, b - at) for b in self.back[at + 1 :])]


def normalise(text: str) -> str:
    """Dummy prefix, and spaces as U+2581."""
    return SPACE + text.replace(" ", SPACE) if text else ""


class Codec:
    def __init__(self, model: str | bytes):
        self.model = Model(model)
        self.search = StreamingViterbi(self.model)
        self.known: dict[str, list[int]] = {}
        self.raw: dict[str, bytes] = {}  # of a word without its space, little-endian
        self.old: dict[str, bytes] = {}  # the generation before
        self.marks: dict[str, bytes] = {}
        self.bridged: set[str] | None = None  # characters that some piece holds side by side

    def packed(self, text: str) -> bytes:
        """The ids of a whole text as little-endian unsigned 32-bit numbers."""
        if not self.model.by_word or SPACE in text or "  " in text or not text or " " in (text[0], text[-1]):
            return np.fromiter(itertools.chain.from_iterable(self.encode(text)), "<u4").tobytes()
        words, raw = text.split(" "), self.raw
        missing = set(words).difference(raw)
        brief = [w for w in missing if self._learn(w)]
        out = b"".join(map(raw.__getitem__, words))
        for w in brief:
            del raw[w]
        if len(raw) > CACHE_WORDS:  # common words move on, others are forgotten
            self.raw, self.old = {}, raw
        return out

    def _learn(self, w: str) -> bool:
        """Put the ids of a word into ``raw``; whether they are not to stay:
        those of long words, and of words whose last marks no piece joins to the
        letters before, which are found again by their two parts."""
        raw, old = self.raw, self.old
        core = w.rstrip(_MARKS)
        n = len(core)
        if 0 < n < len(w) and n <= _CACHE_CHARS and self.bridged is not None and core[-1] + w[n] not in self.bridged:
            if core not in raw:
                got = old.get(core)
                raw[core] = got if got is not None else self._packed_word(SPACE + core)
            marks = w[n:]
            if marks not in self.marks:
                if len(self.marks) > 10_000:
                    self.marks.clear()
                self.marks[marks] = self._packed_word(marks)
            raw[w] = raw[core] + self.marks[marks]
            return True
        got = old.get(w)
        raw[w] = got if got is not None else self._packed_word(SPACE + w)
        return len(w) > _CACHE_CHARS

    def _segment(self, word: str) -> list[int]:
        return [*self.search.feed(word), *self.search.close()]

    def _packed_word(self, word: str) -> bytes:
        return np.array(self._segment(word), "<u4").tobytes()

    def _word(self, word: str) -> list[int]:
        ids = self.known.get(word)
        if ids is None:
            ids = self._segment(word)
            if len(word) <= _CACHE_CHARS:
                if len(self.known) >= CACHE_WORDS:
                    self.known.clear()
                self.known[word] = ids
        return ids

    def encode(self, text: str | None) -> Iterator[list[int]]:
        """Ids of a whole text, a word at a time."""
        text = normalise(text or "")
        if not text:
            return
        if not self.model.by_word:
            for at in range(0, len(text), _CHUNK):
                yield [*self.search.feed(text[at : at + _CHUNK])]
            yield [*self.search.close()]
            return
        # a word: a run of spaces and what follows up to the next space
        run, known = "", self.known
        for part in text.split(SPACE)[1:]:
            if not part:
                run += SPACE
                continue
            word = run + SPACE + part
            run = ""
            ids = known.get(word)
            yield ids if ids is not None else self._word(word)
        if run:
            yield self._word(run)

    def decode(self, ids: list[int]) -> str:
        """The text whose normal form the ids are."""
        of = self.model.of_id
        text = b"".join(map(of.__getitem__, ids)).decode("utf-8", "surrogatepass").replace(SPACE, " ")
        return text[1:] if text[:1] == " " else text


class _PackedIds(dict):
    """The ids of each piece met so far, little-endian."""

    def __init__(self, model: Model):
        self.model = model

    def __missing__(self, piece: str) -> bytes:
        packed = self[piece] = np.array(self.model.ids_of(piece), "<u4").tobytes()
        return packed


class MergeCodec(Codec):
    """Ids of a BPE model, those of its merges."""

    def __init__(self, model: str | bytes):
        super().__init__(model)
        self.search = MergeViterbi(self.model)
        self.packed_of = _PackedIds(self.model)
        self.bridged = {p[i : i + 2] for p in self.model.scores for i in range(len(p) - 1)}

    def _segment(self, word: str) -> list[int]:
        if len(word) >= _STRIDE:
            return super()._segment(word)
        return [i for p in self.search.short(word) for i in self.model.ids_of(p)]

    def _packed_word(self, word: str) -> bytes:
        if len(word) >= _STRIDE:
            return super()._packed_word(word)
        return b"".join(map(self.packed_of.__getitem__, self.search.short(word)))


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a protobuf message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        else:
            size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
            yield tag >> 3, data[at : at + size]
            at += size


def is_bpe(model: bytes) -> bool:
    """Whether trainer_spec.model_type (field 2, its field 3) is BPE."""
    return any(v == 2 for k, spec in _fields(model) if k == 2 for n, v in _fields(spec) if n == 3)


_CODECS: dict[str, Codec] = {}


def codec(model: str | bytes) -> Codec:
    """The codec of a model, made once a process."""
    content = content_of(model)
    key = hashlib.md5(content, usedforsecurity=False).hexdigest()
    if key not in _CODECS:
        _CODECS[key] = (MergeCodec if is_bpe(content) else Codec)(content)
    return _CODECS[key]


def _sent(frame: DataFrame, model: str) -> Broadcast:
    """The driver's model file, for the tasks."""
    return frame.sparkSession.sparkContext.broadcast(content_of(model))


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids) for each row."""
    sent = _sent(docs, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(sent.value)
        for batch in batches:
            ids = [[i for word in own.encode(t) for i in word] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["id", "ids"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "id long, ids array<int>").withColumnRenamed("id", id_col)


def decode(tokens: DataFrame, model: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, text) for each row."""
    sent = _sent(tokens, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(sent.value)
        for batch in batches:
            text = [own.decode(x or []) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(text, pa.string())], ["id", "text"])

    rows = tokens.select(F.col(id_col).cast("long").alias("id"), F.col(ids_col).alias("ids"))
    return rows.mapInArrow(run, "id long, text string").withColumnRenamed("id", id_col)


def round_trip(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, n_chars, ids_crc32, round_trip): ids of the whole text as
    a digest, and whether decoding them gives the text back."""
    sent = _sent(docs, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(sent.value)
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                text = text or ""
                raw = own.packed(text)
                rows.append((len(raw) // 4, len(text), zlib.crc32(raw), own.decode(np.frombuffer(raw, "<u4").tolist()) == text))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds))], ["id", "n_tokens", "n_chars", "ids_crc32", "round_trip"]
            )

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "id long, n_tokens long, n_chars long, ids_crc32 long, round_trip boolean").withColumnRenamed("id", id_col)
