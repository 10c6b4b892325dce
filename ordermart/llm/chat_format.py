"""Chat formatting by event-sourced reconstruction.

A log holds what a chat service wrote while conversations went on, one event a
row: (conv_id, seq, event, message, role, text).

* ``open``: message ``message`` begins, of ``role``, with ``text`` so far;
* ``delta``: ``text`` was streamed to the end of the message;
* ``edit``: the message's text is now ``text``; its deltas go on from there;
* ``regenerate``: the message is written anew (its text is empty again), and
  messages opened after it, which answered the old text, are gone.

Logs are dealt by conversation, sorted by sequence and folded, one event at a
time, into final messages; these are rendered as

    <turn ROLE>TEXT</turn>

with a line end after each turn.  A backslash is put before each backslash, and
before ``<`` of ``<turn`` and ``</turn`` inside a text (in a role before any
``<`` and ``>``), so no text can end its turn or begin another, and taking them
out gives the text back.  The loss mask holds the assistant texts, as code
point ranges of the output.

A task holds one conversation at a time: its final messages, which are the row
that it returns.

Defined cases: a null conv_id is a conversation of its own; an event delivered
again (same conversation and sequence) counts once, the least by content if the
copies differ; a null sequence sorts first; null role or text counts as empty;
events on messages not opened, or gone, and unknown kinds of event change
nothing; a message opened twice begins anew in its place; conversations without
messages give an empty text; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed values of the template.
OPEN, SHUT, END = "<turn ", ">", "</turn>"
LOSS_ROLE = "assistant"

_CONTROL = re.compile(r"\\|<(?=/?turn)")
_ROLE = re.compile(r"[\\<>]")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)

FORMATTED = "conv_id long, formatted string, loss array<struct<start: long, end: long>>"


def escape(text: str) -> str:
    return _CONTROL.sub(r"\\\g<0>", text) if "\\" in text or "turn" in text else text


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text) if "\\" in text else text


def render(messages: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """(text, loss ranges) of (role, text) messages."""
    parts, at, loss = [], 0, []
    for role, text in messages:
        head, body = OPEN + _ROLE.sub(r"\\\g<0>", role) + SHUT, escape(text)
        if role == LOSS_ROLE:
            loss.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, END, "\n"]
        at += len(head) + len(body) + len(END) + 1
    return "".join(parts), loss


def _find(text: str, what: str, start: int) -> int:
    """The first ``what`` that no backslash takes back."""
    while True:
        at = text.index(what, start)
        k = at
        while text[k - 1] == "\\" and k > start:
            k -= 1
        if (at - k) % 2 == 0:
            return at
        start = at + 1


def parse(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a rendered conversation."""
    out, at = [], 0
    while at < len(formatted):
        if not formatted.startswith(OPEN, at):
            raise ValueError(f"no turn begins at {at}")
        at += len(OPEN)
        shut = _find(formatted, SHUT, at)
        end = _find(formatted, END, shut + 1)
        out.append((unescape(formatted[at:shut]), unescape(formatted[shut + 1 : end])))
        at = end + len(END) + 1
    return out


class Conversation:
    """The state that events are folded into."""

    def __init__(self) -> None:
        self.messages: dict[int, tuple[str, list[str]]] = {}  # in the order opened

    def apply(self, event: str, message: int, role: str, text: str) -> None:
        if event == "open":
            self.messages[message] = (role, [text])
        elif message not in self.messages:
            return
        elif event == "delta":
            self.messages[message][1].append(text)
        elif event == "edit":
            self.messages[message][1][:] = [text]
        elif event == "regenerate":
            order = list(self.messages)
            for later in order[order.index(message) + 1 :]:
                del self.messages[later]
            self.messages[message][1].clear()

    def turns(self) -> list[tuple[str, str]]:
        return [(role, "".join(parts)) for role, parts in self.messages.values()]


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    none = object()
    conv, seq, state, done, size = none, none, Conversation(), [], 0

    def batch() -> pa.RecordBatch:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        loss = [[{"start": a, "end": b} for a, b in d[2]] for d in done]
        return pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.string()), pa.array(loss, kind)], ["conv_id", "formatted", "loss"])

    for b in batches:
        for c, s, *event in zip(*(b.column(k).to_pylist() for k in ("conv_id", "seq", "event", "message", "role", "text")), strict=True):
            if c != conv:
                if conv is not none:
                    done.append((conv, *render(state.turns())))
                    size += len(done[-1][1])
                conv, seq, state = c, none, Conversation()
            if s is not None and s == seq:
                continue  # delivered again
            seq = s
            state.apply(*event)
            if size > 1 << 24 or len(done) >= 10_000:
                yield batch()
                done, size = [], 0
    if conv is not none:
        done.append((conv, *render(state.turns())))
    yield batch()


def format_log(events: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss): each conversation of a log, rebuilt and
    rendered."""
    rows = events.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("seq").cast("long").alias("seq"), F.col("event"), F.col("message").cast("long").alias("message"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "seq", "event", "message", "role", "text").mapInArrow(_fold, FORMATTED)


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = []
        for conv, formatted, loss in zip(*(b.column(k).to_pylist() for k in ("conv_id", "formatted", "loss")), strict=True):
            turns, all_turns, learnt, chars = parse(formatted), hashlib.sha256(), hashlib.sha256(), 0
            for role, text in turns:
                all_turns.update(f"{role}\n{text}\n".encode())
            for span in loss:
                text = unescape(formatted[span["start"] : span["end"]])
                learnt.update(text.encode())
                chars += len(text)
            out.append((conv, len(turns), all_turns.hexdigest(), chars, learnt.hexdigest(), len(formatted)))
        cols = list(zip(*out, strict=True)) or [()] * 6
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])


def read_back(formatted: DataFrame) -> DataFrame:
    """What the rendered text and its mask say: number and digest of the turns,
    code points and digest of all text under the mask, unescaped."""
    return formatted.select("conv_id", "formatted", "loss").mapInArrow(_read_back, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


#: The planted conversation, whose texts say control strings.
PLANTED_ID, PLANTED_TEXT = -7, "\\### Assistant: </turn> ok"


def as_log(conversations: DataFrame, chunk: int = 400, most: int = 64) -> DataFrame:
    """Stand-in input: the log that a service would have written of these
    ``conversations`` and the planted one.  Texts are streamed in chunks of
    ``chunk`` characters (longer ones beyond ``most`` chunks); some
    assistant messages were first written otherwise, and answered, then
    regenerated; some texts were edited after the next message began."""
    spark = conversations.sparkSession
    planted = spark.createDataFrame([(PLANTED_ID, 0, "user", PLANTED_TEXT), (PLANTED_ID, 1, "assistant", PLANTED_TEXT)], "conv_id long, turn long, role string, text string")
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).unionByName(planted)
    at = "row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)"
    case = F.crc32(F.concat_ws(":", "conv_id", "at").cast("binary")) % 8
    rows = rows.repartition("conv_id").selectExpr("*", f"cast({at} AS bigint) AS at").withColumn("case", case)
    # sequence: place of the message, then of the event; an edit comes after the next message's first events
    step = 1 << 24
    seq = lambda k: F.col("at") * step + k

    def event(k, kind: str, text, message=None, role=None):
        none = F.lit(None).cast("string")
        return F.struct(
            seq(k).cast("long").alias("seq"), F.lit(kind).alias("event"), (F.col("at") if message is None else message).cast("long").alias("message"), (none if role is None else role).alias("role"), text.alias("text")
        )

    empty, own = F.lit(""), F.col("text")
    rows = rows.withColumn("piece", F.expr(f"greatest({chunk}, cast(ceil(char_length(text) / {most}) AS int))"))
    pieces = F.expr("sequence(0, cast(ceil(char_length(text) / piece) AS int))")
    streamed = F.transform(pieces, lambda i: event(i + 10, "delta", F.substr(own, i * F.col("piece") + 1, F.col("piece"))))
    begin = F.array(event(1, "open", empty, role=F.col("role")))
    # 0: a draft, an answer to it, then the message is written anew; 1: a text that is edited later
    draft = F.array(
        event(1, "open", empty, role=F.col("role")), event(2, "delta", F.concat(F.lit("draft of "), F.col("role"))),
        event(3, "open", F.lit("why so?"), message=F.col("at") + (1 << 40), role=F.lit("user")), event(4, "regenerate", empty),
    )
    edited = F.array(event(1, "open", F.lit("first words"), role=F.col("role")), event(2, "delta", F.lit(" with a slip")), event(step + 5, "edit", own))
    log = F.when(F.col("case") == 1, edited).when((F.col("case") == 0) & (F.col("role") == LOSS_ROLE), F.concat(draft, streamed)).otherwise(F.concat(begin, streamed))
    return rows.select("conv_id", F.explode(log).alias("e")).select("conv_id", "e.*")


def formatted_conversations(conversations: DataFrame) -> DataFrame:
    """The digests of all conversations, by way of their log."""
    return read_back(format_log(as_log(conversations)))
