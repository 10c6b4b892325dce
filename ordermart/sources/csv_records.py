"""CSV records over many splits a file, line breaks inside quotes included.

Files are read as lines, so a large file has many splits.  A line break ends a
record only outside quotes, and whether a split begins inside quotes depends on
all text before it.  So each line is reduced to what it does to that state, a
map of {outside, inside} to itself with the quoting rules of Python's ``csv``
(a quote opens a field only at its begin, ``""`` inside quotes is a quote, what
follows a closing quote belongs to the field, other quotes are text):

    outside stays / inside stays      no quote in the line (nearly all lines)
    swapped                           e.g. a quoted field begins and goes on
    always outside, always inside

Such maps compose, so the state is carried by a scan in two levels: over the
quoted lines of each chunk of a split (``2 ** CHUNK_BITS`` lines at most, so a
window holds no more, however large the split), then over the chunks of each
file in order.  Only the small columns of lines with quotes are dealt anew.
Chunks in which no record goes over a line end (nearly all, as a rule) yield
their lines as records where they are; the lines of the others are dealt by
chunk, get their record's first line, and are put together by record: those of
records that end in their chunk at once, the few others by a shuffle.

Lines are landed once as Parquet with their position, because the position of
a line in a second text scan may differ when the number of cores has changed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import dealt, landed, new_run_dir

#: A record of more characters than this is not put together: its lines come
#: back one by one, marked.  (Python's own reader refuses a field of 131,072.)
MAX_RECORD = 16 << 20

_FIELD = r'(?:"[^"]*+(?:""[^"]*+)*+"[^,]*+|[^",][^,]*+|)'
#: Lines after which no quote is open, from outside and from inside quotes.
#: Possessive loops only: no backtracking, no recursion, whatever the length.
_SHUT = rf"\A{_FIELD}(?:,{_FIELD})*+\z"
_SHUT_INSIDE = rf'\A[^"]*+(?:""[^"]*+)*+"[^,]*+(?:,{_FIELD})*+\z'
#: A comma and a field as it stands, the last one perhaps with its quote open.
_SPLIT = r',("[^"]*+(?:""[^"]*+)*+(?:"[^,]*+|\z)|[^",][^,]*+|)'
#: The text between a field's quotes.
_QUOTED = r'\A"([^"]*+(?:""[^"]*+)*+)'

#: What a line does: bit 0 the state after it from outside, bit 1 from inside.
SAME, SWAP, OUTSIDE, INSIDE = 2, 1, 0, 3
POSITION = ("file", "block", "row")
CHUNK_BITS = 15
CHUNK = ("file", "block", "chunk")


def line_kind(line: Column) -> Column:
    quoted = F.when(line.rlike(_SHUT), 0).otherwise(1) + F.when(line.rlike(_SHUT_INSIDE), 0).otherwise(2)
    return F.when(F.instr(line, '"') == 0, SAME).otherwise(quoted).cast("int")


def raw_fields(record: Column) -> Column:
    """The fields of one record as they stand, quotes and all."""
    led = F.concat(F.lit(","), record)
    return F.when(F.instr(record, '"') == 0, F.split(record, ",", -1)).otherwise(F.regexp_extract_all(led, F.lit(_SPLIT), F.lit(1)))


def unquoted(field: Column) -> Column:
    """The text of a raw field."""
    body = F.substr(field, F.lit(2))
    end = F.instr(body, '"')
    inner = F.regexp_extract(field, _QUOTED, 1)
    hard = F.concat(F.replace(inner, F.lit('""'), F.lit('"')), F.substr(field, F.length(inner) + 3))
    # most have no quote but the two around them
    quoted = F.when(end == 0, body).when(end == F.length(body), F.substr(body, F.lit(1), end - 1)).otherwise(hard)
    return F.when(field.startswith('"'), quoted).otherwise(field)


def fields(record: Column) -> Column:
    """The fields of one record, as an array of text."""
    return F.transform(raw_fields(record), unquoted)


def land_lines(spark: SparkSession, path: str | list[str], needed: list[str]) -> DataFrame:
    """(file, block, row, line, kind, head) of every line, written once.
    ``head``: the line, if it may be a header with the ``needed`` names."""
    line = F.col("value")
    named = F.lit(True)
    for n in needed:
        named = named & (F.instr(line, n) > 0)
    text = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"), line_kind(line).alias("kind")
    )
    out = text.select("file", "block", "row", F.col("value").alias("line"), "kind", F.when((F.col("block") == 0) & named & F.col("kind").isin(OUTSIDE, SAME), line).alias("head"))
    where = new_run_dir(spark, "csv-lines")
    out.write.option("compression", "zstd").parquet(where)
    return spark.read.schema(out.schema).parquet(where)


def _chunk() -> Column:
    """Rows of a split are numbered one after the other."""
    return F.shiftright("row", CHUNK_BITS).alias("chunk")


def _scan(df: DataFrame, by: tuple[str, ...], order: tuple[str, ...], upto: int) -> DataFrame:
    """The composition of the kinds of each group's rows in order, from its
    first row up to ``upto`` rows from the current one: ``fixed`` (whether the
    state is then the same from both sides) and ``state`` (that state, or the
    state from outside)."""
    w = Window.partitionBy(*by).orderBy(*order)
    df = df.withColumn("__n", F.sum((F.col("kind") == SWAP).cast("long")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    before = w.rowsBetween(Window.unboundedPreceding, upto)
    known = F.when(F.col("kind").isin(OUTSIDE, INSIDE), F.struct(F.col("__n").alias("n"), (F.col("kind") == INSIDE).cast("long").alias("v")))
    df = df.withColumn("__k", F.last(known, ignorenulls=True).over(before)).withColumn("__m", F.coalesce(F.last("__n").over(before), F.lit(0)))
    swaps = F.col("__m") - F.coalesce(F.col("__k.n"), F.lit(0))
    state = F.pmod(F.coalesce(F.col("__k.v"), F.lit(0)) + swaps, F.lit(2))
    return df.withColumns({"fixed": F.col("__k").isNotNull(), "state": state}).drop("__n", "__k", "__m")


def _from(start: Column) -> Column:
    """The state after a composition, from ``start``."""
    return F.when(F.col("fixed"), F.col("state")).otherwise(F.pmod(F.col("state") + start, F.lit(2)))


def _open_chunks(lines: DataFrame) -> DataFrame:
    """(file, block, chunk, start) of the chunks that a record crosses a line end in,
    with the state in which they begin."""
    events = _scan(lines.where(F.col("kind") != SAME).select(*POSITION, "kind", _chunk()), CHUNK, ("row",), 0)
    inside = F.col("state") == 1
    of_chunk = events.groupBy(*CHUNK).agg(
        F.max(F.struct("row", "fixed", "state")).alias("last"), F.max(F.col("fixed") & inside).alias("opens"), F.max(~F.col("fixed") & inside).alias("opens_from_outside")
    )
    chunks = lines.select("file", "block", _chunk()).distinct().join(of_chunk, list(CHUNK), "left")
    kind = F.when(F.col("last").isNull() | (~F.col("last.fixed") & (F.col("last.state") == 0)), SAME).when(~F.col("last.fixed"), SWAP).when(F.col("last.state") == 1, INSIDE).otherwise(OUTSIDE)
    chunks = _scan(chunks.withColumn("kind", kind), ("file",), ("block", "chunk"), -1).withColumn("start", _from(F.lit(0)))
    is_open = (F.col("start") == 1) | F.coalesce("opens", F.lit(False)) | F.coalesce("opens_from_outside", F.lit(False))
    return chunks.where(is_open).select(*CHUNK, "start")


def records(lines: DataFrame, max_record: int = MAX_RECORD) -> tuple[DataFrame, DataFrame]:
    """(records, lines of records too long), both (file, block, row, line): a
    record stands at its first line's position, its lines joined by ``\\n``."""
    plain = lines.select(*POSITION, "line", "kind", _chunk())
    dirty = landed(_open_chunks(lines), "csv-open")
    alone = plain.join(dirty, list(CHUNK), "left_anti").drop("kind", "chunk")
    part = plain.join(dirty, list(CHUNK))
    n_lines = part.count()
    part = _scan(dealt(part, n_lines, *CHUNK), CHUNK, ("row",), -1)
    first = _from(F.col("start")) == 0
    own = F.last(F.when(first, F.col("row")), ignorenulls=True).over(Window.partitionBy(*CHUNK).orderBy("row").rowsBetween(Window.unboundedPreceding, 0))
    part = part.withColumn("record", own)
    # records that end in their chunk are put together there, without another
    # shuffle; the lines of the others (the last of each chunk, or too long) are not
    chars = F.sum(F.length("line") + 1).over(Window.partitionBy(*CHUNK, "record"))
    ended = F.coalesce((F.col("record") < F.max("record").over(Window.partitionBy(*CHUNK))) & (chars <= max_record), F.lit(False))
    pieces = part.withColumn("at", F.when(~ended, F.col("row"))).groupBy(*CHUNK, "record", "at").agg(F.sort_array(F.collect_list(F.struct("row", "line"))).alias("l"))
    pieces = landed(pieces.select(*CHUNK, F.coalesce("at", "record").alias("row"), F.array_join(F.col("l.line"), "\n").alias("line"), "record", F.col("at").isNull().alias("ended")), "csv-part")
    ended, part = pieces.where("ended").select(*POSITION, "line"), pieces.where("NOT ended").select(*POSITION, "chunk", "line", "record")
    n_lines = part.count()
    # lines that go on with a record of an earlier chunk; the others are not joined
    last = part.groupBy(*CHUNK).agg(F.max("record").alias("last"))
    carried = last.select(*CHUNK, F.last("last", ignorenulls=True).over(Window.partitionBy("file").orderBy("block", "chunk").rowsBetween(Window.unboundedPreceding, -1)).alias("carried"))
    gone_on = part.where(F.col("record").isNull()).join(carried, list(CHUNK)).withColumn("record", F.col("carried")).select(*part.columns)
    part = part.where(F.col("record").isNotNull()).unionByName(gone_on).drop("chunk")
    # fewer than (characters of input) / max_record ids
    long = F.broadcast(part.groupBy("record").agg(F.sum(F.length("line") + 1).alias("n")).where(F.col("n") > max_record).select("record"))
    whole = dealt(part.join(long, "record", "left_anti"), n_lines, "file", "record").groupBy("file", "record").agg(F.sort_array(F.collect_list(F.struct("block", "row", "line"))).alias("l"))
    joined = whole.select("file", F.col("l")[0]["block"].alias("block"), F.col("record").alias("row"), F.array_join(F.col("l.line"), "\n").alias("line"))
    return alone.unionByName(ended).unionByName(joined), part.join(long, "record", "left_semi").select(*POSITION, "line")


def headers(lines: DataFrame, names: list[str]) -> DataFrame:
    """(file, row, head, at) of each file: its first line and the places (from
    1, 0: absent) of ``names`` in it.  A name that stands twice counts where it
    stands last."""
    first = F.broadcast(lines.where(F.col("block") == 0).groupBy("file").agg(F.min("row").alias("row")))
    first = lines.join(first, ["file", "row"]).select("file", "row", "head")
    held = F.reverse(fields(F.regexp_replace("head", "^\ufeff", "")))
    first = first.withColumn("held", held)
    at = [F.when(F.array_position("held", n) > 0, F.size("held") - F.array_position("held", n) + 1).otherwise(0).cast("int") for n in names]
    return first.select("file", "row", "head", F.array(*at).alias("at"))
