"""WARC 1.1 files: writer, and a Spark data source (format ``warc``).

Reading: the driver lists the files under ``path`` and plans partitions of
about ``bytes_per_partition``.  Each record's header block is parsed first;
record type and header predicates (pushed filters on ``record_type``,
``target_uri``, ``record_id``, ``refers_to``) decide on it alone, and the block
of a record that is not wanted, or whose payload is not asked for, is skipped
without decoding: by a seek in plain files and, in gzip files of a member per
record, by the compressed length that the writer leaves in the member header
(the ``sl`` extra field of the WARC annex); members without it, which may hold
any number of records, are inflated in bounded pieces.  ``payload_bytes`` and ``payload_sha1`` are taken
from the payload itself; the declared digest must agree.

Files are opened through ``pyarrow.fs``, so local, HDFS and object-store paths
serve alike; executors write under the given folder, first under a name of the
task attempt, and the driver keeps those of the attempts that Spark commits.

Defined cases: null payloads are empty; null uris are written as
``urn:page:none`` and read back so; line breaks in header values become
spaces; repeated rows make a record each; an empty table makes no file and
reads back as no rows; a folder without files is an empty table.
"""

from __future__ import annotations

import base64
import hashlib
import posixpath
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, In, InputPartition, IsNotNull, WriterCommitMessage,
)
from pyspark.sql.types import StructType

from ..session import new_run_dir
from .common import HOT_KEYS, cut

SCHEMA = (
    "record_id string, record_type string, target_uri string, date string, refers_to string, content_type string, "
    "content_length long, declared_digest string, headers map<string,string>, payload binary, payload_bytes long, payload_sha1 string, file string, position long"
)
_NEEDS_PAYLOAD = {"payload", "payload_bytes", "payload_sha1"}
_PIECE = 1 << 16
_HEADER_OF = {"record_type": "warc-type", "target_uri": "warc-target-uri", "record_id": "warc-record-id", "refers_to": "warc-refers-to"}
#: A WARC file is closed beyond so many bytes.
FILE_BYTES = 1 << 28


def sha1_text(payload: bytes) -> str:
    """SHA-1 in upper-case base 32."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _line(value: str) -> str:
    return " ".join(str(value).splitlines()) if value is not None else ""


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as a gzip member that says how long it is."""
    head = "".join(f"{k}: {_line(v)}\r\n" for k, v in headers if v is not None)
    raw = b"WARC/1.1\r\n" + head.encode() + f"Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = packer.compress(raw) + packer.flush()
    extra = struct.pack("<2sHII", b"sl", 8, (24 + len(body) + 8) & 0xFFFFFFFF, len(raw) & 0xFFFFFFFF)
    head_gz = struct.pack("<BBBBIBB", 0x1F, 0x8B, 8, 4, 0, 0, 255) + struct.pack("<H", len(extra)) + extra
    return head_gz + body + struct.pack("<II", zlib.crc32(raw), len(raw) & 0xFFFFFFFF)


class _Member:
    """The inflated bytes of one gzip member, read a piece at a time."""

    def __init__(self, stream, start: int):
        self.stream, self.start, self.at, self.length = stream, start, start, None
        stream.seek(start)
        head = stream.read(10)
        if len(head) < 10 or head[:3] != b"\x1f\x8b\x08":
            raise ValueError(f"no gzip member at {start}")
        flags, self.at = head[3], start + 10
        if flags & 4:
            n = struct.unpack("<H", stream.read(2))[0]
            extra, self.at = stream.read(n), self.at + 2 + n
            while len(extra) >= 4:
                name, size = extra[:2], struct.unpack("<H", extra[2:4])[0]
                if name == b"sl" and size == 8:
                    self.length = struct.unpack("<I", extra[4:8])[0]
                extra = extra[4 + size :]
        for flag in (8, 16):  # name, comment
            if flags & flag:
                while (b := stream.read(1)) not in (b"\0", b""):
                    self.at += 1
                self.at += 1
        self.at += 2 if flags & 2 else 0
        stream.seek(self.at)
        self.inflate, self.ready, self.over = zlib.decompressobj(-15), b"", False

    def _more(self) -> bool:
        if self.over:
            return False
        piece = self.inflate.unconsumed_tail
        if not piece:
            piece = self.stream.read(_PIECE)
            self.at += len(piece)
        self.ready += self.inflate.decompress(piece, 1 << 20)
        if self.inflate.eof:
            self.over, self.at = True, self.at - len(self.inflate.unused_data) + 8
        elif not piece:
            raise ValueError("a gzip member is cut off")
        return True

    def header(self) -> bytes:
        while b"\r\n\r\n" not in self.ready and self._more():
            pass
        head, _, self.ready = self.ready.partition(b"\r\n\r\n")
        return head

    def read(self, n: int) -> bytes:
        parts, have = [self.ready], len(self.ready)
        while have < n:
            self.ready = b""
            if not self._more():
                break
            parts.append(self.ready)
            have += len(self.ready)
        whole = b"".join(parts)
        self.ready = whole[n:]
        return whole[:n]

    def follows(self, rest: int) -> bool:
        """Pass over the ``rest`` of a record; whether another one stands in
        the same member.  One that says its length holds a single record."""
        if self.length and self.length < 0xFFFF0000:
            return False
        rest += 4  # the two line ends after the block
        while rest > 0 and (self.ready or self._more()):
            part = min(rest, len(self.ready))
            self.ready, rest = self.ready[part:], rest - part
        while not self.ready and self._more():
            pass
        return bool(self.ready)

    def end(self, length: int) -> int:
        """Where the next member begins."""
        if self.length and self.length < 0xFFFF0000:
            return self.start + self.length
        while not self.over:
            self.ready = b""
            self._more()
        return self.at


class _Plain:
    """A record in a file that is not compressed."""

    def __init__(self, stream, start: int):
        self.stream, self.start = stream, start
        stream.seek(start)

    def header(self) -> bytes:
        got = b""
        while b"\r\n\r\n" not in got:
            piece = self.stream.read(4096)
            if not piece:
                break
            got += piece
        head, _, _ = got.partition(b"\r\n\r\n")
        self.block = self.start + len(head) + 4
        return head

    def read(self, n: int) -> bytes:
        self.stream.seek(self.block)
        return self.stream.read(n)

    def follows(self, rest: int) -> bool:
        return False

    def end(self, length: int) -> int:
        return self.block + length + 4


def parse_headers(block: bytes) -> tuple[str, dict[str, str]]:
    """(first line, headers by lower-case name) of a header block."""
    first, *lines = block.decode("utf-8", "replace").split("\r\n")
    out: dict[str, str] = {}
    last = None
    for line in lines:
        if line[:1] in (" ", "\t") and last:  # folded
            out[last] += " " + line.strip()
        elif ":" in line:
            last, _, value = line.partition(":")
            last = last.strip().lower()
            out[last] = value.strip()
    return first.strip(), out


def read_records(stream, size: int, wanted, payload: bool) -> Iterator[tuple[int, dict[str, str], bytes | None]]:
    """(position, headers, payload) of the records whose headers are wanted.
    Records of one gzip member have its position."""
    at = 0
    stream.seek(0)
    packed = stream.read(2) == b"\x1f\x8b"
    while at < size:
        one, more = (_Member if packed else _Plain)(stream, at), True
        length = 0
        while more:  # records of one member
            head = one.header()
            if not head.strip():
                break
            version, headers = parse_headers(head.lstrip())
            if not version.startswith("WARC/"):
                raise ValueError(f"no WARC record at {at}: {version[:40]!r}")
            length = rest = int(headers.get("content-length", 0))
            if wanted(headers):
                body = None
                if payload:
                    body = one.read(length)
                    rest -= len(body)
                    if rest:
                        raise ValueError(f"the record at {at} is cut off")
                    if headers.get("content-type", "").lower().replace(" ", "").startswith("application/http") and b"\r\n\r\n" in body:
                        body = body.partition(b"\r\n\r\n")[2]
                yield at, headers, body
            more = one.follows(rest)
        if not packed and not head.strip():
            break
        at = one.end(length)


def _filesystem(path: str) -> tuple[fs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))
    return fs.LocalFileSystem(), path


@dataclass
class _Files(InputPartition):
    files: list[tuple[str, int]]

    def __init__(self, files):
        super().__init__(None)
        self.files = files


def _test(column: str, values: list):
    """A check of the headers; a column that isn't there is null."""
    name = _HEADER_OF[column]
    return lambda headers: headers.get(name) in values


class WarcReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.names = [f.name for f in schema.fields]
        self.path = options["path"]
        self.most = int(options.get("bytes_per_partition", 1 << 27))
        self.parallel = int(options.get("parallelism", 1))
        self.tests: list[tuple[str, list]] = []

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 and f.attribute[0] in _HEADER_OF:
                self.tests.append((f.attribute[0], [f.value] if isinstance(f, EqualTo) else list(f.value)))
            elif isinstance(f, IsNotNull) and f.attribute[0] in ("record_type", "record_id"):
                continue
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        system, path = _filesystem(self.path)
        info = system.get_file_info(path)
        if info.type == fs.FileType.File:
            files = [(path, info.size)]
        else:
            listed = system.get_file_info(fs.FileSelector(path, recursive=True, allow_not_found=True))
            files = sorted((f.path, f.size) for f in listed if f.is_file and f.base_name.endswith((".warc", ".warc.gz")) and not f.base_name.startswith((".", "_")))
        most = max(1 << 20, min(self.most, sum(s for _, s in files) // self.parallel + 1))
        out: list[list[tuple[str, int]]] = [[]]
        used = 0
        for f in files:  # small files share a partition
            if out[-1] and used + f[1] > most:
                out.append([])
                used = 0
            out[-1].append(f)
            used += f[1]
        return [_Files(x) for x in out]

    def read(self, partition: _Files) -> Iterator[tuple]:
        system, _ = _filesystem(self.path)
        tests = [_test(c, v) for c, v in self.tests]
        payload = bool(_NEEDS_PAYLOAD & set(self.names))
        for path, size in partition.files:
            with system.open_input_file(path) as stream:
                for at, headers, body in read_records(stream, size, lambda h: all(t(h) for t in tests), payload):
                    row = {
                        "record_id": headers.get("warc-record-id"), "record_type": headers.get("warc-type"), "target_uri": headers.get("warc-target-uri"),
                        "date": headers.get("warc-date"), "refers_to": headers.get("warc-refers-to"), "content_type": headers.get("content-type"),
                        "content_length": int(headers.get("content-length", 0)), "declared_digest": headers.get("warc-payload-digest"), "headers": headers,
                        "payload": body, "file": posixpath.basename(path), "position": at,
                    }
                    if body is not None:
                        row["payload_bytes"], row["payload_sha1"] = len(body), sha1_text(body)
                        declared = headers.get("warc-payload-digest", "")
                        if declared.startswith("sha1:") and headers.get("warc-type") == "response" and declared[5:] != row["payload_sha1"]:
                            raise ValueError(f"{path} at {at}: the payload does not have its digest")
                    yield tuple(row.get(n) for n in self.names)


@dataclass
class _Written(WriterCommitMessage):
    files: list[str] = field(default_factory=list)


class WarcWriter(DataSourceWriter):
    """Rows (record_id, record_type, target_uri, date, refers_to, payload,
    payload_digest, payload_length) to files of a task each, rolled by size."""

    def __init__(self, schema: StructType, options: dict):
        self.names = [f.name for f in schema.fields]
        self.path, self.most = options["path"], int(options.get("file_bytes", FILE_BYTES))

    def write(self, rows: Iterator) -> _Written:
        import uuid

        from pyspark import TaskContext

        system, path = _filesystem(self.path)
        system.create_dir(path, recursive=True)
        part, out, stream, used = TaskContext.get().partitionId(), [], None, 0
        try:
            for r in rows:
                data = _as_record(dict(zip(self.names, r, strict=True)))
                if stream is None or used + len(data) > self.most:
                    if stream:
                        stream.close()
                    out.append(f"{path}/.part-{part:06d}-{len(out):04d}-{uuid.uuid4().hex}.warc.gz")
                    stream, used = system.open_output_stream(out[-1], compression=None), 0
                stream.write(data)
                used += len(data)
        finally:
            if stream:
                stream.close()
        return _Written(out)

    def commit(self, messages: list) -> None:
        """Files of committed attempts get their names; others stay hidden."""
        system, _ = _filesystem(self.path)
        for m in messages:
            for f in m.files if m else ():
                system.move(f, posixpath.join(posixpath.dirname(f), posixpath.basename(f)[1:]))

    def abort(self, messages: list) -> None:
        system, _ = _filesystem(self.path)
        for m in messages:
            for f in m.files if m else ():
                system.delete_file(f)


def _as_record(row: dict) -> bytes:
    payload = bytes(row.get("payload") or b"")
    revisit = row["record_type"] == "revisit"
    # a revisit holds no payload: its digest and length are those of the record it refers to
    block = b"" if revisit else b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload) + payload
    return record(
        [
            ("WARC-Type", row["record_type"]), ("WARC-Record-ID", row["record_id"]), ("WARC-Date", row.get("date") or "2000-01-01T00:00:00Z"),
            ("WARC-Target-URI", row.get("target_uri") or "urn:page:none"), ("WARC-Refers-To", row.get("refers_to")),
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" if revisit else None),
            ("WARC-Payload-Digest", f"sha1:{row.get('payload_digest') or sha1_text(payload)}"),
            ("X-Payload-Length", str(row.get("payload_length") if row.get("payload_length") is not None else len(payload))),
            ("Content-Type", "application/http; msgtype=response"),
        ],
        block,
    )


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(schema, self.options)

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(schema, self.options)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def read_warc(spark: SparkSession, path: str, columns: str = SCHEMA) -> DataFrame:
    """Records under ``path``; ``columns`` (DDL) names those to be read, and
    payloads are decoded only if one of them needs it."""
    register(spark)
    return spark.read.format("warc").schema(columns).option("parallelism", spark.sparkContext.defaultParallelism).load(path)


def archive_pages(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_bytes: int = 0) -> None:
    """A record for each row: of rows with equal payloads of at least
    ``least_bytes``, those with the smallest id are responses and the others
    revisits that refer to it (a null id is larger than all others)."""
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary")
    hexed = F.sha1(payload)
    base = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"), hexed.alias("hash"))
    large = base.where(F.octet_length("payload") >= least_bytes)
    # digests that occur twice or more; the very common ones (fewer than HOT_KEYS) by broadcast
    again = cut(large.groupBy("hash").agg(F.count("*").alias("n"), F.min("id").alias("first")).where("n > 1 and first is not null"), "warc-digests")
    rows = again.agg(F.sum("n")).first()[0] or 0
    is_hot = F.col("n") * HOT_KEYS >= rows
    ids = large.select("id", "hash")
    firsts = (
        ids.join(F.broadcast(again.where(is_hot)), "hash")
        .unionByName(ids.join(F.broadcast(again.where(is_hot).select("hash")), "hash", "left_anti").join(again.where(~is_hot), "hash"))
        .where(~F.col("id").eqNullSafe(F.col("first"))).select("id", "hash", "first").distinct()
    )
    firsts = firsts.select(F.col("id").alias("own"), F.col("hash").alias("own_hash"), "first")
    joined = base.join(firsts, F.col("id").eqNullSafe(F.col("own")) & (F.col("hash") == F.col("own_hash")), "left")
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("none")), F.lit(">"))
    revisit = F.col("first").isNotNull()
    out = joined.select(
        urn(F.col("id")).alias("record_id"), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")).alias("record_type"), F.col("url").alias("target_uri"),
        F.when(revisit, urn(F.col("first"))).alias("refers_to"), "payload",
    )
    register(pages.sparkSession)
    out.write.format("warc").mode("append").save(path)


def page_records(records: DataFrame, id_col: str = "page_id") -> DataFrame:
    """What ``archive_pages`` wrote, a row a page."""
    number = lambda c: F.expr(f"try_cast(regexp_extract({c}, '^<urn:page:(-?[0-9]+)>$', 1) as bigint)")
    revisit = F.col("record_type") == "revisit"
    return records.select(
        number("record_id").alias(id_col),
        F.when(revisit, F.element_at("headers", "x-payload-length").cast("long")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(revisit, F.substring("declared_digest", 6, 32)).otherwise(F.col("payload_sha1")).alias("payload_digest"),
        "record_type", number("refers_to").alias("refers_to"),
    )


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write ``pages`` as WARC files in the shared folder and read them back."""
    spark = pages.sparkSession
    path = new_run_dir(spark, "llm-warc")
    archive_pages(pages, path, id_col, url_col, html_col)
    by_header = "record_id string, record_type string, refers_to string, declared_digest string, headers map<string,string>"
    of_payload = "payload_bytes long, payload_sha1 string"
    # the record type is pushed into both scans; that of the revisits decodes no payload
    responses = read_warc(spark, path, f"{by_header}, {of_payload}").where("record_type = 'response'")
    revisits = read_warc(spark, path, by_header).where("record_type = 'revisit'")
    return page_records(responses.unionByName(revisits, allowMissingColumns=True), id_col)


