"""WARC archives as a Python data source: ``spark.read.format("warc")`` and ``df.write.format("warc")``.

Writing: every task writes gzip archives, a member per record, into a hidden folder; the commit moves them to their names, so
a lost task or a second attempt leaves nothing behind. Each member carries its compressed length in its gzip header.

Reading: partitions are planned from the files' sizes. Of a record the headers are read first. Predicates on the header
columns (``warc_type``, ``record_id``, ``target_uri``, ``payload_digest``, ``refers_to``, ``content_length``) are pushed down where the
session allows it (``spark.sql.python.filterPushdown.enabled``), predicates on any other header are given as options
``header.<name>``. A record that is not wanted, and the payload of any record if the schema asks for no payload, is skipped by
the length in the gzip header; members of other writers, without it, are inflated and thrown away; plain archives are
skipped by Content-Length. Paths are anything pyarrow's file systems know, not only local ones.

A record's payload is the entity of the HTTP response; ``payload_length`` and ``payload_digest`` (bare lower-case hex SHA-1)
are those of the full payload, also for a revisit, which has none itself. Null html is an empty payload, a null url an
empty target. An empty frame writes no file, and an empty folder reads as no rows. Repeated rows are a record each. Where an
archive is damaged (a member that cannot be inflated or ends early, a head that is none, a length that is no number), one row of
type ``error`` without anything else stands for what could not be read, and reading goes on with the next record that can be.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In,
    InputPartition, IsNotNull, LessThan, LessThanOrEqual, Not, StringContains, StringEndsWith, StringStartsWith,
    WriterCommitMessage)
from pyspark.sql.types import StructType

from gustline.llm.arrow import col
from gustline.storage import materialize

SCHEMA = ("record_id string, warc_type string, target_uri string, date string, payload_digest string, refers_to string, "
          "content_length bigint, payload_length bigint, payload binary")
_PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
#: Archives are closed at the first size; small ones are put together into partitions up to the second.
FILE_BYTES, SPLIT_BYTES = 128 << 20, 32 << 20
#: Size from which equal payloads are stored once.
LEAST = 1000
DATE = "2024-01-01T00:00:00Z"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ALGORITHM = re.compile(r"sha1:([A-Z2-7]{32})$")
_ENDS = b"\r\n\r\n"


#: What is known of a record that cannot be read.
_DAMAGE = {"warc-type": "error"}


# Records

def _size(h: dict[str, str]) -> int | None:
    """Length of the record's block, None if the head has no such number."""
    text = h.get("content-length", "0").strip()
    return int(text) if text.isascii() and text.isdigit() else None


def member(body: bytes, level: int = 6) -> bytes:
    """A gzip member whose extra field SL holds its own length and that of its content."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    packed = packer.compress(body) + packer.flush()
    size = 10 + 2 + 12 + len(packed) + 8
    extra = struct.pack("<H2sHII", 12, b"SL", 8, size & 0xFFFFFFFF, len(body) & 0xFFFFFFFF)
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + extra + packed + struct.pack("<II", zlib.crc32(body), len(body) & 0xFFFFFFFF)


def record(record_id: str, kind: str, target: str, date: str, digest: str, payload: bytes | None, length: int, refers_to: str | None) -> bytes:
    """A response with its payload, or a revisit without."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    block = http if kind == "revisit" else http + (payload or b"")
    named = base64.b32encode(bytes.fromhex(digest)).decode()
    head = [f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {date}",
            "WARC-Target-URI: " + re.sub(r"[\r\n]+", " ", target), f"WARC-Payload-Digest: sha1:{named}"]
    if kind == "revisit":
        head += [f"WARC-Profile: {_REVISIT}", f"WARC-Refers-To: <{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return b"WARC/1.1\r\n" + "\r\n".join(head).encode() + _ENDS + block + _ENDS


def _headers(raw: bytes) -> dict[str, str]:
    """Names in lower case; lines that begin with a blank go on the one before."""
    out: dict[str, str] = {}
    last = ""
    for line in raw.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and last:
            out[last] += " " + line.strip()
        elif ":" in line:
            name, _, value = line.partition(":")
            last = name.strip().lower()
            out[last] = value.strip()
    return out


def _row(h: dict[str, str], block: bytes | None) -> dict:
    """The columns of a record; ``block`` is None if it was not read."""
    digest = h.get("warc-payload-digest")
    if digest and (m := _ALGORITHM.match(digest)):
        digest = base64.b32decode(m[1]).hex()
    row = {"record_id": h.get("warc-record-id", "").strip("<>") or None, "warc_type": h.get("warc-type"),
           "target_uri": h.get("warc-target-uri", ""), "date": h.get("warc-date"), "payload_digest": digest,
           "refers_to": h.get("warc-refers-to", "").strip("<>") or None,
           "content_length": _size(h) if "content-length" in h else None,
           "payload_length": None, "payload": None}
    if block is not None:
        payload, length = block, None
        if "application/http" in h.get("content-type", ""):
            http, _, payload = block.partition(_ENDS)
            stated = _headers(http)
            length = _size(stated) if "content-length" in stated else None
        if row["warc_type"] == "revisit":
            row["payload_length"] = length
        else:
            row["payload"], row["payload_length"] = payload, len(payload)
    return row


class _Reader:
    """Records of one archive, one after another."""

    def __init__(self, file, wanted: Callable[[dict[str, str]], bool], block: bool):
        """``wanted`` decides by the headers; ``block``: whether what follows them is read."""
        self.file, self.wanted, self.block = file, wanted, block
        self.inflated = 0

    def __iter__(self) -> Iterator[dict]:
        magic = self.file.read(2)
        self.file.seek(0)
        yield from self._packed() if magic == b"\x1f\x8b" else self._plain()

    def _take(self, raw: bytes) -> tuple[dict[str, str], bool, bool]:
        h = _headers(raw)
        wanted = self.wanted(h)
        return h, wanted, wanted and self.block

    def _lost(self) -> Iterator[dict]:
        """The row that stands for what cannot be read, if it is asked for."""
        if self.wanted(_DAMAGE):
            yield _row(_DAMAGE, None)

    def _plain(self) -> Iterator[dict]:
        line = self.file.readline()
        lost = False
        while line:
            if not line.startswith(b"WARC/"):
                # Between records there are empty lines; anything else is looked through for the next head.
                if line.strip() and not lost:
                    lost = True
                    yield from self._lost()
                line = self.file.readline()
                continue
            raw = line
            while not raw.endswith(_ENDS) and (line := self.file.readline()):
                raw += line
            size = _size(_headers(raw)) if raw.endswith(_ENDS) else None
            if size is None:
                lost = True
                yield from self._lost()
                line = self.file.readline()
                continue
            lost = False
            h, wanted, block = self._take(raw)
            if block:
                body = self.file.read(size)
                self.inflated += len(body)
                if len(body) < size:
                    yield from self._lost()
                    return
            else:
                self.file.seek(size, io.SEEK_CUR)
            if wanted:
                yield _row(h, body if block else None)
            line = self.file.readline()

    def _member_after(self, at: int) -> int | None:
        """Where the next gzip member may begin."""
        held = b""
        while True:
            self.file.seek(at + len(held))
            piece = self.file.read(1 << 16)
            found = (held + piece).find(b"\x1f\x8b\x08")
            if found >= 0:
                return at + found
            if not piece:
                return None
            at, held = at + len(held) + len(piece) - 2, (held + piece)[-2:]

    def _packed(self) -> Iterator[dict]:
        at: int | None = 0
        lost = False
        while at is not None:
            self.file.seek(at)
            start = self.file.read(24)
            if not start:
                return
            try:
                row, at = self._member(at, start)
                lost = False
                if row is not None:
                    yield row
            except (zlib.error, ValueError):
                if not lost:
                    yield from self._lost()
                # What looks like a member and is none belongs to the same damage.
                lost = True
                at = self._member_after(at + 1)

    def _member(self, at: int, start: bytes) -> tuple[dict | None, int]:
        """The record of the member that begins there, if it is wanted, and where the next one begins. A member that cannot be
        read raises an error."""
        known = len(start) >= 20 and start[3] & 4 and start[10:16] == struct.pack("<H2sH", 12, b"SL", 8)
        length = struct.unpack("<I", start[16:20])[0] if known else None
        self.file.seek(at)
        unpack = zlib.decompressobj(31)
        got, read = b"", 0

        def more(most: int = 0) -> bytes:
            """Inflate a little more; empty at the end of the member."""
            nonlocal read
            while not unpack.eof:
                source = unpack.unconsumed_tail
                if not source:
                    source = self.file.read(1 << 12 if most else 1 << 16)
                    if not source:
                        raise ValueError("the archive ends within a member")
                    read += len(source)
                out = unpack.decompress(source, most)
                self.inflated += len(out)
                if out:
                    return out
            return b""

        while _ENDS not in got and (piece := more(1 << 10)):
            got += piece
        raw, _, rest = got.partition(_ENDS)
        h = _headers(raw + b"\r\n")
        size = _size(h)
        if not raw.startswith(b"WARC/") or size is None:
            raise ValueError("no head of a record")
        h, wanted, block = self._take(raw + b"\r\n")
        row = None
        if block:
            body = [rest]
            have = len(rest)
            while have < size and (piece := more()):
                body.append(piece)
                have += len(piece)
            if have < size:
                raise ValueError("the record is shorter than its head says")
            row = _row(h, b"".join(body)[:size])
        elif wanted:
            row = _row(h, None)
        if length:
            return row, at + length
        # A member of another writer: its end is found by inflating it.
        while more():
            pass
        return row, at + read - len(unpack.unused_data)


# Files

def _place(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def _uri(path: str) -> str:
    """``file:/x`` as Spark writes it, in the form that pyarrow reads."""
    return re.sub(r"^file:/+", "file:///", path)


@dataclass
class Files(InputPartition):
    paths: tuple[str, ...]

    def __init__(self, paths: tuple[str, ...]):
        super().__init__(paths)
        self.paths = paths


@dataclass
class Written(WriterCommitMessage):
    names: tuple[str, ...]


_TESTS: dict[type, Callable] = {
    EqualTo: lambda v, x: v == x, EqualNullSafe: lambda v, x: v == x, GreaterThan: lambda v, x: v > x,
    GreaterThanOrEqual: lambda v, x: v >= x, LessThan: lambda v, x: v < x, LessThanOrEqual: lambda v, x: v <= x,
    In: lambda v, x: v in x, StringStartsWith: lambda v, x: v.startswith(x), StringEndsWith: lambda v, x: v.endswith(x),
    StringContains: lambda v, x: x in v}
_BY_HEADER = ("record_id", "warc_type", "target_uri", "date", "payload_digest", "refers_to", "content_length")


def _test(f: Filter) -> Callable[[dict], bool] | None:
    """The filter on a record's header columns, or None if Spark has to do it."""
    if isinstance(f, Not):
        inner = f.child
        test = _test(inner)
        if test is None or isinstance(inner, (IsNotNull, EqualNullSafe)):
            return None
        # Null compares to null, which is not true either way.
        return lambda row: row[inner.attribute[0]] is not None and not test(row)
    if len(getattr(f, "attribute", ())) != 1 or f.attribute[0] not in _BY_HEADER:
        return None
    name = f.attribute[0]
    if isinstance(f, IsNotNull):
        return lambda row: row[name] is not None
    how = _TESTS.get(type(f))
    if how is None or f.value is None:
        return None
    value = f.value
    return lambda row: row[name] is not None and how(row[name], value)


class WarcReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.names = [f.name for f in schema]
        self.path = _uri(options["path"])
        self.split = int(options.get("splitbytes", SPLIT_BYTES))
        self.headers = {k[len("header."):].lower(): v for k, v in options.items() if k.lower().startswith("header.")}
        self.filters: list[Filter] = []

    def partitions(self) -> list[Files]:
        fs, root = _place(self.path)
        found = [i for i in fs.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True))
                 if i.type == pafs.FileType.File and i.size and re.search(r"\.warc(\.gz)?$", i.path)
                 and not any(p[:1] in "_." for p in i.path[len(root):].strip("/").split("/"))]
        out: list[Files] = []
        now: list[str] = []
        size = 0
        for i in sorted(found, key=lambda i: i.path):
            if now and size + i.size > self.split:
                out.append(Files(tuple(now)))
                now, size = [], 0
            now.append(i.path)
            size += i.size
        return [*out, Files(tuple(now))] if now or not out else out

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        fs, _ = _place(self.path)
        tests = [t for t in map(_test, self.filters) if t]
        kinds = {"content_length": pa.int64(), "payload_length": pa.int64(), "payload": pa.binary()}
        schema = pa.schema([(n, kinds.get(n, pa.string())) for n in self.names])
        block = "payload" in self.names or "payload_length" in self.names

        def wanted(h: dict[str, str]) -> bool:
            if any(h.get(k) != v for k, v in self.headers.items()):
                return False
            row = _row(h, None) if tests else {}
            return all(t(row) for t in tests)

        def packed(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{n: r[n] for n in self.names} for r in rows], schema=schema)

        for path in partition.paths:
            with fs.open_input_file(path) as file:
                rows, size = [], 0
                for row in _Reader(io.BufferedReader(file, 1 << 16), wanted, block):
                    rows.append(row)
                    size += len(row["payload"] or b"") + 256
                    if size > 4 << 20:
                        yield packed(rows)
                        rows, size = [], 0
                if rows:
                    yield packed(rows)


class PushingWarcReader(WarcReader):
    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if _test(f) is None:
                yield f
            else:
                self.filters.append(f)


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.path = _uri(options["path"])
        self.limit = int(options.get("filebytes", FILE_BYTES))
        self.level = int(options.get("level", 6))
        self.overwrite = overwrite
        self.job = uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, root = _place(self.path)
        hidden = f"{root.rstrip('/')}/_temporary-{self.job}"
        fs.create_dir(hidden, recursive=True)
        names: list[str] = []
        out = None
        try:
            for batch in iterator:
                for row in batch.to_pylist():
                    if out is None or out.tell() >= self.limit:
                        if out is not None:
                            out.close()
                        names.append(f"part-{uuid.uuid4().hex}.warc.gz")
                        out = fs.open_output_stream(f"{hidden}/{names[-1]}", compression=None)
                    payload = row.get("payload")
                    digest = row.get("payload_digest") or hashlib.sha1(payload or b"").hexdigest()
                    length = row.get("payload_length")
                    out.write(member(record(
                        row["record_id"], row["warc_type"], row.get("target_uri") or "", row.get("date") or DATE, digest, payload,
                        len(payload or b"") if length is None else length, row.get("refers_to")), self.level))
        finally:
            if out is not None:
                out.close()
        return Written(tuple(names))

    def commit(self, messages: list[Written | None]) -> None:
        fs, root = _place(self.path)
        root = root.rstrip("/")
        if self.overwrite:
            for i in fs.get_file_info(pafs.FileSelector(root, allow_not_found=True)):
                if i.type == pafs.FileType.File and re.search(r"/part-[0-9a-f]{32}\.warc\.gz$", i.path):
                    fs.delete_file(i.path)
        fs.create_dir(root, recursive=True)
        for m in messages:
            for name in m.names if m else ():
                fs.move(f"{root}/_temporary-{self.job}/{name}", f"{root}/{name}")
        self.abort([])

    def abort(self, messages: list[Written | None]) -> None:
        """What is still hidden belongs to attempts that did not count."""
        fs, root = _place(self.path)
        hidden = f"{root.rstrip('/')}/_temporary-{self.job}"
        if fs.get_file_info(hidden).type == pafs.FileType.Directory:
            fs.delete_dir(hidden)


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        kind = PushingWarcReader if self.options.get("pushdown") == "true" else WarcReader
        return kind(schema, dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(dict(self.options), overwrite)


def read(spark: SparkSession, path: str, columns: str = SCHEMA, **options: str) -> DataFrame:
    """The records of a folder. ``columns``: the schema wanted; without payload and payload_length only headers are read."""
    spark.dataSource.register(WarcSource)
    if spark.conf.get(_PUSHDOWN, "false") == "true":
        options["pushdown"] = "true"
    return spark.read.format("warc").schema(columns).options(**options).load(path)


def write(df: DataFrame, path: str, **options: str) -> None:
    df.sparkSession.dataSource.register(WarcSource)
    df.write.format("warc").mode("append").options(**options).save(path)


def archive(df: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html", least: int = LEAST, **options: str) -> None:
    """A record per row. Of equal payloads of at least ``least`` bytes, the row with the largest key is a response and the
    others revisit it; repeated rows with that key are responses too. A null key is the largest only among nulls."""
    payload = F.encode(F.coalesce(col(html).cast("string"), F.lit("")), "UTF-8")
    rows = df.select(col(key).alias("key"), col(url).cast("string").alias("url"), payload.alias("payload")).select(
        "key", "url", "payload", F.sha1("payload").alias("digest"), F.octet_length("payload").cast("bigint").alias("length"))
    # Counted before the exchange, so a page with a third of all copies is one small row per task.
    groups = rows.where(F.col("length") >= least).groupBy("digest", "length").agg(F.max("key").alias("first"), F.count(F.lit(1)).alias("n"))
    shared = materialize(groups.where("n > 1 AND first IS NOT NULL").select("digest", "length", "first"), "shared")
    joined = rows.join(shared, ["digest", "length"], "left")
    again = F.col("first").isNotNull() & ~F.col("key").eqNullSafe(F.col("first"))
    name = F.lit("urn:page:")
    write(joined.select(
        F.concat(name, F.coalesce(F.col("key").cast("string"), F.lit("null"))).alias("record_id"),
        F.when(again, F.lit("revisit")).otherwise(F.lit("response")).alias("warc_type"), F.col("url").alias("target_uri"),
        F.col("digest").alias("payload_digest"), F.when(again, F.concat(name, F.col("first").cast("string"))).alias("refers_to"),
        F.col("length").alias("payload_length"), F.when(~again, F.col("payload")).alias("payload")), path, **options)


def key_of(record_id: str) -> F.Column:
    """The key a record was named by, as a string; null for a null key."""
    return F.nullif(F.substring(F.col(record_id), len("urn:page:") + 1, 1 << 20), F.lit("null"))
