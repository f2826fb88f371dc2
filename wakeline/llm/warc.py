"""WARC archives as a Python data source: headers are parsed first, and payloads that are not wanted are not decoded."""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, WriterCommitMessage

from wakeline.session import scratch_path

FILE_BYTES = 128 << 20
"""A task begins a new file behind so many bytes."""
SPLIT_BYTES = 32 << 20
"""Files are read together up to so many bytes."""
SHORTEST_REVISIT = 100
"""Payloads below so many bytes are always written."""

SCHEMA = "record_id string, record_type string, target_uri string, refers_to string, payload_digest string, payload_bytes long, payload binary"
_HEADERS = {"WARC-Record-ID": "record_id", "WARC-Type": "record_type", "WARC-Target-URI": "target_uri", "WARC-Refers-To": "refers_to", "WARC-Payload-Digest": "payload_digest"}
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_MANIFEST = "manifest.jsonl"
_END = b"\r\n\r\n"
_HEAD_BYTES = 4096


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


# ---------------------------------------------------------------- writing


def record_bytes(row: dict) -> bytes:
    """One record: WARC headers, HTTP headers with the length of the full payload, and the payload unless it is a revisit."""
    clean = {k: "".join(f"%{ord(c):02X}" if c < " " else c for c in v) if isinstance(v, str) else v for k, v in row.items() if k != "payload"}
    payload = b"" if row["record_type"] == "revisit" else row["payload"]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n".encode()
    lines = ["WARC/1.1", f"WARC-Type: {clean['record_type']}", f"WARC-Record-ID: <{clean['record_id']}>", "WARC-Date: 1970-01-01T00:00:00Z"]
    lines += [f"WARC-Target-URI: {clean['target_uri']}"] if clean["target_uri"] is not None else []
    lines += [f"WARC-Refers-To: <{clean['refers_to']}>", f"WARC-Profile: {_PROFILE}"] if clean["refers_to"] is not None else []
    lines += [f"WARC-Payload-Digest: sha256:{clean['payload_digest']}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(http) + len(payload)}"]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + _END + http + payload + _END


def gzip_member(data: bytes) -> bytes:
    """One gzip member whose extra field ``sl`` has its compressed and uncompressed lengths, so that a reader can skip it."""
    press = zlib.compressobj(4, zlib.DEFLATED, -15)
    body = press.compress(data) + press.flush()
    size = 24 + len(body) + 8
    extra = b"sl" + struct.pack("<HII", 8, size & 0xFFFFFFFF if size < 1 << 32 else 0, len(data) & 0xFFFFFFFF)
    return struct.pack("<4BIBBH", 0x1F, 0x8B, 8, 4, 0, 0, 255, len(extra)) + extra + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


@dataclass
class Written(WriterCommitMessage):
    files: list


class WarcWriter(DataSourceArrowWriter):
    """Each task writes files of its own; the manifest, written when all tasks are done, lists those that count.

    So a task that ran twice, or failed, leaves files that no reader sees.
    """

    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, root = _open(self.path)
        fs.create_dir(root, recursive=True)
        files, out, size = [], None, 0
        for batch in iterator:
            for row in batch.to_pylist():
                if out is None:
                    files.append([f"part-{uuid.uuid4().hex}.warc.gz", 0])
                    out, size = fs.open_output_stream(f"{root}/{files[-1][0]}", compression=None), 0
                data = gzip_member(record_bytes(row))
                out.write(data)
                size += len(data)
                files[-1][1] = size
                if size >= FILE_BYTES:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        return Written(files)

    def commit(self, messages: list) -> None:
        fs, root = _open(self.path)
        fs.create_dir(root, recursive=True)
        with fs.open_output_stream(f"{root}/{_MANIFEST}", compression=None) as out:
            for name, size in (f for m in messages if m is not None for f in m.files):
                out.write((json.dumps({"file": name, "bytes": size}) + "\n").encode())

    def abort(self, messages: list) -> None:
        fs, root = _open(self.path)
        for name, _ in (f for m in messages if m is not None for f in m.files):
            fs.delete_file(f"{root}/{name}")


# ---------------------------------------------------------------- reading


@dataclass
class WarcPartition(InputPartition):
    files: list


def _lines(block: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in block.decode("utf-8", "replace").split("\r\n")[1:])
    return {name.strip(): value.strip() for name, _, value in pairs}


def _bare(value: str | None) -> str | None:
    if value is None:
        return None
    return value[1:-1] if value[:1] == "<" and value[-1:] == ">" else value.removeprefix("sha256:")


class _Member:
    """A gzip member of an open file, decoded as far as it is asked for."""

    def __init__(self, file, at: int):
        self.file, self.at, self.data = file, at, b""
        file.seek(at)
        self.first = file.read(_HEAD_BYTES)
        self.size = 0
        if len(self.first) > 24 and self.first[3] & 4 and self.first[12:14] == b"sl":
            self.size = struct.unpack("<I", self.first[16:20])[0]
        self.press = zlib.decompressobj(31)
        self.feed = self.first
        self.read = len(self.first)

    def until(self, enough) -> bool:
        """Decode until ``enough(data)`` holds; false if the member ends before."""
        while not enough(self.data):
            if self.press.eof:
                return False
            if not self.feed:
                self.feed = self.file.read(1 << 16)
                self.read += len(self.feed)
                if not self.feed:
                    return False
            self.data += self.press.decompress(self.feed, _HEAD_BYTES if len(self.data) < _HEAD_BYTES else 1 << 20)
            self.feed = self.press.unconsumed_tail
        return True

    def end(self) -> int:
        """Where the next member begins: known from its extra field, else by decoding the rest."""
        if self.size:
            return self.at + self.size
        self.until(lambda _: False)
        return self.at + self.read - len(self.press.unused_data) - len(self.feed if not self.press.eof else b"")


class _Plain:
    """A record of an open file that is not compressed."""

    def __init__(self, file, at: int):
        self.file, self.at, self.data = file, at, b""
        file.seek(at)

    def until(self, enough) -> bool:
        while not enough(self.data):
            more = self.file.read(_HEAD_BYTES if len(self.data) < _HEAD_BYTES else 1 << 20)
            if not more:
                return False
            self.data += more
        return True

    def end(self) -> int:
        head = self.data.index(_END) + 4
        return self.at + head + int(_lines(self.data[: head - 4])["Content-Length"]) + 4


class WarcReader(DataSourceReader):
    """Plans one partition for some files; reads record by record."""

    def __init__(self, path: str, payload: bool):
        self.path, self.payload, self.wanted = path, payload, []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:  # noqa: N802  the name that Spark calls
        """Equality and membership of header fields are tested before any payload is decoded; other filters stay with Spark."""
        for f in filters:
            if isinstance(f, EqualTo | In) and len(f.attribute) == 1 and f.attribute[0] in (*_HEADERS.values(), "payload_bytes"):
                self.wanted.append((f.attribute[0], [f.value] if isinstance(f, EqualTo) else list(f.value)))
            else:
                yield f

    def partitions(self) -> list[WarcPartition]:
        fs, root = _open(self.path)
        if fs.get_file_info(f"{root}/{_MANIFEST}").type == pafs.FileType.File:
            with fs.open_input_stream(f"{root}/{_MANIFEST}") as lines:
                files = [(x["file"], x["bytes"]) for x in map(json.loads, lines.read().splitlines())]
        else:  # archives of other writers
            found = fs.get_file_info(pafs.FileSelector(root))
            files = sorted((f.base_name, f.size) for f in found if f.is_file and f.base_name.endswith((".warc", ".warc.gz")))
        groups, size = [], SPLIT_BYTES
        for name, more in files:
            if size + more > SPLIT_BYTES:
                groups.append([])
                size = 0
            groups[-1].append(name)
            size += more
        return [WarcPartition(g) for g in groups] or [WarcPartition([])]

    def read(self, partition: WarcPartition) -> Iterator[pa.RecordBatch]:
        fs, root = _open(self.path)
        rows, size = [], 0
        for name in partition.files:
            with fs.open_input_file(f"{root}/{name}") as file:
                for row in self._records(file, name.endswith(".gz")):
                    rows.append(row)
                    size += len(row["payload"] or b"") + 300
                    if size > 8 << 20:
                        yield self._batch(rows)
                        rows, size = [], 0
        yield self._batch(rows)

    def _batch(self, rows: list[dict]) -> pa.RecordBatch:
        types = [(name, pa.string()) for name in _HEADERS.values()] + [("payload_bytes", pa.int64()), ("payload", pa.binary())]
        return pa.RecordBatch.from_pylist(rows, schema=pa.schema(types))

    def _records(self, file, packed: bool) -> Iterator[dict]:
        at, total = 0, file.size()
        while at < total:
            record = (_Member if packed else _Plain)(file, at)
            if not record.until(lambda d: _END in d):
                raise ValueError(f"a record at {at} has no complete header")
            head = record.data.index(_END) + 4
            fields = _lines(record.data[: head - 4])
            row = {column: _bare(fields.get(name)) for name, column in _HEADERS.items()}
            whole = head + int(fields["Content-Length"])
            start, row["payload_bytes"], row["payload"] = head, whole - head, None
            if fields.get("Content-Type", "").startswith("application/http"):
                if not record.until(lambda d, h=head: d.find(_END, h) >= 0):
                    raise ValueError(f"a record at {at} has no complete HTTP header")
                start = record.data.index(_END, head) + 4
                length = {k.lower(): v for k, v in _lines(record.data[head : start - 4]).items()}.get("content-length")
                row["payload_bytes"] = int(length) if length is not None else whole - start
            if all(row[column] in values for column, values in self.wanted):
                if self.payload and row["record_type"] != "revisit":
                    if not record.until(lambda d, w=whole: len(d) >= w):
                        raise ValueError(f"a record at {at} ends too soon")
                    row["payload"] = record.data[start:whole]
                yield row
            at = record.end()


class WarcSource(DataSource):
    """``spark.read.format("warc")``: option ``path`` is a folder, option ``payload`` (true) whether payloads are decoded."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options["path"], self.options.get("payload", "true").lower() == "true")

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"])


def register(spark: SparkSession) -> None:
    """Make the format known to the session, with filters handed to it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


# ---------------------------------------------------------------- pages


def records(pages: DataFrame, shortest: int = SHORTEST_REVISIT) -> DataFrame:
    """The rows of SCHEMA for pages (``page_id, url, html``): of equal payloads of ``shortest`` bytes or more, the smallest page_id's is the
    response and the others revisit it.

    The html moves once, by page and digest; who revisits whom is found from digests alone, pre-aggregated. Null html is an empty payload. A page
    without an id is a response that nothing refers to.
    """
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("target_uri"), F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    base = base.withColumn("payload_digest", F.sha2("payload", 256)).withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    long_ones = base.where((F.col("payload_bytes") >= shortest) & F.col("page_id").isNotNull()).select("page_id", "payload_digest")
    firsts = long_ones.groupBy("payload_digest").agg(F.min("page_id").alias("first"), F.max("page_id").alias("last")).where("first < last").drop("last")
    roles = long_ones.join(firsts, "payload_digest").where("page_id > first").distinct()
    joined = base.join(roles, ["page_id", "payload_digest"], "left")
    urn = lambda c: F.concat(F.lit("urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("none")))
    return joined.select(
        urn("page_id").alias("record_id"), F.when(F.col("first").isNull(), "response").otherwise("revisit").alias("record_type"), "target_uri",
        F.when(F.col("first").isNotNull(), urn("first")).alias("refers_to"), "payload_digest", "payload_bytes",
        F.when(F.col("first").isNull(), F.col("payload")).alias("payload"),
    )


def write_pages(pages: DataFrame, path: str) -> None:
    """Write the archives of all pages below ``path``."""
    register(pages.sparkSession)
    records(pages).write.format("warc").mode("append").save(path)


def read_archive(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """The records below ``path``, with columns SCHEMA; payloads are null for revisits and where they are not wanted."""
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)


def round_trip(pages: DataFrame, path: str | None = None) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of every page, from archives written and read back.

    Lengths and digests of responses are taken from the payload that was read; those of revisits from their headers. A page without an id has a null page_id;
    repeated rows are records of their own; no pages give no records.
    """
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    write_pages(pages, path)
    back = read_archive(spark, path)
    number = lambda c: F.regexp_extract(F.col(c), r"^urn:page:(-?\d+)$", 1)
    id_of = lambda c: F.when(number(c) != "", number(c).cast("long"))
    there = F.col("payload").isNotNull()
    return back.select(
        id_of("record_id").alias("page_id"),
        F.when(there, F.octet_length("payload").cast("long")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(there, F.sha2("payload", 256)).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type",
        id_of("refers_to").alias("refers_to"),
    )
