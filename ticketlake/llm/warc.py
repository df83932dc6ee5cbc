"""WARC archives as a Spark data source.

``spark.dataSource.register(WarcSource)``, then ``df.write.format("warc")`` and
``spark.read.format("warc")`` on a folder.

Writing: every task writes one file of gzip members, a record each.  A member's
gzip header says how long it is (the ``sl`` extra field), so a reader can pass
over it.  File names are unique per attempt; the commit lists the files that
count in ``_manifest.json`` with places to split them at, so files of failed or
repeated attempts are never read.

Reading: without a manifest every ``*.warc`` / ``*.warc.gz`` file is one partition;
with it, large files are several.  Filters on the record type and on other
headers are pushed down.  A reader decodes the first bytes of a record, looks
at its headers, and only for wanted records decodes the payload
(``option("payload", "false")``: for none).  Members without a length are
decoded and dropped piece by piece.

``write_pages`` and ``read_pages`` archive a table of pages.  Of pages with equal
payloads of at least ``least`` bytes the one with the smallest id is a response,
the others are revisits of it that hold headers only.

Defined results: a null html is an empty payload; short payloads are always
responses; a page without id that equals a page with one revisits it, and if no
equal page has an id all are responses; rows that repeat the smallest id are all
responses.  An empty table gives an archive without pages.  Control characters in
a url are percent-encoded.  Other columns are not looked at.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
    IsNotNull,
    WriterCommitMessage,
)

from ticketlake.llm.common import col, spread_join, text_of

LEAST_BYTES = 100
SPLIT_BYTES = 64 << 20
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
WRITE_SCHEMA = "record_id string, record_type string, target_uri string, refers_to string, payload_digest string, payload_length long, payload binary"
READ_SCHEMA = WRITE_SCHEMA + ", file string, offset long"
#: column: WARC header
HEADERS = {
    "record_id": "warc-record-id",
    "record_type": "warc-type",
    "target_uri": "warc-target-uri",
    "refers_to": "warc-refers-to",
    "payload_digest": "warc-payload-digest",
}
HEAD = b"\x1f\x8b\x08\x04\x00\x00\x00\x00\x00\xff" + struct.pack("<H2sH", 12, b"sl", 8)


def file_system(path: str):
    """The file system of a path or URI, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("/") else path.replace("file:", "", 1))


def record(values: dict) -> bytes:
    """One WARC record; ``payload`` is left out of revisits."""
    kind = values["record_type"]
    length, payload = values["payload_length"], values["payload"]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length or 0}\r\n\r\n".encode()
    block = http + (payload or b"") if kind in ("response", "revisit") else payload or b""
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{values['record_id']}>", f"WARC-Date: {DATE}"]
    if values["target_uri"] is not None:
        uri = "".join(f"%{ord(c):02X}" if ord(c) < 33 or ord(c) == 127 else c for c in values["target_uri"])
        head.append(f"WARC-Target-URI: {uri}")
    if values["payload_digest"] is not None:
        head.append(f"WARC-Payload-Digest: sha256:{values['payload_digest']}")
    if kind == "revisit":
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{values['refers_to']}>"]
    media = "application/http; msgtype=response" if kind in ("response", "revisit") else "application/warc-fields"
    head += [f"Content-Type: {media}", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8", "replace") + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """A gzip member that tells its compressed and plain length."""
    deflate = zlib.compressobj(3, zlib.DEFLATED, -15)
    body = deflate.compress(data) + deflate.flush()
    size = len(HEAD) + 8 + len(body) + 8
    return HEAD + struct.pack("<II", size, len(data)) + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


@dataclass
class Written(WriterCommitMessage):
    name: str
    size: int
    splits: list[int]


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, root = file_system(self.path)
        fs.create_dir(root, recursive=True)
        name = f"part-{uuid.uuid4().hex}.warc.gz"
        splits, size = [0], 0
        with fs.open_output_stream(f"{root}/{name}", compression=None) as out:
            info = {"record_type": "warcinfo", "record_id": f"urn:uuid:{uuid.uuid4()}", "payload": b"format: WARC File Format 1.1\r\n"}
            size += out.write(member(record(dict.fromkeys(WRITE_COLUMNS) | info)))
            for batch in iterator:
                for values in batch.to_pylist():
                    if size - splits[-1] >= SPLIT_BYTES:
                        splits.append(size)
                    size += out.write(member(record(values)))
        return Written(name, size, splits)

    def commit(self, messages: list) -> None:
        fs, root = file_system(self.path)
        fs.create_dir(root, recursive=True)
        files = [{"name": m.name, "size": m.size, "splits": m.splits} for m in messages if m]
        with fs.open_output_stream(f"{root}/_manifest.json", compression=None) as out:
            out.write(json.dumps(files).encode())

    def abort(self, messages: list) -> None:
        fs, root = file_system(self.path)
        for m in messages:
            if m:
                fs.delete_file(f"{root}/{m.name}")


WRITE_COLUMNS = [c.split()[0] for c in WRITE_SCHEMA.split(", ")]


@dataclass
class Part(InputPartition):
    file: str
    start: int
    end: int | None
    value: int = field(default=0)


class Source:
    """Bytes of a file from a place on, read in pieces, with cheap skips."""

    def __init__(self, handle, start: int, piece: int = 1 << 18):
        self.handle, self.piece, self.at = handle, piece, start
        self.held = b""
        self.handle.seek(start)

    def peek(self, n: int) -> bytes:
        while len(self.held) < n:
            more = self.handle.read(max(self.piece, n - len(self.held)))
            if not more:
                break
            self.held += more
        return self.held[:n]

    def skip(self, n: int) -> None:
        self.at += n
        if n <= len(self.held):
            self.held = self.held[n:]
        else:
            self.handle.seek(self.at)
            self.held = b""


def headers_of(data: bytes) -> tuple[dict[str, str], int] | None:
    """Header fields and where the block begins; None if the data ends before."""
    end = data.find(b"\r\n\r\n")
    if end < 0:
        return None
    lines = data[:end].decode("utf-8", "replace").split("\r\n")
    fields = (line.partition(":") for line in lines[1:])
    return {k.strip().lower(): v.strip() for k, _, v in fields}, end + 4


def values_of(headers: dict[str, str]) -> dict[str, str | None]:
    out: dict[str, str | None] = {}
    for column, name in HEADERS.items():
        v = headers.get(name)
        if v is not None and name in ("warc-record-id", "warc-refers-to"):
            v = v.strip("<>")
        if v is not None and name == "warc-payload-digest":
            v = v.removeprefix("sha256:")
        out[column] = v
    return out


class WarcReader(DataSourceReader):
    def __init__(self, path: str, payload: bool):
        self.path, self.payload = path, payload
        self.wanted: dict[str, set] = {}
        self.present: set[str] = set()

    def pushFilters(self, filters: list[Filter]):  # noqa: N802
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if column in HEADERS and isinstance(f, (EqualTo, In)):
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.wanted[column] = self.wanted.get(column, values) & values
            elif column in HEADERS and isinstance(f, IsNotNull):
                self.present.add(column)
            else:
                yield f

    def partitions(self) -> list[Part]:
        from pyarrow import fs as pafs

        fs, root = file_system(self.path)
        parts = []
        if fs.get_file_info(f"{root}/_manifest.json").type == pafs.FileType.File:
            with fs.open_input_stream(f"{root}/_manifest.json", compression=None) as f:
                files = json.loads(f.read())
            for x in files:
                ends = [*x["splits"][1:], x["size"]]
                parts += [Part(x["name"], a, b) for a, b in zip(x["splits"], ends, strict=True)]
        else:
            for info in fs.get_file_info(pafs.FileSelector(root)):
                if info.base_name.endswith((".warc", ".warc.gz")):
                    parts.append(Part(info.base_name, 0, None))
        return parts or [Part("", 0, 0)]

    def accepts(self, values: dict[str, str | None]) -> bool:
        return all(values[c] is not None for c in self.present) and all(values[c] in v for c, v in self.wanted.items())

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        columns = [*WRITE_COLUMNS, "file", "offset"]
        kinds = [pa.string()] * 5 + [pa.int64(), pa.binary(), pa.string(), pa.int64()]
        rows: list[dict] = []
        size = 0
        for row in self.records(partition) if partition.file else ():
            rows.append(row)
            size += len(row["payload"] or b"") + 200
            if size > 8 << 20:
                yield batch_of(rows, columns, kinds)
                rows, size = [], 0
        if rows:
            yield batch_of(rows, columns, kinds)

    def records(self, partition: Part) -> Iterator[dict]:
        fs, root = file_system(self.path)
        with fs.open_input_file(f"{root}/{partition.file}") as handle:
            source = Source(handle, partition.start)
            while partition.end is None or source.at < partition.end:
                at = source.at
                start = source.peek(2)
                if not start:
                    break
                found = self.packed(source) if start == b"\x1f\x8b" else self.plain(source)
                if found is not None:
                    yield found | {"file": partition.file, "offset": at}

    def row(self, headers: dict[str, str], values: dict, block: bytes | None) -> dict:
        """A wanted record from its headers and its block (None: not decoded past the headers of the response)."""
        length, payload = None, None
        if block is not None and headers.get("content-type", "").startswith("application/http"):
            http = headers_of(block)
            if http:
                said = http[0].get("content-length")
                length = int(said) if said and said.isdigit() else None
                if values["record_type"] != "revisit":
                    payload = block[http[1] :]
        elif block is not None:
            payload, length = block, len(block)
        return {**values, "payload_length": length, "payload": payload if self.payload else None}

    def packed(self, source: Source) -> dict | None:
        """The next gzip member: headers first, the rest only for wanted records."""
        told = None
        head = source.peek(len(HEAD) + 8)
        if len(head) == len(HEAD) + 8 and head[3] == 4 and head[12:14] == b"sl":
            told = struct.unpack("<I", head[16:20])[0]
        unpack = zlib.decompressobj(31)
        if told:  # the whole member's length is known
            data = source.peek(told)
            plain = unpack.decompress(data, 4096)
            while headers_of(plain) is None and not unpack.eof and unpack.unconsumed_tail:
                plain += unpack.decompress(unpack.unconsumed_tail, 4096)
            headers, begin = headers_of(plain) or ({}, 0)
            values = values_of(headers)
            if not self.accepts(values):
                source.skip(told)
                return None
            if self.payload:
                plain += unpack.decompress(unpack.unconsumed_tail) + unpack.flush()
            source.skip(told)
        else:
            plain, wanted, headers, values, begin = b"", True, None, {}, 0
            while not unpack.eof:
                data = source.peek(1 << 16)
                if not data:
                    break
                piece = unpack.decompress(data)
                source.skip(len(data) - len(unpack.unused_data))
                if wanted:
                    plain += piece
                    if headers is None and (found := headers_of(plain)):
                        headers, begin = found
                        values = values_of(headers)
                        wanted = self.accepts(values)
            if headers is None or not wanted:
                return None
        block = plain[begin:]
        whole = int(headers.get("content-length") or 0)
        return self.row(headers, values, block[:whole])

    def plain(self, source: Source) -> dict | None:
        """The next record of an archive that is not compressed."""
        n = 4096
        while (found := headers_of(source.peek(n))) is None:
            if len(source.peek(n)) < n:
                source.skip(len(source.peek(n)))
                return None
            n *= 2
        headers, begin = found
        values, whole = values_of(headers), int(headers.get("content-length") or 0)
        block = None
        if self.accepts(values):
            block = source.peek(begin + (whole if self.payload else min(whole, 4096)))[begin:]
        source.skip(begin + whole + 4)
        return None if block is None else self.row(headers, values, block)


def batch_of(rows: list[dict], columns: list[str], kinds: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], k) for c, k in zip(columns, kinds, strict=True)], names=columns)


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return READ_SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options["path"], self.options.get("payload", "true").lower() != "false")

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"])


def use(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def page_records(pages: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """The archive records of pages (page_id, url, html)."""
    rows = pages.select(
        col("page_id").alias("page_id"), col("url").cast("string").alias("target_uri"), F.encode(text_of("html"), "UTF-8").alias("payload")
    ).withColumn("payload_digest", F.sha2("payload", 256))
    long_enough = F.length("payload") >= least
    first = rows.where(long_enough).groupBy("payload_digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    joined = spread_join(rows, first.where("n > 1").drop("n"), "payload_digest", "left")
    again = long_enough & F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id"))
    name = lambda c: F.concat(F.lit("urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")))
    return joined.select(
        name("page_id").alias("record_id"),
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        "target_uri",
        F.when(again, name("first")).alias("refers_to"),
        "payload_digest",
        F.length("payload").cast("long").alias("payload_length"),
        F.when(~again, F.col("payload")).alias("payload"),
    )


def write_pages(pages: DataFrame, path: str, least: int = LEAST_BYTES) -> None:
    use(pages.sparkSession)
    page_records(pages, least).write.format("warc").mode("append").save(path)


def read_pages(spark: SparkSession, path: str, id_type: str = "bigint") -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, payload; digests of responses are made anew."""
    use(spark)
    source = lambda payload: spark.read.format("warc").option("payload", payload).load(path)
    page = lambda c: F.regexp_extract(c, "^urn:page:(.+)$", 1)
    number = lambda c: F.when(page(c) != "", page(c)).cast(id_type)
    whole = source("true").where("record_type = 'response'")
    made = F.sha2("payload", 256)
    sound = (made == F.col("payload_digest")) & (F.length("payload") == F.col("payload_length"))
    responses = whole.select(
        number("record_id").alias("page_id"),
        F.length("payload").cast("long").alias("payload_bytes"),
        F.when(sound, made).otherwise(F.raise_error(F.concat(F.lit("damaged record "), F.col("record_id")))).alias("payload_digest"),
        "record_type",
        F.lit(None).cast(id_type).alias("refers_to"),
        "payload",
    )
    revisits = source("false").where("record_type = 'revisit'").select(
        number("record_id").alias("page_id"),
        F.col("payload_length").alias("payload_bytes"),
        "payload_digest",
        "record_type",
        number("refers_to").alias("refers_to"),
        F.lit(None).cast("binary").alias("payload"),
    )
    return responses.union(revisits)
