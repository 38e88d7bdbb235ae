"""WARC archives as a Spark data source (``format("warc")``).

Writing: each task writes one archive of gzip members, a record each, with the
compressed length of the record in the member's extra field and a sidecar of
record offsets every ``STRIDE`` bytes; the driver commits by a manifest of the
files, so files of failed or repeated attempts are never read.

Reading: the plan lists the files (of the manifest, else all ``*.warc`` and
``*.warc.gz``) and cuts them at the sidecar's offsets into partitions of about
``STRIDE`` bytes.  Equality and membership predicates on header columns are
pushed down.  A record is inflated only as far as its header; unless the
predicates hold and a payload is wanted, the reader seeks to the next member.

Options: ``path``; ``payload`` = ``full`` (default), ``verify`` (decode, take
length and digest from the payload, return none) or ``skip`` (headers only).

Both sides use ``pyarrow.fs``, which opens local, HDFS and object-store paths
on executors.  Foreign archives (no sidecar, no extra field) are read whole.

Edge cases: null payloads are empty; null urls have no target header; a record
with a null id has no id header, is no response that others refer to while one
with an id has its payload, and refers to that one; an empty table writes
archives without records; repeated ids are separate records.
"""

from __future__ import annotations

import base64
import hashlib
import json
import posixpath
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    In,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

from eventlens.llm.common import join_skewed, small_batches
from eventlens.session import materialize, scratch_path

STRIDE = 8 << 20
MANIFEST = "_manifest.json"
HEADER_COLUMNS = ["record_id", "record_type", "target_uri", "payload_digest", "payload_bytes", "refers_to"]
SCHEMA = "record_id string, record_type string, target_uri string, payload_digest string, payload_bytes long, refers_to string, payload binary"
_ID = "<urn:x-record:%s>"
#: First bytes read of a record; enough for the headers of nearly all.
_PEEK = 2048


def digest_of(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path)


def _one_line(value: str) -> str:
    return " ".join(value.splitlines())


def record_bytes(record: dict) -> bytes:
    """One uncompressed WARC record."""
    payload, kind = record["payload"] or b"", record["record_type"]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + payload if kind == "response" else http
    head = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", _ID % record["record_id"] if record["record_id"] is not None else None),
        ("WARC-Target-URI", record["target_uri"]),
        ("WARC-Payload-Digest", "sha1:" + digest_of(payload)),
        ("WARC-Payload-Length", str(len(payload))),
        ("WARC-Refers-To", _ID % record["refers_to"] if record["refers_to"] is not None else None),
        ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" if kind == "revisit" else None),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    lines = [f"{k}: {_one_line(v)}" for k, v in head if v is not None]
    return "\r\n".join(["WARC/1.1", *lines]).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """A gzip member that says its own length in an extra field ``SL``."""
    deflater = zlib.compressobj(1, zlib.DEFLATED, -15)
    body = deflater.compress(data) + deflater.flush()
    total = 10 + 2 + 8 + len(body) + 8
    extra = b"SL" + struct.pack("<HI", 4, total)
    return (
        b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra + body
        + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)
    )


class Commit(WriterCommitMessage):
    def __init__(self, files: list[str]):
        self.files = files


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Commit:
        fs, root = filesystem(self.path)
        fs.create_dir(root, recursive=True)
        name = f"part-{uuid.uuid4().hex}.warc.gz"
        at, cuts, n = 0, [0], 0
        with fs.open_output_stream(posixpath.join(root, name), compression=None) as out:
            for batch in iterator:
                for record in batch.to_pylist():
                    if at - cuts[-1] >= STRIDE:
                        cuts.append(at)
                    data = member(record_bytes(record))
                    out.write(data)
                    at += len(data)
                    n += 1
        with fs.open_output_stream(posixpath.join(root, name + ".offsets"), compression=None) as out:
            out.write(json.dumps([*cuts, at]).encode())
        return Commit([name] if n else [])

    def commit(self, messages: list[Commit | None]) -> None:
        fs, root = filesystem(self.path)
        fs.create_dir(root, recursive=True)
        files = sorted(f for m in messages if m for f in m.files)
        with fs.open_output_stream(posixpath.join(root, MANIFEST), compression=None) as out:
            out.write(json.dumps(files).encode())

    def abort(self, messages: list[Commit | None]) -> None:
        fs, root = filesystem(self.path)
        for name in (f for m in messages if m for f in m.files):
            fs.delete_file(posixpath.join(root, name))


class Slice(InputPartition):
    """Bytes of one archive; ``end`` None: to its end."""

    def __init__(self, path: str, start: int, end: int | None):
        super().__init__(path)
        self.path, self.start, self.end = path, start, end


class WarcReader(DataSourceReader):
    def __init__(self, path: str, payload: str):
        self.path, self.payload = path, payload
        self.wanted: list[tuple[str, frozenset]] = []

    def pushFilters(self, filters: list) -> Iterator:
        for f in filters:
            column = f.attribute[0] if getattr(f, "attribute", None) and len(f.attribute) == 1 else None
            if isinstance(f, (EqualTo, In)) and column in HEADER_COLUMNS:
                self.wanted.append((column, frozenset([f.value] if isinstance(f, EqualTo) else f.value)))
            else:
                yield f

    def partitions(self) -> list[Slice]:
        fs, root = filesystem(self.path)
        if fs.get_file_info(root).type == pafs.FileType.File:
            return [Slice(root, 0, None)]
        listed = posixpath.join(root, MANIFEST)
        if fs.get_file_info(listed).type == pafs.FileType.File:
            with fs.open_input_stream(listed, compression=None) as f:
                names = [posixpath.join(root, x) for x in json.loads(f.read())]
        else:
            found = fs.get_file_info(pafs.FileSelector(root, recursive=True))
            names = sorted(x.path for x in found if x.path.endswith((".warc", ".warc.gz")))
        slices: list[Slice] = []
        for name in names:
            if fs.get_file_info(name + ".offsets").type == pafs.FileType.File:
                with fs.open_input_stream(name + ".offsets", compression=None) as f:
                    cuts = json.loads(f.read())
                slices += [Slice(name, a, b) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            else:
                slices.append(Slice(name, 0, None))
        return slices or [Slice("", 0, 0)]

    def read(self, part: Slice) -> Iterator[pa.RecordBatch]:
        if not part.path:
            return
        fs, _ = filesystem(self.path)
        names = [*HEADER_COLUMNS, "payload"]
        kinds = [pa.string()] * 4 + [pa.int64(), pa.string(), pa.binary()]
        rows: list[tuple] = []
        held = 0
        with fs.open_input_file(part.path) as f:
            for row in self._records(f, part):
                rows.append(row)
                held += len(row[-1] or b"")
                if len(rows) >= 1024 or held >= 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    def _records(self, f: pa.NativeFile, part: Slice) -> Iterator[tuple]:
        at, end = part.start, part.end if part.end is not None else f.size()
        while at < end:
            record = _Record(f, at)
            row = self._row(record)
            if row is not None:
                yield row
            at = record.end()

    def _row(self, record: _Record) -> tuple | None:
        h = record.header
        digest = h.get("warc-payload-digest", "").removeprefix("sha1:") or None
        length = h.get("warc-payload-length")
        values = {
            "record_id": _bare(h.get("warc-record-id")),
            "record_type": h.get("warc-type"),
            "target_uri": h.get("warc-target-uri"),
            "payload_digest": digest,
            "payload_bytes": int(length) if length is not None else None,
            "refers_to": _bare(h.get("warc-refers-to")),
        }
        if any(values[c] not in allowed for c, allowed in self.wanted):
            return None
        payload = None
        if self.payload != "skip" and values["record_type"] != "revisit":
            payload = record.payload()
            if self.payload == "verify":
                values["payload_digest"], values["payload_bytes"], payload = digest_of(payload), len(payload), None
        return (*(values[c] for c in HEADER_COLUMNS), payload)


def _bare(value: str | None) -> str | None:
    """The id inside <urn:x-record:...>; foreign ids stay as they are."""
    if value is None:
        return None
    head, tail = _ID.split("%s")
    return value[len(head) : -len(tail)] if value.startswith(head) else value


class _Record:
    """A record at an offset of an archive, inflated only as far as needed."""

    def __init__(self, f: pa.NativeFile, at: int):
        self.f, self.at = f, at
        f.seek(at)
        raw = f.read(_PEEK)
        self.read_to = at + len(raw)
        self.zipped = raw[:2] == b"\x1f\x8b"
        self.length = None
        if self.zipped:
            if raw[3] & 4 and raw[12:14] == b"SL":
                self.length = struct.unpack_from("<I", raw, 16)[0]
            self.inflater = zlib.decompressobj(31)
        self.data = self.inflater.decompress(raw) if self.zipped else raw
        while b"\r\n\r\n" not in self.data and self._more():
            pass
        head, _, _ = self.data.partition(b"\r\n\r\n")
        self.block_at = len(head) + 4
        lines = head.decode("utf-8", "replace").split("\r\n")[1:]
        self.header = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        self.block_length = int(self.header.get("content-length", 0))

    def _more(self) -> bool:
        if self.zipped and self.inflater.eof:
            return False
        self.f.seek(self.read_to)
        raw = self.f.read(1 << 16)
        self.read_to += len(raw)
        self.data += self.inflater.decompress(raw) if self.zipped else raw
        return bool(raw)

    def payload(self) -> bytes:
        while len(self.data) < self.block_at + self.block_length and self._more():
            pass
        block = self.data[self.block_at : self.block_at + self.block_length]
        if "application/http" in self.header.get("content-type", ""):
            return block.partition(b"\r\n\r\n")[2]
        return block

    def end(self) -> int:
        if self.length is not None:
            return self.at + self.length
        if not self.zipped:
            return self.at + self.block_at + self.block_length + 4
        while not self.inflater.eof and self._more():
            self.data = self.data[: self.block_at]
        return self.read_to - len(self.inflater.unused_data)


class WarcDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(self.options["path"], self.options.get("payload", "full"))

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"])


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


def read_warc(spark: SparkSession, path: str, payload: str = "full") -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("payload", payload).load(path)


def write_warc(records: DataFrame, path: str) -> None:
    """``records``: record_id, record_type, target_uri, refers_to, payload."""
    register(records.sparkSession)
    small_batches(records.sparkSession)
    cols = ["record_id", "record_type", "target_uri", "refers_to", "payload"]
    records.select(*cols).write.format("warc").mode("append").save(path)


def with_revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Records of ``pages`` (page_id, url, html): of equal payloads of at least
    ``least_bytes`` bytes the smallest page_id is the response, the others
    revisit it.  Groups are counted by digest first (partial aggregation); a
    payload that many pages share reaches them by broadcast."""
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("string").alias("record_id"), "page_id", F.col("url").alias("target_uri"), payload.alias("payload"))
    keyed = rows.withColumns({"sha": F.unhex(F.sha1("payload")), "bytes": F.octet_length("payload")})
    groups = keyed.filter(F.col("bytes") >= least_bytes).groupBy("sha", "bytes").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("copies"))
    groups = materialize(groups.filter(F.col("copies") > 1), "warc-copies")
    marked = join_skewed(keyed, groups, ["sha", "bytes"], "copies", how="left")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return marked.select(
        "record_id",
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        "target_uri",
        F.when(again, F.col("first").cast("string")).alias("refers_to"),
        "payload",
    )


def archive_round_trip(pages: DataFrame, least_bytes: int = 0, path: str | None = None) -> DataFrame:
    """Write the pages as archives, read them back: header columns per record,
    length and digest of responses taken from the decoded payload."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    write_warc(with_revisits(pages, least_bytes), path)
    responses = read_warc(spark, path, "verify").filter(F.col("record_type") == "response")
    revisits = read_warc(spark, path, "skip").filter(F.col("record_type") == "revisit")
    return responses.unionByName(revisits).select(*HEADER_COLUMNS)
