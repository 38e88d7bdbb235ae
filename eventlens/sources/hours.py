"""Hourly gzip dumps as a Spark data source (S4 over S5, S5, S14).

``format("event_hours")`` reads dumps ``{day}-{h}.json.gz`` line by line.  A
file is inflated member by member; what was inflated before a damage is kept as
whole lines, and every file ends in one status row: bytes, rows, whether it is
complete, and what is wrong (``missing``, ``not_gzip``, ``truncated``,
``corrupt``).  One damaged hour fails no job.

Columns: source_file, day, hour, line_no, value for lines (stripped, blank ones
left out, undecodable bytes replaced); source_file, day, hour, file_bytes, rows,
complete, error for the status, whose value is null.

Writing (``write_hours``) is two jobs.  Tasks of the first write gzip members
in staging, any number of tasks an hour, and commit a list of what they wrote;
tasks of the second put each hour's members one after another into its file, a
byte copy.  Files of a call go to a folder of their own, and a manifest written
last names the files that count: an hour that was there before is carried over
into its new file, a retried task writes the same bytes again, and no file is
renamed.  Rows, bytes and files come from the manifest.
"""

from __future__ import annotations

import json
import posixpath
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from eventlens.session import materialize, scratch_path
from eventlens.sources.lines import HOURLY_NAME

MANIFEST = "_hours.json"
#: Files are read together up to so many bytes a task.
TASK_BYTES = 32 << 20
#: A member holds about so many bytes of text.
MEMBER_BYTES = 8 << 20
_CHUNK = 256 << 10

SCHEMA = pa.schema([
    ("source_file", pa.string()), ("day", pa.string()), ("hour", pa.int32()), ("line_no", pa.int64()), ("value", pa.string()),
    ("file_bytes", pa.int64()), ("rows", pa.int64()), ("complete", pa.bool_()), ("error", pa.string()),
])
DDL = "source_file string, day string, hour int, line_no long, value string, file_bytes long, rows long, complete boolean, error string"


class Damaged(Exception):
    """A file that cannot be read to its end; the message is its error name."""


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI (Spark's ``s3a`` is ``s3`` here), and the path there."""
    return pafs.FileSystem.from_uri(f"s3://{path[6:]}" if path.startswith("s3a://") else path)


def read_json(path: str):
    """The JSON document at ``path``; None if there is none."""
    fs, at = filesystem(path)
    if fs.get_file_info(at).type != pafs.FileType.File:
        return None
    with fs.open_input_stream(at, compression=None) as f:
        return json.loads(f.read())


def write_json(path: str, value) -> None:
    fs, at = filesystem(path)
    fs.create_dir(posixpath.dirname(at), recursive=True)
    with fs.open_output_stream(at, compression=None) as out:
        out.write(json.dumps(value).encode())


def inflated(f) -> Iterator[bytes]:
    """The text of a gzip stream of any number of members, a bounded piece at a time."""
    raw, first = f.read(_CHUNK), True
    while raw:
        if not first:
            raw = raw.lstrip(b"\0")
            if not raw:
                raw = f.read(_CHUNK)
                continue
        while len(raw) < 2 and (more := f.read(_CHUNK)):
            raw += more
        if raw[:2] != b"\x1f\x8b"[: len(raw)]:
            raise Damaged("not_gzip" if first else "corrupt")
        first, member = False, zlib.decompressobj(31)
        while not member.eof:
            if not raw:
                raise Damaged("truncated")
            try:
                text = member.decompress(raw, 4 * _CHUNK)
            except zlib.error:
                raise Damaged("corrupt") from None
            if text:
                yield text
            raw = member.unconsumed_tail or (b"" if member.eof else f.read(_CHUNK))
        raw = member.unused_data or f.read(_CHUNK)


def plain(f) -> Iterator[bytes]:
    while text := f.read(_CHUNK):
        yield text


def whole_lines(texts: Iterator[bytes]) -> Iterator[str]:
    """Stripped lines that are not blank.  A damage after a line's start loses
    that line: whether it was whole cannot be known."""
    parts: list[bytes] = []
    for text in texts:
        if b"\n" not in text:
            parts.append(text)
            continue
        *done, rest = (b"".join(parts) + text).split(b"\n")
        parts = [rest]
        for line in done:
            if said := line.decode("utf-8", "replace").strip():
                yield said
    if said := b"".join(parts).decode("utf-8", "replace").strip():
        yield said


class Hour(NamedTuple):
    path: str
    day: str | None
    hour: int | None
    size: int


def named(path: str, size: int) -> Hour:
    found = re.search(HOURLY_NAME, path)
    return Hour(path, found[1] if found else None, int(found[2]) if found else None, size)


class Hours(InputPartition):
    def __init__(self, files: list[Hour]):
        super().__init__(len(files))
        self.files = files


class HoursReader(DataSourceReader):
    """Options: ``path``; ``day`` and ``hours`` (comma-joined) for the dumps of
    some hours; ``content`` = ``lines`` (default) or ``status``; ``limit``, the
    lines after which a file is not read on (its completeness is then unknown)."""

    def __init__(self, options: dict):
        self.path = options["path"].rstrip("/")
        self.day, self.hours = options.get("day"), options.get("hours")
        self.content, self.limit = options.get("content", "lines"), int(options["limit"]) if "limit" in options else None

    def files(self) -> list[Hour]:
        fs, root = filesystem(self.path)
        listed = read_json(f"{self.path}/{MANIFEST}")
        if listed is not None:
            paths = {posixpath.basename(x["file"]): posixpath.join(root, x["file"]) for x in listed}
        else:
            found = fs.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True))
            paths = {posixpath.relpath(x.path, root): x.path for x in found if x.type == pafs.FileType.File and re.search(HOURLY_NAME, x.path)}
        if self.day is not None:
            wanted = [f"{self.day}-{int(h)}.json.gz" for h in self.hours.split(",")]
            paths = {x: paths.get(x, posixpath.join(root, x)) for x in wanted}
        sizes = fs.get_file_info(list(paths.values()))
        return [named(x.path, x.size if x.type == pafs.FileType.File else -1) for x in sizes]

    def partitions(self) -> list[Hours]:
        groups: list[list[Hour]] = [[]]
        held = 0
        for file in self.files():
            if groups[-1] and held + file.size > TASK_BYTES:
                groups.append([])
                held = 0
            groups[-1].append(file)
            held += max(file.size, 1 << 16)
        return [Hours(g) for g in groups]

    def read(self, part: Hours) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        held = 0
        fs, _ = filesystem(self.path)
        for file in part.files:
            count, error = 0, None
            try:
                for count, line in enumerate(self._lines(fs, file), 1):
                    if self.content == "lines":
                        rows.append((file.path, file.day, file.hour, count, line, None, None, None, None))
                        held += len(line)
                        if held > 4 << 20 or len(rows) >= 8192:
                            yield self._batch(rows)
                            rows, held = [], 0
                    if count == self.limit:
                        break
            except Damaged as damage:
                error = str(damage)
            stopped = self.limit is not None and count >= self.limit
            rows.append((file.path, file.day, file.hour, None, None, max(file.size, 0), count, None if stopped else error is None, error))
        if rows:
            yield self._batch(rows)

    def _lines(self, fs: pafs.FileSystem, file: Hour) -> Iterator[str]:
        if file.size < 0:
            raise Damaged("missing")
        with fs.open_input_stream(file.path, compression=None, buffer_size=_CHUNK) as f:
            yield from whole_lines(inflated(f) if file.path.endswith(".gz") else plain(f))

    def _batch(self, rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*rows, strict=True), SCHEMA, strict=True)], schema=SCHEMA)


class Member(NamedTuple):
    """A committed part of an hour: where, and what is in it."""

    name: str
    order: int
    file: str
    rows: int
    bytes: int


class Written(WriterCommitMessage):
    def __init__(self, members: list[Member]):
        self.members = members


class MembersWriter(DataSourceArrowWriter):
    """Rows (name, value), rows of one name together: a part of gzip members
    for each name."""

    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, root = filesystem(self.path)
        fs.create_dir(root, recursive=True)
        order, done = TaskContext.get().partitionId(), []
        name, file, out, rows, size, text, held = None, "", None, 0, 0, [], 0

        def close() -> None:
            nonlocal text, held, size
            data = _member(text)
            out.write(data)
            text, held, size = [], 0, size + len(data)

        for batch in iterator:
            for now, value in zip(batch.column("name").to_pylist(), batch.column("value").to_pylist(), strict=True):
                if now != name:
                    if out is not None:
                        close()
                        out.close()
                        done.append(Member(name, order, file, rows, size))
                    name, file, rows, size = now, f"{uuid.uuid4().hex}.gz", 0, 0
                    out = fs.open_output_stream(posixpath.join(root, file), compression=None)
                text.append(value or "")
                rows, held = rows + 1, held + len(value or "")
                if held >= MEMBER_BYTES:
                    close()
        if out is not None:
            close()
            out.close()
            done.append(Member(name, order, file, rows, size))
        return Written(done)

    def commit(self, messages: list[Written | None]) -> None:
        members = sorted(m for w in messages if w for m in w.members)
        write_json(f"{self.path}/{MANIFEST}", [m._asdict() for m in members])

    def abort(self, messages: list[Written | None]) -> None:
        fs, root = filesystem(self.path)
        for m in (m for w in messages if w for m in w.members):
            fs.delete_file(posixpath.join(root, m.file))


def _member(lines: list[str]) -> bytes:
    if not lines:
        return b""
    deflater = zlib.compressobj(6, zlib.DEFLATED, 31)
    return deflater.compress("\n".join([*lines, ""]).encode()) + deflater.flush()


class EventHours(DataSource):
    @classmethod
    def name(cls) -> str:
        return "event_hours"

    def schema(self) -> str:
        return DDL

    def reader(self, schema: StructType) -> HoursReader:
        return HoursReader(dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> MembersWriter:
        return MembersWriter(self.options["path"])


def read_hours(spark: SparkSession, base: str, day: str | None = None, hours: list[int] | range | None = None, content: str = "lines", limit: int | None = None) -> DataFrame:
    """The dumps of ``base``, or of some hours of a day: line rows and a status row a file."""
    spark.dataSource.register(EventHours)
    reader = spark.read.format("event_hours").option("content", content)
    if limit is not None:
        reader = reader.option("limit", limit)
    if day is not None:
        reader = reader.option("day", day).option("hours", ",".join(str(h) for h in hours if h is not None) or "-1")
    return reader.load(base)


def lines_of(hours: DataFrame) -> DataFrame:
    return hours.where(F.col("value").isNotNull()).select("source_file", "day", "hour", "line_no", "value")


def status_of(hours: DataFrame) -> DataFrame:
    return hours.where(F.col("value").isNull()).select("source_file", "day", "hour", "file_bytes", "rows", "complete", "error")


class Ingested(NamedTuple):
    """What a capped ingest took: its lines, the hours used in order, events,
    and the hour that ended it early (None when the cap or the range did)."""

    lines: DataFrame
    hours: list[int]
    events: int
    failed: int | None


def capped_ingest(spark: SparkSession, base: str, day: str, hours: list[int] | range, cap: int) -> Ingested:
    """S4 over S5: lines of the hours in order until ``cap`` of them are there
    or an hour is damaged; what a damaged hour gave before its damage stays,
    but it does not count as used, and no hour after it is opened.  Hours are
    read in waves, twice as many each time, and only while lines are missing;
    each wave's lines are written once.  The driver sees a status an hour."""
    hours, used, events, failed = list(hours), [], 0, None
    kept: DataFrame | None = None
    wave = 1
    while hours and events < cap and failed is None:
        now, hours = hours[:wave], hours[wave:]
        wave *= 2
        read = materialize(read_hours(spark, base, day, now, limit=cap - events), "hours")
        found = {r["hour"]: r for r in status_of(read).collect()}
        take = {}
        for h in now:
            if events >= cap or failed is not None:
                break
            take[h] = min(found[h]["rows"], cap - events)
            events += take[h]
            if found[h]["error"] is not None and events < cap:
                failed = h
            else:
                used.append(h)
        last = F.element_at(F.create_map(*[F.lit(x) for pair in take.items() for x in pair]), F.col("hour"))
        part = lines_of(read).where(F.col("hour").isin(list(take)) & (F.col("line_no") <= last))
        kept = part if kept is None else kept.unionByName(part)
    if kept is None:
        kept = lines_of(spark.createDataFrame([], DDL))
    return Ingested(kept, used, events, failed)


def _joined(target: str) -> callable:
    """Each hour's parts put one after another; (name, file, rows, bytes)."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(target)
        fs.create_dir(root, recursive=True)
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                size = 0
                with fs.open_output_stream(posixpath.join(root, row["name"]), compression=None) as out:
                    for part in row["parts"]:
                        theirs, at = filesystem(part)
                        with theirs.open_input_stream(at, compression=None) as f:
                            while data := f.read(1 << 20):
                                out.write(data)
                                size += len(data)
                done.append((row["name"], row["rows"], size))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], ["name", "rows", "bytes"])

    return tasks


def write_hours(lines: DataFrame, base: str, day: str = "day", hour: str = "hour", order: list[Column | str] | None = None) -> list[dict]:
    """Add ``lines`` (value, day, hour) to the hourly dumps of
    ``base``, in ``order`` within an hour.  Returns the manifest: file, rows and
    bytes an hour.  Lines without a day or hour go to ``undated.json.gz``.  One
    writer at a time: of two that overlap the later manifest stands."""
    spark = lines.sparkSession
    spark.dataSource.register(EventHours)
    base = base.rstrip("/")
    name = F.coalesce(F.concat(F.col(day).cast("string"), F.lit("-"), F.col(hour).cast("int"), F.lit(".json.gz")), F.lit("undated.json.gz"))
    keys = [F.col(c) if isinstance(c, str) else c for c in order or [F.monotonically_increasing_id()]]
    rows = lines.select(name.alias("name"), "value", *[k.alias(f"_{i}") for i, k in enumerate(keys)])
    by = ["name", *[f"_{i}" for i in range(len(keys))]]
    staging = scratch_path(spark, "hours")
    dealt = rows.repartitionByRange(*by).sortWithinPartitions(*by).select("name", "value")
    dealt.write.format("event_hours").mode("append").save(staging)
    members = read_json(f"{staging}/{MANIFEST}")
    before = read_json(f"{base}/{MANIFEST}") or []
    kept = {posixpath.basename(x["file"]): x for x in before}
    version = uuid.uuid4().hex[:12]
    parts: dict[str, dict] = {}
    for m in members:
        old = kept.get(m["name"])
        into = parts.setdefault(m["name"], {"name": m["name"], "parts": [f"{base}/{old['file']}"] if old else [], "rows": old["rows"] if old else 0})
        into["parts"].append(f"{staging}/{m['file']}")
        into["rows"] += m["rows"]
    if parts:
        todo = spark.createDataFrame(list(parts.values()), "name string, parts array<string>, rows long")
        todo = todo.repartition(min(len(parts), 4 * spark.sparkContext.defaultParallelism))
        for r in todo.mapInArrow(_joined(f"{base}/{version}"), "name string, rows long, bytes long").collect():
            kept[r["name"]] = {"file": f"{version}/{r['name']}", "rows": r["rows"], "bytes": r["bytes"]}
    manifest = sorted(kept.values(), key=lambda x: posixpath.basename(x["file"]))
    write_json(f"{base}/{MANIFEST}", manifest)
    return manifest


def collect_versions(base: str) -> int:
    """Remove the files that the manifest no longer names; how many they were."""
    fs, root = filesystem(base.rstrip("/"))
    named_now = {posixpath.join(root, x["file"]) for x in read_json(f"{base.rstrip('/')}/{MANIFEST}") or []}
    old = [x.path for x in fs.get_file_info(pafs.FileSelector(root, recursive=True)) if x.type == pafs.FileType.File and x.path.endswith(".json.gz")]
    old = [p for p in old if p not in named_now]
    for p in old:
        fs.delete_file(p)
    return len(old)


def dataset_summary(hours: DataFrame, source: str = "archive") -> DataFrame:
    """Source, events, files, bytes, days, hours and n_hours of dumps, from
    the status rows (``content="status"`` ships no line).  A damaged file counts
    with what it gave; a missing one does not count."""
    there = status_of(hours).where(~F.col("error").eqNullSafe("missing"))
    hour = F.lpad(F.col("hour").cast("string"), 2, "0")
    return there.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("events"),
        F.count("*").alias("files"),
        F.coalesce(F.sum("file_bytes"), F.lit(0)).alias("bytes"),
        F.concat_ws(",", F.array_sort(F.collect_set("day"))).alias("days"),
        F.concat_ws(",", F.array_sort(F.collect_set(hour))).alias("hours"),
        F.count_distinct("hour").alias("n_hours"),
    ).select(F.lit(source).alias("source"), "*")
