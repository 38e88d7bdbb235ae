"""Sinks (S7, S9-S12).  All are distributed writes (one file per task) to
any Hadoop-FS URI; nothing is funnelled through the driver."""

from __future__ import annotations

import json
import time
import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from eventlens.functions.keyvalue import decode_key, encode_key, encode_line, parse_value, split_line


class Published(NamedTuple):
    """What ``publish`` wrote.  ``destination`` is the folder of this version,
    ``mode`` says whether it lies on a ``cluster`` file system or a ``local`` one."""

    destination: str
    rows: int
    files: int
    bytes: int
    mode: str
    uri: str


#: The file that names a published dataset's current version.
POINTER = "_current.json"


def publish(df: DataFrame, uri: str, fmt: str = "text", partition_by: list[str] | None = None, compression: str | None = None, keep: int = 1) -> Published:
    """Publish a dataset to a lake path (``hdfs://``, ``s3a://``, ``file:``),
    in place of what was there.

    The data goes to a version folder of its own; the pointer is replaced last
    and in one step, so readers see the old dataset until the new one is whole,
    and a job that dies leaves the old one current.  Of earlier versions the
    newest ``keep`` stay for readers that have begun.  Rows are counted while
    they are written; files and bytes come from the file system's listing."""
    spark = df.sparkSession
    uri = uri.rstrip("/")
    version = f"v-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    seen = Observation()
    w = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if compression:
        w = w.option("compression", compression)
    getattr(w, fmt)(f"{uri}/{version}")
    files, size = path_size(spark, f"{uri}/{version}")
    current = _pointer(spark, uri)
    done = Published(f"{uri}/{version}", seen.get["rows"], files, size, file_system_mode(spark, uri), uri)
    history = [version, *([] if current is None else current["history"])][: keep + 1]
    _replace_text(spark, f"{uri}/{POINTER}", json.dumps({"version": version, "format": fmt, "rows": done.rows, "files": files, "bytes": size, "history": history}))
    _collect(spark, uri, history)
    return done


def published_path(spark: SparkSession, uri: str) -> str:
    """The folder of a published dataset's current version; ``uri`` itself where nothing was published."""
    current = _pointer(spark, uri.rstrip("/"))
    return uri if current is None else f"{uri.rstrip('/')}/{current['version']}"


def read_published(spark: SparkSession, uri: str) -> DataFrame:
    """The current version of a published dataset, in the format it was written."""
    current = _pointer(spark, uri.rstrip("/"))
    if current is None:
        raise FileNotFoundError(f"nothing is published at {uri}")
    return spark.read.format(current["format"]).load(published_path(spark, uri))


def _file(spark: SparkSession, uri: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(uri)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def file_system_mode(spark: SparkSession, uri: str) -> str:
    return "local" if _file(spark, uri)[1].getUri().getScheme() == "file" else "cluster"


def _pointer(spark: SparkSession, uri: str) -> dict | None:
    path, fs = _file(spark, f"{uri}/{POINTER}")
    if not fs.exists(path):
        return None
    stream = fs.open(path)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _replace_text(spark: SparkSession, uri: str, text: str) -> None:
    """Write a small file beside ``uri`` and put it in its place in one step."""
    jvm = spark.sparkContext._jvm
    target, _ = _file(spark, uri)
    fresh, fs = _file(spark, f"{uri}.{uuid.uuid4().hex[:8]}")
    out = fs.create(fresh, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(fresh), fs.makeQualified(target), how)


def _collect(spark: SparkSession, uri: str, history: list[str]) -> None:
    """Remove versions older than the oldest kept one (newer ones may be being written)."""
    path, fs = _file(spark, uri)
    for status in fs.listStatus(path):
        name = status.getPath().getName()
        if name.startswith("v-") and name not in history and name < min(history):
            fs.delete(status.getPath(), True)


def path_size(spark: SparkSession, uri: str) -> tuple[int, int]:
    """Data files and bytes under a path, by the file system's own summary."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(uri)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.listFiles(path, True)
    files = size = 0
    while found.hasNext():
        status = found.next()
        if not status.getPath().getName().startswith(("_", ".")):
            files, size = files + 1, size + status.getLen()
    return files, size


def write_json_dir(df: DataFrame, path: str) -> None:
    """One JSON object per row, directory output, overwrite."""
    df.write.mode("overwrite").json(path)


def keyvalue_lines(metrics: DataFrame, sort: bool = False) -> DataFrame:
    """S10 + F9: (kind, name, event_type, value) -> ``key<TAB>value`` text,
    with ``sort`` in order of the encoded key."""
    key = F.when(F.col("kind") == "evt", encode_key("kind", "name", "event_type")).otherwise(encode_key("kind", "name"))
    rows = metrics.select(key.alias("key"), "value")
    return (rows.orderBy("key") if sort else rows).select(encode_line("key", "value").alias("value"))


def write_keyvalue(metrics: DataFrame, path: str, sort: bool = False) -> None:
    keyvalue_lines(metrics, sort).write.mode("overwrite").text(path)


def read_keyvalue(spark: SparkSession, path: str) -> DataFrame:
    """Reads an S10 file back: key, kind, name, event_type, value.
    Lines for the same key are summed (a reduce with map-side combine)."""
    kv = split_line(spark.read.text(path).where(F.length("value") > 0))
    return reduce_keyvalue(kv)


def reduce_keyvalue(kv: DataFrame) -> DataFrame:
    """(key, value_text) -> key, kind, name, event_type, value summed per key."""
    summed = kv.groupBy("key").agg(F.sum(parse_value("value_text")).cast("bigint").alias("value"))
    kind, name, etype = decode_key("key")
    return summed.select("key", kind.alias("kind"), name.alias("name"), etype.alias("event_type"), "value")


def write_report(report: DataFrame, path: str) -> None:
    """The long report (metric, rank, name, count) as one JSON dataset."""
    report.write.mode("overwrite").json(path)


def ndjson(df: DataFrame) -> DataFrame:
    """Compact JSON text of every row; NULL fields are written as null."""
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value"))


def write_ndjson(df: DataFrame, path: str, compression: str | None = None) -> None:
    w = ndjson(df).write.mode("overwrite")
    if compression:
        w = w.option("compression", compression)
    w.text(path)
