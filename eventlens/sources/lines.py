"""Line-oriented sources: NDJSON text, hourly gzip dumps, caps and gates
(S2, S4, S5, S8).  ``hours`` has the dumps as a data source (S5, S14)."""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlens.functions.extract import strip

HOURLY_NAME = r"(\d{4}-\d{2}-\d{2})-(\d{1,2})\.json(\.gz)?$"
HOUR_PARTITION = r"hour=(\d{1,2})(/|$)"


def strip_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """Strip whitespace around every line and drop blank ones."""
    return lines.select(strip(col).alias("value")).where(F.length("value") > 0)


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """NDJSON line scan (gzip is decoded by the text source)."""
    return strip_lines(spark.read.text(path))


def first_n(events: DataFrame, n: int, order: list[str] | None = None) -> DataFrame:
    """The first ``n`` events in a deterministic order (``created_at, id``).

    ``orderBy().limit()`` plans as TakeOrderedAndProject: each task keeps its
    own top n, so only n x tasks rows ever move."""
    return events.orderBy(*(order or ["created_at", "id"])).limit(n)


def _file_order(path: str) -> tuple:
    """Hourly dumps by day and numeric hour, other files by path."""
    named = re.search(HOURLY_NAME, path)
    return (named[1], int(named[2]), path) if named else ("", -1, path)


def first_lines(spark: SparkSession, path: str | list[str], n: int) -> DataFrame:
    """S4, file-order form: the first ``n`` non-blank lines (with their
    1-based ``line_no``) of the input as a reader going file by file would see
    them.  Files are listed (names only) and ordered; the first is read, and
    more, twice as many each time, only while fewer than ``n`` lines were
    found.  Within a file, lines keep their order through (split start,
    position in the split).  ``orderBy().limit(n)`` plans as
    TakeOrderedAndProject: each task keeps its first n."""
    from pyspark.sql import Window

    files = sorted((unquote(f) for f in spark.read.text(path).inputFiles()), key=_file_order)
    day = F.regexp_extract("source_file", HOURLY_NAME, 1)
    hour = F.regexp_extract("source_file", HOURLY_NAME, 2)
    key = ["_day", "_hour", "source_file", "_block", "_pos"]
    taken, head = 0, None
    while head is None or (taken < len(files) and head.count() < n):
        taken = min(max(1, 2 * taken), len(files))
        df = spark.read.text(files[:taken] or path).select(
            strip("value").alias("value"),
            F.col("_metadata.file_path").alias("source_file"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_pos"),
        )
        df = df.select("*", day.alias("_day"), F.when(hour != "", hour.cast("int")).otherwise(F.lit(-1)).alias("_hour"))
        head = df.where(F.length("value") > 0).orderBy(*key).limit(n)
    return head.select(F.row_number().over(Window.orderBy(*key)).cast("bigint").alias("line_no"), "value", "source_file")


def hourly_paths(base: str, day: str, hours: list[int] | range) -> list[str]:
    """Paths of hourly dumps ``{base}/{day}-{h}.json.gz``."""
    return [f"{base.rstrip('/')}/{day}-{h}.json.gz" for h in hours]


def read_hourly(spark: SparkSession, paths: str | list[str], hour_pattern: str = HOURLY_NAME, group: int = 2) -> DataFrame:
    """Read hourly dumps as one dataset; each line keeps its source hour
    (from the file path) and file.  gzip is not splittable, so each file is
    one task; ``repartition`` before heavy work if files are few and big."""
    df = spark.read.text(paths).select(
        strip("value").alias("value"),
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_size").alias("file_size"),
    )
    hour = F.regexp_extract("source_file", hour_pattern, group)
    return df.where(F.length("value") > 0).withColumn(
        "source_hour", F.when(hour != "", F.lpad(hour, 2, "0"))
    )


def volume_gate(events: DataFrame, minimum: int) -> DataFrame:
    """Whether an ingest holds at least ``minimum`` events: one row
    (events, minimum, passed).  It reports; what to read instead is the
    caller's decision, and no other data takes the place of these."""
    return events.agg(F.count("*").alias("events")).select(
        "events", F.lit(minimum).cast("bigint").alias("minimum"), (F.col("events") >= minimum).alias("passed")
    )
