"""The activity report over hourly dumps as they arrive (Structured
Streaming).

Hourly archive files land in a folder one after another.  A file stream
reads them (``maxFilesPerTrigger`` bounds a micro-batch), the same parse and
normalize as the batch path run per micro-batch, and the report's single
aggregation is kept as streaming state keyed by (kind, name) -- its size is
the number of distinct repositories, users, languages, types and hours, not
the number of events.  In ``update`` mode each micro-batch hands
``foreachBatch`` only the keys that it changed; they are written to a folder
of their own (``batch=N``, so a repeated batch replaces itself and a reader
never finds the sink empty).  ``read_stream_report`` takes each key's latest
counts and ranks them in a batch read.  Progress and state live in the
checkpoint folder, so a restarted query resumes where it stopped.  No watermark is needed: the rankings are over all time, not
windows, and every late file simply updates the counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventlens.operators.aggregates import expand_report_aggregate, report_aggregate
from eventlens.operators.normalize import normalize
from eventlens.plans.report import report_from_metrics
from eventlens.sources.json_scan import valid_events
from eventlens.sources.lines import strip_lines


def stream_silver(spark: SparkSession, source_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format("text").option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return normalize(valid_events(strip_lines(reader.load(source_dir))))


def start_report_stream(
    spark: SparkSession,
    source_dir: str,
    sink_path: str,
    checkpoint: str,
    max_files_per_trigger: int | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Start the streaming report.  ``available_now`` processes what is
    there (in bounded micro-batches) and stops; otherwise it polls every
    ``processing_time``."""
    agg = report_aggregate(stream_silver(spark, source_dir, max_files_per_trigger))

    def publish(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink_path}/batch={epoch}")

    w = agg.writeStream.outputMode("update").foreachBatch(publish).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "1 minute")
    return w.start()


def read_stream_report(spark: SparkSession, sink_path: str) -> DataFrame:
    """The report of everything the stream has seen: the latest counts per
    key (combined before the shuffle), ranked."""
    changed = spark.read.parquet(sink_path)
    latest = changed.groupBy("kind", "name").agg(F.max(F.struct("batch", "n", "p", "c")).alias("last"))
    return report_from_metrics(expand_report_aggregate(latest.select("kind", "name", "last.n", "last.p", "last.c")))
