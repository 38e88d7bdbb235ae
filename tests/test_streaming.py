"""Streaming report: resumes from its checkpoint and ends equal to the
batch report over all files."""

from conftest import SF_SMALL
from pyspark.sql import functions as F

from eventlens.plans.report import report_long, silver_from_tables
from eventlens.session import scratch_path
from eventlens.sinks import publish
from eventlens.sources.adapter import event_lines_with_hour
from eventlens.streaming.hourly import read_stream_report, start_report_stream


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_stream_resumes_and_matches_batch(spark):
    src, sink, ckpt = (scratch_path(spark, n) for n in ("t-ssrc", "t-ssink", "t-sckpt"))
    lines = event_lines_with_hour(spark, SF_SMALL).select("value", "hour").repartition("hour")
    publish(lines.where(F.col("hour") < "12"), f"{src}/a", "text", partition_by=["hour"])
    q = start_report_stream(spark, src, sink, ckpt, max_files_per_trigger=5)
    q.awaitTermination()
    first = read_stream_report(spark, sink)
    morning = report_long(silver_from_tables(spark, SF_SMALL).where(F.col("hour") < "12"))
    assert first.where("metric = 'hours'").count() == morning.where("metric = 'hours'").count()

    publish(lines.where(F.col("hour") >= "12"), f"{src}/b", "text", partition_by=["hour"])
    q = start_report_stream(spark, src, sink, ckpt, max_files_per_trigger=5)
    q.awaitTermination()
    # a batch writes the keys it changed, not the whole state
    changed = {r["batch"]: r["n"] for r in spark.read.parquet(sink).groupBy("batch").agg(F.count("*").alias("n")).collect()}
    assert len(changed) > 2
    assert _rows(read_stream_report(spark, sink)) == _rows(report_long(silver_from_tables(spark, SF_SMALL)))
