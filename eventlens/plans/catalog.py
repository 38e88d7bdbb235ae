"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Every query starts from the driver tables (``events``, through the fixture
adapter), so its work grows with them.  Round-trip queries write under a
fresh folder inside the shared checkpoint directory and read back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventlens.functions import extract as X
from eventlens.functions.keyvalue import split_line
from eventlens.operators import aggregates as A
from eventlens.operators.compare import ranking_agreement as ranking_agreement_op
from eventlens.operators.compare import ranking_fallback as ranking_fallback_op
from eventlens.operators.emissions import emissions as emit
from eventlens.operators.normalize import normalize
from eventlens.operators.quality import path_coverage as coverage
from eventlens.operators.quality import preview as preview_op
from eventlens.operators.quality import required_fields as required_op
from eventlens.operators.ranking import full_ranking, global_rank, leader_headline as headline_op, top_k
from eventlens.operators.schema_profile import infer_schema, schema_profile as profile_op
from eventlens.plans import report as R
from eventlens.schema import LANGUAGE_PATHS, LANGUAGE_PATHS_3, MIN_EVENTS, REQUIRED_FIELDS, TOP_K
from eventlens.session import ensure_semantics, scratch_path
from eventlens.sinks import (
    keyvalue_lines,
    ndjson,
    path_size,
    publish,
    read_keyvalue,
    read_published,
    reduce_keyvalue,
    write_json_dir,
    write_keyvalue,
)
from eventlens.sources import adapter
from eventlens.sources import hours as H
from eventlens.sources.json_scan import parse_events, read_declared, read_inferred, valid_events
from eventlens.sources.lines import HOUR_PARTITION, first_n, read_hourly, read_lines

from eventlens.sources.lines import volume_gate as gate

#: Files of the ordered dump.
N_ORDERED_FILES = 8

Query = Callable[[SparkSession, str], DataFrame]


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    ensure_semantics(spark)
    return adapter.event_lines(spark, sf)


def _parsed(spark: SparkSession, sf: str) -> DataFrame:
    return parse_events(_lines(spark, sf))


def _valid(spark: SparkSession, sf: str) -> DataFrame:
    return valid_events(_lines(spark, sf))


def _silver(spark: SparkSession, sf: str) -> DataFrame:
    return normalize(_valid(spark, sf))


# ---------------------------------------------------------------- streaming
def hourly_stream_report(spark, sf):
    """The report maintained by a file stream over hourly gzip dumps, fed in
    three micro-batches (so state carries across batches); returns the
    report over the counts that the sink holds at the end."""
    from eventlens.streaming.hourly import read_stream_report, start_report_stream

    lines = adapter.event_lines_with_hour(spark, sf).select("value", "hour")
    done = publish(lines, scratch_path(spark, "stream-src"), "text", partition_by=["hour"], compression="gzip")
    src, files = done.destination, done.files
    sink = scratch_path(spark, "stream-sink")
    q = start_report_stream(spark, src, sink, scratch_path(spark, "stream-ckpt"), max_files_per_trigger=max(1, -(-files // 3)))
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return read_stream_report(spark, sink)


# ---------------------------------------------------------------- sources
def scan_inferred(spark, sf):
    """NDJSON written to the lake, read back with an inferred schema."""
    path = scratch_path(spark, "inferred")
    _lines(spark, sf).write.text(path)
    df = read_inferred(spark, path)
    corrupt = F.col("_corrupt_record") if "_corrupt_record" in df.columns else F.lit(None).cast("string")
    name = F.when(corrupt.isNotNull(), F.lit("_corrupt")).otherwise(F.coalesce(F.col("type"), F.lit("(absent)")))
    return df.select(name.alias("type_name")).groupBy("type_name").agg(F.count("*").alias("rows"))


def scan_declared(spark, sf):
    """S1 + S2: the declared scan of a dump with blank and padded lines."""
    path = scratch_path(spark, "declared")
    adapter.event_lines_with_blanks(spark, sf).write.text(path)
    name = F.when(~F.col("valid"), F.lit("_corrupt")).otherwise(F.coalesce(F.col("type"), F.lit("(absent)")))
    return read_declared(spark, path).groupBy(name.alias("type_name")).agg(F.count("*").alias("rows"))


def scan_lines(spark, sf):
    """Text scan with blank and padded lines; count valid/broken."""
    path = scratch_path(spark, "lines")
    adapter.event_lines_with_blanks(spark, sf).write.text(path)
    return parse_events(read_lines(spark, path)).groupBy("valid").agg(F.count("*").alias("lines"))


def malformed_lines(spark, sf):
    """S3: quarantined lines per reason."""
    return _parsed(spark, sf).where(~F.col("valid")).groupBy("reason").agg(F.count("*").alias("lines"))


def first_n_events(spark, sf):
    """S4 + T5: the first 20 events by (created_at, id)."""
    top = first_n(_silver(spark, sf), 20)
    w = Window.orderBy("created_at", "id")
    return top.select(F.row_number().over(w).cast("bigint").alias("rank"), "id", "created_at", "type")


def first_n_lines(spark, sf):
    """S4, file-order form: the first 20 non-blank lines of a dump whose
    files are in event-id order (range-partitioned write), as (rank, valid,
    id)."""
    from eventlens.sources.lines import first_lines

    path = scratch_path(spark, "ordered")
    ev = adapter.fixture_columns(adapter.fixture_events(spark, sf))
    ev.repartitionByRange(N_ORDERED_FILES, "event_id").sortWithinPartitions("event_id").select("value").write.text(path)
    head = parse_events(first_lines(spark, path, 20), keep=["line_no"])
    return head.select(F.col("line_no").alias("rank"), "valid", F.when(F.col("valid"), F.col("id")).alias("id"))


def hourly_gzip_ingest(spark, sf):
    """Hourly gzip layout, hour taken from the file path."""
    lines = adapter.event_lines_with_hour(spark, sf).select("value", "hour")
    done = publish(lines, scratch_path(spark, "hourly"), "text", partition_by=["hour"], compression="gzip")
    parsed = parse_events(read_hourly(spark, done.destination, HOUR_PARTITION, 1), keep=["source_hour"])
    return parsed.groupBy("source_hour").agg(
        F.count("*").alias("lines"), F.count_if("valid").cast("bigint").alias("valid_events")
    )


def required_fields(spark, sf):
    """Missing required keys per field, over every valid record."""
    return required_op(_lines(spark, sf))


def publish_roundtrip(spark, sf):
    """Publish a part of the raw dataset, then all of it in its place; the
    profile of what the pointer names."""
    path = scratch_path(spark, "published")
    publish(_lines(spark, sf).where(F.hash("value") % 2 == 0), path)
    publish(_lines(spark, sf), path)
    return normalize(valid_events(read_published(spark, path))).groupBy("type").agg(F.count("*").alias("events"))


def publish_result(spark, sf):
    """What the publisher reports: rows written, the mode, and that files
    and bytes are those found at the destination."""
    done = publish(_lines(spark, sf), scratch_path(spark, "published"), "text")
    back = spark.read.text(done.destination).select("value", F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("n"))
    found = back.groupBy("f").agg(F.max("n").alias("n")).agg(F.sum("n").alias("bytes"))
    return found.select(F.lit(done.rows).cast("bigint").alias("rows"), F.lit(done.mode).alias("mode"), (F.col("bytes") == done.bytes).alias("bytes_match"))


def volume_gate(spark, sf):
    """Events, the minimum of 50, and whether it is reached."""
    return gate(_valid(spark, sf), MIN_EVENTS)


def json_sink_roundtrip(spark, sf):
    """A ranking written as a JSON directory and read back."""
    path = scratch_path(spark, "json")
    write_json_dir(R.top_push_repos(_silver(spark, sf)), path)
    return spark.read.schema("rank bigint, name string, count bigint").json(path)


def text_sink_roundtrip(spark, sf):
    """S10 (+F9-F11): the key/value text file written and read back."""
    path = scratch_path(spark, "kv")
    write_keyvalue(A.metrics_long(_silver(spark, sf)), path)
    return read_keyvalue(spark, path)


def report_long(spark, sf):
    """The whole report, one pass."""
    return R.report_long(_silver(spark, sf))


def report_document(spark, sf):
    """The report with the repository x type matrix and the run's
    counters as further metrics."""
    return R.report_document(_parsed(spark, sf))


def ndjson_roundtrip(spark, sf):
    """Normalized events as compact NDJSON (nulls written), read back:
    every column, and how many of its keys every line carries."""
    path = scratch_path(spark, "ndjson")
    silver = _silver(spark, sf)
    ndjson(silver).write.text(path)
    keys = F.size(F.json_object_keys("value")).cast("bigint").alias("n_keys")
    return spark.read.text(path).select(F.from_json("value", silver.schema).alias("e"), keys).select("e.*", "n_keys")


def dataset_summary(spark, sf):
    """Source, events, files, days and hours of dumps named
    ``{day}-{h}.json.gz``, and that its bytes are those of the files."""
    path = scratch_path(spark, "summary")
    H.write_hours(adapter.event_lines_with_hour(spark, sf), path, order=["event_id"])
    row = H.dataset_summary(H.read_hours(spark, path, content="status"))
    return row.select("source", "events", "files", "days", "hours", "n_hours", (F.col("bytes") == path_size(spark, path)[1]).alias("bytes_match"))


def hourly_append(spark, sf):
    """Dumps written in two calls that share hours: lines read of
    every day and hour, and the rows that each file's status and the manifest give."""
    path = scratch_path(spark, "append")
    lines = adapter.event_lines_with_hour(spark, sf)
    H.write_hours(lines.where("event_id % 3 = 0"), path, order=["event_id"])
    listed = spark.createDataFrame(H.write_hours(lines.where("event_id % 3 <> 0"), path, order=["event_id"]), "file string, rows long, bytes long")
    name = F.substring_index("file", "/", -1).alias("name")
    found = H.read_hours(spark, path).groupBy(F.substring_index("source_file", "/", -1).alias("name"), "day", "hour").agg(
        F.count("value").alias("lines"), F.max("rows").alias("rows")
    )
    return found.join(listed.select(name, F.col("rows").alias("listed")), "name", "left").select("day", "hour", "lines", "rows", "listed")


# --- fixed values (fixture rules): the damaged day
DAY, TRUNCATED, EMPTY, NOT_GZIP, MISSING = "2024-01-01", 5, 7, 9, 11
CAP = 1500
# --- end fixed values ---


def _damaged_dumps(spark, sf) -> str:
    """All events as one day of hourly dumps: one cut off at the start of its
    second member (its first has the events of even id), one of no bytes, one
    that is not gzip, one that is not there."""
    base = scratch_path(spark, "damaged")
    hour = F.col("hour").cast("int")
    lines = adapter.event_lines_with_hour(spark, sf).select("value", "event_id", hour.alias("hour"), F.lit(DAY).alias("day"))
    whole = ~hour.isin(EMPTY, NOT_GZIP, MISSING) & ((hour != TRUNCATED) | (F.col("event_id") % 2 == 0))
    files = {x["file"].rsplit("/", 1)[1]: x["file"] for x in H.write_hours(lines.where(whole), base, order=["event_id"])}
    fs, root = H.filesystem(base)
    cut = f"{root}/{files.get(f'{DAY}-{TRUNCATED}.json.gz', f'{DAY}-{TRUNCATED}.json.gz')}"
    with fs.open_input_stream(cut, compression=None) as f:
        first = f.read()
    for path, data in ((cut, first + first[:10]), (f"{root}/{DAY}-{EMPTY}.json.gz", b""), (f"{root}/{DAY}-{NOT_GZIP}.json.gz", b'{"id":"1"}\n')):
        with fs.open_output_stream(path, compression=None) as out:
            out.write(data)
    return base


def hourly_ingest_status(spark, sf):
    """Lines of every hour of a day, damaged ones included, and each file's
    status: rows, whether it is complete, what is wrong, whether it has bytes."""
    found = H.read_hours(spark, _damaged_dumps(spark, sf), DAY, range(24))
    return found.groupBy("hour").agg(
        F.count("value").alias("lines"), F.max("rows").alias("rows"), F.bool_or("complete").alias("complete"),
        F.max("error").alias("error"), (F.max("file_bytes") > 0).alias("has_bytes"),
    )


def capped_ingest(spark, sf):
    """S4 over S5: the first 1500 lines in order of hour, up to the first
    damaged one; with the hours used, the events and the hour that failed."""
    got = H.capped_ingest(spark, _damaged_dumps(spark, sf), DAY, range(24), CAP)
    parsed = parse_events(got.lines, keep=["hour", "line_no"])
    return parsed.select(
        "hour", "line_no", F.when(F.col("valid"), F.col("id")).alias("id"), F.lit(",".join(map(str, got.hours))).alias("hours"),
        F.lit(got.events).cast("bigint").alias("events"), F.lit(got.failed).cast("int").alias("failed"),
    )


# ------------------------------------------------- projections / functions
def push_events(spark, sf):
    """P1."""
    s = _silver(spark, sf)
    return s.where(X.is_push("type")).select("id", "repo", "commits")


def language_events(spark, sf):
    """P2."""
    return _silver(spark, sf).where(F.col("language").isNotNull()).select("id", "language")


def nested_paths(spark, sf):
    """Raw nested values (NULL when absent)."""
    v = _valid(spark, sf)
    return v.select(
        "id",
        F.col("actor.login").alias("login"),
        F.col("repo.name").alias("repo_name"),
        X.payload_path("$.pull_request.base.repo.language").alias("base_language"),
        X.payload_path("$.forkee.language").alias("forkee_language"),
        F.to_json(F.try_variant_get("payload", "$.size", "variant")).alias("size_json"),
    )


COVERAGE_PATHS = LANGUAGE_PATHS + ["$.size", "$.commits", "$.forkee", "$.pull_request"]


def path_coverage(spark, sf):
    """P4."""
    return coverage(_valid(spark, sf), COVERAGE_PATHS)


def preview(spark, sf):
    """P5."""
    return preview_op(_valid(spark, sf))


def normalized_events(spark, sf):
    """F1, F3-F7."""
    return _silver(spark, sf).select("id", "type", "repo", "user", "language", "commits", "hour")


def languages_3path(spark, sf):
    """F2."""
    return R.languages(normalize(_valid(spark, sf), LANGUAGE_PATHS_3))


def payload_keys(spark, sf):
    """F8: all keys of every event."""
    return _valid(spark, sf).select("id", F.concat_ws(",", X.payload_keys("payload")).alias("payload_keys"))


def keyvalue_decode(spark, sf):
    """F9 + F10: encode every reduced key, decode it again."""
    kv = split_line(keyvalue_lines(A.metrics_long(_silver(spark, sf))))
    return reduce_keyvalue(kv)


def keyvalue_parse(spark, sf):
    """value text that is missing or not an integer counts as 1."""
    em = emit(_silver(spark, sf), keep=["id"])
    n = F.col("id").cast("bigint")
    text = F.when(n % 17 == 0, F.lit("x")).when(n % 19 == 0, F.lit("")).otherwise(F.col("value").cast("string"))
    key = F.when(F.col("kind") == "evt", F.concat_ws("|", "kind", "name", "event_type")).otherwise(F.concat_ws("|", "kind", "name"))
    return reduce_keyvalue(em.select(key.alias("key"), text.alias("value_text"))).select("key", "value")


def commit_volume_size_only(spark, sf):
    """commit volume with integer ``size`` else 0."""
    v = _valid(spark, sf)
    s = v.select(X.repo_name("repo").alias("repo"), X.event_type("type").alias("type"), X.commit_count("payload", "zero").alias("c"))
    return R.top_commit_repos(s.withColumnRenamed("c", "commits"))


def ranking_with_blank_names(spark, sf):
    """users grouped without defaults; NULL names shown as ''."""
    v = _valid(spark, sf)
    raw = v.groupBy(F.col("actor.login").alias("login")).agg(F.count("*").alias("n"))
    normalized = raw.select(X.normalize_name("login").alias("name"), X.normalize_count("n").alias("count"))
    return top_k(normalized, TOP_K["user"])


def emissions(spark, sf):
    """Every emission with its composite key."""
    em = emit(_silver(spark, sf), keep=["id"])
    key = F.when(F.col("kind") == "evt", F.concat_ws("|", "kind", "name", "event_type")).otherwise(F.concat_ws("|", "kind", "name"))
    return em.select("id", "kind", key.alias("key"), "value")


# ------------------------------------------------------------ aggregates
def top_repos(spark, sf):
    return R.top_repos(_silver(spark, sf))


def top_push_repos(spark, sf):
    return R.top_push_repos(_silver(spark, sf))


def top_commit_repos(spark, sf):
    return R.top_commit_repos(_silver(spark, sf))


def top_users(spark, sf):
    return R.top_users(_silver(spark, sf))


def languages(spark, sf):
    return R.languages(_silver(spark, sf))


def event_types(spark, sf):
    return R.event_types(_silver(spark, sf))


def events_by_hour(spark, sf):
    return R.events_by_hour(_silver(spark, sf))


def repo_type_counts(spark, sf):
    """A8."""
    return A.repo_type_counts(_silver(spark, sf))


def repo_type_rollup(spark, sf):
    """A9."""
    return A.repo_type_rollup(_silver(spark, sf))


def repo_type_matrix_top15(spark, sf):
    """A10: the 15 busiest repositories with their per-type counts."""
    return A.repo_type_matrix(_silver(spark, sf))


def repo_type_matrix_wide(spark, sf):
    """A10, pivoted: a column for every event type."""
    return A.repo_type_matrix_wide(_silver(spark, sf))


def metrics_long(spark, sf):
    """A11."""
    return A.metrics_long(_silver(spark, sf))


def run_counters(spark, sf):
    """A12."""
    return A.run_counters(_parsed(spark, sf))


def schema_inferred(spark, sf):
    """A13."""
    return infer_schema(_lines(spark, sf))


def schema_profile(spark, sf):
    """A14."""
    return profile_op(_lines(spark, sf))


def schema_field_count(spark, sf):
    """A14 summary: fields, leaves and the compatible field score."""
    from eventlens.operators.schema_profile import schema_field_count as count_op

    return count_op(_lines(spark, sf))


def discovery_document(spark, sf):
    """A13, A14, S6 and P4 in one scan."""
    from eventlens.operators.schema_profile import discover

    return discover(_lines(spark, sf), REQUIRED_FIELDS, COVERAGE_PATHS)


# -------------------------------------------------------------- ranking
def all_push_repos(spark, sf):
    """T1."""
    return full_ranking(A.pushes_per_repo(_silver(spark, sf)))


def all_users(spark, sf):
    """T1."""
    return full_ranking(A.events_per_user(_silver(spark, sf)))


def keyvalue_sorted(spark, sf):
    """T4: reduced key/value pairs in key order."""
    kv = reduce_keyvalue(split_line(keyvalue_lines(A.metrics_long(_silver(spark, sf)))))
    return global_rank(kv.select("key", "value"), [F.col("key").asc()]).select("rank", "key", "value")


def events_by_time(spark, sf):
    """T5: all events in (created_at, id) order."""
    s = _silver(spark, sf).select("id", "created_at")
    return global_rank(s, [F.col("created_at").asc(), F.col("id").asc()]).select("rank", "id", "created_at")


def leader_headline(spark, sf):
    """T6."""
    metrics = A.report_metrics(_silver(spark, sf))
    return headline_op(R.report_from_metrics(metrics), R.records_from_metrics(metrics))


def _metrics_with_lang3(spark, sf) -> DataFrame:
    """The one-pass aggregate of the report with the 3-path languages as one
    more kind: every ranking below reads this one exchange."""
    with_lang3 = _valid(spark, sf).withColumn("language3", X.language(LANGUAGE_PATHS_3))
    return A.report_metrics(normalize(with_lang3, keep=["language3"]), more={"lang3": "language3"})


def _ranking_of(metrics: DataFrame, kind: str, k: int) -> DataFrame:
    return top_k(metrics.where(F.col("kind") == kind), k)


def ranking_agreement(spark, sf):
    """Q1: the report's rankings vs stand-alone top-k (repos, users), and the
    4-path vs 3-path language rankings, on their first 5 names."""
    metrics = _metrics_with_lang3(spark, sf)
    rep = R.report_from_metrics(metrics)

    def metric(name):
        return rep.where(F.col("metric") == name).select("rank", "name")

    pairs = [
        ("top_repos", metric("top_repos"), _ranking_of(metrics, "repo", TOP_K["repo"])),
        ("top_users", metric("top_users"), _ranking_of(metrics, "user", TOP_K["user"])),
        ("languages_4_vs_3", metric("languages"), _ranking_of(metrics, "lang3", TOP_K["lang"])),
    ]
    out = None
    for name, left, right in pairs:
        row = ranking_agreement_op(left, right, 5).select(F.lit(name).alias("pair"), "*")
        out = row if out is None else out.unionByName(row)
    return out


def ranking_fallback(spark, sf):
    """Q2: the stand-alone job's three rankings first, the full report for
    every metric they do not cover."""
    metrics = _metrics_with_lang3(spark, sf)
    primary = (
        _ranking_of(metrics, "push", TOP_K["push"]).select(F.lit("top_push_repos").alias("metric"), "*")
        .unionByName(_ranking_of(metrics, "user", TOP_K["user"]).select(F.lit("top_users").alias("metric"), "*"))
        .unionByName(_ranking_of(metrics, "lang3", TOP_K["lang"]).select(F.lit("languages").alias("metric"), "*"))
    )
    return ranking_fallback_op(primary, R.report_from_metrics(metrics))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in [
        scan_inferred, scan_declared, scan_lines, malformed_lines, first_n_events, first_n_lines, hourly_gzip_ingest, required_fields,
        publish_roundtrip, publish_result, volume_gate, json_sink_roundtrip, text_sink_roundtrip, report_long,
        report_document, ndjson_roundtrip, dataset_summary, hourly_append, hourly_ingest_status, capped_ingest,
        push_events, language_events, nested_paths, path_coverage, preview,
        normalized_events, languages_3path, payload_keys, keyvalue_decode, keyvalue_parse,
        commit_volume_size_only, ranking_with_blank_names, emissions,
        top_repos, top_push_repos, top_commit_repos, top_users, languages, event_types, events_by_hour,
        repo_type_counts, repo_type_rollup, repo_type_matrix_top15, repo_type_matrix_wide, metrics_long, run_counters,
        schema_inferred, schema_profile, schema_field_count, discovery_document,
        all_push_repos, all_users, keyvalue_sorted, events_by_time, leader_headline,
        ranking_agreement, ranking_fallback, hourly_stream_report,
    ]
}
