"""Report plans: the full activity report in one pass, and each ranking on
its own.

``report_long`` is one Spark job: lines are parsed once, every event emits at
most five (kind, name) rows, a single aggregation shuffle reduces them, and a
per-metric WindowGroupLimit keeps the top k of each metric before the only
other (tiny) exchange.
The seven stand-alone rankings are what the profiled application ran as
seven separate jobs over a cached table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlens.operators import aggregates as A
from eventlens.operators.normalize import normalize
from eventlens.operators.ranking import top_k, top_k_per_metric
from eventlens.schema import TOP_K
from eventlens.session import materialize
from eventlens.sources.adapter import event_lines
from eventlens.sources.json_scan import valid_events


def silver_from_lines(lines: DataFrame, language_paths: list[str] | None = None) -> DataFrame:
    return normalize(valid_events(lines), language_paths)


def silver_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalized events derived from the driver tables (fixture adapter)."""
    return silver_from_lines(event_lines(spark, sf_dir))


def report_long(silver: DataFrame, limits: dict[str, int] | None = None) -> DataFrame:
    """Every ranking in one long table (metric, rank, name, count)."""
    return report_from_metrics(A.report_metrics(silver), limits)


def report_from_metrics(metrics: DataFrame, limits: dict[str, int] | None = None) -> DataFrame:
    return top_k_per_metric(metrics, limits or TOP_K)


def report_document(parsed: DataFrame) -> DataFrame:
    """S11, whole document: the report, the repository x type matrix (one row
    per repository and type, ranked as the repository; name ``repo|type``) and
    the counters, all as (metric, rank, name, count).  Lines are parsed once:
    every part reads one materialised table of normalized rows."""
    rows = materialize(normalize(parsed, keep=["valid"]), "document-rows")
    silver = rows.where("valid").drop("valid")
    cells = A.repo_type_matrix(silver).select("repo_rank", "repo", F.explode(F.from_json("types_json", "map<string, bigint>")).alias("type", "count"))
    matrix = cells.select(
        F.lit("repo_type_matrix").alias("metric"), F.col("repo_rank").alias("rank"), F.concat_ws("|", "repo", "type").alias("name"), "count"
    )
    names = ["records", "malformed", "emissions", "keys"]
    pairs = F.array(*[F.struct(F.lit(i + 1).cast("bigint").alias("rank"), F.lit(n).alias("name"), F.col(n).alias("count")) for i, n in enumerate(names)])
    counters = A.counters_from_normalized(rows).select(F.lit("counters").alias("metric"), F.inline(pairs))
    return report_long(silver).unionByName(matrix).unionByName(counters)


def records_from_metrics(metrics: DataFrame) -> DataFrame:
    """Valid records = total of the event-type counts (each record has
    exactly one type).  Shares the report's aggregation exchange."""
    return metrics.where(F.col("kind") == "type").agg(F.sum("count").cast("bigint").alias("records"))


# Stand-alone rankings (A1-A7 with T2/T3), each (rank, name, count).
def top_repos(silver: DataFrame, k: int = TOP_K["repo"]) -> DataFrame:
    return top_k(A.events_per_repo(silver), k)


def top_push_repos(silver: DataFrame, k: int = TOP_K["push"]) -> DataFrame:
    return top_k(A.pushes_per_repo(silver), k)


def top_commit_repos(silver: DataFrame, k: int = TOP_K["commits"]) -> DataFrame:
    return top_k(A.commits_per_repo(silver), k)


def top_users(silver: DataFrame, k: int = TOP_K["user"]) -> DataFrame:
    return top_k(A.events_per_user(silver), k)


def languages(silver: DataFrame, k: int = TOP_K["lang"]) -> DataFrame:
    return top_k(A.events_per_language(silver), k)


def event_types(silver: DataFrame, k: int | None = None) -> DataFrame:
    """Event types: unlimited by default (the report caps them at 20)."""
    counts = A.events_per_type(silver)
    if k is None:
        from eventlens.operators.ranking import full_ranking

        return full_ranking(counts)
    return top_k(counts, k)


def events_by_hour(silver: DataFrame) -> DataFrame:
    """All hours, ordered by hour (bounded: two-character keys)."""
    from pyspark.sql import Window

    return A.events_per_hour(silver).select(
        F.row_number().over(Window.orderBy("name")).cast("bigint").alias("rank"), "name", "count"
    )
