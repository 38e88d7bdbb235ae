"""Group-and-count metrics.

All are count/sum aggregations, which Spark plans as a map-side partial
aggregate, a hash shuffle of one row per (task, key), and a final merge.  A
hot key (one repository holding a third of the events) therefore costs one
row per map task, not a third of the data in one reducer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.operators.emissions import emissions
from eventlens.operators.ranking import top_k
from eventlens.schema import PUSH
from eventlens.session import materialize


def count_by(silver: DataFrame, col: str, name: str = "name") -> DataFrame:
    return silver.groupBy(F.col(col).alias(name)).agg(F.count("*").alias("count"))


def events_per_repo(silver: DataFrame) -> DataFrame:
    """A1."""
    return count_by(silver, "repo")


def pushes_per_repo(silver: DataFrame) -> DataFrame:
    """A2: P1 filter + count."""
    return count_by(silver.where(F.col("type") == PUSH), "repo")


def commits_per_repo(silver: DataFrame, commits_col: str = "commits") -> DataFrame:
    """A3: commit volume of pushes per repo."""
    return (
        silver.where(F.col("type") == PUSH)
        .groupBy(F.col("repo").alias("name"))
        .agg(F.sum(commits_col).cast("bigint").alias("count"))
    )


def events_per_user(silver: DataFrame) -> DataFrame:
    """A4."""
    return count_by(silver, "user")


def events_per_language(silver: DataFrame) -> DataFrame:
    """A5: P2 filter (non-null language) + count."""
    return count_by(silver.where(F.col("language").isNotNull()), "language")


def events_per_type(silver: DataFrame) -> DataFrame:
    """A6."""
    return count_by(silver, "type")


def events_per_hour(silver: DataFrame) -> DataFrame:
    """A7 (events without an hour are skipped)."""
    return count_by(silver.where(F.col("hour").isNotNull()), "hour")


def repo_type_counts(silver: DataFrame) -> DataFrame:
    """Events per (repo, type)."""
    return silver.groupBy("repo", F.col("type").alias("event_type")).agg(F.count("*").alias("count"))


def repo_type_rollup(silver: DataFrame) -> DataFrame:
    """(repo, type) counts plus per-repo totals (``level`` is 0 for
    (repo, type) rows, 1 for repo totals).  Events are aggregated once, to
    pairs; the totals are summed from the pairs, over the same exchange."""
    pairs = repo_type_counts(silver)
    totals = pairs.groupBy("repo").agg(F.sum("count").cast("bigint").alias("count"))
    return pairs.select("repo", "event_type", F.lit(0).cast("bigint").alias("level"), "count").unionByName(
        totals.select("repo", F.lit(None).cast("string").alias("event_type"), F.lit(1).cast("bigint").alias("level"), "count")
    )


def repo_type_matrix(silver: DataFrame, k: int = 15) -> DataFrame:
    """A10: the k busiest repositories (by total events) with their
    per-type counts: repo_rank, repo, total, types_json (a JSON object
    type -> count, keys sorted).  ``k`` is a report size, 1000 at most.

    The (repo, type) aggregate is computed once (its exchange is reused for
    the totals); the top-k list has at most k rows, so broadcasting it is
    bounded by construction; collect_list per repo is bounded by the number
    of event types."""
    from pyspark.sql import Window

    if not 0 < k <= 1000:
        raise ValueError("the matrix lists 1 to 1000 repositories")
    pairs = repo_type_counts(silver)
    totals = pairs.groupBy(F.col("repo").alias("name")).agg(F.sum("count").cast("bigint").alias("count"))
    top = totals.orderBy(F.col("count").desc(), F.col("name").asc()).limit(k)
    top = top.select(
        F.row_number().over(Window.orderBy(F.col("count").desc(), F.col("name").asc())).cast("bigint").alias("repo_rank"),
        F.col("name").alias("repo"),
        F.col("count").alias("total"),
    )
    joined = pairs.join(F.broadcast(top), "repo")
    entries = F.array_sort(F.collect_list(F.struct("event_type", "count")))
    return joined.groupBy("repo_rank", "repo", "total").agg(F.to_json(F.map_from_entries(entries)).alias("types_json"))


#: The wide matrix has a column a type, up to so many.
MAX_TYPE_COLUMNS = 500


def repo_type_matrix_wide(silver: DataFrame, k: int = 15) -> DataFrame:
    """A10, pivoted: repo_rank, repo, total and a column for every event type
    of the data (by name), 0 where a repository has none.

    The columns come from the (repo, type) aggregate, which is written once and
    read for the types, the totals and the cells, so events are scanned once.
    More types than ``MAX_TYPE_COLUMNS`` raise: types are then no columns, and
    ``repo_type_counts`` has the same cells as rows."""
    pairs = materialize(repo_type_counts(silver), "repo-types")
    types = [r[0] for r in pairs.select("event_type").distinct().orderBy("event_type").limit(MAX_TYPE_COLUMNS + 1).collect()]
    if len(types) > MAX_TYPE_COLUMNS:
        raise ValueError(f"more than {MAX_TYPE_COLUMNS} event types")
    top = top_k(pairs.groupBy(F.col("repo").alias("name")).agg(F.sum("count").cast("bigint").alias("count")), k)
    top = top.select(F.col("rank").alias("repo_rank"), F.col("name").alias("repo"), F.col("count").alias("total"))
    cells = pairs.join(F.broadcast(top), "repo").groupBy("repo_rank", "repo", "total").pivot("event_type", types).agg(F.sum("count").cast("bigint"))
    return cells.fillna(0, types)


def metrics_long(silver: DataFrame) -> DataFrame:
    """One pass, every metric: U1 emissions summed per
    (kind, name, event_type)."""
    return (
        emissions(silver)
        .groupBy("kind", "name", "event_type")
        .agg(F.sum("value").cast("bigint").alias("value"))
    )


def report_aggregate(silver: DataFrame, more: dict[str, str] | None = None) -> DataFrame:
    """The report's one aggregation: (kind, name) -> n, p (pushes), c
    (commits) for kinds repo, user, type, lang, hour.

    Each event emits at most five rows -- (repo, with its push flag and commit
    count), user, type, language, hour -- reduced by ONE aggregation (map-side
    partial, one shuffle).  Push and commit totals ride on the repo row, so
    they cost no extra emission.  Also valid on a stream (stateful).
    ``more`` adds kinds, each counting a column's non-null values.
    (Written as one SQL expression: the same plan, built with one JVM call.)"""
    extra = "".join(
        f""", CASE WHEN `{col}` IS NOT NULL THEN
          named_struct('kind', '{kind}', 'name', `{col}`, 'n', 1L, 'p', CAST(NULL AS BIGINT), 'c', CAST(NULL AS BIGINT)) END"""
        for kind, col in (more or {}).items()
    )
    emit = F.expr(f"""filter(array(
        named_struct('kind', 'repo', 'name', repo, 'n', 1L,
                     'p', CASE WHEN type = '{PUSH}' THEN 1L ELSE 0L END,
                     'c', CASE WHEN type = '{PUSH}' THEN CAST(commits AS BIGINT) END),
        named_struct('kind', 'user', 'name', user, 'n', 1L, 'p', CAST(NULL AS BIGINT), 'c', CAST(NULL AS BIGINT)),
        named_struct('kind', 'type', 'name', type, 'n', 1L, 'p', CAST(NULL AS BIGINT), 'c', CAST(NULL AS BIGINT)),
        CASE WHEN language IS NOT NULL THEN
          named_struct('kind', 'lang', 'name', language, 'n', 1L, 'p', CAST(NULL AS BIGINT), 'c', CAST(NULL AS BIGINT)) END,
        CASE WHEN hour IS NOT NULL THEN
          named_struct('kind', 'hour', 'name', hour, 'n', 1L, 'p', CAST(NULL AS BIGINT), 'c', CAST(NULL AS BIGINT)) END
        {extra}
      ), x -> x IS NOT NULL)""")
    return silver.select(F.inline(emit)).groupBy("kind", "name").agg(
        F.sum("n").alias("n"), F.sum("p").alias("p"), F.sum("c").alias("c")
    )


def expand_report_aggregate(agg: DataFrame) -> DataFrame:
    """(kind, name, n, p, c) -> (kind, name, count) for the seven ranking
    kinds: a repo row yields repo, push and commits rows.  The rows leave
    through a generator, which also keeps later per-metric filters from being
    pushed into the aggregation, so every consumer shares one scan and one
    shuffle."""
    rows = F.expr("""CASE WHEN kind = 'repo' THEN filter(array(
          named_struct('kind', 'repo', 'count', CAST(n AS BIGINT)),
          CASE WHEN p > 0 THEN named_struct('kind', 'push', 'count', CAST(p AS BIGINT)) END,
          CASE WHEN p > 0 THEN named_struct('kind', 'commits', 'count', CAST(coalesce(c, 0) AS BIGINT)) END
        ), x -> x IS NOT NULL)
      ELSE array(named_struct('kind', kind, 'count', CAST(n AS BIGINT))) END""")
    return agg.select("name", F.inline(rows)).select("kind", "name", "count")


def report_metrics(silver: DataFrame, more: dict[str, str] | None = None) -> DataFrame:
    """The report's one-pass aggregate: (kind, name, count) for the seven
    ranking kinds repo, push, commits, user, lang, type, hour (and ``more``)."""
    return expand_report_aggregate(report_aggregate(silver, more))


def run_counters(parsed: DataFrame) -> DataFrame:
    """Records (valid), malformed, emissions and distinct keys, from
    parsed lines (``valid`` flag plus envelope fields)."""
    from eventlens.operators.normalize import normalize

    return counters_from_normalized(normalize(parsed, keep=["valid"]))


def counters_from_normalized(rows_with_valid: DataFrame) -> DataFrame:
    """A12 over normalized rows that still carry every line's ``valid``
    flag (values of invalid rows are ignored).

    One scan: a malformed line becomes a single marker row next to the
    emissions of valid lines, everything is reduced per key (map-side
    partial), and a global aggregate over the reduced table yields the four
    counters.  No join."""
    from eventlens.operators.emissions import emission_array

    marker = F.array(
        F.struct(
            F.lit("_malformed").alias("kind"),
            F.lit(None).cast("string").alias("name"),
            F.lit(None).cast("string").alias("event_type"),
            F.lit(1).cast("bigint").alias("value"),
        )
    )
    rows = rows_with_valid.select(F.inline(F.when(F.col("valid"), emission_array()).otherwise(marker)))
    reduced = rows.groupBy("kind", "name", "event_type").agg(
        F.sum("value").alias("value"), F.count("*").alias("rows")
    )
    real = F.col("kind") != F.lit("_malformed")
    return reduced.agg(
        F.coalesce(F.sum(F.when(F.col("kind") == "type", F.col("value"))), F.lit(0)).cast("bigint").alias("records"),
        F.coalesce(F.sum(F.when(~real, F.col("rows"))), F.lit(0)).cast("bigint").alias("malformed"),
        F.coalesce(F.sum(F.when(real, F.col("rows"))), F.lit(0)).cast("bigint").alias("emissions"),
        F.count_if(real).cast("bigint").alias("keys"),
    )
