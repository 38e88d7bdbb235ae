"""Driver ``events`` table -> GitHub-archive-shaped NDJSON lines.

Deterministic and row-local (a single narrow Project, no shuffle), so the
lines scale with the table.  It plants the ragged cases the profiler must
handle: missing type, missing/empty logins, missing repo names, int / missing /
string ``size``, empty base language, missing fork language, missing payload,
date-only timestamps and truncated lines.  The rule for every field is in
FIXTURES.md section 5; oracles re-derive expectations from the raw columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values (fixture rules) ---
TYPE_OF = {
    "purchase": "PushEvent",
    "click": "PullRequestEvent",
    "signup": "ForkEvent",
    "error": "IssuesEvent",
    "view": "WatchEvent",
}
BROKEN_LINES = [
    '{"id":"broken"',
    '{"id":"1"} {"id":"2"}',
    '{"id":"1"}, junk}',
    '{"id":"1"}}',
    '[{"id":"1"}]',
    '{"id":"1","actor":"bob"}',
    "{'id':'1'}",
    '{"id":"1","payload":{"size":NaN}}',
]
#: White space that is not ASCII counts around a line, too.
PAD_LEFT, PAD_RIGHT, BLANK = "\u00a0 ", "\t\u2028\x1f", " \u3000\x85"
# Depth over 12, more than 8 keys, a key with a dot, nulls, arrays whose later
# elements have other fields.
DEEP = "true"
for _level in range(14, 0, -1):
    DEEP = f'{{"d{_level}":{DEEP}}}'
RICH_PAYLOAD = (
    '{"a.b":1,"a":{"b":"s"},"n":null,"mix":[{"x":1},{"y":"s","z":2}],"mix2":[1,"s"],'
    f'"k1":1,"k2":2,"k3":3,"k4":4,"k5":5,"deep":{DEEP}}}'
)
# --- end fixed values ---


def spread(df: DataFrame, partitions: int | None, keys: list[str] | None = None) -> DataFrame:
    """Parsing JSON is CPU-heavy and row-local.  Where a scan is known to have
    too few splits (a few large row groups or gzip files), the caller spreads
    its rows over ``partitions`` first; None leaves the scan as it is, which
    is right for inputs of many splits.

    With ``keys`` (unique per row, e.g. an event id) rows are hash-placed;
    without, round-robin, which stays balanced even when many rows are
    identical (a hash of the content would put all copies in one task).
    Both are deterministic under task retries (Spark sorts before a
    round-robin repartition), so a recomputed partition gets the same rows."""
    if partitions is None:
        return df
    return df.repartition(partitions, *keys) if keys else df.repartition(partitions)


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def _commits(eid: Column, n: Column) -> Column:
    # n commit objects; sha derived from the event id and position
    return F.transform(
        F.array_repeat(F.lit(0), n.cast("int")),
        lambda _x, i: F.struct(F.sha1(F.concat_ws(":", eid.cast("string"), i.cast("string"))).alias("sha")),
    )


def fixture_columns(events: DataFrame) -> DataFrame:
    """Adds the per-event fixture fields (k, lang, line) to ``events``."""
    eid = F.col("event_id")
    uid = F.col("user_id")
    et = F.col("event_type")
    k = F.get_json_object("props", "$.k").cast("bigint")
    lang = F.concat(F.lit("L"), F.lpad((k % 24).cast("string"), 2, "0"))

    etype = F.when((et == "view") & (eid % 10 == 0), F.lit(None).cast("string")).when(
        (et == "view") & (eid % 4 == 2), F.concat(F.lit("Kind"), (eid % 23).cast("string"), F.lit("Event"))
    )
    for raw, name in TYPE_OF.items():
        etype = etype.when(et == raw, F.lit(name))

    login = F.when(uid % 7 == 0, F.lit(None).cast("string")).when(uid % 11 == 0, F.lit("")).when(
        uid % 13 == 0, F.concat(F.lit("u\t"), uid.cast("string"), F.lit("\n\\end"))
    ).otherwise(F.concat(F.lit("user"), uid.cast("string")))
    display = F.when(uid % 11 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("User"), uid.cast("string")))
    repo_name = F.when(eid % 3 == 0, F.lit("org0/hot")).when(k % 25 == 0, F.lit(None).cast("string")).otherwise(
        F.concat(F.lit("org"), (k % 10).cast("string"), F.lit("/repo"), k.cast("string"))
    )

    push_payload = (
        F.when(eid % 3 == 0, F.to_json(F.struct((eid % 6).alias("size"), _commits(eid, F.lit(0)).alias("commits"))))
        .when(eid % 3 == 1, F.to_json(F.struct(_commits(eid, eid % 4).alias("commits"))))
        .otherwise(F.to_json(F.struct((eid % 9).cast("string").alias("size"), _commits(eid, eid % 5).alias("commits"))))
    )
    lang_obj = lambda c: F.struct(F.struct(c.alias("language")).alias("repo"))
    pr_payload = F.to_json(
        F.struct(
            F.struct(
                lang_obj(F.when(k % 4 == 0, F.lit("")).otherwise(lang)).alias("base"),
                lang_obj(lang).alias("head"),
            ).alias("pull_request")
        )
    )
    fork_payload = F.to_json(
        F.struct(F.struct(F.when(k % 6 == 0, F.lit(None).cast("string")).otherwise(lang).alias("language")).alias("forkee"))
    )
    issue_payload = F.to_json(F.struct(F.struct(lang.alias("language")).alias("repository")))
    payload = (
        F.when(et == "purchase", push_payload)
        .when(et == "click", pr_payload)
        .when(et == "signup", fork_payload)
        .when(et == "error", issue_payload)
        .when((et == "view") & (eid % 4 == 0), F.lit(RICH_PAYLOAD))
        .when((et == "view") & (eid % 2 == 0), F.lit("{}"))
    )
    created = F.when(eid % 50 == 0, F.date_format("ts", "yyyy-MM-dd")).otherwise(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    )
    envelope = F.to_json(
        F.struct(
            eid.cast("string").alias("id"),
            etype.alias("type"),
            F.struct(login.alias("login"), display.alias("display_login")).alias("actor"),
            F.struct(repo_name.alias("name")).alias("repo"),
            created.alias("created_at"),
        )
    )
    broken = F.element_at(F.array(*[F.lit(x) for x in BROKEN_LINES]), (F.floor(eid / 97) % len(BROKEN_LINES) + 1).cast("int"))
    return events.withColumn("value", F.when(eid % 97 == 0, broken).otherwise(splice_payload(envelope, payload)))


def splice_payload(envelope: Column, payload: Column) -> Column:
    """Append ``"payload": <payload JSON text>`` as the last key of the JSON
    object ``envelope``; the envelope alone when the payload is NULL."""
    body = F.substr(envelope, F.lit(1), F.length(envelope) - 1)
    return F.when(payload.isNull(), envelope).otherwise(F.concat(body, F.lit(',"payload":'), payload, F.lit("}")))


def fixture_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table's columns that make a line; the driver's file has one row
    group, so its rows are spread over the session's cores."""
    ev = read_events(spark, sf_dir).select("event_id", "ts", "user_id", "event_type", "props")
    return spread(ev, spark.sparkContext.defaultParallelism, ["event_id"])


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One NDJSON line per ``events`` row, column ``value`` (like ``read.text``)."""
    ev = fixture_events(spark, sf_dir)
    return fixture_columns(ev).select("value")


def event_lines_with_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines plus the UTC hour (``HH``) and day of the source event, for hourly
    layouts, and its id to order them by."""
    ev = fixture_events(spark, sf_dir)
    return fixture_columns(ev).select("value", F.date_format("ts", "HH").alias("hour"), F.to_date("ts").alias("day"), "event_id")


def event_lines_with_blanks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines where every 13th event is followed by a whitespace-only line and
    every 17th line carries surrounding spaces (exercises strip + skip)."""
    ev = fixture_events(spark, sf_dir)
    fx = fixture_columns(ev)
    line = F.when(F.col("event_id") % 17 == 0, F.concat(F.lit(PAD_LEFT), "value", F.lit(PAD_RIGHT))).otherwise(F.col("value"))
    arr = F.when(F.col("event_id") % 13 == 0, F.array(line, F.lit(BLANK))).otherwise(F.array(line))
    return fx.select(F.explode(arr).alias("value"))
