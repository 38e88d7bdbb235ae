"""DuckDB oracles: for each registered query, SQL over the raw driver
tables that derives the expected result *without* parsing the event JSON --
every fallback is re-stated as a CASE over the columns the fixture adapter
started from (FIXTURES.md section 5).  Integer outputs are BIGINT.
"""

from __future__ import annotations

# ev: one row per events row with the planted fields; s: the expected
# normalized (silver) row of every valid line.
BASE = f"""
WITH fx AS (
  SELECT event_id, user_id, event_type, ts,
         CAST(regexp_extract(props, '"k"[ ]*:[ ]*(-?[0-9]+)', 1) AS BIGINT) AS k,
         event_id % 97 <> 0 AS valid,
         CAST(event_id AS VARCHAR) AS id
  FROM events
), ev AS (
  SELECT *,
    concat('L', lpad(CAST(k % 24 AS VARCHAR), 2, '0')) AS lang,
    CASE event_type WHEN 'purchase' THEN 'PushEvent' WHEN 'click' THEN 'PullRequestEvent'
         WHEN 'signup' THEN 'ForkEvent' WHEN 'error' THEN 'IssuesEvent'
         WHEN 'view' THEN CASE WHEN event_id % 10 = 0 THEN NULL
              WHEN event_id % 4 = 2 THEN concat('Kind', event_id % 23, 'Event') ELSE 'WatchEvent' END END AS raw_type,
    CASE WHEN user_id % 7 = 0 THEN NULL WHEN user_id % 11 = 0 THEN ''
         WHEN user_id % 13 = 0 THEN concat('u', chr(9), user_id, chr(10), chr(92), 'end') ELSE concat('user', user_id) END AS raw_login,
    CASE WHEN user_id % 11 = 0 THEN 'unknown' WHEN user_id % 7 = 0 THEN concat('User', user_id)
         WHEN user_id % 13 = 0 THEN concat('u', chr(9), user_id, chr(10), chr(92), 'end') ELSE concat('user', user_id) END AS usr,
    CASE WHEN event_id % 3 = 0 THEN 'org0/hot' WHEN k % 25 = 0 THEN NULL ELSE concat('org', k % 10, '/repo', k) END AS raw_repo,
    CASE WHEN event_id % 97 = 0 THEN (event_id // 97) % 8 END AS broken,
    CASE WHEN event_id % 50 = 0 THEN strftime(ts, '%Y-%m-%d') ELSE strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS created_at,
    CASE WHEN event_id % 50 <> 0 THEN strftime(ts, '%H') END AS hour,
    CASE event_id % 3 WHEN 0 THEN 0 WHEN 1 THEN event_id % 4 ELSE event_id % 5 END AS n_commits
  FROM fx
), s AS (
  SELECT id, event_id, user_id, k, event_type, raw_type, raw_login, raw_repo, lang, n_commits,
    coalesce(raw_type, 'Unknown') AS type,
    coalesce(raw_repo, 'unknown/unknown') AS repo,
    usr AS "user",
    CASE WHEN event_type IN ('click', 'error') THEN lang
         WHEN event_type = 'signup' AND k % 6 <> 0 THEN lang END AS language,
    CASE WHEN event_type IN ('click', 'error') AND NOT (event_type = 'click' AND k % 4 = 0) THEN lang
         WHEN event_type = 'signup' AND k % 6 <> 0 THEN lang END AS language3,
    hour,
    CASE WHEN event_type = 'purchase' THEN
      CASE event_id % 3 WHEN 0 THEN event_id % 6 WHEN 1 THEN event_id % 4 ELSE event_id % 5 END END AS commits,
    CASE WHEN event_type = 'purchase' THEN CASE WHEN event_id % 3 = 0 THEN event_id % 6 ELSE 0 END END AS size_only,
    created_at
  FROM ev WHERE valid
), em AS (
  SELECT id, event_id, 'evt' AS kind, repo AS name, type AS event_type, 1 AS value FROM s
  UNION ALL SELECT id, event_id, 'user', "user", NULL, 1 FROM s
  UNION ALL SELECT id, event_id, 'type', type, NULL, 1 FROM s
  UNION ALL SELECT id, event_id, 'push', repo, NULL, 1 FROM s WHERE type = 'PushEvent'
  UNION ALL SELECT id, event_id, 'commits', repo, NULL, commits FROM s WHERE type = 'PushEvent'
  UNION ALL SELECT id, event_id, 'lang', language, NULL, 1 FROM s WHERE language IS NOT NULL
  UNION ALL SELECT id, event_id, 'hour', hour, NULL, 1 FROM s WHERE hour IS NOT NULL
), ml AS (
  SELECT kind, name, event_type, CAST(sum(value) AS BIGINT) AS value,
         CASE WHEN kind = 'evt' THEN concat_ws('|', kind, name, event_type) ELSE concat_ws('|', kind, name) END AS key
  FROM em GROUP BY kind, name, event_type
)"""


def _ranking(counts_sql: str, k: int | None, by_name: bool = False) -> str:
    """(name, count) subquery -> rank, name, count (first k)."""
    order = "name ASC" if by_name else "count DESC, name ASC"
    lim = f"WHERE rank <= {k}" if k else ""
    return f"""SELECT CAST(rank AS BIGINT) AS rank, name, CAST(count AS BIGINT) AS count FROM (
  SELECT name, count, row_number() OVER (ORDER BY {order}) AS rank FROM ({counts_sql}) c) r {lim}"""


C_REPO = "SELECT repo AS name, count(*) AS count FROM s GROUP BY repo"
C_PUSH = "SELECT repo AS name, count(*) AS count FROM s WHERE type = 'PushEvent' GROUP BY repo"
C_COMMITS = "SELECT repo AS name, sum(commits) AS count FROM s WHERE type = 'PushEvent' GROUP BY repo"
C_USER = 'SELECT "user" AS name, count(*) AS count FROM s GROUP BY "user"'
C_LANG = "SELECT language AS name, count(*) AS count FROM s WHERE language IS NOT NULL GROUP BY language"
C_LANG3 = "SELECT language3 AS name, count(*) AS count FROM s WHERE language3 IS NOT NULL GROUP BY language3"
C_TYPE = "SELECT type AS name, count(*) AS count FROM s GROUP BY type"
C_HOUR = "SELECT hour AS name, count(*) AS count FROM s WHERE hour IS NOT NULL GROUP BY hour"

REPORT = f"""
, m AS (
  SELECT 'top_repos' AS metric, name, count FROM ({C_REPO}) a
  UNION ALL SELECT 'top_push_repos', name, count FROM ({C_PUSH}) b
  UNION ALL SELECT 'top_commit_repos', name, count FROM ({C_COMMITS}) c
  UNION ALL SELECT 'top_users', name, count FROM ({C_USER}) d
  UNION ALL SELECT 'languages', name, count FROM ({C_LANG}) e
  UNION ALL SELECT 'event_types', name, count FROM ({C_TYPE}) f
  UNION ALL SELECT 'hours', name, count FROM ({C_HOUR}) g
), rep AS (
  SELECT metric, CAST(rank AS BIGINT) AS rank, name, CAST(count AS BIGINT) AS count FROM (
    SELECT *, row_number() OVER (PARTITION BY metric
                                 ORDER BY CASE WHEN metric = 'hours' THEN name END, count DESC, name) AS rank
    FROM m) x
  WHERE rank <= CASE metric WHEN 'top_repos' THEN 15 WHEN 'top_push_repos' THEN 15
                            WHEN 'top_commit_repos' THEN 15 WHEN 'top_users' THEN 15
                            WHEN 'languages' THEN 20 WHEN 'event_types' THEN 20
                            ELSE 1000000000 END
)"""


PAYLOAD_KEYS = """CASE s.event_type WHEN 'purchase' THEN CASE WHEN s.event_id % 3 = 1 THEN 'commits' ELSE 'commits,size' END
  WHEN 'click' THEN 'pull_request' WHEN 'signup' THEN 'forkee' WHEN 'error' THEN 'repository'
  ELSE CASE WHEN s.event_id % 4 = 0 THEN 'a,a.b,deep,k1,k2,k3,k4,k5,mix,mix2,n' ELSE '' END END"""
FIRST_KEYS = PAYLOAD_KEYS.replace(",k5,mix,mix2,n", "").replace("k4", "k4,k5")

PROFILE_ENTRIES = """
, pe AS (
  SELECT 'id' AS path, 'string' AS t FROM s
  UNION ALL SELECT 'type', 'string' FROM s WHERE raw_type IS NOT NULL
  UNION ALL SELECT 'actor', 'struct' FROM s
  UNION ALL SELECT 'actor.login', 'string' FROM s WHERE raw_login IS NOT NULL
  UNION ALL SELECT 'actor.display_login', 'string' FROM s WHERE user_id % 11 <> 0
  UNION ALL SELECT 'repo', 'struct' FROM s
  UNION ALL SELECT 'repo.name', 'string' FROM s WHERE raw_repo IS NOT NULL
  UNION ALL SELECT 'created_at', 'string' FROM s
  UNION ALL SELECT 'payload', 'struct' FROM s WHERE NOT (event_type = 'view' AND event_id % 2 = 1)
  UNION ALL SELECT 'payload.size', CASE WHEN event_id % 3 = 0 THEN 'long' ELSE 'string' END FROM s
            WHERE event_type = 'purchase' AND event_id % 3 <> 1
  UNION ALL SELECT 'payload.commits', 'array' FROM s WHERE event_type = 'purchase'
  UNION ALL SELECT 'payload.commits[]', 'struct' FROM s WHERE event_type = 'purchase' AND n_commits > 0
  UNION ALL SELECT 'payload.commits[].sha', 'string' FROM s WHERE event_type = 'purchase' AND n_commits > 0
  UNION ALL SELECT p, t FROM s, (VALUES ('payload.pull_request', 'struct'), ('payload.pull_request.base', 'struct'),
            ('payload.pull_request.base.repo', 'struct'), ('payload.pull_request.base.repo.language', 'string'),
            ('payload.pull_request.head', 'struct'), ('payload.pull_request.head.repo', 'struct'),
            ('payload.pull_request.head.repo.language', 'string')) v(p, t) WHERE event_type = 'click'
  UNION ALL SELECT p, t FROM s, (VALUES ('payload.`a.b`', 'long'), ('payload.a', 'struct'), ('payload.a.b', 'string'),
            ('payload.n', 'null'), ('payload.mix', 'array'), ('payload.mix[]', 'struct'), ('payload.mix[].x', 'long'),
            ('payload.mix[].y', 'string'), ('payload.mix[].z', 'long'), ('payload.mix2', 'array'), ('payload.k1', 'long'),
            ('payload.k2', 'long'), ('payload.k3', 'long'), ('payload.k4', 'long'), ('payload.k5', 'long'), ('payload.deep', 'struct')) v(p, t)
            WHERE event_type = 'view' AND event_id % 4 = 0
  UNION ALL SELECT concat('payload.deep', array_to_string(list_transform(range(1, d + 1), lambda i: concat('.d', i)), '')),
            CASE d WHEN 14 THEN 'boolean' ELSE 'struct' END
            FROM s, range(1, 15) r(d) WHERE event_type = 'view' AND event_id % 4 = 0
  UNION ALL SELECT 'payload.forkee', 'struct' FROM s WHERE event_type = 'signup'
  UNION ALL SELECT 'payload.forkee.language', 'string' FROM s WHERE event_type = 'signup' AND k % 6 <> 0
  UNION ALL SELECT 'payload.repository', 'struct' FROM s WHERE event_type = 'error'
  UNION ALL SELECT 'payload.repository.language', 'string' FROM s WHERE event_type = 'error'
)"""


#: A14 over the entries, and the merged schema (A13) from which fields occur.
PROFILE = """
SELECT path, array_to_string(list_sort(list(DISTINCT t)), ',') AS types_seen, CAST(count(*) AS BIGINT) AS present_rows
FROM pe GROUP BY path
UNION ALL SELECT 'payload.mix2[]', 'long,string', CAST(count(*) AS BIGINT) FROM s WHERE event_type = 'view' AND event_id % 4 = 0
HAVING count(*) > 0"""


def _agreement(name: str, left: str, right: str, n: int = 5) -> str:
    return f"""SELECT '{name}' AS pair, coalesce(bool_and(l.name IS NOT DISTINCT FROM r.name), true) AS agree,
  CAST(count(*) AS BIGINT) AS compared,
  CAST(min(CASE WHEN l.name IS DISTINCT FROM r.name THEN coalesce(l.rank, r.rank) END) AS BIGINT) AS first_diff_rank
FROM (SELECT * FROM ({left}) a WHERE rank <= {n}) l FULL OUTER JOIN (SELECT * FROM ({right}) b WHERE rank <= {n}) r
  ON l.rank = r.rank"""


def _rep(metric: str) -> str:
    return f"SELECT rank, name FROM rep WHERE metric = '{metric}'"


ORACLE_SQL: dict[str, str] = {
    "scan_inferred": BASE + """
SELECT CASE WHEN broken IN (0, 6, 7) THEN '_corrupt' WHEN NOT valid THEN '(absent)' ELSE coalesce(raw_type, '(absent)') END AS type_name,
       CAST(count(*) AS BIGINT) AS rows
FROM ev GROUP BY 1""",
    "scan_declared": BASE + """
SELECT CASE WHEN NOT valid THEN '_corrupt' ELSE coalesce(raw_type, '(absent)') END AS type_name,
       CAST(count(*) AS BIGINT) AS rows
FROM ev GROUP BY 1""",
    "scan_lines": BASE + "\nSELECT valid, CAST(count(*) AS BIGINT) AS lines FROM ev GROUP BY valid",
    "malformed_lines": BASE + """
SELECT ['invalid_json', 'trailing_text', 'trailing_text', 'trailing_text', 'not_object', 'bad_field_type', 'invalid_json', 'invalid_json'][broken + 1] AS reason,
       CAST(count(*) AS BIGINT) AS lines
FROM ev WHERE NOT valid GROUP BY 1""",
    "first_n_events": BASE + """
SELECT * FROM (SELECT CAST(row_number() OVER (ORDER BY created_at, id) AS BIGINT) AS rank, id, created_at, type FROM s) x
WHERE rank <= 20""",
    "first_n_lines": BASE + """
SELECT * FROM (SELECT CAST(row_number() OVER (ORDER BY event_id) AS BIGINT) AS rank, valid,
                      CASE WHEN valid THEN id END AS id FROM ev) x
WHERE rank <= 20""",
    "hourly_gzip_ingest": BASE + """
SELECT strftime(ts, '%H') AS source_hour, CAST(count(*) AS BIGINT) AS lines, CAST(count_if(valid) AS BIGINT) AS valid_events
FROM ev GROUP BY 1""",
    "required_fields": BASE + """
SELECT 'type' AS field, CAST(count_if(raw_type IS NULL) AS BIGINT) AS missing_rows FROM s
UNION ALL SELECT 'actor', CAST(0 AS BIGINT)
UNION ALL SELECT 'repo', CAST(0 AS BIGINT)
UNION ALL SELECT 'payload', CAST(count_if(event_type = 'view' AND event_id % 2 = 1) AS BIGINT) FROM s""",
    "publish_roundtrip": BASE + "\nSELECT type, CAST(count(*) AS BIGINT) AS events FROM s GROUP BY type",
    "publish_result": BASE + "\nSELECT CAST(count(*) AS BIGINT) AS rows, 'local' AS mode, true AS bytes_match FROM ev",
    "volume_gate": BASE + "\nSELECT CAST(count(*) AS BIGINT) AS events, CAST(50 AS BIGINT) AS minimum, count(*) >= 50 AS passed FROM s",
    "json_sink_roundtrip": BASE + "\n" + _ranking(C_PUSH, 15),
    "text_sink_roundtrip": BASE + "\nSELECT key, kind, name, event_type, value FROM ml",
    "report_long": BASE + REPORT + "\nSELECT * FROM rep",
    "report_document": BASE + REPORT + """
, tot AS (
  SELECT * FROM (SELECT repo, row_number() OVER (ORDER BY count(*) DESC, repo) AS r FROM s GROUP BY repo) x WHERE r <= 15
), cnt AS (
  SELECT (SELECT count(*) FROM s) AS records, (SELECT count(*) FROM ev WHERE NOT valid) AS malformed,
         (SELECT count(*) FROM em) AS emissions, (SELECT count(*) FROM ml) AS keys)
SELECT metric, rank, name, count FROM rep
UNION ALL SELECT 'repo_type_matrix', CAST(r AS BIGINT), concat_ws('|', s.repo, s.type), CAST(count(*) AS BIGINT)
  FROM s JOIN tot USING (repo) GROUP BY r, s.repo, s.type
UNION ALL SELECT 'counters', CAST(1 AS BIGINT), 'records', CAST(records AS BIGINT) FROM cnt
UNION ALL SELECT 'counters', CAST(2 AS BIGINT), 'malformed', CAST(malformed AS BIGINT) FROM cnt
UNION ALL SELECT 'counters', CAST(3 AS BIGINT), 'emissions', CAST(emissions AS BIGINT) FROM cnt
UNION ALL SELECT 'counters', CAST(4 AS BIGINT), 'keys', CAST(keys AS BIGINT) FROM cnt""",
    "hourly_stream_report": BASE + REPORT + "\nSELECT * FROM rep",
    "ndjson_roundtrip": BASE + """
SELECT id, type, repo, "user", language, hour, CAST(commits AS BIGINT) AS commits, created_at, CAST(8 AS BIGINT) AS n_keys FROM s""",
    "dataset_summary": BASE + """
SELECT 'archive' AS source, true AS bytes_match, CAST(count(*) AS BIGINT) AS events, CAST(count(DISTINCT d || h) AS BIGINT) AS files,
       array_to_string(list_sort(list(DISTINCT d)), ',') AS days, array_to_string(list_sort(list(DISTINCT h)), ',') AS hours,
       CAST(count(DISTINCT h) AS BIGINT) AS n_hours
FROM (SELECT strftime(ts, '%H') AS h, strftime(ts, '%Y-%m-%d') AS d FROM ev) x""",
    "hourly_append": BASE + """
SELECT strftime(ts, '%Y-%m-%d') AS day, CAST(strftime(ts, '%H') AS INTEGER) AS hour, CAST(count(*) AS BIGINT) AS lines,
       CAST(count(*) AS BIGINT) AS rows, CAST(count(*) AS BIGINT) AS listed
FROM ev GROUP BY 1, 2""",
    "hourly_ingest_status": BASE + """
SELECT CAST(h AS INTEGER) AS hour, CAST(count(event_id) AS BIGINT) AS lines, CAST(count(event_id) AS BIGINT) AS rows, h NOT IN (5, 9, 11) AS complete,
       CASE h WHEN 5 THEN 'truncated' WHEN 9 THEN 'not_gzip' WHEN 11 THEN 'missing' END AS error, h NOT IN (7, 11) AS has_bytes
FROM range(24) r(h) LEFT JOIN ev ON CAST(strftime(ts, '%H') AS INTEGER) = h AND h NOT IN (7, 9, 11) AND (h <> 5 OR event_id % 2 = 0)
GROUP BY h""",
    "capped_ingest": BASE + """
, q AS (
  SELECT h, CASE WHEN valid THEN id END AS id, row_number() OVER (PARTITION BY h ORDER BY event_id) AS line_no,
         row_number() OVER (ORDER BY h, event_id) AS n
  FROM (SELECT *, CAST(strftime(ts, '%H') AS INTEGER) AS h FROM ev) x WHERE h < 5 OR h = 5 AND event_id % 2 = 0
), t AS (SELECT * FROM q WHERE n <= 1500), e AS (SELECT count(*) AS events FROM t)
SELECT h AS hour, CAST(line_no AS BIGINT) AS line_no, id,
  (SELECT array_to_string(list_sort(list(DISTINCT h)), ',') FROM t, e WHERE h < 5 OR events = 1500) AS hours,
  CAST(events AS BIGINT) AS events, CASE WHEN events < 1500 THEN 5 END AS failed
FROM t, e""",
    "push_events": BASE + "\nSELECT id, repo, CAST(commits AS BIGINT) AS commits FROM s WHERE type = 'PushEvent'",
    "language_events": BASE + "\nSELECT id, language FROM s WHERE language IS NOT NULL",
    "nested_paths": BASE + """
SELECT id, raw_login AS login, raw_repo AS repo_name,
  CASE WHEN event_type = 'click' THEN CASE WHEN k % 4 = 0 THEN '' ELSE lang END END AS base_language,
  CASE WHEN event_type = 'signup' AND k % 6 <> 0 THEN lang END AS forkee_language,
  CASE WHEN event_type = 'purchase' AND event_id % 3 = 0 THEN CAST(event_id % 6 AS VARCHAR)
       WHEN event_type = 'purchase' AND event_id % 3 = 2 THEN concat('"', event_id % 9, '"') END AS size_json
FROM s""",
    "path_coverage": BASE + """
SELECT p AS path, CAST(n AS BIGINT) AS present_rows FROM (
  SELECT '$.pull_request.base.repo.language' AS p, count_if(event_type = 'click') AS n FROM s
  UNION ALL SELECT '$.pull_request.head.repo.language', count_if(event_type = 'click') FROM s
  UNION ALL SELECT '$.forkee.language', count_if(event_type = 'signup' AND k % 6 <> 0) FROM s
  UNION ALL SELECT '$.repository.language', count_if(event_type = 'error') FROM s
  UNION ALL SELECT '$.size', count_if(event_type = 'purchase' AND event_id % 3 <> 1) FROM s
  UNION ALL SELECT '$.commits', count_if(event_type = 'purchase') FROM s
  UNION ALL SELECT '$.forkee', count_if(event_type = 'signup') FROM s
  UNION ALL SELECT '$.pull_request', count_if(event_type = 'click') FROM s) x""",
    "preview": BASE + f"""
SELECT * FROM (
  SELECT CAST(row_number() OVER (ORDER BY event_id) AS BIGINT) AS rank, id, raw_type AS type, "user" AS actor, repo,
         created_at, language, {FIRST_KEYS} AS payload_keys
  FROM s) x WHERE rank <= 20""",
    "normalized_events": BASE + """
SELECT id, type, repo, "user", language, CAST(commits AS BIGINT) AS commits, hour FROM s""",
    "languages_3path": BASE + "\n" + _ranking(C_LANG3, 20),
    "payload_keys": BASE + f"\nSELECT id, {PAYLOAD_KEYS} AS payload_keys FROM s",
    "keyvalue_decode": BASE + "\nSELECT key, kind, name, event_type, value FROM ml",
    "keyvalue_parse": BASE + """
SELECT CASE WHEN kind = 'evt' THEN concat_ws('|', kind, name, event_type) ELSE concat_ws('|', kind, name) END AS key,
       CAST(sum(CASE WHEN event_id % 17 = 0 OR event_id % 19 = 0 THEN 1 ELSE value END) AS BIGINT) AS value
FROM em GROUP BY 1""",
    "commit_volume_size_only": BASE + "\n" + _ranking(
        "SELECT repo AS name, sum(size_only) AS count FROM s WHERE type = 'PushEvent' GROUP BY repo", 15),
    "ranking_with_blank_names": BASE + "\n" + _ranking(
        "SELECT coalesce(raw_login, '') AS name, count(*) AS count FROM s GROUP BY raw_login", 15),
    "emissions": BASE + """
SELECT id, kind, CASE WHEN kind = 'evt' THEN concat_ws('|', kind, name, event_type) ELSE concat_ws('|', kind, name) END AS key,
       CAST(value AS BIGINT) AS value
FROM em""",
    "top_repos": BASE + "\n" + _ranking(C_REPO, 15),
    "top_push_repos": BASE + "\n" + _ranking(C_PUSH, 15),
    "top_commit_repos": BASE + "\n" + _ranking(C_COMMITS, 15),
    "top_users": BASE + "\n" + _ranking(C_USER, 15),
    "languages": BASE + "\n" + _ranking(C_LANG, 20),
    "event_types": BASE + "\n" + _ranking(C_TYPE, None),
    "events_by_hour": BASE + "\n" + _ranking(C_HOUR, None, by_name=True),
    "repo_type_counts": BASE + "\nSELECT repo, type AS event_type, CAST(count(*) AS BIGINT) AS count FROM s GROUP BY repo, type",
    "repo_type_rollup": BASE + """
SELECT repo, type AS event_type, CAST(0 AS BIGINT) AS level, CAST(count(*) AS BIGINT) AS count FROM s GROUP BY repo, type
UNION ALL SELECT repo, NULL, CAST(1 AS BIGINT), CAST(count(*) AS BIGINT) FROM s GROUP BY repo""",
    "repo_type_matrix_top15": BASE + f"""
, tot AS (
  SELECT * FROM (SELECT repo, count(*) AS total, row_number() OVER (ORDER BY count(*) DESC, repo) AS repo_rank
                 FROM s GROUP BY repo) x WHERE repo_rank <= 15
), pairs AS (SELECT repo, type, count(*) AS c FROM s GROUP BY repo, type)
SELECT CAST(t.repo_rank AS BIGINT) AS repo_rank, t.repo, CAST(t.total AS BIGINT) AS total,
       concat('{{', string_agg(concat('"', p.type, '":', p.c), ',' ORDER BY p.type), '}}') AS types_json
FROM tot t JOIN pairs p ON p.repo = t.repo GROUP BY t.repo_rank, t.repo, t.total""",
    "repo_type_matrix_wide": BASE + """
, tot AS (
  SELECT * FROM (SELECT repo, count(*) AS total, row_number() OVER (ORDER BY count(*) DESC, repo) AS repo_rank
                 FROM s GROUP BY repo) x WHERE repo_rank <= 15
), t AS (SELECT DISTINCT type FROM s)
, cells AS (
  SELECT CAST(repo_rank AS BIGINT) AS repo_rank, repo, CAST(total AS BIGINT) AS total, t.type, count(s.event_id) AS n
  FROM tot CROSS JOIN t LEFT JOIN s USING (repo, type) GROUP BY ALL)
SELECT * FROM (PIVOT cells ON type USING CAST(sum(n) AS BIGINT) GROUP BY repo_rank, repo, total)""",
    "metrics_long": BASE + "\nSELECT kind, name, event_type, value FROM ml",
    "run_counters": BASE + """
SELECT (SELECT CAST(count(*) AS BIGINT) FROM s) AS records,
       (SELECT CAST(count(*) AS BIGINT) FROM ev WHERE NOT valid) AS malformed,
       (SELECT CAST(count(*) AS BIGINT) FROM em) AS emissions,
       (SELECT CAST(count(*) AS BIGINT) FROM ml) AS keys""",
    "schema_inferred": BASE + """
, flags AS (
  SELECT count(*) AS records,
    bool_or(user_id % 11 <> 0) AS has_dl, bool_or(raw_login IS NOT NULL) AS has_login,
    bool_or(NOT (event_type = 'view' AND event_id % 2 = 1)) AS has_payload,
    bool_or(event_type = 'purchase') AS has_push, bool_or(event_type = 'purchase' AND n_commits > 0) AS has_commit,
    bool_or(event_type = 'signup') AS has_fork, bool_or(event_type = 'signup' AND k % 6 <> 0) AS has_fork_lang,
    bool_or(event_type = 'view' AND event_id % 4 = 0) AS has_rich,
    bool_or(event_type = 'click') AS has_pr, bool_or(event_type = 'error') AS has_issue,
    bool_or(event_type = 'purchase' AND event_id % 3 = 0) AS size_int,
    bool_or(event_type = 'purchase' AND event_id % 3 = 2) AS size_str,
    bool_or(raw_repo IS NOT NULL) AS has_repo_name, bool_or(raw_type IS NOT NULL) AS has_type
  FROM s)
SELECT CAST(records AS BIGINT) AS records,
  'OBJECT<' || array_to_string(list_filter([
    'actor: OBJECT<' || array_to_string(list_filter([CASE WHEN has_dl THEN 'display_login: STRING' END,
                                                     CASE WHEN has_login THEN 'login: STRING' END], lambda x: x IS NOT NULL), ', ') || '>',
    'created_at: STRING', 'id: STRING',
    CASE WHEN has_payload THEN 'payload: OBJECT<' || array_to_string(list_filter([
      CASE WHEN has_rich THEN 'a: OBJECT<b: STRING>, `a.b`: BIGINT' END,
      CASE WHEN has_push THEN 'commits: ARRAY<' || CASE WHEN has_commit THEN 'OBJECT<sha: STRING>' ELSE 'VOID' END || '>' END,
      CASE WHEN has_rich THEN 'deep: ' || array_to_string(list_transform(range(1, 15), lambda i: concat('OBJECT<d', i, ': ')), '')
                              || 'BOOLEAN' || repeat('>', 14) END,
      CASE WHEN has_fork THEN 'forkee: OBJECT<' || CASE WHEN has_fork_lang THEN 'language: STRING' ELSE '' END || '>' END,
      CASE WHEN has_rich THEN 'k1: BIGINT, k2: BIGINT, k3: BIGINT, k4: BIGINT, k5: BIGINT, '
                              || 'mix: ARRAY<OBJECT<x: BIGINT, y: STRING, z: BIGINT>>, mix2: ARRAY<VARIANT>, n: VOID' END,
      CASE WHEN has_pr THEN 'pull_request: OBJECT<base: OBJECT<repo: OBJECT<language: STRING>>, '
                            || 'head: OBJECT<repo: OBJECT<language: STRING>>>' END,
      CASE WHEN has_issue THEN 'repository: OBJECT<language: STRING>' END,
      CASE WHEN size_int AND size_str THEN 'size: VARIANT' WHEN size_int THEN 'size: BIGINT'
           WHEN size_str THEN 'size: STRING' END], lambda x: x IS NOT NULL), ', ') || '>' END,
    'repo: OBJECT<' || CASE WHEN has_repo_name THEN 'name: STRING' ELSE '' END || '>',
    CASE WHEN has_type THEN 'type: STRING' END], lambda x: x IS NOT NULL), ', ') || '>' AS schema
FROM flags""",
    "schema_profile": BASE + PROFILE_ENTRIES + PROFILE,
    "schema_field_count": BASE + PROFILE_ENTRIES + """
, prof AS (SELECT path, list_sort(list(DISTINCT t)) AS ts FROM pe GROUP BY path
  UNION ALL SELECT 'payload.mix2[]', ['long', 'string'] FROM s WHERE event_type = 'view' AND event_id % 4 = 0 GROUP BY 1)
SELECT CAST(count_if(NOT ends_with(path, '[]')) AS BIGINT) AS fields,
       CAST(count_if(NOT list_contains(ts, 'struct') AND NOT list_contains(ts, 'array')) AS BIGINT) AS leaves,
       CAST(count_if(NOT ends_with(path, '[]'))
            + count_if(NOT list_contains(ts, 'struct') AND NOT list_contains(ts, 'array'))
            + count_if(list_contains(ts, 'array'))
            + count_if(list_contains(ts, 'array') AND NOT EXISTS (SELECT 1 FROM prof q WHERE q.path = prof.path || '[]'))
            AS BIGINT) AS score
FROM prof""",
    "all_push_repos": BASE + "\n" + _ranking(C_PUSH, None),
    "all_users": BASE + "\n" + _ranking(C_USER, None),
    "keyvalue_sorted": BASE + """
SELECT CAST(row_number() OVER (ORDER BY key) AS BIGINT) AS rank, key, value FROM ml""",
    "events_by_time": BASE + """
SELECT CAST(row_number() OVER (ORDER BY created_at, id) AS BIGINT) AS rank, id, created_at FROM s""",
    "leader_headline": BASE + REPORT + """
SELECT metric, max(CASE WHEN rank = 1 THEN name END) AS leader, max(CASE WHEN rank = 1 THEN count END) AS leader_count,
       CAST(count(*) AS BIGINT) AS entries, (SELECT CAST(count(*) AS BIGINT) FROM s) AS records
FROM rep GROUP BY metric""",
    "ranking_agreement": BASE + REPORT + "\n" + "\nUNION ALL\n".join([
        _agreement("top_repos", _rep("top_repos"), _ranking(C_REPO, 15)),
        _agreement("top_users", _rep("top_users"), _ranking(C_USER, 15)),
        _agreement("languages_4_vs_3", _rep("languages"), _ranking(C_LANG3, 20)),
    ]),
    "ranking_fallback": BASE + REPORT + f"""
, prim AS (
  SELECT 'top_push_repos' AS metric, * FROM ({_ranking(C_PUSH, 15)}) a
  UNION ALL SELECT 'top_users', * FROM ({_ranking(C_USER, 15)}) b
  UNION ALL SELECT 'languages', * FROM ({_ranking(C_LANG3, 20)}) c
)
SELECT metric, rank, name, count, 'primary' AS source FROM prim
UNION ALL SELECT metric, rank, name, count, 'secondary' FROM rep WHERE metric NOT IN (SELECT metric FROM prim)""",
}

_QUERY = {name: sql.removeprefix(BASE) for name, sql in ORACLE_SQL.items()}
_FLAGS, _SCHEMA = _QUERY["schema_inferred"].split("\nSELECT CAST(records", 1)
ORACLE_SQL["discovery_document"] = BASE + PROFILE_ENTRIES + _FLAGS + f"""
SELECT 'schema' AS part, '' AS name, schema AS types, records AS rows FROM (SELECT CAST(records{_SCHEMA}) a
UNION ALL SELECT 'profile', path, types_seen, present_rows FROM ({PROFILE}) b
UNION ALL SELECT 'required', field, NULL, missing_rows FROM ({_QUERY["required_fields"]}) c
UNION ALL SELECT 'coverage', path, NULL, present_rows FROM ({_QUERY["path_coverage"]}) d"""
