"""Golden edge lines: one or more per ragged case (C1-C12) and per
quarantine reason, checked field by field after parse + normalize."""

from collections import Counter

from conftest import lines_df

from eventlens.operators.normalize import normalize
from eventlens.sources.json_scan import parse_events
from eventlens.sources.lines import strip_lines

GOOD = {
    # Empty base language falls through to head
    "pr_empty_base": ('{"id":"1","type":"PullRequestEvent","payload":{"pull_request":{"base":{"repo":{"language":""}},'
                      '"head":{"repo":{"language":"Go"}}}}}', {"language": "Go"}),
    "pr_base_first": ('{"id":"2","type":"PullRequestEvent","payload":{"pull_request":{"base":{"repo":{"language":"Java"}},'
                      '"head":{"repo":{"language":"Go"}}}}}', {"language": "Java"}),
    "fork_lang": ('{"id":"3","type":"ForkEvent","payload":{"forkee":{"language":"Rust"}}}', {"language": "Rust"}),
    "repository_lang": ('{"id":"4","type":"IssuesEvent","payload":{"repository":{"language":"C"}}}', {"language": "C"}),
    "no_lang": ('{"id":"5","type":"ForkEvent","payload":{"forkee":{}}}', {"language": None}),
    "forkee_string": ('{"id":"6","type":"ForkEvent","payload":{"forkee":"x","repository":{"language":"Zig"}}}',
                      {"language": "Zig"}),
    # Commit count
    "size_int": ('{"id":"10","type":"PushEvent","payload":{"size":3,"commits":[1]}}', {"commits": 3}),
    "size_string": ('{"id":"11","type":"PushEvent","payload":{"size":"3","commits":[1,2]}}', {"commits": 2}),
    "size_float": ('{"id":"12","type":"PushEvent","payload":{"size":2.0}}', {"commits": 0}),
    "size_bool": ('{"id":"13","type":"PushEvent","payload":{"size":true,"commits":[{"sha":"a"}]}}', {"commits": 1}),
    "no_size_list": ('{"id":"14","type":"PushEvent","payload":{"commits":[{},{},{}]}}', {"commits": 3}),
    "commits_not_list": ('{"id":"15","type":"PushEvent","payload":{"commits":"abc"}}', {"commits": 0}),
    "payload_string": ('{"id":"16","type":"PushEvent","payload":"str"}', {"commits": 0, "language": None}),
    "payload_missing": ('{"id":"17","type":"PushEvent"}', {"commits": 0}),
    "dup_size": ('{"id":"18","type":"PushEvent","payload":{"size":1,"size":7}}', {"commits": 7}),
    "not_push": ('{"id":"19","type":"WatchEvent","payload":{"size":4}}', {"commits": None}),
    # C4: users
    "login": ('{"id":"20","actor":{"login":"ann","display_login":"Ann"}}', {"user": "ann"}),
    "login_empty": ('{"id":"21","actor":{"login":"","display_login":"Ann"}}', {"user": "Ann"}),
    "login_missing": ('{"id":"22","actor":{"display_login":"Ann"}}', {"user": "Ann"}),
    "no_names": ('{"id":"23","actor":{"login":"","display_login":""}}', {"user": "unknown"}),
    "actor_null": ('{"id":"24","actor":null}', {"user": "unknown"}),
    # C5 / C6
    "repo_missing": ('{"id":"30"}', {"repo": "unknown/unknown", "type": "Unknown"}),
    "repo_empty": ('{"id":"31","repo":{"name":""},"type":""}', {"repo": "unknown/unknown", "type": "Unknown"}),
    "dup_type": ('{"id":"32","type":"A","type":"B"}', {"type": "B"}),
    # hours
    # falsy values of another type count as missing, other fields are read
    "actor_empty_string": ('{"id":"33","actor":"","type":"PushEvent","payload":{"size":2}}', {"user": "unknown", "commits": 2}),
    "actor_empty_list": ('{"id":"34","actor":[],"repo":{"name":"o/r"}}', {"user": "unknown", "repo": "o/r"}),
    "repo_zero": ('{"id":"35","repo":0,"type":"A"}', {"repo": "unknown/unknown", "type": "A"}),
    "language_false": ('{"id":"36","payload":{"pull_request":{"base":{"repo":{"language":false}}},"repository":{"language":"Go"}}}',
                       {"language": "Go"}),
    "language_zero": ('{"id":"37","payload":{"forkee":{"language":0},"repository":{"language":"Go"}}}', {"language": "Go"}),
    "hour": ('{"id":"40","created_at":"2023-03-15T05:06:07Z"}', {"hour": "05"}),
    "short_ts": ('{"id":"41","created_at":"2023-03-15"}', {"hour": None}),
    "no_ts": ('{"id":"42"}', {"hour": None}),
    "empty_object": ("{}", {"type": "Unknown", "user": "unknown", "repo": "unknown/unknown"}),
    "padded": ('  \t{"id":"43","type":"PushEvent","payload":{"size":2}} \t', {"commits": 2}),
}

BAD = {
    "truncated": ('{"id":"broken"', "invalid_json"),
    "not_json": ("hello", "not_object"),
    "top_array": ('[{"id":"1"}]', "not_object"),
    "json_null": ("null", "not_object"),
    "json_string": ('"x"', "not_object"),
    "number": ("42", "not_object"),
    "trailing": ('{"id":"1"} junk', "trailing_text"),
    "actor_string": ('{"id":"1","actor":"bob"}', "bad_field_type"),
    "repo_number": ('{"id":"1","repo":5}', "bad_field_type"),
    "two_objects": ('{"id":"1"} {"id":"2"}', "trailing_text"),
    "two_objects_comma": ('{"id":"1"},{"id":"2"}', "trailing_text"),
    "junk_then_brace": ('{"id":"1"}, junk}', "trailing_text"),
    "extra_brace": ('{"id":"1"}}', "trailing_text"),
    "actor_and_junk": ('{"id":"1","actor":"bob"} x', "trailing_text"),
}


def test_golden_good_lines(spark):
    lines = [v[0] for v in GOOD.values()] + ["", "   ", "\t"]
    parsed = parse_events(strip_lines(lines_df(spark, lines)))
    rows = {r["line"]: r for r in parsed.collect()}
    assert len(rows) == len(GOOD)  # blank lines are skipped
    assert all(r["valid"] for r in rows.values()), [r for r in rows.values() if not r["valid"]]
    silver = {r["id"]: r for r in normalize(parsed.where("valid")).collect()}
    for name, (line, expect) in GOOD.items():
        rid = str(__import__("json").loads(line).get("id")) if line.strip().startswith("{") and '"id"' in line else None
        row = silver[rid]
        for k, v in expect.items():
            assert row[k] == v, (name, k, row[k], v)


def test_golden_bad_lines(spark):
    parsed = parse_events(lines_df(spark, [v[0] for v in BAD.values()]))
    got = {r["line"]: (r["valid"], r["reason"]) for r in parsed.collect()}
    for name, (line, reason) in BAD.items():
        assert got[line] == (False, reason), (name, got[line])


def test_bad_lines_never_reach_metrics(spark):
    from eventlens.operators.aggregates import run_counters

    lines = [v[0] for v in GOOD.values()] + [v[0] for v in BAD.values()]
    c = run_counters(parse_events(strip_lines(lines_df(spark, lines)))).collect()[0]
    assert c["records"] == len(GOOD)
    assert c["malformed"] == len(BAD)


def test_schema_score_matches_recursive_rule(spark):
    """The path-based score equals the recursive struct/array/leaf count."""
    import json

    from eventlens.operators.schema_profile import schema_field_count

    recs = ['{"a":1,"b":{"c":"x","d":[1,2]},"e":[],"f":[{"g":true}]}', '{"a":2,"h":null}']

    def tree(v):
        if isinstance(v, dict):
            return {"t": "struct", "f": {k: tree(x) for k, x in v.items()}}
        if isinstance(v, list):
            return {"t": "array", "e": tree(v[0]) if v else "null"}
        return "leaf"

    def merge(a, b):
        if a is None:
            return b
        if isinstance(a, dict) and isinstance(b, dict) and a["t"] == b["t"] == "struct":
            return {"t": "struct", "f": {k: merge(a["f"].get(k), b["f"].get(k)) for k in set(a["f"]) | set(b["f"])}}
        return a if b is None else a

    def score(t):
        if isinstance(t, dict) and t["t"] == "struct":
            return len(t["f"]) + sum(score(x) for x in t["f"].values())
        if isinstance(t, dict) and t["t"] == "array":
            return 1 + score(t["e"])
        return 1

    merged = None
    for r in recs:
        merged = merge(merged, tree(json.loads(r)))
    got = schema_field_count(lines_df(spark, recs)).collect()[0]
    assert got["score"] == score(merged)


def test_profile_sees_every_depth_element_and_key(spark):
    import json

    from eventlens.operators.schema_profile import infer_schema, schema_field_count, schema_profile

    deep = True
    for i in range(15, 0, -1):
        deep = {f"d{i}": deep}
    lines = lines_df(spark, [json.dumps(deep), '{"a":[{"x":1},{"y":"s","z":2}]}', '{"a.b":1,"b":{"c":"s"},"":{"`":null}}', "[1]", '{"a":1} x'])
    got = {r["path"]: (r["types_seen"], r["present_rows"]) for r in schema_profile(lines).collect()}
    chain = ".".join(f"d{i}" for i in range(1, 16))
    assert got[chain] == ("boolean", 1) and sum(p.startswith("d1") for p in got) == 15
    assert got["a[].x"] == ("long", 1) and got["a[].y"] == ("string", 1) and got["a[]"] == ("struct", 1)
    assert got["`a.b`"] == ("long", 1) and got["b.c"] == ("string", 1) and got["``.````"] == ("null", 1)
    one = schema_field_count(lines_df(spark, [json.dumps(deep)])).collect()[0]
    assert (one["fields"], one["leaves"], one["score"]) == (15, 1, 16)
    # discovery and profile name the same fields
    schema = infer_schema(lines).collect()[0]["schema"]
    for path in got:
        leaf = path.removesuffix("[]").split(".")[-1]
        assert f"{leaf.removesuffix('[]')}: " in schema or "`" in path, path


def test_same_lines_are_valid_for_envelope_and_schema(spark):
    from eventlens.sources.json_scan import valid_variants

    lines = lines_df(spark, [v[0].strip() for v in GOOD.values()] + [v[0] for v in BAD.values()])
    assert valid_variants(lines).count() == parse_events(lines).where("valid").count() == len(GOOD)


def test_declared_read_strips_and_skips_blank_lines(spark, tmp_path):
    from eventlens.sources.json_scan import read_declared

    (tmp_path / "x.json").write_text('  {"id":"1"} \t\n\n   \n{"id":"2"}\n')
    got = read_declared(spark, str(tmp_path)).collect()
    assert [(r["id"], r["valid"]) for r in got] == [("1", True), ("2", True)]


def test_commit_fallback_without_ansi(spark):
    """A push without size or commits counts 0 commits in any ANSI mode
    (legacy size(NULL) is -1 when ANSI is off)."""
    prev = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        lines = ['{"id":"1","type":"PushEvent"}', '{"id":"2","type":"PushEvent","payload":{"commits":[1,2]}}']
        got = {r["id"]: r["commits"] for r in normalize(parse_events(lines_df(spark, lines)).where("valid")).collect()}
        assert got == {"1": 0, "2": 2}
    finally:
        spark.conf.set("spark.sql.ansi.enabled", prev)


def test_profile_counts_in_the_task(spark, monkeypatch):
    """A task adds its lines' states up before they are shuffled, in a table
    of bounded size, with the variant's rules for numbers and repeated keys."""
    import pyarrow as pa

    from eventlens.operators import schema_profile as S

    lines = [
        '{"a":9223372036854775807,"b":-9223372036854775809,"c":1.0,"d":-0,"e":1e400,"f":[],"g":[[1],["x",null]]}',
        '{"a":1,"a":"x","a.b":{"":true},"z[]":[3],"\\ud800":{}}',
        '{"g":[[2.5]],"a":null}',
    ]
    want = {
        "a": ("long,null,string", 3), "b": ("double", 1), "c": ("double", 1), "d": ("long", 1), "e": ("double", 1), "f": ("array", 1),
        "g": ("array", 2), "g[]": ("array", 2), "g[][]": ("double,long,null,string", 2), "`a.b`": ("struct", 1), "`a.b`.``": ("boolean", 1),
        "`z[]`": ("array", 1), "`z[]`[]": ("long", 1), "?": ("struct", 1),
    }
    got = {r["path"]: (r["types_seen"], r["present_rows"]) for r in S.schema_profile(lines_df(spark, [*lines, "[1]", "", '{"a":NaN}'])).collect()}
    assert got == want

    batch = pa.RecordBatch.from_arrays([pa.array([x.encode() for x in lines * 500])], ["line"])
    whole = [b for b in S._counted(iter([batch, batch]))]
    assert len(whole) == 1 and whole[0].num_rows < 40
    monkeypatch.setattr(S, "TASK_STATES", 5)
    parts = [b for b in S._counted(iter([batch, batch]))]
    assert len(parts) > 100 and max(b.num_rows for b in parts) < 30
    sums = Counter()
    for b in parts:
        for r in b.to_pylist():
            sums[r["path"], r["type"], r["elem"]] += r["n"]
    assert dict(sums) == {(r["path"], r["type"], r["elem"]): r["n"] for r in whole[0].to_pylist()}
    assert sums[None, None, None] == 3000
