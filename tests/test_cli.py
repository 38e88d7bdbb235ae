"""Command line: report / profile / keyvalue / schema on the same lines."""

import pytest
from conftest import SF_SMALL

from eventlens.__main__ import main
from eventlens.session import scratch_path
from eventlens.sinks import read_published
from eventlens.sources.adapter import event_lines
from eventlens.sources.json_scan import parse_events


@pytest.fixture(scope="module")
def dump(spark):
    path = scratch_path(spark, "t-cli-in")
    event_lines(spark, SF_SMALL).write.text(path)
    return path


def test_cli_end_to_end(spark, dump):
    out, prof, kv, lake = (scratch_path(spark, f"t-cli-{n}") for n in ("out", "prof", "kv", "lake"))
    main(["report", "--input", dump, "--output", out])
    main(["profile", "--input", dump, "--output", prof, "--partitions", "3"])
    main(["keyvalue", "--input", dump, "--output", kv])
    main(["publish", "--input", dump, "--output", lake])

    parsed = parse_events(spark.read.text(dump))
    records, malformed = parsed.where("valid").count(), parsed.where("not valid").count()
    counters = spark.read.json(f"{out}/counters").collect()[0]
    assert counters["records"] == records and counters["malformed"] == malformed > 0
    kept = spark.read.json(f"{out}/quarantine")
    assert kept.count() == malformed and kept.select("reason").distinct().count() >= 4
    report = spark.read.json(f"{out}/report")
    assert {r["metric"] for r in report.select("metric").distinct().collect()} == {
        "top_repos", "top_push_repos", "top_commit_repos", "top_users", "languages", "event_types", "hours"}
    head = {r["metric"]: r for r in spark.read.json(f"{out}/headline").collect()}
    assert head["event_types"]["records"] == records

    # the profile's full push ranking agrees with the report's top 15
    full = {r["name"]: r["count"] for r in spark.read.json(f"{prof}/top_projects").collect()}
    top = {r["name"]: r["count"] for r in report.where("metric = 'top_push_repos'").collect()}
    assert len(top) == 15 < len(full) and all(full[n] == c for n, c in top.items())

    # key/value file: one line per key, in key order, type counts sum to the records
    lines = [r["value"] for r in spark.read.text(kv).collect()]
    keys = [x.split("\t")[0] for x in lines]
    assert len(lines) == len(set(keys)) and all(x.count("\t") == 1 for x in lines)
    assert sum(int(ln.split("\t")[1]) for ln in lines if ln.startswith("type|")) == records
    assert read_published(spark, lake).count() == records + malformed
    again = scratch_path(spark, "t-cli-again")
    main(["report", "--input", lake, "--output", again])
    assert spark.read.json(f"{again}/counters").collect() == [counters]

    # a key/value file read back
    back = scratch_path(spark, "t-cli-counts")
    main(["counts", "--input", kv, "--output", back])
    assert {r["name"]: r["value"] for r in spark.read.json(back).where("kind = 'push'").collect()} == full


def test_cli_hours_and_cap(spark, tmp_path, capsys):
    import gzip

    for hour in range(3):
        text = "".join(f'{{"id":"{hour}{i}","type":"PushEvent"}}\n' for i in range(4)).encode()
        (tmp_path / f"2023-03-15-{hour}.json.gz").write_bytes(gzip.compress(text)[: -9 if hour == 1 else None])
    out = scratch_path(spark, "t-cli-hours")
    main(["report", "--input", str(tmp_path), "--hours", "2023-03-15:0-3", "--output", out])
    said = capsys.readouterr().out
    assert "2023-03-15-0: 4 lines" in said and "missing" in said and "truncated" in said
    status = {r["hour"]: (r["rows"], r["complete"], r["error"] if "error" in r else None) for r in spark.read.json(f"{out}/hours").collect()}
    assert status[0][:2] == status[2][:2] == (4, True) and status[1][1:] == (False, "truncated") and status[3] == (0, False, "missing")
    assert spark.read.json(f"{out}/counters").first()["records"] == 8 + status[1][0]
    main(["preview", "--input", str(tmp_path), "--hours", "2023-03-15:0-3", "--cap", "3"])
    assert "3 events of hours [0]" in capsys.readouterr().out


def test_keyvalue_is_in_key_order(spark):
    from eventlens.sinks import keyvalue_lines

    rows = [("evt", "a-b", "PushEvent", 1), ("evt", "a", "PushEvent", 2), ("user", "x", None, 3)]
    df = spark.createDataFrame(rows, "kind string, name string, event_type string, value bigint")
    got = [r["value"].split("\t")[0] for r in keyvalue_lines(df, sort=True).collect()]
    assert got == sorted(got) == ["evt|a-b|PushEvent", "evt|a|PushEvent", "user|x"]


def test_cli_schema_and_preview(spark, dump, capsys):
    out = scratch_path(spark, "t-cli-schema")
    main(["schema", "--input", dump, "--output", out])
    assert "payload" in capsys.readouterr().out
    paths = {r["path"] for r in spark.read.json(out).collect()}
    assert {"payload.commits[].sha", "payload.`a.b`", "payload.a.b", "payload.mix[].z"} <= paths
    main(["preview", "--input", dump, "--n", "5"])
    out = capsys.readouterr().out
    assert "payload_keys" in out and out.count("|") > 10
