"""Discovery from one scan, the profile's single parse, the wide matrix."""

import re

import pytest
from conftest import SF_SMALL, lines_df
from test_plans import _plan

from eventlens.operators import aggregates as A
from eventlens.operators import schema_profile as S
from eventlens.plans import catalog
from eventlens.plans import report as R
from eventlens.sources.adapter import event_lines


def test_the_profile_parses_once_at_any_depth(spark):
    _, txt = _plan(S.schema_profile(event_lines(spark, SF_SMALL)), run=False)
    assert txt.count("try_parse_json(") + txt.count("parse_json(") <= 2 and len(re.findall(r"Scan parquet", txt.split("\n\n")[0])) == 1
    deep = '{"x":' * 60 + '{"k":[1,[2,[{"z":null}]]]}' + "}" * 60
    got = {r["path"]: r["types_seen"] for r in S.schema_profile(lines_df(spark, [deep, '{"x":"{[{["}'])).collect()}
    path = ".".join(["x"] * 60)
    assert got[path + ".k[][][].z"] == "null" and got[path + ".k[]"] == "array,long" and got["x"] == "string,struct" and len(got) == 65


def test_discovery_is_one_scan_and_equals_its_parts(spark, monkeypatch):
    lines = event_lines(spark, SF_SMALL)
    seen, write = [], S.materialize

    def once(df, name):
        seen.append(_plan(df, run=False)[1].split("\n\n")[0])
        return write(df, name)

    monkeypatch.setattr(S, "materialize", once)
    fields, paths = ["type", "actor", "repo", "payload", "nowhere"], [*catalog.COVERAGE_PATHS, "$.nowhere.at.all"]
    got = S.discover(lines, fields, paths).collect()
    assert len(seen) == 1 and len(re.findall("Scan parquet", seen[0])) == 1
    part = lambda p: {r["name"]: (r["types"], r["rows"]) for r in got if r["part"] == p}
    schema = S.infer_schema(lines).first()
    assert part("schema") == {"": (schema["schema"], schema["records"])}
    assert part("profile") == {r["path"]: (r["types_seen"], r["present_rows"]) for r in S.schema_profile(lines).collect()}
    required = {r["field"]: (None, r["missing_rows"]) for r in catalog.required_op(lines, fields).collect()}
    assert part("required") == required and required["nowhere"][1] == schema["records"]
    covered = {r["path"]: (None, r["present_rows"]) for r in catalog.coverage(catalog._valid(spark, SF_SMALL), paths).collect()}
    assert part("coverage") == covered and covered["$.nowhere.at.all"] == (None, 0)


def test_discovery_of_no_lines(spark):
    got = {(r["part"], r["name"]): (r["types"], r["rows"]) for r in S.discover(lines_df(spark, ["x"]), ["type"], ["$.size"]).collect()}
    assert got[("required", "type")][1] == 0 and got[("coverage", "$.size")][1] == 0 and got[("schema", "")][1] == 0


def test_wide_matrix(spark, monkeypatch):
    silver = R.silver_from_tables(spark, SF_SMALL)
    wide = A.repo_type_matrix_wide(silver, 5)
    types = sorted({r["type"] for r in silver.select("type").distinct().collect()})
    assert wide.columns == ["repo_rank", "repo", "total", *types] and len(types) > 20
    cells = {(r["repo"], r["event_type"]): r["count"] for r in A.repo_type_counts(silver).collect()}
    rows = wide.collect()
    assert len(rows) == 5 and all(r[t] == cells.get((r["repo"], t), 0) for r in rows for t in types)
    assert all(sum(r[t] for t in types) == r["total"] for r in rows)
    monkeypatch.setattr(A, "MAX_TYPE_COLUMNS", 3)
    with pytest.raises(ValueError, match="more than 3"):
        A.repo_type_matrix_wide(silver)
