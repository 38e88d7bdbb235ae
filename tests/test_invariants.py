"""Cross-metric invariants on the fixture at sf0.01."""

import pytest
from conftest import SF_MID

from eventlens.operators import aggregates as A
from eventlens.plans import catalog as C
from eventlens.plans.report import silver_from_tables


@pytest.fixture(scope="module")
def silver(spark):
    return silver_from_tables(spark, SF_MID).cache()


def _total(df):
    return sum(r["count"] for r in df.collect())


def test_totals_agree(spark, silver):
    records = silver.count()
    assert _total(A.events_per_repo(silver)) == records
    assert _total(A.events_per_user(silver)) == records
    assert _total(A.events_per_type(silver)) == records
    pushes = {r["name"]: r["count"] for r in A.events_per_type(silver).collect()}["PushEvent"]
    assert _total(A.pushes_per_repo(silver)) == pushes


def test_rollup_matches_repo_counts(silver):
    roll = {r["repo"]: r["count"] for r in A.repo_type_rollup(silver).where("level = 1").collect()}
    direct = {r["name"]: r["count"] for r in A.events_per_repo(silver).collect()}
    assert roll == direct


def test_emission_count(spark, silver):
    c = C.run_counters(spark, SF_MID).collect()[0]
    records = c["records"]
    pushes = silver.where("type = 'PushEvent'").count()
    langs = silver.where("language is not null").count()
    hours = silver.where("hour is not null").count()
    assert c["emissions"] == 3 * records + 2 * pushes + langs + hours
    assert c["keys"] == A.metrics_long(silver).count()


def test_one_pass_equals_separate(silver):
    """Slices of the one-pass metric table equal the stand-alone aggregates."""
    one = {(r["kind"], r["name"]): r["count"] for r in A.report_metrics(silver).collect()}
    sep = {}
    for kind, df in [("repo", A.events_per_repo(silver)), ("push", A.pushes_per_repo(silver)),
                     ("commits", A.commits_per_repo(silver)), ("user", A.events_per_user(silver)),
                     ("lang", A.events_per_language(silver)), ("type", A.events_per_type(silver)),
                     ("hour", A.events_per_hour(silver))]:
        for r in df.collect():
            sep[(kind, r["name"])] = r["count"]
    assert one == sep


def test_report_equals_topk(silver):
    from eventlens.plans import report as R

    rep = R.report_long(silver).collect()
    for metric, fn in [("top_repos", R.top_repos), ("top_users", R.top_users), ("languages", R.languages),
                       ("top_commit_repos", R.top_commit_repos), ("top_push_repos", R.top_push_repos)]:
        a = sorted((r["rank"], r["name"], r["count"]) for r in rep if r["metric"] == metric)
        b = sorted((r["rank"], r["name"], r["count"]) for r in fn(silver).collect())
        assert a == b, metric
