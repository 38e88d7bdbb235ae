"""Plan-shape regression tests: the properties the design relies on at
scale, read from ``explain`` output."""

import contextlib
import io
import re

from conftest import SF_SMALL
from pyspark.sql import functions as F

from eventlens.operators.normalize import write_silver
from eventlens.plans import report as R
from eventlens.session import scratch_path


def _plan(df, run=True):
    if run:
        df.collect()  # final adaptive plan (shows exchange reuse)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    txt = buf.getvalue()
    return txt.split("== Initial Plan ==")[0], txt


def test_report_is_one_scan_one_parse(spark):
    _, before = _plan(R.report_long(R.silver_from_tables(spark, SF_SMALL)), run=False)
    # before execution each union branch has its own copy of the subtree,
    # with exactly one parse per scan; at run time they share one exchange
    assert before.count("from_json(") == len(re.findall(r"Scan parquet", before.split("\n\n")[0]))
    final, _ = _plan(R.report_long(R.silver_from_tables(spark, SF_SMALL)))
    tree = final.split("\n\n")[0]
    assert len(re.findall(r"Scan parquet", tree)) == 1, tree
    assert "WindowGroupLimit" in tree
    assert "ReusedExchange" in tree


def test_parse_not_duplicated_into_filter(spark):
    from eventlens.sources.adapter import event_lines
    from eventlens.sources.json_scan import valid_events

    _, txt = _plan(valid_events(event_lines(spark, SF_SMALL)), run=False)
    assert txt.count("from_json(") == 1
    conditions = re.findall(r"\(\d+\) Filter.*?\nCondition : ([^\n]*)", txt, flags=re.S)
    assert conditions
    for cond in conditions:  # the validity filter reads the parsed row, never re-parses or re-builds lines
        assert "from_json" not in cond and "event_id" not in cond, cond[:300]


def test_silver_pushdown_and_pruning(spark):
    path = scratch_path(spark, "t-plan-silver")
    write_silver(R.silver_from_tables(spark, SF_SMALL), path)
    s = spark.read.parquet(path).where(F.col("day") >= "2024-01-10")
    _, txt = _plan(R.top_push_repos(s), run=False)
    assert "EqualTo(type,PushEvent)" in txt
    assert "ReadSchema: struct<type:string,repo:string>" in txt
    assert "PartitionFilters: [isnotnull(day" in txt


def test_topk_is_take_ordered(spark):
    from eventlens.operators.aggregates import events_per_repo
    from eventlens.operators.ranking import top_k

    _, txt = _plan(top_k(events_per_repo(R.silver_from_tables(spark, SF_SMALL)), 15), run=False)
    assert "TakeOrderedAndProject" in txt


def test_rollup_aggregates_events_once(spark):
    from eventlens.operators.aggregates import repo_type_rollup

    final, _ = _plan(repo_type_rollup(R.silver_from_tables(spark, SF_SMALL)))
    tree = final.split("\n\n")[0]
    assert "Expand" not in tree and "ReusedExchange" in tree


def test_agreement_and_fallback_parse_once(spark):
    from eventlens.plans import catalog

    for query in (catalog.ranking_agreement, catalog.ranking_fallback):
        final, _ = _plan(query(spark, SF_SMALL))
        tree = final.split("\n\n")[0]
        assert len(re.findall(r"Scan parquet", tree)) == 1, tree


def test_first_lines_open_only_the_files_they_need(spark):
    import os

    from eventlens.sources.lines import first_lines

    base = scratch_path(spark, "t-first-files").replace("file:", "")
    os.makedirs(base)
    for h in range(6):
        with open(f"{base}/2023-03-15-{h}.json", "w") as f:
            f.write("".join(f"{h}.{i}\n\n" for i in range(3)))
    few = first_lines(spark, base, 2)
    assert [r["value"] for r in few.orderBy("line_no").collect()] == ["0.0", "0.1"] and len(few.inputFiles()) == 1
    more = first_lines(spark, base, 5)  # the first file holds three lines only
    assert [r["value"] for r in more.orderBy("line_no").collect()] == ["0.0", "0.1", "0.2", "1.0", "1.1"] and len(more.inputFiles()) == 2
    assert first_lines(spark, base, 100).count() == 18


def test_scratch_folder(spark, tmp_path):
    """The context's checkpoint folder wins, then the conf; a cluster without either raises."""
    from types import SimpleNamespace as Fake

    import pytest

    from eventlens.session import checkpoint_root

    def session(master, current=None, conf=None):
        sc = Fake(master=master, getCheckpointDir=lambda: current, setCheckpointDir=lambda p: None)
        return Fake(sparkContext=sc, conf=Fake(get=lambda k, d=None: conf or d))

    assert checkpoint_root(session("spark://x", "hdfs://a/b", "hdfs://c")) == "hdfs://a/b"
    assert checkpoint_root(session("spark://x", None, "hdfs://c/")) == "hdfs://c"
    with pytest.raises(ValueError):
        checkpoint_root(session("spark://x"))
    assert checkpoint_root(session("local[2]"))


def test_scratch_of_a_step_is_removed(spark):
    from eventlens import session

    first = session.materialize(spark.range(3), "t-first")
    mark = session.scratch_mark()
    kept, gone = session.materialize(first, "t-kept"), session.materialize(spark.range(4), "t-gone")
    session.release_since(spark, mark, kept)
    path = lambda df: spark._jvm.org.apache.hadoop.fs.Path(df.scratch)
    there = [path(x).getFileSystem(spark._jsc.hadoopConfiguration()).exists(path(x)) for x in (first, kept, gone)]
    assert there == [True, True, False] and kept.count() == 3
