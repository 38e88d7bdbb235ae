"""The pipeline on sf0.001 against its stages by brute force."""

import re

import duckdb
import numpy as np
import pytest
from fixtures import awkward_texts, documents
from pyspark.sql import functions as F
from test_dedup import brute_components
from test_text_ops import brute_hits

import __spark_entry__
import corpus_pipeline
from eventlens.llm.catalog import QUERIES
from eventlens.llm.language_id import keep_identified
from eventlens.session import scratch_mark

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    c = duckdb.connect()
    return c.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall(), c.sql(f"select item_id, text from '{SF}/benchmark.parquet'").fetchall()


def test_registered():
    names = list(__spark_entry__.queries())
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)]
    assert "pipeline" in names and set(QUERIES) <= set(names)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "near_dedup", "decontaminate", "packing"]


def test_pipeline(spark, tables):
    rows, items = tables
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    identified = {r["doc_id"] for r in keep_identified(docs).select("doc_id").collect()}
    assert identified == {i for i, t in rows if re.search(r"[^\W\d_]", t or "")}  # clean documents stay
    left = [(i, t or "") for i, t in rows if i in identified]
    best = {}
    for i, t in sorted(left, key=lambda r: (-len(r[1]), r[0])):
        best.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t), (i, t))
    left = sorted(best.values())
    found, _ = brute_components(left)
    left = [(i, t) for (i, t), (_, _, comp) in zip(left, found, strict=True) if comp == i]
    expected = {i for i, t in left if not brute_hits(t, items)[1]}
    out = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "start", "length", "sequence_id", "offset"} <= set(out.columns)
    assert {r["doc_id"] for r in out.select("doc_id").distinct().collect()} == expected


def test_pipeline_on_awkward_documents(spark, tmp_path):
    """Null ids and texts, empty and very long texts, ties, repeated rows, clashing columns."""
    texts = awkward_texts()
    items = [(1, " ".join(f"w{i}" for i in range(12))), (2, None), (3, "x" * 10)]
    texts += [(60, f"words before {items[0][1]} and after"), (61, "a" * 400_000), (62, None), (None, None)]
    docs = documents(spark, texts).withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "xx").when(F.col("doc_id") % 3 == 0, "yy"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    first = keep_identified(spark.read.parquet(f"{tmp_path}/documents.parquet")).select("doc_id", "text").collect()
    left = {}
    for i, t in sorted(((r["doc_id"], r["text"]) for r in first), key=lambda r: (-len(r[1]), r[0] is None, r[0])):
        left.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t), (i, t))
    left = list(left.values())
    named = [(n, t) for n, (_, t) in enumerate(left)]
    found, _ = brute_components(named)
    groups = {}
    for (i, t), (_, _, group) in zip(left, found, strict=True):
        groups.setdefault(group, []).append((i is None, i or 0, i, t))
    kept = [min(g)[2:] for g in groups.values()]
    expected = sorted((i is not None, i or 0) for i, t in kept if not brute_hits(t, items)[1])
    out = corpus_pipeline.run(spark, str(tmp_path))
    got = [r["doc_id"] for r in out.filter("start = 0").select("doc_id").collect()]
    assert sorted((i is not None, i or 0) for i in got) == expected and 60 not in got


def test_scratch_of_stages_goes(spark):
    mark = scratch_mark()
    out = corpus_pipeline.run(spark, SF)
    assert scratch_mark() - mark == {out.scratch} and out.count() > 0


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0


def test_language_stage_rejects_by_all_rows(spark):
    """600 texts of one kind and 599 of another: the middle of all rows is in
    the first kind, while half of the rows may as well have it in the other."""
    import zlib

    rng = np.random.default_rng(7)
    ids = [i for i in range(2400) if zlib.crc32(str(i).encode()) % 4 != 2][:1199]
    first = set(ids[::2])
    text = lambda i: "the cat sat on the mat " * 8 if i in first else "".join(map(chr, rng.integers(0x4E00, 0x9000, 60)))
    docs = spark.createDataFrame([(i, text(i), "xx") for i in ids], "doc_id long, text string, lang string").repartition(2)
    assert {r["doc_id"] for r in keep_identified(docs).collect()} == first


def test_language_stage_learns_from_every_labelled_row(spark):
    """A language whose rows all have ids that ``held_out`` picks."""
    import zlib

    rng = np.random.default_rng(11)
    is_out = lambda i: zlib.crc32(str(i).encode()) % 4 == 2
    ids = [i for i in range(800) if not is_out(i)][:200] + [i for i in range(800) if is_out(i)][:60]
    word = lambda letters: "".join(rng.choice(list(letters), 5))
    text = lambda i: " ".join(word("αβγδεζηθ" if is_out(i) else "abcdefgh") for _ in range(40))
    docs = spark.createDataFrame([(i, text(i), "el" if is_out(i) else "en") for i in ids], "doc_id long, text string, lang string").repartition(2)
    assert {r["doc_id"] for r in keep_identified(docs).collect()} == set(ids)
