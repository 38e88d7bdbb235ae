"""Key/value encoding (F9-F11) and sink round trips."""

from conftest import SF_SMALL, lines_df
from pyspark.sql import functions as F

from eventlens.functions.keyvalue import decode_key, parse_value, split_line
from eventlens.session import scratch_path
from eventlens.sinks import path_size, publish, published_path, read_keyvalue, read_published, write_keyvalue, write_ndjson


def test_decode_and_parse(spark):
    df = lines_df(spark, ["evt|org/r|PushEvent\t3", "user|bob\t", "evt|org/r", "plain\tx", "hour|05\t 7", "lang|Go\t2.5"])
    kv = split_line(df)
    kind, name, etype = decode_key("key")
    got = kv.select(kind.alias("k"), name.alias("n"), etype.alias("t"), parse_value("value_text").alias("v")).collect()
    assert [tuple(r) for r in got] == [
        ("evt", "org/r", "PushEvent", 3),
        ("user", "bob", None, 1),
        ("evt", "org/r", "", 1),
        ("plain", "", None, 1),
        ("hour", "05", None, 7),
        ("lang", "Go", None, 1),
    ]


def test_keyvalue_roundtrip_sums_duplicates(spark):
    metrics = spark.createDataFrame(
        [("user", "a", None, 2), ("user", "a", None, 3), ("evt", "o/r", "PushEvent", 1)],
        "kind string, name string, event_type string, value bigint",
    )
    path = scratch_path(spark, "t-kv")
    write_keyvalue(metrics, path)
    back = {r["key"]: (r["kind"], r["name"], r["event_type"], r["value"]) for r in read_keyvalue(spark, path).collect()}
    assert back == {"user|a": ("user", "a", None, 5), "evt|o/r|PushEvent": ("evt", "o/r", "PushEvent", 1)}


def test_control_characters_survive(spark):
    names = ["a\nb", "x\ty", "c\rd", "\\", "\\n", "\\\\t\n", "plain", "", "é|\t|"]
    metrics = spark.createDataFrame([("user", n, None, i) for i, n in enumerate(names)], "kind string, name string, event_type string, value bigint")
    path = scratch_path(spark, "t-kv-control")
    write_keyvalue(metrics, path)
    assert spark.read.text(path).count() == len(names)
    assert {(r["name"], r["value"]) for r in read_keyvalue(spark, path).collect()} == {(n, i) for i, n in enumerate(names)}


def test_publish_reports_what_it_wrote(spark):
    path = scratch_path(spark, "t-published")
    done = publish(spark.range(100).selectExpr("cast(id as string) value").repartition(3), path)
    assert (done.uri, done.rows, done.files, done.bytes, done.mode) == (path, 100, 3, 290, "local")
    assert published_path(spark, path) == done.destination and read_published(spark, path).count() == 100


def test_a_publish_that_dies_leaves_the_old_version(spark):
    import pytest

    path = scratch_path(spark, "t-published")
    publish(spark.range(100).selectExpr("cast(id as string) value"), path)
    half = spark.range(100, numPartitions=4).selectExpr("if(id = 60, raise_error('killed'), cast(id as string)) value")
    with pytest.raises(Exception, match="killed"):
        publish(half, path)
    assert read_published(spark, path).count() == 100
    new = publish(spark.range(7).selectExpr("id"), path, "parquet")
    assert sorted(r["id"] for r in read_published(spark, path).collect()) == list(range(7)) and new.rows == 7


def test_a_reader_keeps_its_version_until_two_more_are_published(spark):
    path = scratch_path(spark, "t-published")
    old = publish(spark.range(5).selectExpr("cast(id as string) value"), path).destination
    begun = spark.read.text(old)
    publish(spark.range(6).selectExpr("cast(id as string) value"), path)
    assert begun.count() == 5
    publish(spark.range(7).selectExpr("cast(id as string) value"), path)
    assert path_size(spark, path)[0] > 0 and read_published(spark, path).count() == 7
    fs = spark._jvm.org.apache.hadoop.fs.Path(old).getFileSystem(spark._jsc.hadoopConfiguration())
    assert not fs.exists(spark._jvm.org.apache.hadoop.fs.Path(old))


def test_unpublished_paths_stay_as_they_are(spark, tmp_path):
    import pytest

    assert published_path(spark, f"{tmp_path}/x.json") == f"{tmp_path}/x.json"
    with pytest.raises(FileNotFoundError):
        read_published(spark, str(tmp_path))


def test_ndjson_writes_nulls_and_roundtrips(spark):
    df = spark.createDataFrame([("1", None, 3), ("2", "x", None)], "id string, name string, n bigint")
    path = scratch_path(spark, "t-nd")
    write_ndjson(df, path)
    lines = sorted(r["value"] for r in spark.read.text(path).collect())
    assert lines == ['{"id":"1","name":null,"n":3}', '{"id":"2","name":"x","n":null}']


def test_publish_partitioned_hourly_reads_hours(spark):
    from eventlens.sources.adapter import event_lines_with_hour
    from eventlens.sources.lines import HOUR_PARTITION, read_hourly

    path = scratch_path(spark, "t-hourly")
    src = event_lines_with_hour(spark, SF_SMALL)
    done = publish(src.select("value", "hour"), path, "text", partition_by=["hour"], compression="gzip")
    back = read_hourly(spark, done.destination, HOUR_PARTITION, 1).groupBy("source_hour").count()
    want = src.groupBy(F.col("hour").alias("source_hour")).count()
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, want.collect()))


def test_first_lines_follow_hourly_file_order(spark):
    import gzip
    import os

    from eventlens.sources.lines import first_lines, hourly_paths

    base = scratch_path(spark, "t-first")
    local = base.replace("file:", "")
    os.makedirs(local, exist_ok=True)
    for h in (10, 2, 0):
        with gzip.open(f"{local}/2023-03-15-{h}.json.gz", "wt") as f:
            f.write("".join(f'{{"h":{h},"i":{i}}}\n' + ("\n" if i == 1 else "") for i in range(3)))
    got = [(r["line_no"], r["value"]) for r in first_lines(spark, hourly_paths(base, "2023-03-15", [0, 2, 10]), 7).collect()]
    want = [f'{{"h":{h},"i":{i}}}' for h in (0, 2, 10) for i in range(3)][:7]
    assert sorted(got) == list(enumerate(want, start=1))
