"""Hourly dumps: damaged files, the committed writer, the capped ingest."""

import gzip
import os

import pyarrow as pa
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from eventlens.session import scratch_path
from eventlens.sources import hours as H
from eventlens.sources.adapter import event_lines_with_hour

DAY = "2023-03-15"


def text(hour, n=5):
    return "".join(f'{{"h":{hour},"i":{i}}}\n' for i in range(n)).encode()


def folder(spark, files):
    base = scratch_path(spark, "t-hours").replace("file:", "")
    os.makedirs(base)
    for hour, data in files.items():
        with open(f"{base}/{DAY}-{hour}.json.gz", "wb") as f:
            f.write(data)
    return base


def status(df):
    return {r["hour"]: (r["rows"], r["complete"], r["error"]) for r in H.status_of(df).collect()}


def test_every_file_gives_what_it_can_and_a_status(spark):
    long = b"".join(b'{"i":%d,"pad":"%s"}\n' % (i, os.urandom(300).hex().encode()) for i in range(4000))
    flipped = bytearray(gzip.compress(long))
    flipped[len(flipped) // 2] ^= 0xFF
    files = {
        0: gzip.compress(text(0)),
        1: gzip.compress(text(1)) + gzip.compress(text(1, 3)),  # two members
        2: gzip.compress(long)[: len(gzip.compress(long)) // 2],
        3: b"",
        4: b"not gzip\n",
        5: bytes(flipped),
        6: gzip.compress(text(6)) + b"\0" * 700,  # padded, as gzip allows
        7: gzip.compress(text(7)) + b"junk",
        8: gzip.compress(b"\xff\xfe bad bytes \n\n \xc2\xa0\n last without end"),
        9: gzip.compress(text(9))[:-5],  # only the trailer is cut
    }
    read = H.read_hours(spark, folder(spark, files), DAY, range(11))
    got = status(read)
    assert got[0] == (5, True, None) and got[1] == (8, True, None) and got[3] == (0, True, None) and got[6] == (5, True, None)
    assert got[4] == (0, False, "not_gzip") and got[10] == (0, False, "missing")
    assert got[7] == (5, False, "corrupt") and got[9] == (5, False, "truncated") and got[8] == (2, True, None)
    assert 0 < got[2][0] < 4000 and got[2][1:] == (False, "truncated")
    assert 0 < got[5][0] <= 4000 and got[5][1:] == (False, "corrupt")
    lines = H.lines_of(read)
    per = {r["hour"]: r["count"] for r in lines.groupBy("hour").count().collect()}
    assert per == {h: n for h, (n, _, _) in got.items() if n}
    assert {r["value"] for r in lines.where("hour = 8").collect()} == {"\ufffd\ufffd bad bytes", "last without end"}
    whole = long.decode().splitlines()
    kept = [r["value"] for r in lines.where("hour = 2").orderBy("line_no").collect()]
    assert kept == whole[: len(kept)]


def test_lines_and_status_survive_small_reads(monkeypatch):
    monkeypatch.setattr(H, "_CHUNK", 7)
    data = gzip.compress(text(0)) + b"\0\0" + gzip.compress(text(1, 4))
    assert [*H.whole_lines(H.inflated(pa.BufferReader(data)))] == (text(0) + text(1, 4)).decode().splitlines()
    for cut in range(1, len(data)):
        got = []
        try:
            got += H.whole_lines(H.inflated(pa.BufferReader(data[:cut])))
        except H.Damaged as damage:
            assert str(damage) == "truncated"
        assert got == (text(0) + text(1, 4)).decode().splitlines()[: len(got)]


def counts(spark, base):
    return {(r["day"], r["hour"]): r["count"] for r in H.lines_of(H.read_hours(spark, base)).groupBy("day", "hour").count().collect()}


def expected(lines):
    return {(str(r["day"]), int(r["hour"])): r["count"] for r in lines.groupBy("day", "hour").count().collect()}


def test_rows_out_are_rows_in(spark, monkeypatch):
    """For many tasks and members an hour, a second call, and any record limit."""
    monkeypatch.setattr(H, "MEMBER_BYTES", 500)
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "3")
    try:
        base = scratch_path(spark, "t-write")
        lines = event_lines_with_hour(spark, SF_SMALL).withColumn("day", F.lit(DAY)).withColumn("hour", F.col("event_id") % 2)
        first = H.write_hours(lines, base, order=["event_id"])
        assert [x["rows"] for x in first] == [r["count"] for r in lines.groupBy("hour").count().orderBy("hour").collect()]
        assert counts(spark, base) == expected(lines)
        got = [r["value"] for r in H.lines_of(H.read_hours(spark, base)).where("hour = 0").orderBy("line_no").collect()]
        assert got == [r["value"] for r in lines.where("hour = 0").orderBy("event_id").collect()]
        more = lines.where("event_id % 5 = 0").withColumn("hour", F.lit(1))
        second = H.write_hours(more, base)
        assert sum(x["rows"] for x in second) == lines.count() + more.count()
        assert counts(spark, base)[DAY, 1] == lines.where("hour = 1").count() + more.count()
        assert [x["file"] for x in second if "-0.json" in x["file"]] == [x["file"] for x in first if "-0.json" in x["file"]]
        assert H.collect_versions(base) == 1 and counts(spark, base)[DAY, 0] == lines.where("hour = 0").count()
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")


def test_parts_of_failed_attempts_are_not_read(spark):
    """What an attempt left in staging, and files no manifest names, do not count."""
    base = scratch_path(spark, "t-write").replace("file:", "")
    lines = spark.createDataFrame([(f"l{i}", DAY, i % 2) for i in range(10)], "value string, day string, hour int")
    H.write_hours(lines, base)
    with open(f"{base}/{DAY}-9.json.gz", "wb") as f:
        f.write(gzip.compress(text(9)))
    os.makedirs(f"{base}/other", exist_ok=True)
    with open(f"{base}/other/{DAY}-0.json.gz", "wb") as f:
        f.write(gzip.compress(text(0)))
    assert counts(spark, base) == {(DAY, 0): 5, (DAY, 1): 5}


def test_joining_twice_gives_the_same_file(tmp_path):
    """A retried task of the second job writes the same bytes in the same place."""
    for i in range(3):
        (tmp_path / f"{i}.gz").write_bytes(H._member([f"line {i}"]))
    batch = pa.RecordBatch.from_pylist([{"name": "x.json.gz", "parts": [f"{tmp_path}/{i}.gz" for i in range(3)], "rows": 3}])
    join = H._joined(str(tmp_path / "v"))
    first = [*join(iter([batch]))][0].to_pylist()
    data = (tmp_path / "v" / "x.json.gz").read_bytes()
    assert [*join(iter([batch]))][0].to_pylist() == first and (tmp_path / "v" / "x.json.gz").read_bytes() == data
    assert gzip.decompress(data) == b"line 0\nline 1\nline 2\n"


def test_lines_without_a_time_are_kept(spark):
    base = scratch_path(spark, "t-write")
    H.write_hours(spark.createDataFrame([("a", None, 1), ("b", DAY, None), ("c", DAY, 1)], "value string, day string, hour int"), base)
    assert counts(spark, base) == {(None, None): 2, (DAY, 1): 1}
    assert H.write_hours(spark.createDataFrame([], "value string, day string, hour int"), scratch_path(spark, "t-none")) == []


@pytest.mark.parametrize("cap, hours, events, failed", [(3, [0], 3, None), (5, [0], 5, None), (6, [0, 1], 6, None), (12, [0, 1, 2], 12, None), (100, [0, 1], 12, 2)])
def test_capped_ingest(spark, cap, hours, events, failed):
    base = folder(spark, {0: gzip.compress(text(0)), 1: gzip.compress(text(1)), 2: gzip.compress(text(2, 2)) + gzip.compress(text(2))[:10], 4: b"never read"})
    got = H.capped_ingest(spark, base, DAY, range(5), cap)
    assert (got.hours, got.events) == (hours, events)
    assert got.failed == (failed if events < cap else None)
    order = [(r["hour"], r["line_no"]) for r in got.lines.orderBy("hour", "line_no").collect()]
    assert order == [(h, i) for h, n in ((0, 5), (1, 5), (2, 2)) for i in range(1, n + 1)][:events]


def test_capped_ingest_opens_no_later_hour(spark, monkeypatch):
    base = folder(spark, {h: gzip.compress(text(h)) for h in range(8)})
    opened, read = [], H.read_hours
    monkeypatch.setattr(H, "read_hours", lambda spark, base, day, hours, **k: opened.extend(hours) or read(spark, base, day, hours, **k))
    assert H.capped_ingest(spark, base, DAY, range(8), 4).events == 4 and opened == [0]
    opened.clear()
    assert H.capped_ingest(spark, base, DAY, range(8), 14).hours == [0, 1, 2] and opened == [0, 1, 2]


def test_a_file_is_not_read_past_its_limit(spark):
    base = folder(spark, {0: gzip.compress(text(0)) + b"damage that is never seen"})
    assert status(H.read_hours(spark, base, DAY, [0], limit=5)) == {0: (5, None, None)}
    assert status(H.read_hours(spark, base, DAY, [0])) == {0: (5, False, "corrupt")}


def test_summary(spark):
    base = folder(spark, {3: gzip.compress(text(3, 3)), 4: gzip.compress(text(4, 4))})
    row = H.dataset_summary(H.read_hours(spark, base, DAY, [3, 4, 5], content="status")).first()
    assert (row["source"], row["events"], row["files"], row["days"], row["hours"], row["n_hours"]) == ("archive", 7, 2, DAY, "03,04", 2)
    assert row["bytes"] == sum(os.path.getsize(f"{base}/{DAY}-{h}.json.gz") for h in (3, 4))
    assert H.dataset_summary(H.read_hours(spark, folder(spark, {}), content="status")).first()["events"] == 0
