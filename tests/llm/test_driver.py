"""What many short jobs leave in the driver."""

import os

from eventlens import session
from eventlens.llm import graph


def test_the_driver_is_cleaned_between_many_steps(spark):
    def full_collections():
        beans = spark.sparkContext._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
        return sum(b.getCollectionCount() for b in beans if "Old" in b.getName() or "MarkSweep" in b.getName())

    before = full_collections()
    for _ in range(2 * session.CLEAN_EVERY):
        session.release(session.materialize(spark.range(1), "driver-test"))
    assert full_collections() - before == 2


def test_rounds_have_the_tasks_that_their_links_need(spark, monkeypatch):
    files = {}

    def counted(*tables):
        for df in tables:
            files[os.path.basename(df.scratch)] = sum(f.startswith("part-") for f in os.listdir(df.scratch.removeprefix("file:")))
        session.release(*tables)

    monkeypatch.setattr(graph, "release", counted)
    confs = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in confs}
    try:
        for k, v in confs.items():
            spark.conf.set(k, v)
        links = [(10 * i + j, 10 * i + j + 1) for i in range(100) for j in range(9)]
        found = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert found == {n: n // 10 * 10 for n in range(1000)}
    rounds = [n for name, n in files.items() if name.startswith(("cc-large", "cc-small"))]
    assert rounds and max(rounds) <= graph.LEAST_TASKS
