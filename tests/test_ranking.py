"""Distributed global rank and top-k ordering."""

from pyspark.sql import functions as F

from eventlens.operators.ranking import full_ranking, global_rank, top_k


def test_global_rank_many_partitions(spark):
    df = spark.range(0, 5000, numPartitions=13).select(
        (F.col("id") * 7919 % 5000).alias("k"), (F.col("id") % 3).alias("g")
    )
    ranked = global_rank(df.repartition(11), [F.col("k").asc()]).collect()
    assert sorted(r["rank"] for r in ranked) == list(range(1, 5001))
    assert all(r["rank"] == r["k"] + 1 for r in ranked)


def test_ties_broken_by_name(spark):
    df = spark.createDataFrame([("b", 2), ("a", 2), ("c", 5), ("d", 1)], "name string, count bigint")
    got = [(r["rank"], r["name"]) for r in top_k(df, 3).collect()]
    assert sorted(got) == [(1, "c"), (2, "a"), (3, "b")]
    full = sorted((r["rank"], r["name"]) for r in full_ranking(df).collect())
    assert full == [(1, "c"), (2, "a"), (3, "b"), (4, "d")]


def test_spread_is_what_the_caller_asks_for(spark):
    from eventlens.sources.adapter import spread

    df = spark.range(0, 1000, numPartitions=1)
    assert spread(df, None) is df  # no shuffle unless asked for
    by_key = spread(df, 7, ["id"])
    assert by_key.rdd.getNumPartitions() == 7
    assert sorted(r["id"] for r in by_key.collect()) == list(range(1000))
    rr = spread(df.selectExpr("cast(id % 3 as string) as value"), 5)  # many identical rows
    sizes = rr.rdd.glom().map(len).collect()
    assert max(sizes) - min(sizes) <= 1  # round-robin keeps copies spread


def test_partition_counts_read_one_column(spark):
    from eventlens.operators.ranking import partition_counts
    from eventlens.session import materialize

    placed = materialize(spark.range(100).withColumns({"_pid": F.spark_partition_id(), "name": F.lit("x")}), "t-placed")
    plan = partition_counts(placed)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<_pid:int>" in plan
