"""Scale guards: spread only small splits, broadcast only under the bound."""

import os

from quire.session import bounded_broadcast, estimated_bytes, local_table, spread


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_spread_only_when_few_splits(spark, scratch):
    par = spark.sparkContext.defaultParallelism
    one = os.path.join(scratch, "one")
    spark.range(100).coalesce(1).write.parquet(one)
    small = spread(spark.read.parquet(one), ["id"])
    assert small.rdd.getNumPartitions() == par and "Exchange hashpartitioning(id" in _plan(small)
    many = os.path.join(scratch, "many")
    spark.range(1000).repartition(par * 2).write.parquet(many)
    big = spark.read.parquet(many)
    if big.rdd.getNumPartitions() >= par:  # enough splits: untouched, no exchange
        assert "Exchange" not in _plan(spread(big, ["id"]))


def test_bounded_broadcast(spark):
    small = local_table(spark, [(1, "a'b\\c"), (2, None)], "k int, v string")
    assert sorted(tuple(r) for r in small.collect()) == [(1, "a'b\\c"), (2, None)]
    assert estimated_bytes(small) < 1024
    big = spark.range(10_000_000).selectExpr("id as k", "repeat('x', 100) as v")
    left = spark.range(100).selectExpr("id as k")
    assert "BroadcastHashJoin" in _plan(left.join(bounded_broadcast(small), "k"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" not in _plan(left.join(bounded_broadcast(big, max_bytes=1024), "k"))
        assert "BroadcastHashJoin" in _plan(left.join(bounded_broadcast(small, max_bytes=1 << 20), "k"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_small_tables_of_large_sources_are_counted(spark):
    """The estimate of a few distinct rows follows the table they come from; counted, they are broadcast."""
    few = spark.range(10_000).selectExpr("id % 3 AS k").distinct()
    hint = lambda df: "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()
    assert not hint(bounded_broadcast(few, 1000))
    assert hint(bounded_broadcast(few, 1000, row_bytes=100))
    assert not hint(bounded_broadcast(few, 1000, row_bytes=400))
