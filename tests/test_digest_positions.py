"""Line numbers of the digest against a sort on one machine."""

import random

from quire.operators import digest as DG

SCHEMA = "section int, resource_pos int, item_pos long, line_no int, line string"


def check(spark, rows, partitions):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = [tuple(r) for r in DG.positions(df, partitions).orderBy("position").collect()]
    assert got == [(*r, i + 1) for i, r in enumerate(sorted(rows))]


def test_one_resource_holds_most_lines(spark):
    rng = random.Random(5)
    rows = [(3, 0, i, k, f"<p>{rng.random()}</p>") for i in range(300) for k in range(5)]
    rows += [(1, r, i, 0, f"item {i}") for r in range(4) for i in range(20)]
    rng.shuffle(rows)
    for partitions in (1, 3, 16):
        check(spark, rows, partitions)


def test_equal_keys_and_no_lines(spark):
    check(spark, [(1, 0, 0, 0, "b"), (1, 0, 0, 0, "a"), (1, 0, 0, 0, "a"), (0, -1, -1, 0, "")], 4)
    assert DG.positions(spark.createDataFrame([], SCHEMA), 4).count() == 0
