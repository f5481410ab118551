"""Keyed marks that start from a feed table, meet late and replayed items, and go on from a checkpoint."""

import os

from pyspark.sql import functions as F

from conftest import SF
from quire.operators import incremental as INC
from quire.plans import catalog
from quire.streaming import keyed as SK

ITEMS = "feed_url string, event_id long, ts long"


def land(spark, scratch, k, rows):
    spark.createDataFrame(rows, ITEMS).coalesce(1).write.parquet(os.path.join(scratch, "landing", f"slice={k}"))


def take_up(spark, scratch, marks=None):
    stream = spark.readStream.schema(ITEMS).parquet(os.path.join(scratch, "landing")).drop("slice")
    SK.run(stream, os.path.join(scratch, "out"), os.path.join(scratch, "checkpoint"), marks).awaitTermination()
    return sorted(r.event_id for r in spark.read.schema(ITEMS).parquet(os.path.join(scratch, "out")).collect())


def test_initial_marks_late_items_and_restart(spark, scratch):
    marks = spark.createDataFrame([("a", 100), ("a", 90), ("idle", 70), ("none", None), (None, 5)],
                                  "feed_url string, last_processed_at long")
    land(spark, scratch, 0, [("a", 1, 100), ("a", 2, 101), ("b", 3, 1), ("a", 4, None), ("none", 5, 2), (None, 6, 3)])
    assert take_up(spark, scratch, marks) == [2, 3, 4, 5, 6]
    # restarted: 102 is new, 101 comes again, 99 comes late; the table passed now is not read
    land(spark, scratch, 1, [("a", 7, 102), ("a", 2, 101), ("a", 8, 99), ("b", 9, 1), ("b", 10, 2), ("a", 11, 0)])
    wrong = spark.createDataFrame([("a", 10_000), ("b", 10_000)], "feed_url string, last_processed_at long")
    assert take_up(spark, scratch, wrong) == [2, 3, 4, 5, 6, 7, 10, 11]
    # nothing new has landed
    assert take_up(spark, scratch, marks) == [2, 3, 4, 5, 6, 7, 10, 11]
    passed = spark.read.schema(ITEMS).parquet(os.path.join(scratch, "out"))
    got = {r.feed_url: (r.last_processed_at, r.n_passed) for r in SK.marks_after(passed, marks).collect()}
    assert got == {"a": (102, 4), "b": (2, 2), "idle": (70, 0), "none": (2, 1), None: (5, 1)}


def test_empty_feed_table(spark, scratch):
    land(spark, scratch, 0, [("a", 1, 5)])
    assert take_up(spark, scratch, spark.createDataFrame([], "feed_url string, last_processed_at long")) == [1]


def test_handover_equals_batch_runs_over_the_same_slices(spark):
    first, slices = catalog._late_slices(spark, SF)
    marks = {r.feed_url: r.last_processed_at for r in first.collect()}
    n = dict.fromkeys(marks, 0)
    skipped = 0
    for k in range(catalog.SLICES):
        part = slices.where(F.col("slice") == k)
        table = spark.createDataFrame(list(marks.items()), "feed_url string, last_processed_at long")
        passed = INC.skip_processed(part, table).select("feed_url", "ts").collect()
        skipped += part.count() - len(passed)
        for r in passed:
            n[r.feed_url] = n.get(r.feed_url, 0) + 1
            marks[r.feed_url] = max(marks.get(r.feed_url, 0), r.ts)
    got = {r.feed_url: (r.last_processed_at, r.n_passed) for r in catalog.stream_marks_handover(spark, SF).collect()}
    assert skipped > 0
    assert got == {f: (m, n[f]) for f, m in marks.items()}
