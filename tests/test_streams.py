"""Streams agree with the batch marks (items arrive as time slices)."""

from pyspark.sql import functions as F

from conftest import SF
from quire.plans import catalog
from quire.sources import tables as S


def _batch_marks(spark):
    it = S.event_items(S.read(spark, SF, "events"))
    return {r[0]: r[1] for r in it.groupBy("feed_url").agg(F.max("ts")).where(F.col("max(ts)") > 0).collect()}


def test_foreach_batch_marks(spark):
    got = {r.url: r.last_processed_at for r in catalog.stream_marks(spark, SF).collect()}
    assert got == _batch_marks(spark)


def test_keyed_state_marks(spark):
    got = {r.feed_url: r.last_processed_at for r in catalog.stream_marks_keyed(spark, SF).collect()}
    assert got == _batch_marks(spark)
