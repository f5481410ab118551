"""Per-feed high-water marks over a stream of items (Structured Streaming).

Each micro-batch is one run: items meet the current feed table (stream-static
join), items at or below their feed's mark are dropped (there is no watermark
delay: the mark is per feed and exact to the second), the new marks are
upserted into the feed table and appended to the history under the batch id.
`foreachBatch` may replay a batch after a failure; the batch is the id of one
commit of both tables, so a batch that has committed is not run again and one
that has not leaves nothing behind.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators import incremental as INC
from quire.session import materialize
from quire.operators import state as ST

FEED_SCHEMA = "url string, title string, last_processed_at long"
HISTORY_SCHEMA = "id long, feed_url string, last_processed_at long, created_at long"


class MarkJob:
    """foreachBatch body: skip, mark, append history and feed changes."""

    def __init__(self, store: ST.StateStore, feed_table: str = "feed", history_table: str = "history_stream"):
        self.store = store
        self.feed_table = feed_table
        self.history_table = history_table

    def feed_state(self) -> DataFrame:
        return self.store.read(self.feed_table, FEED_SCHEMA, keys=["url"])

    def history(self, spark: SparkSession) -> DataFrame:
        return self.store.read(self.history_table, HISTORY_SCHEMA)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        run_id = f"{self.feed_table}-{batch_id}"
        if self.store.committed(run_id):
            return
        marks = self.feed_state().select(F.col("url").alias("feed_url"), "last_processed_at")
        passed = INC.skip_processed(batch, marks)
        new = materialize(INC.new_marks(passed))  # lineage cut under spark.checkpoint.dir
        if not new.take(1):
            return
        created = int(batch.agg(F.max("ts")).first()[0] or 0)
        hist = new.select((F.lit(batch_id) * (1 << 32) + F.monotonically_increasing_id()).alias("id"),
                          "feed_url", "last_processed_at", F.lit(created).cast("long").alias("created_at"))
        change = self.store.begin(run_id)
        change.append(self.history_table, hist)
        change.append(self.feed_table, new.select(F.col("feed_url").alias("url"),
                                                  F.col("feed_url").alias("title"), "last_processed_at"))
        change.commit()


def run(spark: SparkSession, items: DataFrame, store: ST.StateStore, checkpoint: str,
        available_now: bool = True):
    """Start the mark job over a streaming `items(feed_url, ts, ...)` frame."""
    job = MarkJob(store)
    w = items.writeStream.foreachBatch(job).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start(), job
