"""Per-feed marks as keyed streaming state (transformWithStateInPandas).

The same contract as `marks.MarkJob` without a state table: each feed key
holds its mark in a ValueState; a micro-batch drops the feed's items at or
below the mark (undated items and epoch <= 0 always pass), emits the rest and
raises the mark to their greatest positive time. Rows of a key arrive in
Arrow batches, so a hot feed streams through its task without being gathered.

Handover: a feed table of earlier batch runs can be given as the stream's
initial state. It is read in the first micro-batch only; a stream restarted
from its checkpoint goes on from its own state, whatever table is passed then.
A feed listed more than once starts from its greatest mark, a null or negative
mark is none, and a feed that no item ever reaches keeps its mark in the table.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PASSED_SCHEMA = "feed_url string, event_id long, ts long"


class FeedMark(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.mark = handle.getValueState("mark", "last_processed_at long")

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        best = int(initialState["last_processed_at"].max())
        if not self.mark.exists() or self.mark.get()[0] < best:
            self.mark.update((best,))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        last = self.mark.get()[0] if self.mark.exists() else 0
        best = last
        for pdf in rows:
            ts = pdf["ts"]
            keep = pdf[~((ts > 0) & (ts <= last))]
            if len(keep):
                if keep["ts"].notna().any():  # undated items pass without a mark
                    best = max(best, int(keep["ts"].max()))
                yield keep[["feed_url", "event_id", "ts"]]
        if best > last:
            self.mark.update((best,))

    def close(self) -> None:
        pass


def passed_items(items: DataFrame, marks: DataFrame | None = None) -> DataFrame:
    """Streaming items(feed_url, event_id, ts) -> the items that pass their feed's mark.

    marks: (feed_url, last_processed_at) that the feeds start from.
    """
    from quire.session import ship_package
    spark = items.sparkSession
    ship_package(spark)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    start = None
    if marks is not None:  # one row a feed, as a key's initial rows may come in several pieces
        start = (marks.where(F.col("feed_url").isNotNull() & (F.col("last_processed_at") > 0)).groupBy("feed_url")
                 .agg(F.max(F.col("last_processed_at").cast("long")).alias("last_processed_at")).groupBy("feed_url"))
    return (items.select("feed_url", "event_id", "ts").groupBy("feed_url")
            .transformWithStateInPandas(FeedMark(), PASSED_SCHEMA, "append", "None", start))


def run(items: DataFrame, out: str, checkpoint: str, marks: DataFrame | None = None):
    """Start the stream over what has landed: passed items appended to the Parquet folder `out`.

    Started again with the same checkpoint it takes up what landed since.
    """
    return (passed_items(items, marks).writeStream.format("parquet").option("path", out)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def marks_after(passed: DataFrame, marks: DataFrame) -> DataFrame:
    """(feed_url, last_processed_at, n_passed): the feed table after a stream that began with `marks`.

    A feed without a positive time has a null mark; n_passed counts its passed items.
    """
    both = marks.select("feed_url", F.col("last_processed_at").alias("ts"), F.lit(0).alias("n")).unionByName(
        passed.select("feed_url", "ts", F.lit(1).alias("n")))
    return both.groupBy("feed_url").agg(F.max(F.when(F.col("ts") > 0, F.col("ts"))).alias("last_processed_at"),
                                        F.sum("n").alias("n_passed"))
