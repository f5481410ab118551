"""Incremental skip: items at or below their feed's mark are dropped.

Undated items carry the zero time (negative epoch) and therefore always pass;
so do items at epoch 0. Marks are whole seconds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.session import bounded_broadcast


def skip_processed(items: DataFrame, marks: DataFrame, include_all: bool = False,
                   key: str = "feed_url", ts: str = "ts") -> DataFrame:
    """Keep items that are new for their feed.

    `marks(feed_url, last_processed_at)`: one row per feed. With include_all
    the history is ignored (and the caller writes no marks for the run).
    """
    if include_all:
        return items
    m = bounded_broadcast(marks.select(F.col("feed_url").alias(key), "last_processed_at"))
    j = items.join(m, key, "left")
    last = F.coalesce(F.col("last_processed_at"), F.lit(0))
    return j.where(~((F.col(ts) > 0) & (F.col(ts) <= last))).drop("last_processed_at")


def new_marks(passed: DataFrame, key: str = "feed_url", ts: str = "ts") -> DataFrame:
    """Greatest item time per feed over the items that passed; only positive marks."""
    return (passed.groupBy(key).agg(F.max(ts).alias("last_processed_at"))
            .where(F.col("last_processed_at") > 0))
