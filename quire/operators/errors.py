"""Error rows: transient-error triage and retry schedules as Columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions import text as T

ERRORS_SCHEMA = "resource_pos int, item_pos long, stage string, message string"


def triage(errors: DataFrame, msg: str = "message", attempt: str = "attempt",
           initial: float = 1.0, cap: float = 30.0) -> DataFrame:
    return (errors.withColumn("retryable", T.is_retryable(msg))
            .withColumn("delay_s", T.retry_delay_seconds(msg))
            .withColumn("backoff_s", T.backoff_seconds(attempt, msg, initial, cap)))


def counts_by_stage(errors: DataFrame) -> DataFrame:
    return errors.groupBy("stage").agg(F.count(F.lit(1)).alias("n"))
