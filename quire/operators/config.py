"""Resource configuration as a table: enabled flag, type registries, dispatch checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.session import local_table

# The registries of the source and parser types.
SOURCE_TYPES = ("rss", "telegram_channel")
PARSER_TYPES = ("web", "telegram", "youtube")


def enabled(resources: DataFrame) -> DataFrame:
    """A resource without an explicit flag is enabled."""
    return resources.where(F.coalesce("enabled", F.lit(True)))


def agent_types(resources: DataFrame) -> DataFrame:
    return enabled(resources).select(F.explode("agents").alias("agent")).distinct()


def parser_types(resources: DataFrame) -> DataFrame:
    return enabled(resources).select("parser").distinct()


def source_types(resources: DataFrame) -> DataFrame:
    return enabled(resources).select("type").distinct()


def unknown_types(spark: SparkSession, resources: DataFrame) -> DataFrame:
    """Enabled resources naming an unregistered source or parser type (a startup failure)."""
    known_s = local_table(spark, [(t,) for t in SOURCE_TYPES], "type string")
    known_p = local_table(spark, [(p,) for p in PARSER_TYPES], "parser string")
    e = enabled(resources)
    bad_s = e.join(F.broadcast(known_s), "type", "left_anti").select("resource_pos", F.lit("type").alias("kind"),
                                                                      F.col("type").alias("value"))
    bad_p = e.join(F.broadcast(known_p), "parser", "left_anti").select("resource_pos", F.lit("parser").alias("kind"),
                                                                        F.col("parser").alias("value"))
    return bad_s.unionByName(bad_p)


def validate(spark: SparkSession, resources: DataFrame) -> None:
    bad = unknown_types(spark, resources).limit(20).collect()
    if bad:
        raise ValueError("unknown resource types: " + ", ".join(f"{r.kind}={r.value}" for r in bad))
