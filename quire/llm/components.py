"""Connected components of a link table by large-star and small-star rounds."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C


def components(links: DataFrame, rounds: int = 60, stage: Callable[[DataFrame, str], DataFrame] = C.staged) -> DataFrame:
    """(node, root): the smallest node of the component of every linked node, as a table written by `stage`.

    links: (a, b) long, in any direction; loops and repeated links do no harm.
    Each round points every node at the smallest node next to it, first over
    its larger neighbours, then over the smaller ones; hot nodes meet only
    partial minima and skew-split joins. It ends when no node stands on both
    sides, so that the links are stars. Both halves of a round are written
    tables, so that no plan holds more than one of them; all go at the end.
    """
    with C.Scratch(links.sparkSession) as held:
        edges = held(links.where("a <> b").select(
            F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
        for left in reversed(range(rounds + 1)):
            inner = edges.select(F.col("b").alias("a")).distinct()
            if not C.counted(edges.join(inner, "a", "left_semi").limit(1)):
                break
            if not left:
                raise RuntimeError(f"components did not settle in {rounds} rounds")
            both = edges.union(edges.select("b", "a"))
            low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
            large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            large = held(large.union(low.where("m < a").select("a", F.col("m").alias("b"))).where("a <> b").distinct(), "large")
            down = large.groupBy("a").agg(F.min("b").alias("m"))
            small = large.join(down, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(
                down.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
            edges = held(small, "stars")
        return stage(edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
            edges.select("b", F.col("b").alias("root")).distinct()), "components")
