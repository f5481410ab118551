"""Transcript checks: expected-segment parsing, word-overlap similarity, validity.

Similarity = 0.3 * length ratio (shorter / longer word count)
           + 0.7 * (actual words found in the expected word set) / expected words.
Words are computed per segment and exploded, so the overlap is a count per
(key, word) aggregated map-side, never an array scan per pair.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.session import materialize

# Fixed values
EXPECTED_RE = r"\[(\d{2}):(\d{2}):(\d{2})\]([^\n]*)"
EXPECTED_DURATION = 2.0
LENGTH_WEIGHT, OVERLAP_WEIGHT = 0.3, 0.7


def parse_expected(df: DataFrame, col: str = "raw") -> DataFrame:
    """'[HH:MM:SS] text' -> start, end (= start + 2 s), text; unparsable rows dropped."""
    g = lambda i: F.regexp_extract(col, EXPECTED_RE, i)
    ok = F.col(col).rlike(EXPECTED_RE)
    return (df.where(ok)
            .withColumn("start", (g(1).cast("long") * 3600 + g(2).cast("long") * 60 + g(3).cast("long")).cast("double"))
            .withColumn("end", F.col("start") + EXPECTED_DURATION)
            .withColumn("text", F.regexp_replace(g(4), rf"^[{T.WS_CLASS}]+|[{T.WS_CLASS}]+$", "")))


def _score(ne, na, common):
    ratio = F.least(na / ne, ne / na)
    return (F.when((ne == 0) & (na == 0), F.lit(1.0))
            .when((ne == 0) | (na == 0), F.lit(0.0))
            .otherwise(ratio * LENGTH_WEIGHT + common / ne * OVERLAP_WEIGHT))


# Words of the expected texts up to which they are broadcast, so that other words are counted without being told apart.
MAX_VOCABULARY = 500_000


def word_counts(texts: DataFrame, key: str, only: DataFrame | None = None) -> DataFrame:
    """(key, w, n): how often each normalised word occurs in the texts of a key.

    only: (w) distinct words, broadcast; all others count as one word, which is null.
    """
    # outer: else the optimizer derives a filter from the words, and they are made once more for it
    words = texts.select(key, F.explode_outer(T.normalise_words("text")).alias("w")).where("w IS NOT NULL")
    if only is not None:
        words = words.join(F.broadcast(only.select("w", F.col("w").alias("_in"))), "w", "left").select(key, F.col("_in").alias("w"))
    return words.groupBy(key, "w").agg(F.count(F.lit(1)).alias("n"))


def blocked_pairs(expected: DataFrame, actual: DataFrame, rarest: int = 8, shared: int = 3) -> DataFrame:
    """(e, a): expected and actual texts that may resemble each other.

    expected(e, w, n), actual(a, w, n): word counts. Words are ranked by how
    many actual texts hold them; an expected text asks an inverted index of
    the actual ones for its `rarest` words that any of them holds, and a pair
    is kept that shares at least `shared` of those (all, where the text has
    fewer). Frequent words are never looked up while rarer ones exist, so the
    lists that meet are the shortest ones. Measured: all pairs are proposed in
    which the actual text holds four in five of the expected words; long texts
    that hold half of them by chance are mostly not.
    """
    held = actual.where("w IS NOT NULL").groupBy("w").agg(F.count(F.lit(1)).alias("df"))  # a text holds a word in one row
    rank = F.row_number().over(Window.partitionBy("e").orderBy("df", "w"))
    asked = expected.join(held, "w").withColumn("rank", rank).where(F.col("rank") <= rarest).select("e", "w")
    asked = asked.withColumn("need", F.least(F.lit(shared), F.count(F.lit(1)).over(Window.partitionBy("e"))))
    return (asked.join(actual.select("a", "w"), "w").groupBy("e", "a").agg(F.count(F.lit(1)).alias("hits"), F.first("need").alias("need"))
            .where("hits >= need").select("e", "a"))


def pair_similarity(expected: DataFrame, actual: DataFrame, **options) -> DataFrame:
    """expected(e, text), actual(a, text) -> e, a, n_expected, n_actual, common, similarity of the blocked pairs.

    The words of a pair meet by (text, word); no text is compared that the
    blocking did not propose. Of the actual texts only words that an expected
    one holds are told apart; the others just count. options: as of blocked_pairs().
    """
    ew = materialize(word_counts(expected, "e"))
    asked = materialize(ew.select("w").distinct())
    few = asked.count() <= MAX_VOCABULARY
    aw = materialize(word_counts(actual, "a", asked if few else None))
    pairs = materialize(blocked_pairs(ew, aw, **options))
    total = lambda df, key, name: df.groupBy(key).agg(F.sum("n").alias(name))
    common = (pairs.join(ew.select("e", "w"), "e").join(aw, ["a", "w"]).groupBy("e", "a").agg(F.sum("n").alias("common")))
    j = (pairs.join(common, ["e", "a"], "left").join(total(ew, "e", "n_expected"), "e").join(total(aw, "a", "n_actual"), "a")
         .withColumn("common", F.coalesce("common", F.lit(0))))
    ne, na = F.col("n_expected").cast("double"), F.col("n_actual").cast("double")
    return j.select("e", "a", "n_expected", "n_actual", "common", _score(ne, na, F.col("common")).alias("similarity"))


def similarity(expected: DataFrame, actual: DataFrame, key: str = "key") -> DataFrame:
    """expected/actual(key, text) segment rows -> key, n_expected, n_actual, common, similarity.

    Both sides are read once: their words are tagged, unioned and counted per
    (key, word) (partial aggregation map-side), then per key. `common` counts
    the actual words whose word also occurs on the expected side. Keys
    without any word survive through `explode_outer`.
    """
    def words(df, e, a):
        return df.select(key, F.explode_outer(T.normalise_words("text")).alias("w"),
                         F.lit(e).alias("_e"), F.lit(a).alias("_a"))
    tagged = words(expected, 1, 0).unionByName(words(actual, 0, 1))
    has_w = F.col("w").isNotNull()
    per_word = tagged.groupBy(key, "w").agg(F.sum(F.when(has_w, F.col("_e")).otherwise(0)).alias("ec"),
                                            F.sum(F.when(has_w, F.col("_a")).otherwise(0)).alias("ac"))
    j = per_word.groupBy(key).agg(F.sum("ec").cast("long").alias("n_expected"),
                                  F.sum("ac").cast("long").alias("n_actual"),
                                  F.sum(F.when(F.col("ec") > 0, F.col("ac")).otherwise(0)).cast("long").alias("common"))
    ne, na = F.col("n_expected").cast("double"), F.col("n_actual").cast("double")
    return j.withColumn("similarity", _score(ne, na, F.col("common")))


def validity(segs: DataFrame, key: str = "file_id") -> DataFrame:
    """Per transcript: segments, negative starts, non-increasing timings, blank texts."""
    blank = F.regexp_replace(T.s("text"), rf"^[{T.WS_CLASS}]+|[{T.WS_CLASS}]+$", "") == ""
    return segs.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_segments"),
        F.sum((F.col("start") < 0).cast("int")).alias("bad_start"),
        F.sum((F.col("end") <= F.col("start")).cast("int")).alias("bad_timing"),
        F.sum(blank.cast("int")).alias("blank_text"))
