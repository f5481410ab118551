"""Benchmark decontamination by spaced seeds, with DataFrame functions only.

Fixed masks pick some of the words under them and ignore the others, so a
window still hits when words at ignored places were replaced. Hashes of all
masked windows of the documents are joined with those of the benchmark items;
each distinct alignment (document, item, offset) with a hit is verified: along
it, equal words count 1 and different ones -3, and the best segment (more
than three quarters equal) must hold enough equal words.

Words are runs of letters and digits, lower-cased. Defined results: null and
empty texts or items match nothing; repeated rows give one row per (doc_id,
item_id); an item shorter than every mask is found only if a mask fits into
it; an empty benchmark gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C

# Masks: 1 compared, 0 ignored.
MASKS = ("11101011", "110110101", "1100101011")
MIN_EQUAL = 10      # equal words a match needs, or all words of a shorter item
MISMATCH = 3        # equal words that one different word outweighs


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def word_hashes(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def windows(df: DataFrame, key: str, text: str, masks: tuple[str, ...]) -> DataFrame:
    """(key, at, seed): the hash of every window of every mask over the words of `text`.

    One row per word position leaves the generator; the masks are read off the
    array of word hashes inside the same generated code.
    """
    shortest = min(map(len, masks))
    rows = df.select(F.col(key), word_hashes(F.col(text)).alias("h")).where(F.size("h") >= shortest)
    at = rows.select(key, "h", F.size("h").alias("n"), F.explode(
        F.sequence(F.lit(0), F.size("h") - shortest)).alias("at"))

    def seed(i: int, mask: str) -> Column:
        picked = [F.col("h")[F.col("at") + k] for k, bit in enumerate(mask) if bit == "1"]
        return F.when(F.col("at") + len(mask) <= F.col("n"), F.xxhash64(F.lit(i), *picked))

    return at.select(key, "at", *[seed(i, m).alias(f"s{i}") for i, m in enumerate(masks)])


def hits(docs: DataFrame, items: DataFrame, masks: tuple[str, ...]) -> DataFrame:
    """Distinct (doc_id, item_id, shift) alignments with a seed hit; shift = document position - item position."""
    side = windows(items.withColumnRenamed("text", "_item"), "item_id", "_item", masks)
    seeds = C.staged(side.select("item_id", F.col("at").alias("item_at"), F.explode(
        F.array(*[f"s{i}" for i in range(len(masks))])).alias("seed")).where("seed IS NOT NULL").distinct(), "seeds")
    found = None
    here = windows(docs, "doc_id", "text", masks)
    table = C.checked_broadcast(seeds, 48)
    hit = here.select("doc_id", "at", F.explode(F.array(*[f"s{i}" for i in range(len(masks))])).alias("seed")).join(table, "seed")
    found = hit.select("doc_id", "item_id", (F.col("at") - F.col("item_at")).alias("shift"))
    return found.distinct()


def best_segment(equal: Column) -> Column:
    """struct(score, equal, start, stop) of the best run in an array of booleans: 1 each, -MISMATCH each."""
    start = F.struct(F.lit(0).alias("score"), F.lit(0).alias("equal"), F.lit(0).alias("start"), F.lit(0).alias("at"),
                     F.struct(F.lit(0).alias("score"), F.lit(0).alias("equal"), F.lit(0).alias("start"),
                              F.lit(0).alias("stop")).alias("best"))

    def step(s: Column, e: Column) -> Column:
        fresh = s["score"] <= 0
        score = F.when(fresh, 0).otherwise(s["score"]) + F.when(e, 1).otherwise(-MISMATCH)
        same = F.when(fresh, 0).otherwise(s["equal"]) + F.when(e, 1).otherwise(0)
        begin = F.when(fresh, s["at"]).otherwise(s["start"])
        now = F.struct(score.alias("score"), same.alias("equal"), begin.alias("start"), (s["at"] + 1).alias("stop"))
        return F.struct(score.alias("score"), same.alias("equal"), begin.alias("start"), (s["at"] + 1).alias("at"),
                        F.when(score > s["best"]["score"], now).otherwise(s["best"]).alias("best"))

    return F.aggregate(equal, start, step, lambda s: s["best"])


def contamination(docs: DataFrame, items: DataFrame, masks: tuple[str, ...] = MASKS, min_equal: int = MIN_EQUAL) -> DataFrame:
    """(doc_id, item_id, equal_words, overlap_words, doc_start, item_start): the best overlap of each pair.

    docs: (doc_id, text); items: (item_id, text).
    """
    docs = docs.select("doc_id", "text").where("text IS NOT NULL")
    items = items.select("item_id", "text").where("text IS NOT NULL")
    found = C.staged(hits(docs, items, masks), "hits")
    doc_key, item_key = found.select("*"), items.select(F.col("item_id").alias("_item"), word_hashes(F.col("text")).alias("ih"))
    placed = doc_key.withColumnRenamed("doc_id", "_doc").join(
        item_key, F.col("item_id").eqNullSafe(F.col("_item"))).drop("_item")
    pairs = docs.join(_small(placed), F.col("doc_id").eqNullSafe(F.col("_doc")))
    dh = F.col("dh")
    lo = F.greatest(-F.col("shift"), F.lit(0))  # first item word that lies inside the document
    n = F.least(F.size("ih"), F.size(dh) - F.col("shift")) - lo
    equal = F.zip_with(F.slice("ih", lo + 1, n), F.slice(dh, lo + F.col("shift") + 1, n), lambda a, b: a == b)
    checked = pairs.select("doc_id", "item_id", "shift", "ih", word_hashes(F.col("text")).alias("dh")).where(n > 0).select(
        "doc_id", "item_id", "shift", F.size("ih").alias("n_item"), lo.alias("lo"), best_segment(equal).alias("s"))
    good = checked.where(F.col("s.equal") >= F.least(F.lit(min_equal), "n_item")).select("doc_id", "item_id", F.struct(
        F.col("s.equal").cast("long").alias("equal_words"),
        (F.col("s.stop") - F.col("s.start")).cast("long").alias("overlap_words"),
        (-(F.col("lo") + F.col("shift") + F.col("s.start"))).cast("long").alias("minus_start"),
        (F.col("lo") + F.col("s.start")).cast("long").alias("item_start")).alias("m"))
    return good.groupBy("doc_id", "item_id").agg(F.max("m").alias("m")).select(
        "doc_id", "item_id", "m.equal_words", "m.overlap_words", (-F.col("m.minus_start")).alias("doc_start"), "m.item_start")


def _small(placed: DataFrame) -> DataFrame:
    return C.checked_broadcast(placed, 400)


def drop_contaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """`docs` without the rows that hold a benchmark passage; all columns and other rows stay, also under the same id."""
    key = F.xxhash64("doc_id", "text")
    bad = contamination(docs.select(key.alias("doc_id"), "text"), items, **options).select(
        F.col("doc_id").alias("_bad")).distinct()
    return docs.join(bad, key == F.col("_bad"), "left_anti")
