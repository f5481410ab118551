"""Blocked similarity against all pairs: scores, spread and the recall of the blocking."""

import re
from collections import Counter

from conftest import SF
from pyspark.sql import functions as F

from quire.operators import transcripts as TR


def words(text):
    t = re.sub(r"[^0-9A-Za-z_\t\n\f\r ]", "", (text or "").lower())
    return [w for w in re.split(r"[\t\n\f\r ]+", t) if w]


def score(e, a):
    if not e or not a:
        return 1.0 if not e and not a else 0.0
    return min(len(a) / len(e), len(e) / len(a)) * 0.3 + sum(w in set(e) for w in a) / len(e) * 0.7


def test_recall_and_scores(spark):
    """Every document that holds a benchmark passage is proposed, and nearly every pair that scores high."""
    exp = spark.read.parquet(f"{SF}/benchmark.parquet").select(F.col("item_id").alias("e"), "text")
    act = spark.read.parquet(f"{SF}/documents.parquet").select(F.col("doc_id").alias("a"), "text")
    got = {(r.e, r.a): r for r in TR.pair_similarity(exp, act).collect()}
    e, a = ({r[0]: r.text for r in df.collect()} for df in (exp, act))
    want = {(i, d): score(words(e[i]), words(a[d])) for i in e for d in a}
    for k, r in got.items():
        assert abs(r.similarity - want[k]) < 1e-9 and (r.n_expected, r.n_actual) == (len(words(e[k[0]])), len(words(a[k[1]])))
    holds = {(i, d) for i in e for d in a if " ".join(words(e[i])) in " ".join(words(a[d]))}
    assert holds and holds <= set(got)
    distinct = {d: set(words(t)) for d, t in a.items()}
    near = {(i, d) for i in e for d in a if 5 * len(set(words(e[i])) & distinct[d]) >= 4 * len(set(words(e[i])))}
    assert near and len(near & set(got)) >= 0.9 * len(near)  # pairs where the document holds four in five of the item's words
    assert len(got) < len(want) / 2
    spread = [r.similarity for r in got.values()]
    assert max(spread) - min(spread) > 0.3


def test_edges(spark):
    e = spark.createDataFrame([(1, "one rare word"), (2, None), (3, "!!"), (4, "solo")], "e long, text string")
    a = spark.createDataFrame([(1, "One rare, word!"), (2, ""), (3, None), (4, "solo solo"), (5, "rare only"), (5, "and word one")], "a long, text string")
    got = {(r.e, r.a): (r.common, round(r.similarity, 6)) for r in TR.pair_similarity(e, a).collect()}
    assert got == {(1, 1): (3, 1.0), (1, 5): (3, round(0.3 * 3 / 5 + 0.7, 6)), (4, 4): (2, round(0.15 + 1.4, 6))}
    assert TR.pair_similarity(e.limit(0), a).count() == TR.pair_similarity(e, a.limit(0)).count() == 0


def test_words_are_made_once_and_only_expected_ones_told_apart(spark):
    texts = spark.createDataFrame([(1, "One ONE two; three\x0bfour—five d'un_x 9"), (2, "zz zz!"), (3, None), (4, " \t"), (1, "two\r\n\fzz")], "a long, text string")
    counted = TR.word_counts(texts, "a")
    assert counted._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace") == 1
    want = Counter((a, w) for a, t in texts.collect() for w in words(t))
    assert {(r.a, r.w): r.n for r in counted.collect()} == want
    some = spark.createDataFrame([("one",), ("zz",)], "w string")
    assert {(r.a, r.w): r.n for r in TR.word_counts(texts, "a", some).collect()} == {(1, "one"): 2, (1, "zz"): 1, (1, None): 5, (2, "zz"): 2}


def test_same_scores_without_a_broadcast_vocabulary(spark, monkeypatch):
    exp = spark.read.parquet(f"{SF}/benchmark.parquet").select(F.col("item_id").alias("e"), "text")
    act = spark.read.parquet(f"{SF}/documents.parquet").select(F.col("doc_id").alias("a"), "text")
    got = sorted(map(tuple, TR.pair_similarity(exp, act).collect()))
    monkeypatch.setattr(TR, "MAX_VOCABULARY", 0)
    assert got and got == sorted(map(tuple, TR.pair_similarity(exp, act).collect()))
