"""Pairwise ranking: held-out accuracy, the fitted loss against a plain gradient, defined results."""

import numpy as np
from pyspark.sql import functions as F

from quire.llm import ranking
from quire.llm.lm import held_out

DIR = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{DIR}/labels.parquet")
    out = held_out(F.col("doc_id"), 3, 1)
    got = ranking.quality_scores(docs, labels.where(~out).select("doc_id", (F.col("quality") == 1).alias("good")))
    rows = got.join(labels, "doc_id").where(out).select("quality", "predicted", "score").collect()
    assert all((r.score >= 0.5) == (r.predicted == 1) and 0 <= r.score <= 1 for r in rows)
    for label in (0, 1):
        own = [r for r in rows if r.quality == label]
        assert own and sum(r.predicted == label for r in own) >= 0.95 * len(own)


def test_fit_is_a_minimum():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, len(ranking.FEATURES)))
    good = x[:, 0] + rng.normal(size=200) > 0
    model = ranking.fit(x, good)
    z = np.clip((x - model["mean"]) / model["scale"], -6, 6)
    rng = np.random.default_rng(7)
    a, b = z[good], z[~good]
    n = min(ranking.PAIRS, 40 * max(len(a), len(b)))
    diff = a[rng.integers(0, len(a), n)] - b[rng.integers(0, len(b), n)]
    loss = lambda w: np.log1p(np.exp(-diff @ w)).mean() + ranking.L2 / 2 * w @ w
    best = loss(model["weight"])
    for i in range(len(model["weight"])):
        step = np.eye(len(model["weight"]))[i] * 1e-3
        assert loss(model["weight"] + step) >= best and loss(model["weight"] - step) >= best
    s = ranking.scores(model, x)
    assert abs((s < 0.5).mean() - (~good).mean()) < 0.02  # the threshold is the quantile of the bad rows' share


def test_edges(spark, edges, nothing):
    labels = spark.createDataFrame([(4, True), (9, False), (9, False), (10, None), (None, True), (77, True)], "doc_id long, good boolean")
    rows = ranking.quality_scores(edges.selectExpr("*", "'old' AS score", "1 AS good"), labels).collect()
    assert len(rows) == edges.count() and all(r.n == 5 and r.good == 1 and 0 <= r.score <= 1 for r in rows)
    none = ranking.quality_scores(edges, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert ranking.quality_scores(nothing, labels).count() == 0


def test_threshold_covers_all_labels(spark):
    """With more labels than the fitting sample takes, the threshold is still that of all of them."""
    docs = spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{DIR}/labels.parquet").select("doc_id", (F.col("quality") == 1).alias("good"))
    model = ranking.train(docs, labels, per_class=20)
    rows = docs.join(labels, "doc_id").collect()
    s = ranking.raw_scores(model, ranking.features([r.text for r in rows]))
    bad = sum(not r.good for r in rows)
    assert 20 < bad < len(rows) - 20
    assert abs(model["threshold"] - np.quantile(s, bad / len(rows))) < 1e-9
