"""Quality classifier: Bradley-Terry pairwise ranking over style features of a text.

Preference pairs (good document over bad document) are drawn from labelled
rows; the logistic loss of their feature differences gives one weight per
feature. Scores of all labelled documents fix the threshold: the exact score
quantile at their share of bad documents. score = logistic(s - threshold), so a
document is predicted good exactly when it lies above that quantile.

Only the sample that the weights are fitted on is bounded (FIT_ROWS per class,
smallest hash of the id first); threshold and scores cover every document over
its whole text. Features use the text
alone: no label, language, source or id.

Defined results: null and empty texts have all-zero features and are scored
like any other; null labels are ignored, of repeated labelled rows each counts;
if a class is missing from the labels there are no pairs, all weights are 0
and every score is 0.5.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from .quality import text_stats

FIT_ROWS = 4000     # labelled documents per class at most that the model is fitted on
PAIRS = 60_000      # preference pairs drawn from them
L2 = 1e-3
ROUNDS = 30
BINS = 4096         # counts per step of the search for a quantile

FEATURES = ("log_words", "word_chars", "symbols", "dup_lines", "repeats", "upper", "digits", "bars", "bangs",
            "marks", "distinct", "lines", "stops", "capitals")


def _share(mask: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    total = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=total[1:])
    return total[starts + sizes] - total[starts]


def features(texts: list[str | None]) -> np.ndarray:
    """One row of FEATURES per text."""
    st = text_stats(texts)
    w, h = st["_w"], st["_h"]
    starts, sizes, raw = w.base[:-1], w.sizes, w.raw
    words = np.maximum(w.count, 1)
    chars = np.maximum(st["word_chars"], 1)
    doc = w.doc()
    count = lambda mask: _share(mask, starts, sizes)
    pairs = np.unique(C.mix(h ^ C.mix(doc.astype(np.uint64) + np.uint64(1))), return_index=True)[1]
    distinct = np.bincount(doc[pairs], minlength=len(texts))
    upper = (raw >= 65) & (raw <= 90)
    lines = np.maximum(count(raw == 10) + 1, 1)
    ends = raw[w.end - 1] if len(w.end) else np.zeros(0, np.uint8)
    stops = np.bincount(doc, weights=np.isin(ends, list(b".,;:")), minlength=len(texts))
    capital = np.bincount(doc, weights=upper[w.start], minlength=len(texts))
    return np.column_stack([
        np.log1p(w.count), st["word_chars"] / words / 10, st["n_symbols"] / chars, st["n_dup_lines"] / lines,
        st["n_repeat_words"] / words, count(upper) / chars, count((raw >= 48) & (raw <= 57)) / chars,
        count(raw == 124) / words, count(raw == 33) / words,
        count((raw > 32) & (raw < 127) & ~(upper | ((raw >= 97) & (raw <= 122)) | ((raw >= 48) & (raw <= 57)))) / chars,
        distinct / words, lines / words, stops / words, capital / words])


def fit(x: np.ndarray, good: np.ndarray, seed: int = 7) -> dict:
    """Weights, feature scaling and threshold from labelled feature rows."""
    mean, scale = (x.mean(0), x.std(0) + 1e-9) if len(x) else (np.zeros(len(FEATURES)), np.ones(len(FEATURES)))
    z = np.clip((x - mean) / scale, -6, 6)
    a, b = z[good], z[~good]
    weight = np.zeros(len(FEATURES))
    threshold = 0.0
    if len(a) and len(b):
        rng = np.random.default_rng(seed)
        n = min(PAIRS, 40 * max(len(a), len(b)))
        diff = a[rng.integers(0, len(a), n)] - b[rng.integers(0, len(b), n)]
        for _ in range(ROUNDS):  # Newton steps on mean log(1 + exp(-w.diff)) + L2/2 |w|^2
            p = 1 / (1 + np.exp(np.clip(diff @ weight, -35, 35)))
            grad = -(p @ diff) / n + L2 * weight
            hess = (diff * (p * (1 - p))[:, None]).T @ diff / n + L2 * np.eye(len(weight))
            step = np.linalg.solve(hess, grad)
            weight = weight - step
            if np.abs(step).max() < 1e-8:
                break
        threshold = float(np.quantile(z @ weight, len(b) / (len(a) + len(b))))
    return {"weight": weight, "mean": mean, "scale": scale, "threshold": threshold}


def raw_scores(model: dict, x: np.ndarray) -> np.ndarray:
    return np.clip((x - model["mean"]) / model["scale"], -6, 6) @ model["weight"]


def scores(model: dict, x: np.ndarray) -> np.ndarray:
    s = raw_scores(model, x) - model["threshold"]
    return np.round(1 / (1 + np.exp(-np.clip(s, -35, 35))), 9)


def fitting_rows(docs: DataFrame, labelled: DataFrame, per_class: int = FIT_ROWS) -> DataFrame:
    """(features, good) of at most per_class rows of each label, smallest id hash first.

    labelled: (doc_id, good boolean).
    """
    lab = labelled.where("doc_id IS NOT NULL AND good IS NOT NULL").select(
        F.col("doc_id").alias("_id"), "good")
    pick = [lab.where(F.col("good") == v).orderBy(F.xxhash64("_id"), "_id").limit(per_class) for v in (True, False)]
    few = F.broadcast(pick[0].unionByName(pick[1]))  # 2 * per_class rows at most
    rows = docs.select("doc_id", "text").join(few, F.col("doc_id") == F.col("_id")).select("doc_id", "text", "good")
    return C.by_text(rows, "x array<double>", lambda t: {"x": list(features(t))}).select("doc_id", "x", "good")


def labelled_scores(model: dict, docs: DataFrame, labelled: DataFrame) -> DataFrame:
    """(s, good) of all labelled rows."""
    lab = labelled.where("doc_id IS NOT NULL AND good IS NOT NULL").select(F.col("doc_id").alias("_id"), "good")
    ids = lab.select("_id").distinct()
    rows = docs.select("doc_id", "text")
    if ids.count() * 64 <= C.BROADCAST_BYTES:  # else the other texts are scored too rather than shuffled
        rows = rows.join(F.broadcast(ids), F.col("doc_id") == F.col("_id"), "left_semi")
    made = C.by_text(rows, "s double", lambda t: {"s": raw_scores(model, features(t))}).select("doc_id", "s")
    return made.join(lab, F.col("doc_id") == F.col("_id")).select("s", "good")


def at_rank(rows: DataFrame, rank: int) -> float:
    """The value of column s with `rank` smaller or equal ones before it, by counts in ever narrower bins."""
    low, high = rows.agg(F.min("s"), F.max("s")).first()
    while low < high:
        width = (high - low) / BINS
        if not width:
            break
        place = F.least(F.floor((F.col("s") - F.lit(low)) / F.lit(width)), F.lit(BINS - 1))
        bins = rows.where(F.col("s").between(low, high)).groupBy(place.alias("bin")).agg(
            F.count("*").alias("n"), F.min("s").alias("low"), F.max("s").alias("high")).collect()  # BINS rows at most
        for r in sorted(bins, key=lambda r: r["bin"]):
            if rank < r["n"]:
                break
            rank -= r["n"]
        low, high = r["low"], r["high"]
    return low


def quantile(rows: DataFrame, n: int, share: float) -> float:
    """np.quantile() of column s, without bringing its n values together."""
    at = share * (n - 1)
    low = at_rank(rows, int(at))
    return low + (at - int(at)) * (at_rank(rows, min(int(at) + 1, n - 1)) - low)


def train(docs: DataFrame, labelled: DataFrame, per_class: int = FIT_ROWS) -> dict:
    rows = fitting_rows(docs, labelled, per_class).toPandas().sort_values("doc_id", kind="stable")
    x = np.array(rows["x"].tolist(), float).reshape(len(rows), len(FEATURES))
    model = fit(x, rows["good"].to_numpy(bool))
    if model["weight"].any():
        every = C.staged(labelled_scores(model, docs, labelled), "labelled")
        n, bad = every.agg(F.count("*"), F.count_if(~F.col("good"))).first()
        model["threshold"] = quantile(every, n, bad / n)
    return model


def quality_scores(docs: DataFrame, labelled: DataFrame, per_class: int = FIT_ROWS) -> DataFrame:
    """All columns of `docs` plus score (0 to 1) and predicted (1 if score >= 0.5)."""
    C.prepare(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labelled, per_class))

    def make(texts: list[str | None]) -> dict:
        s = scores(model.value, features(texts))
        return {"score": s, "predicted": (s >= 0.5).astype(np.int32)}

    return C.by_text(docs, "score double, predicted int", make)
