"""Quality rules: hashed n-gram log-likelihood ratio between trusted target and raw corpus.

Two multinomials over hashed word 1- and 2-grams are counted, one over the
trusted documents and one over all documents. A document's score is the mean
log ratio of its n-grams; it is kept when it passes the base rules and its
score reaches a threshold that is a fixed parameter, so every document gets
the same verdict on every run.

Defined results: null, empty and blank texts have no words, fail the base rule
and score 0; repeated rows are scored each; without trusted rows (or without
any document) the ratio is 0 everywhere, so the base rule alone decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

BITS = 16                 # hashed n-gram buckets: 2^16
ALPHA = 1.0               # added to each bucket of both multinomials
THRESHOLD = -0.25         # mean log ratio a kept document reaches
MIN_WORDS = 50
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True

STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def bucket_ids(w: C.Words, h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and text index of every 1- and 2-gram."""
    doc = w.doc()
    two, at = w.ngrams(h, 2)
    shift = np.uint64(64 - bits)
    ids = np.concatenate([h >> shift, two >> shift]).astype(np.int64)
    return ids, np.concatenate([doc, doc[at]])


def ngram_counts(df: DataFrame, bits: int = BITS) -> DataFrame:
    """(bucket, raw, target) of all documents; `trusted` marks the target rows."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((2, 1 << bits), np.int64)
        for b in batches:
            texts, trusted = b["text"].tolist(), b["trusted"].to_numpy(bool)
            for s in C.text_slices(texts):
                w = C.Words(texts[s])
                ids, doc = bucket_ids(w, w.hashes(), bits)
                total[0] += np.bincount(ids, minlength=1 << bits)
                total[1] += np.bincount(ids[trusted[s][doc]], minlength=1 << bits)
            del b, texts
            C.trimmed()
        at = np.flatnonzero(total[0])
        yield pd.DataFrame({"bucket": at, "raw": total[0][at], "target": total[1][at]})

    part = df.select("text", F.coalesce("trusted", F.lit(False)).alias("trusted")).mapInPandas(
        count, "bucket long, raw long, target long")
    return part.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def log_ratios(counts: DataFrame, bits: int = BITS, alpha: float = ALPHA) -> np.ndarray:
    """Log ratio per bucket. Reads at most 2^bits rows to the driver."""
    raw, target = np.full(1 << bits, alpha), np.full(1 << bits, alpha)
    rows = counts.toPandas()
    raw[rows["bucket"].to_numpy(int)] += rows["raw"].to_numpy(float)
    target[rows["bucket"].to_numpy(int)] += rows["target"].to_numpy(float)
    if not len(rows) or rows["target"].sum() == 0:
        return np.zeros(1 << bits)
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def text_stats(texts: list[str | None]) -> dict[str, np.ndarray]:
    """The base counts of a run of texts."""
    w = C.Words(texts)
    h = w.hashes()
    n = len(texts)
    starts = w.base[:-1]
    lead = (w.raw & 0xC0) != 0x80  # first bytes of code points
    inside = np.zeros(len(w.raw) + 1, np.int64)
    np.cumsum(lead & ~C._SPACE[w.raw], out=inside[1:])
    chars = inside[starts + w.sizes] - inside[starts]
    sym = np.zeros(len(w.raw) + 1, np.int64)
    np.cumsum(_SYMBOL[w.raw], out=sym[1:])
    symbols = sym[starts + w.sizes] - sym[starts]
    three, at = w.ngrams(h, 3)
    doc = w.doc()
    covered = np.zeros(len(h) + 1, np.int64)
    if len(at):
        key = C.mix(three ^ C.mix(doc[at].astype(np.uint64) + np.uint64(1)))
        order = np.argsort(key, kind="stable")
        ks = key[order]
        same = np.zeros(len(ks), bool)
        same[1:] = ks[1:] == ks[:-1]
        same[:-1] |= ks[1:] == ks[:-1]
        hit = at[order[same]]
        np.add.at(covered, hit, 1)
        np.add.at(covered, np.minimum(hit + 3, len(h)), -1)
    repeat = np.bincount(doc, weights=np.cumsum(covered)[:-1] > 0, minlength=n).astype(np.int64)
    dup = np.fromiter(map(_dup_lines, texts), np.int64, n)
    return {"n_words": w.count.astype(np.int64), "word_chars": chars, "n_symbols": symbols,
            "n_dup_lines": dup, "n_repeat_words": repeat, "_w": w, "_h": h}


def _dup_lines(text: str | None) -> int:
    if not text or "\n" not in text:
        return 0
    lines = [x for x in text.split("\n") if x.strip(" \t\n\v\f\r")]
    return len(lines) - len(set(lines))


def quality_rules(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD, bits: int = BITS,
                  alpha: float = ALPHA) -> DataFrame:
    """All columns of `docs` (doc_id, text, ...) plus base counts, base_failed, llr and kept.

    trusted: doc_id of the trusted-target documents; null and repeated ids
    there count once, unknown ids do nothing.
    """
    C.prepare(docs.sparkSession)
    ids = trusted.select(F.col("doc_id").alias("_trusted_id")).where("_trusted_id IS NOT NULL").distinct()
    marked = docs.select("doc_id", "text").join(
        C.checked_broadcast(ids, 16), F.col("doc_id") == F.col("_trusted_id"), "left").select(
        "text", F.col("_trusted_id").isNotNull().alias("trusted"))
    ratio = log_ratios(ngram_counts(marked, bits), bits, alpha)
    shared = docs.sparkSession.sparkContext.broadcast(ratio)

    def score(texts: list[str | None]) -> dict:
        st = text_stats(texts)
        w, h = st.pop("_w"), st.pop("_h")
        ids, doc = bucket_ids(w, h, bits)
        n = len(texts)
        grams = np.maximum(np.bincount(doc, minlength=n), 1)
        llr = np.round(np.bincount(doc, weights=shared.value[ids], minlength=n) / grams, 9)
        failed = (st["n_words"] < MIN_WORDS) | (100 * st["n_repeat_words"] > 50 * st["n_words"])
        return {**st, "base_failed": failed, "llr": llr, "kept": ~failed & (llr >= threshold)}

    return C.by_text(docs, f"{STATS}, base_failed boolean, llr double, kept boolean", score)
