"""Substring dedup by seed and extend.

A window is `length` consecutive words. Of the 8-word sequences in a window
the one with the smallest hash is its anchor (winnowing), so equal windows have
equal anchors at equal places. Documents are joined on anchors that occur more
than once; only around those are matches extended: every window that has such
an anchor is the anchor with so many words to its left and so many to its
right, and it is kept when the same words stand around another occurrence.
Overlapping kept windows merge into maximal repeats, and the words they cover
are removed. Windows are judged on the input, so a passage goes everywhere.

All steps are counts and joins by hash: an anchor or a window that very many
documents share costs as much as its occurrences, never pairs of them.

Defined results: null, empty and wordless texts have no words; texts shorter
than a window lose nothing; repeated rows repeat each other's windows, so their
words go (unless shorter than a window); null ids are rows like others.
Hashes are 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

LENGTH = 35
ANCHOR = 8
_POS = np.uint64((1 << 28) - 1)


def anchors(w: C.Words, h: np.ndarray, length: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Window starts, the word index of each window's anchor, and the anchor's hash."""
    at = C.windows(w.first, w.count, length)
    if not len(at):
        return at, at, np.zeros(0, np.uint64)
    many = len(h) - k + 1
    gram = C.roll(h, np.arange(many), k)  # those across two texts lie in no window
    key = (gram & ~_POS) | np.arange(many, dtype=np.uint64)  # equal hashes: the leftmost
    width = length - k + 1
    step, low = 1, key
    while 2 * step <= width:
        low = np.minimum(low[:-step], low[step:]) if len(low) > step else low
        step *= 2
    sel = np.minimum(low[at], low[at + width - step])
    where = (sel & _POS).astype(np.int64)
    return at, where, gram[where]


def seeds(rows: DataFrame, length: int, k: int) -> DataFrame:
    """(doc_id, tk, a, at): hash and word position in the text of the anchors of every row."""

    def make(texts: list[str | None]) -> dict:
        w = C.Words(texts)
        _, where, gram = anchors(w, w.hashes(), length, k)
        where, pick = np.unique(where, return_index=True)
        gram = gram[pick].view(np.int64)
        cut = np.searchsorted(where, w.first)
        return {"a": [gram[cut[i]:cut[i + 1]] for i in range(len(texts))],
                "at": [(where[cut[i]:cut[i + 1]] - w.first[i]).astype(np.int32) for i in range(len(texts))]}

    return C.by_text(rows, "a array<long>, at array<int>", make).drop("text")


def extend(rows: DataFrame, length: int, k: int) -> DataFrame:
    """Columns row, w, s of rows with `at` (repeated anchors): hash and start of the windows around those."""

    def make(cols: dict[str, list]) -> dict:
        w = C.Words(cols["text"])
        h = w.hashes()
        starts, where, _ = anchors(w, h, length, k)
        hot = np.zeros(len(h) + 1, bool)
        for i, at in enumerate(cols["at"]):
            hot[np.asarray(at, np.int64) + w.first[i]] = True
        starts = starts[hot[where]]
        code = C.roll(h, starts, length).view(np.int64)
        cut = np.searchsorted(starts, w.first)
        return {"w": [code[cut[i]:cut[i + 1]] for i in range(len(cut) - 1)],
                "s": [(starts[cut[i]:cut[i + 1]] - w.first[i]).astype(np.int32) for i in range(len(cut) - 1)]}

    return C.by_rows(rows, ["text", "at"], "w array<long>, s array<int>", make, drop=["text", "at"])


def repeated(posts: DataFrame, key: str) -> DataFrame:
    """The rows of `posts` whose key occurs more than once."""
    many = posts.groupBy(key).agg(F.count("*").alias("_n")).where("_n > 1").drop("_n")
    return posts.join(many, key)


def merged(starts: DataFrame, length: int) -> DataFrame:
    """(row, runs): window starts of each row as maximal covered runs [begin, end, begin, end, ...)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for s in b["s"]:
                s = np.unique(np.asarray(s, np.int64))
                cut = np.flatnonzero(np.diff(s) > length)
                begin = s[np.concatenate([[0], cut + 1])]
                end = s[np.concatenate([cut, [len(s) - 1]])] + length
                out.append(np.column_stack([begin, end]).ravel())
            yield pd.DataFrame({"row": b["row"], "runs": out})

    return starts.groupBy("row").agg(F.collect_list("s").alias("s")).mapInPandas(run, "row long, runs array<long>")


def repeats(docs: DataFrame, length: int = LENGTH, k: int = ANCHOR) -> DataFrame:
    """(doc_id, tk, runs): word ranges covered by repeated windows; tk is the hash of the text.

    Documents without any are left out. docs: (doc_id, text).
    """
    C.prepare(docs.sparkSession)
    rows = docs.select("doc_id", F.xxhash64("text").alias("tk"), "text")
    found = C.staged(seeds(rows, length, k).where(F.size("a") > 0).withColumn("row", F.monotonically_increasing_id()), "seeds")
    posts = found.select("row", F.explode(F.arrays_zip("a", "at")).alias("p")).select("row", "p.a", "p.at")
    hot = repeated(posts, "a").groupBy("row").agg(F.collect_list("at").alias("at"))
    name = found.select("row", F.col("doc_id").alias("_d"), F.col("tk").alias("_t"))
    hot = C.staged(hot.join(name, "row"), "repeated-seeds")
    # rows with equal id and text have the same anchors; each meets its own row number of them
    size = hot.agg(F.sum(F.size("at") * 4 + 64)).first()[0] or 0
    side = F.broadcast(hot) if size <= C.BROADCAST_BYTES else hot
    pairs = rows.join(side, F.col("doc_id").eqNullSafe(F.col("_d")) & F.col("tk").eqNullSafe(F.col("_t"))).select("row", "text", "at")
    codes = extend(pairs, length, k).select("row", F.explode(F.arrays_zip("w", "s")).alias("p")).select("row", "p.w", "p.s")
    runs = merged(repeated(codes, "w"), length).join(name, "row")
    return C.staged(runs.select(F.col("_d").alias("doc_id"), F.col("_t").alias("tk"), "runs"), "runs")


def dedup(docs: DataFrame, length: int = LENGTH, k: int = ANCHOR, with_text: bool = False) -> DataFrame:
    """Columns of docs but text, plus n_words, n_removed and kept_sha256; with_text adds the kept text."""
    added = ["n_words", "n_removed", "kept_sha256", "kept"]
    docs = docs.drop(*[c for c in added if c in docs.columns])
    runs = repeats(docs, length, k).dropDuplicates(["doc_id", "tk"]).withColumnsRenamed(
        {"doc_id": "_sd_id", "tk": "_sd_tk", "runs": "_sd_runs"})
    runs = C.staged(runs, "unique-runs")
    size = runs.agg(F.sum(F.size("_sd_runs") * 8 + 64)).first()[0] or 0
    side = F.broadcast(runs) if size <= C.BROADCAST_BYTES else runs
    rows = docs.withColumn("_sd_key", F.xxhash64("text")).join(
        side, F.col("doc_id").eqNullSafe(F.col("_sd_id")) & F.col("_sd_key").eqNullSafe(F.col("_sd_tk")), "left").drop(
        "_sd_id", "_sd_tk", "_sd_key")

    def make(cols: dict[str, list]) -> dict:
        out: dict[str, list] = {k: [] for k in added}
        for text, cover in zip(cols["text"], cols["_sd_runs"], strict=True):
            words = [x for x in (text or "").encode("utf-8", "surrogatepass").split()]  # ASCII white space
            kept = words
            if cover:
                kept, at = [], 0
                for i in range(0, len(cover), 2):
                    kept += words[at:cover[i]]
                    at = cover[i + 1]
                kept += words[at:]
            blob = b" ".join(kept)
            out["n_words"].append(len(words))
            out["n_removed"].append(len(words) - len(kept))
            out["kept_sha256"].append(hashlib.sha256(blob).hexdigest())
            out["kept"].append(blob.decode("utf-8", "surrogatepass") if with_text else None)
        return out

    more = ", kept string" if with_text else ""
    return C.by_rows(rows, ["text", "_sd_runs"], "n_words long, n_removed long, kept_sha256 string" + more, make,
                     drop=["text", "_sd_runs"])
