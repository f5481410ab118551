"""Substring dedup against a table of all windows."""

import hashlib
import random
import re
from collections import Counter

from quire.llm import substrings


def brute(rows, length):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    seen = Counter(tuple(w[i:i + length]) for w in words for i in range(len(w) - length + 1))
    out = []
    for (d, _), w in zip(rows, words):
        gone = {j for i in range(len(w) - length + 1) if seen[tuple(w[i:i + length])] > 1 for j in range(i, i + length)}
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def result(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in df.collect()), key=str)


def made(seed, n, length):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghijklmnop") + rng.choice("ABCDEF\U0001f600é")
    shared = [[word() for _ in range(rng.choice([length - 1, length, length + 1, 3 * length]))] for _ in range(5)]
    rows = []
    for i in range(n):
        w = []
        for _ in range(rng.randint(0, 4)):
            w += [word() for _ in range(rng.randint(0, 40))]
            w += rng.choice(shared) if rng.random() < 0.6 else []
        rows.append((i, rng.choice([" ", "\n", "\t  "]).join(w)))
    rows.append((n, " ".join(["same"] * 200)))
    rows.append((n + 1, " ".join(["x", "y"] * 80)))
    return rows


def test_made(spark):
    for seed, length, k in ((1, 35, 8), (2, 6, 3), (3, 12, 8)):
        rows = made(seed, 60, length)
        got = substrings.dedup(spark.createDataFrame(rows, "doc_id long, text string"), length, k)
        assert result(got) == brute(rows, length)


def test_edges(edges):
    rows = [(r.doc_id, r.text) for r in edges.collect()]
    for length in (2, 35):
        got = substrings.dedup(edges.selectExpr("*", "1 AS row", "'t' AS tk", "2 AS n_words", "3 AS runs"), length, 2)
        assert result(got) == brute(rows, length)
        assert {(r.n, r.row, r.tk) for r in got.collect()} == {(5, 1, "t")}


def test_repeated_rows_with_one_id(spark):
    long = " ".join(f"w{i}" for i in range(50))
    rows = [(1, long), (1, long), (2, "other " * 3), (None, long), (3, long + " tail"), (3, "head " + long)]
    assert result(substrings.dedup(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows, 35)


def test_documents(small):
    rows = [(r.doc_id, r.text) for r in small.collect()]
    assert result(substrings.dedup(small)) == brute(rows, 35)


def test_empty(nothing):
    assert substrings.dedup(nothing).count() == 0
