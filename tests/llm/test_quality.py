"""Quality rules against plain Python, over hashed n-grams counted one by one."""

import math
import re
from collections import Counter

import numpy as np

from quire.llm import common as C
from quire.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    cover = set()
    for i in range(len(words) - 2):
        if grams[tuple(words[i:i + 3])] > 1:
            cover |= {i, i + 1, i + 2}
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(cover))


def ngrams(text):
    """Bucket of every 1- and 2-gram, each hashed on its own."""
    words = WORD.findall(text or "")
    out = []
    for n in (1, 2):
        for i in range(len(words) - n + 1):
            w = C.Words([" ".join(words[i:i + n])])
            h = w.hashes()
            out.append(int((h[0] if n == 1 else w.ngrams(h, 2)[0][0]) >> np.uint64(64 - quality.BITS)))
    return out


def check(docs, trusted_ids, spark):
    trusted = spark.createDataFrame([(i,) for i in trusted_ids], "doc_id long")
    got = quality.quality_rules(docs, trusted).collect()
    raw, target = Counter(), Counter()
    seen = {}
    for r in got:
        seen[r.text] = seen.get(r.text) or ngrams(r.text)
        raw.update(seen[r.text])
        if r.doc_id in set(trusted_ids) - {None}:
            target.update(seen[r.text])
    size = 1 << quality.BITS
    for r in got:
        b = base(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == b
        failed = b[0] < 50 or 100 * b[4] > 50 * b[0]
        g = seen[r.text]
        llr = sum(math.log((target[x] + 1) / (sum(target.values()) + size)) - math.log((raw[x] + 1) / (sum(raw.values()) + size))
                  for x in g) / max(len(g), 1) if target else 0.0
        assert abs(r.llr - llr) < 1e-8
        assert (r.base_failed, r.kept) == (failed, not failed and r.llr >= quality.THRESHOLD)
    return got


def test_edges(spark, edges):
    got = check(edges.where("doc_id IS NULL OR doc_id <> 9"), [4, 7, 7, 99, None], spark)
    assert all(r.n == 5 for r in got)
    check(edges.where("doc_id < 8"), [], spark)


def test_small(spark, small):
    check(small.where("doc_id < 40"), list(range(0, 30, 2)), spark)


def test_empty(spark, nothing):
    assert quality.quality_rules(nothing, nothing.select("doc_id")).count() == 0


def test_clashing_columns(spark, small):
    docs = small.limit(5).selectExpr("doc_id", "text", "1 AS kept", "'x' AS llr", "2 AS trusted", "3 AS bucket", "4 AS _trusted_id")
    got = quality.quality_rules(docs, small.select("doc_id"))
    assert got.columns.count("kept") == 1 and dict(got.dtypes)["kept"] == "boolean" and got.count() == 5


def test_marked_documents(spark):
    """On the labelled rows: most good documents stay, most bad ones go."""
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    got = quality.quality_rules(docs, labels.where("quality = 1")).join(labels, "doc_id").where("NOT base_failed")
    good, bad = got.where("quality = 1"), got.where("quality = 0")
    assert good.where("kept").count() >= 0.99 * good.count()
    assert bad.where("kept").count() <= 0.1 * bad.count()
