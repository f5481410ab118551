"""Decontamination against a search of all alignments."""

import random
import re

from quire.llm import decontam as D


def words(text):
    return [w for w in re.split(r"[^\w]|_", (text or "").lower()) if w]


def best(equal):
    """Best run of +1 / -MISMATCH as (score, equal, start, stop), first of the best."""
    top, score, same, start = (0, 0, 0, 0), 0, 0, 0
    for i, e in enumerate(equal):
        if score <= 0:
            score, same, start = 0, 0, i
        score += 1 if e else -D.MISMATCH
        same += e
        if score > top[0]:
            top = (score, same, start, i + 1)
    return top


def brute(docs, items, min_equal=D.MIN_EQUAL):
    """(doc, item) -> best (equal, overlap) over the alignments that some mask hits."""
    out = {}
    for d, t in docs:
        dw = words(t)
        for i, s in items:
            iw = words(s)
            for shift in range(-len(iw) + 1, len(dw)):
                lo = max(0, -shift)
                eq = [iw[k] == dw[k + shift] for k in range(lo, min(len(iw), len(dw) - shift))]
                hit = any(all(eq[a + k] for k, bit in enumerate(m) if bit == "1") for m in D.MASKS for a in range(len(eq) - len(m) + 1))
                if not hit:
                    continue
                _, same, a, b = best(eq)
                if same >= min(min_equal, len(iw)):
                    out[d, i] = max(out.get((d, i), (0, 0)), (same, b - a))
    return out


def made():
    rng = random.Random(4)
    word = lambda: rng.choice("abcdefghij") + rng.choice("klmnop")
    items = [(i, " ".join(word() for _ in range(rng.choice([8, 12, 25, 40])))) for i in range(8)]
    docs = []
    for d in range(60):
        w = [word() for _ in range(rng.randint(0, 60))]
        if d % 2:
            p = rng.choice(items)[1].split()
            for _ in range(d % 7):
                p[rng.randrange(len(p))] = word()
            at = rng.randint(0, len(w))
            w[at:at] = p[rng.randint(0, 4):]
        docs.append((d, (", " if d % 3 else "\n").join(w).upper() if d % 5 == 0 else " ".join(w)))
    return docs, items


def frames(spark, docs, items):
    return (spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))


def test_all_alignments(spark):
    docs, items = made()
    got = {(r.doc_id, r.item_id): (r.equal_words, r.overlap_words) for r in D.contamination(*frames(spark, docs, items)).collect()}
    assert got == brute(docs, items)
    assert len(got) >= 10


def test_substitutions(spark):
    """A passage with every eighth word replaced is found; a clean text is not."""
    p = [f"item{i}" for i in range(40)]
    sub = [x if i % 8 else "other" for i, x in enumerate(p)]
    docs, items = frames(spark, [(1, "before " + " ".join(sub) + " after"), (2, "a clean text " * 30)], [(9, " ".join(p))])
    assert [(r.doc_id, r.item_id, r.equal_words, r.doc_start, r.item_start) for r in D.contamination(docs, items).collect()] == [(1, 9, 35, 2, 1)]
    assert [r.doc_id for r in D.drop_contaminated(docs, items).collect()] == [2]


def test_edges(spark, edges, nothing):
    items = spark.createDataFrame([(1, None), (2, ""), (3, "one two"), (None, "same text here again and so on now"), (4, "a b c d e a b c d e a b"),
                                   (4, "a b c d e a b c d e a b")], "item_id long, text string")
    docs = edges.selectExpr("*", "1 AS item_id", "2 AS at", "3 AS shift", "4 AS _doc", "5 AS h")
    got = D.contamination(docs, items).collect()
    assert [(r.doc_id, r.item_id) for r in got] == [(9, 4)]
    left = D.drop_contaminated(docs, items)
    assert left.columns == docs.columns and left.count() == docs.count() - 1
    none = items.limit(0)
    assert D.contamination(docs, none).count() == 0 and D.drop_contaminated(docs, none).count() == docs.count()
    assert D.contamination(nothing, items).count() == 0 and D.drop_contaminated(nothing, items).count() == 0


def test_planted(spark):
    """Every document of the table that holds 13 benchmark words in a row is found."""
    d = "/root/testdata/sf0.01"
    docs, items = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/benchmark.parquet")
    grams = {tuple(w[i:i + 13]): r.item_id for r in items.collect() for w in [words(r.text)] for i in range(len(w) - 12)}
    want = {(r.doc_id, grams[g]) for r in docs.collect() for w in [words(r.text)] for i in range(len(w) - 12) if (g := tuple(w[i:i + 13])) in grams}
    got = {(r.doc_id, r.item_id) for r in D.contamination(docs, items).collect()}
    assert want and want <= got


def test_other_rows_of_the_id_stay(spark):
    """Of rows with one id, or without an id, only those with a passage go."""
    passage = " ".join(f"item{i}" for i in range(40))
    docs, items = frames(spark, [(None, "x " + passage), (None, "clean"), (None, None), (1, passage), (1, "clean"), (1, passage), (2, "clean")],
                         [(9, passage)])
    left = sorted(((r.doc_id, r.text) for r in D.drop_contaminated(docs, items).collect()), key=str)
    assert left == sorted([(None, "clean"), (None, None), (1, "clean"), (2, "clean")], key=str)
