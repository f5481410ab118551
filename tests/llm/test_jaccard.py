"""N-gram Jaccard join against all pairs."""

import os
import random
import re

from quire.llm import common, jaccard
from quire.llm.components import components
from quire.session import checkpoint_dir


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def brute(rows):
    """(doc_id, n, component) of every row, by union of all linked pairs."""
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            same = len(sets[i] & sets[j])
            if sets[i] and 100 * same >= 75 * len(sets[i] | sets[j]):
                up[find(i)] = find(j)
    ids = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            ids[find(i)] = min(d, ids.get(find(i), d))
    return sorted(((d, len(sets[i]), ids.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)), key=str)


def made(seed=5, n=120):
    """Chains of near copies with a few words changed, so that pairs lie on both sides of the similarity."""
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefgh") + rng.choice("xyz") + rng.choice("01234")
    rows = []
    while len(rows) < n:
        text = [word() for _ in range(rng.choice([3, 5, 6, 20, 60, 120]))]
        for _ in range(rng.choice([1, 2, 6, 12])):
            rows.append((len(rows), " ".join(text)))
            for _ in range(rng.randint(0, 3)):
                text[rng.randrange(len(text))] = word()
            if rng.random() < 0.3:
                text = text[:-2] or text
    rng.shuffle(rows)
    return rows


def result(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


def test_made_chains(spark):
    rows = made()
    assert result(jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def test_exact_border(spark):
    """Pairs with 70 to 80 of 100 shingles in common, each pair with its own words."""
    rows = []
    for k in range(70, 81):
        long = [f"w{k}x{i}" for i in range(104)]
        rows += [(2 * k, " ".join(long)), (2 * k + 1, " ".join(long[: k + 4]))]
    got = result(jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got == brute(rows)
    linked = {d // 2 for d, _, c in got if c != d}
    assert linked == set(range(75, 81))


def test_edges(edges):
    docs = edges.selectExpr("doc_id", "text", "n", "'s' AS s1", "7 AS component_id", "0 AS cid", "1 AS root")
    got = jaccard.jaccard_components(docs)
    rows = [(r.doc_id, r.text) for r in edges.collect()]
    assert result(got) == brute(rows)
    assert {r.s1 for r in got.collect()} == {"s"} and {r.n for r in got.collect()} == {5}


def test_empty(nothing):
    assert jaccard.jaccard_components(nothing).count() == 0 and jaccard.representatives(nothing).count() == 0


def test_representatives(spark, edges):
    rows = made(seed=8, n=80) + [(3, "a b c d e f g"), (3, "a b c d e f g"), (500, "A b c d e f g"), (501, None), (501, ""), (None, "q r s t u v")]
    docs = spark.createDataFrame([(d, t, i) for i, (d, t) in enumerate(rows)], "doc_id long, text string, s1 int")
    got = jaccard.representatives(docs)
    assert got.columns == docs.columns
    kept = got.collect()
    comp = {}
    for d, n, c in brute(rows):
        if n:
            comp.setdefault(c, set()).add(d)
    assert sorted(r.doc_id for r in kept if shingles(r.text) and r.doc_id is not None) == sorted(c for c in comp if c is not None)
    assert sum(not shingles(r.text) for r in kept) == 2 and sum(r.doc_id is None for r in kept) == 1
    assert jaccard.representatives(edges).count() == 10  # of the three equal texts one stays; no words: all stay


def test_shuffled_sides_and_hot_grams(spark, monkeypatch):
    """The plans that a large input takes: no broadcast of wanted ids, frequent n-grams row by row."""
    monkeypatch.setattr(common, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(common.checked_broadcast, "__defaults__", (0,))
    rows = made(seed=11, n=60)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(jaccard.jaccard_components(df, hot=2)) == brute(rows)
    kept = jaccard.representatives(df, hot=2)
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, _, c in brute(rows)})


def test_tables_of_rounds_go(spark):
    """Only what the result is read from stays on disk: it was every table of every round."""
    top = os.path.join(checkpoint_dir(spark).removeprefix("file:"), "quire-llm")
    before = set(os.listdir(top)) if os.path.isdir(top) else set()
    rows = made(seed=9, n=60)
    assert result(jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)
    left = sorted(x.split("-", 1)[1] for x in set(os.listdir(top)) - before)
    assert left == ["classes", "components", "signatures"]


def test_components_of_stars_and_chains(spark):
    links = [(9, 1), (9, 2), (9, 3), (4, 5), (5, 6), (6, 7), (7, 8), (8, 8), (5, 4)]
    found = components(spark.createDataFrame(links, "a long, b long"))
    assert sorted(map(tuple, found.collect())) == [(1, 1), (2, 1), (3, 1), (4, 4), (5, 4), (6, 4), (7, 4), (8, 4), (9, 1)]
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_roots(spark):
    found = jaccard._near_roots(spark.createDataFrame([(5, 1), (5, 2), (5, 9)], "a long, b long"))
    assert sorted(map(tuple, found.collect())) == [(1, 1), (2, 1), (5, 1), (9, 1)]
