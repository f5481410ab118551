"""Language-model scores against plain dictionaries."""

import math
import re
import zlib
from collections import Counter

import numpy as np

from quire.llm import lm


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + [None]


def brute(rows, words, grams, order=3, discount=lm.DISCOUNT):
    """{row number: (held_out, n_tokens, n_known, N, base, score)} by recursive backoff over dictionaries."""
    out_of = [d is not None and zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in rows]
    train = [tokens(t) for (_, t), held in zip(rows, out_of) if not held]
    one = Counter(x for t in train for x in t)
    total, distinct = sum(one.values()), len(one)
    floor = max(2, total / words)
    kept = [{(x,): c for x, c in one.items() if c >= floor}]
    for n in range(2, order + 1):
        seen = Counter(tuple(t[i:i + n]) for t in train for i in range(len(t) - n + 1)
                       if tuple(t[i:i + n - 1]) in kept[-1] and (t[i + n - 1],) in kept[0])
        kept.append({g: c for g, c in seen.items() if c >= max(2, total / grams)})
    used = [Counter() for _ in kept]
    for n in range(1, order):
        for g, c in kept[n].items():
            used[n - 1][g[:-1]] += c - discount
    root = lambda x: (one.get(x, 0) + 0.1) / (total + 0.1 * (distinct + 1))

    def p(context, x):
        if not context:
            return root(x)
        state = kept[len(context) - 1].get(context)
        if state is None:
            return p(context[1:], x)
        left = (state - used[len(context) - 1][context]) / state
        arc = kept[len(context)].get((*context, x))
        return left * p(context[1:], x) + ((arc - discount) / state if arc else 0)

    out = {}
    for i, (_, t) in enumerate(rows):
        t = tokens(t)
        out[i] = (out_of[i], len(t), sum(x in one for x in t), total, sum(math.log10(root(x)) for x in t),
                  sum(math.log10(p(tuple(t[max(0, k - order + 1):k]), x)) for k, x in enumerate(t)))
    return out


def check(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    key = lambda r: str([r[0], *[round(x, 4) if isinstance(x, float) else x for x in r[1:]]])
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score)
                  for r in lm.scores(df, **options).collect()), key=key)
    want = sorted(((rows[i][0], *v) for i, v in brute(rows, options.get("words", lm.WORDS), options.get("grams", lm.GRAMS), options.get("order", 3)).items()), key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert abs(g[5] - w[5]) < 1e-4 and abs(g[6] - w[6]) < 1e-4


def test_documents(spark, small):
    check(spark, [(r.doc_id, r.text) for r in small.where("doc_id < 60").collect()])


def test_rare_words_are_joined(spark, small):
    """With a small head table most words get their counts by the join; the figures stay."""
    rows = [(r.doc_id, r.text) for r in small.where("doc_id < 30").collect()]
    check(spark, rows, head=200, words=100, grams=200)


def test_edges(spark, edges, nothing):
    check(spark, [(r.doc_id, r.text) for r in edges.where("doc_id IS NULL OR doc_id < 9").collect()])
    assert lm.scores(nothing).count() == 0


def test_no_training_rows(spark):
    held = next(i for i in range(1000) if zlib.crc32(str(i).encode()) % 10 == 0)
    check(spark, [(held, "a b c")])


def test_floor_does_not_grow(spark):
    """N-grams seen twice are arcs however large the rest is, also where each one is joined."""
    pairs = [(2, "alpha beta gamma"), (4, "alpha beta delta"), (7, "one alpha beta gamma")]
    rows = pairs + [(11 + 10 * i, "filler " * 5000) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows, math.inf, math.inf)
    for options in ({}, {"head": 3, "head_grams": 3}):
        got = {r.doc_id: r for r in lm.scores(df, **options).collect()}
        for i, (doc, _) in enumerate(pairs):
            assert abs(got[doc].score - want[i][5]) < 1e-4 and got[doc].score > got[doc].base_score + 1


def test_spread_states_and_many_parts(spark, small, monkeypatch):
    """States whose arcs lie in all parts, small parts and flushes: the same figures."""
    monkeypatch.setattr(lm, "HEAD", 1000)
    monkeypatch.setattr(lm, "PART", 50)
    monkeypatch.setattr(lm, "LOOK", 40)
    monkeypatch.setattr(lm, "FLUSH", 300)
    rows = [(r.doc_id, r.text) for r in small.where("doc_id < 25").collect()]
    check(spark, rows, hot=3)
    check(spark, rows, hot=3, head=1, head_grams=1)
    check(spark, rows, order=1, head=1)


def test_equal_rows_share_their_sums(spark):
    """Repeated rows, repeated ids with other texts and null ids, with every key looked up."""
    rows = [(1, "a b c d a b c"), (1, "a b c d a b c"), (1, "a b c"), (None, "x y z x y"), (None, "x y z x y"), (0, "x y z x y"), (3, None)]
    check(spark, rows, head=1, head_grams=1)


def test_order_and_lookup_are_those_of_numpy():
    rng = np.random.default_rng(3)
    own, where = rng.integers(0, 50, 5000), rng.integers(0, 7, 5000)
    assert (lm._order(own, where) == np.lexsort((own, where))).all() and len(lm._order(own[:0], where[:0])) == 0
    assert (lm._order(own << 40, where << 30) == np.lexsort((own, where))).all()  # too wide to be packed
    keys = rng.integers(0, 1 << 62, 300).astype(np.uint64)
    have = np.sort(keys[:100])
    assert (lm._found_at(have, keys) == np.searchsorted(have, keys)).all()
