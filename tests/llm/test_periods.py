"""Periodic runs against a search over all stretches."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from quire.llm import periods


def brute_runs(w):
    """(start, end, period) of every run, from the definition."""
    n, out = len(w), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            s, e = i, j + q
            if e - s >= max(6, 4 * q) and not any(all(w[k] == w[k + p] for k in range(s, e - p)) for p in range(1, q)):
                out.append((s, e, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text, plant=True):
    words = [w for w in (text or "").encode("utf-8").translate(bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")).split(b" ") if w]
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if plant and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    gone = {i for s, e, q in runs for i in range(s + q, e)}
    best = max(runs, key=lambda r: (Fraction(r[1] - r[0], r[2]), -r[0], -r[2]), default=None)
    top = (None,) * 4 if best is None else (best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2])
    said = "".join(f"{s},{e - s},{q}\n" for s, e, q in runs)
    kept = b" ".join(x for i, x in enumerate(words) if i not in gone)
    return (doc_id, len(runs), *top, hashlib.sha256(said.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def result(df):
    return sorted((tuple(r[c] for c in ("doc_id", *periods.NAMES)) for r in df.collect()), key=str)


def periodic(rng, letters, n):
    """A string with runs of runs: powers of powers, broken now and then."""
    w = []
    while len(w) < n:
        unit = [rng.choice(letters) for _ in range(rng.randint(1, 5))]
        if rng.random() < 0.4:
            unit = unit * rng.randint(2, 5) + [rng.choice(letters)]
        w += unit * rng.randint(1, 9)
        w = w[: rng.randint(0, 3) and len(w)] or w
    return w[:n]


@pytest.mark.parametrize("seed", range(30))
def test_extensions(seed):
    """Grammar answers equal letter by letter comparison, both ways."""
    rng = random.Random(seed)
    w = [-1, *periodic(rng, range(rng.choice([1, 2, 3, 8])), rng.randint(1, 150)), -2]
    g = periods.Grammar(np.array(w))
    pairs = [(i, j) for i in range(len(w)) for j in range(len(w)) if i < j]
    i, j = (np.array(x) for x in zip(*pairs))

    def ahead(a, b):
        k = 0
        while b + k < len(w) and w[a + k] == w[b + k]:
            k += 1
        return k

    def behind(a, b):
        k = 0
        while a - k >= 0 and w[a - k] == w[b - k]:
            k += 1
        return k

    assert g.lce(i, j).tolist() == [ahead(*p) for p in pairs]
    assert g.lce(i, j, back=True).tolist() == [behind(*p) for p in pairs]


@pytest.mark.parametrize("seed", range(40))
def test_runs(seed):
    rng = random.Random(seed)
    texts = [periodic(rng, "ab" if rng.random() < 0.5 else "abcdefgh", rng.randint(0, 120)) for _ in range(8)]
    texts += [[], ["x"], ["x"] * 5, ["x"] * 6, ["a", "b"] * 4, ["a", "b"] * 4 + ["a"]]
    got = periods.word_runs(texts)
    assert [list(map(tuple, g.tolist())) for g in got] == [brute_runs(t) for t in texts]


def test_fibonacci_and_powers():
    a, b = ["a"], ["a", "b"]
    while len(b) < 400:
        a, b = b, b + a
    nested = ((["a"] * 7 + ["b"]) * 6 + ["c"]) * 5
    for w in (b, nested, nested + nested[:40]):
        assert list(map(tuple, periods.word_runs([w])[0].tolist())) == brute_runs(w)


def test_pieces_of_the_grid(monkeypatch):
    rng = random.Random(5)
    texts = [periodic(rng, "abc", 200) for _ in range(5)]
    want = [r.tolist() for r in periods.word_runs(texts)]
    monkeypatch.setattr(periods, "QUESTIONS", 7)
    assert [r.tolist() for r in periods.word_runs(texts)] == want


def test_documents(spark, small):
    docs = small.where("length(text) < 6000")
    assert result(periods.periodic_runs(docs, plant=True)) == sorted((brute_row(r.doc_id, r.text) for r in docs.collect()), key=str)


def test_edges(spark, edges, nothing):
    docs = edges.where("doc_id IS NULL OR doc_id < 9")
    for plant in (True, False):
        want = sorted((brute_row(r.doc_id, r.text, plant) for r in docs.collect()), key=str)
        assert result(periods.periodic_runs(docs, plant)) == want
    row = periods.periodic_runs(edges.where("doc_id = 9"), False).first()
    assert (row.n_runs, row.start, row.length, row.period, row.exponent_milli) == (1, 0, 20000, 5, 4000000)
    assert periods.periodic_runs(nothing).count() == 0


def test_clashing_columns(spark, edges):
    """Extra columns pass through; those named like a result are replaced."""
    docs = edges.selectExpr("doc_id", "text", "n AS period", "n AS words", "n AS q")
    got = periods.periodic_runs(docs, True)
    assert set(got.columns) == {"doc_id", "words", "q", *periods.NAMES}
    assert {r.words for r in got.collect()} == {5}
    assert result(got) == result(periods.periodic_runs(edges, True))


def test_long_text():
    """A text of 400,000 words with a long period and one of a single word, in bounded pieces."""
    rng = random.Random(1)
    unit = [rng.randrange(1000) for _ in range(50_000)]
    got = periods.word_runs([unit * 5, [7] * 150_000])
    assert [r.tolist() for r in got] == [[[0, 250_000, 50_000]], [[0, 150_000, 1]]]
