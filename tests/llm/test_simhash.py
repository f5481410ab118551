"""SimHash groups against bit counting over all pairs."""

import random
import re

import numpy as np
import pytest
import xxhash

from quire.llm import simhash as S


def brute_print(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64(g.encode("utf-8", "surrogatepass"), 42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_links(prints):
    p = sorted(set(prints))
    return {(a, b) for i, a in enumerate(p) for b in p[i + 1:] if (a ^ b).bit_count() <= 2}


def brute(rows):
    prints = [brute_print(t) for _, t in rows]
    root = {p: p for p in prints}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in brute_links(prints):
        root[max(top(a), top(b))] = min(top(a), top(b))
    least = {}
    for (d, _), p in zip(rows, prints):
        if d is not None:
            least[top(p)] = min(d, least.get(top(p), d))
    return sorted(((d, f"{p:016x}", least.get(top(p))) for (d, _), p in zip(rows, prints)), key=str)


def result(df):
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in df.collect()), key=str)


def signed(p):
    return p - (1 << 64) if p >> 63 else p


def clouds(seed, n):
    """Fingerprints close to a few centres, some only in a byte or two, with the highest bit on and off."""
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(5)] + [0, (1 << 64) - 1]
    out = set(centres)
    while len(out) < n:
        p = rng.choice(sorted(out) if rng.random() < 0.3 else centres)
        for _ in range(rng.randint(1, 4)):
            p ^= 1 << rng.choice([rng.randrange(64), rng.randrange(12), 60 + rng.randrange(4)])
        out.add(p)
    return sorted(out)


@pytest.mark.parametrize("near,part", [(S.NEAR, S.PART), (2, 500)])
def test_links(spark, monkeypatch, near, part):
    """All pairs, also where lists are long and looked up, and the bytes they share."""
    monkeypatch.setattr(S, "NEAR", near)
    prints = clouds(3, 600)
    df = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
    got = {(*sorted((r.a % (1 << 64), r.b % (1 << 64))), r.shared) for r in S.links(df, part).collect()}
    same = lambda a, b: sum((a >> 8 * i & 255) == (b >> 8 * i & 255) for i in range(8))
    assert got == {(a, b, same(a, b)) for a, b in brute_links(prints)}
    assert S.stars(df, part).count() < 28 * len(prints)


def test_list_pairs_long_list():
    """A full list: 2,000 fingerprints that differ in two bytes only, lookup against all pairs."""
    rng = np.random.default_rng(1)
    low = np.sort(rng.choice(1 << 16, 2000, replace=False)).astype(np.uint64)
    fp = (np.uint64(0xABCDEF0123450000) | low)
    kind = np.full(len(fp), [i for i, m in enumerate(S._masks()) if m[0] == 0xFFFF][0])
    x, y = S._list_pairs(fp, kind)
    want = np.triu(np.bitwise_count(low[:, None] ^ low[None, :]) <= 2, 1)
    assert set(zip(x.tolist(), y.tolist())) == set(zip(*(i.tolist() for i in np.nonzero(want))))


def test_documents(spark, small):
    rows = [(r.doc_id, r.text) for r in small.collect()]
    assert result(S.near_duplicates(small)) == brute(rows)


def test_fingerprint_in_pieces(monkeypatch):
    h = np.random.default_rng(2).integers(0, 1 << 63, 1001, dtype=np.uint64)
    want = sum(1 << b for b in range(64) if 2 * int((h >> np.uint64(b) & np.uint64(1)).sum()) > 1001)
    assert S.fingerprint(h) == want
    monkeypatch.setattr(S, "PIECE", 10)
    assert S.fingerprint(h) == want and S.fingerprint(h[:0]) == 0


def test_edges(spark, edges, nothing):
    rows = [(r.doc_id, r.text) for r in edges.collect()]
    assert result(S.near_duplicates(edges)) == brute(rows)
    only_null = spark.createDataFrame([(None, "a b c d"), (None, "a b c d")], "doc_id long, text string")
    assert result(S.near_duplicates(only_null)) == brute([(None, "a b c d")] * 2)
    assert S.near_duplicates(nothing).count() == 0


def test_clashing_columns(spark, edges):
    docs = edges.selectExpr("doc_id", "text", "n AS fp", "n AS fingerprint", "n AS root", "n AS part", "n AS first_id")
    got = S.near_duplicates(docs)
    assert got.columns == ["doc_id", "fp", "root", "part", "first_id", "fingerprint", "component_id"]
    assert result(got) == result(S.near_duplicates(edges))


def test_hot_fingerprints(spark):
    """A third of all rows in one group: joined apart from the rest, same rows."""
    rows = [(i, "hot text of many rows") for i in range(1000, 2000)] + [(i, f"cold text number {i} of one row") for i in range(1000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(S.near_duplicates(df)) == brute(rows)
