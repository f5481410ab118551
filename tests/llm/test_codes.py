"""Vector codes against plain integer k-means, and the bounds against exact distances."""

import hashlib
import math
import random

import numpy as np
import pytest

from quire.llm import codes as K
from quire.llm.queries import op13_vector_codes


def brute(rows, parts=16, entries=64, rounds=2):
    """rows: (vec_id, vector, label), no null id, one length."""
    rows = [(i, [math.floor(256 * x) for x in v], lab) for i, v, lab in rows
            if v and all(x is not None and math.isfinite(x) for x in v)]
    if not rows:
        return []
    d = len(rows[0][1]) // parts
    cut = lambda v: [v[p * d:(p + 1) * d] for p in range(parts)]
    first = {}
    for i, v, _ in sorted(rows, key=lambda r: (r[0], r[1])):
        first.setdefault(i, v)
    books = [[cut(v)[p] for _, v in sorted(first.items())[:entries]] for p in range(parts)]
    square = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))

    def code(v):
        return [min(range(len(books[p])), key=lambda j: (square(c, books[p][j]), j)) for p, c in enumerate(cut(v))]

    for _ in range(rounds):
        all_ = [code(v) for _, v, _ in rows]
        new = [list(b) for b in books]
        for p in range(parts):
            for j in range(len(books[p])):
                mine = [cut(v)[p] for (_, v, _), c in zip(rows, all_) if c[p] == j]
                if mine:
                    new[p][j] = [sum(x) // len(mine) for x in zip(*mine)]
        books = new
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out = []
    for i, v, lab in rows:
        c = code(v)
        out.append((i, "".join(f"{j:02x}" for j in c), sum(square(x, books[p][c[p]]) for p, x in enumerate(cut(v))), lab, sha))
    total = {}
    for _, _, e, lab, _ in out:
        total[lab] = total.get(lab, 0) + e
    return sorted((i, c, e, total[lab], s) for i, c, e, lab, s in out)


def result(df):
    return sorted((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in df.collect())


def frame(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int")


def coded(df):
    return K.with_label_error(K.compress(df)[0])


@pytest.mark.parametrize("seed", range(6))
def test_bounds_hold(seed):
    """Lists and bounds over moving entries: the first is the nearest, no bound above its distance, any list length."""
    rng = np.random.default_rng(seed)
    k, b, wide = int(rng.choice([2, 5, 64])), int(rng.choice([1, 4, 8])), int(rng.choice([3, 300, 1 << 20]))
    x, entries = rng.integers(-wide, wide, (300, 4)), rng.integers(-wide, wide, (k, 4))
    lists, best = K.closest(x, entries, b)
    spread = []
    for step in (wide // 2, wide // 20, wide // 100, 0, 0):
        d = K.distances(x, entries)
        assert (lists.ids[:, 0] == np.argmin(d, axis=1)).all() and (best == d.min(axis=1)).all()
        n, have = lists.ids.shape
        low = lists.low.astype(float)
        assert (low[:, :-1] <= np.sqrt(np.take_along_axis(d, lists.ids.astype(int), 1)[:, 1:])).all()
        off = np.ones((n, k), bool)
        np.put_along_axis(off, lists.ids.astype(int), False, axis=1)
        assert (low[:, -1] <= np.where(off, np.sqrt(d), np.inf).min(axis=1)).all()
        new = entries + rng.integers(-step, step + 1, entries.shape)
        move = K.Codebooks(new[None], entries[None]).move[0]
        entries = new
        lists, best, needed = K.moved(x, lists, entries, move)
        lists = K.shorter(lists, max(1, have - 1))
        spread.append((needed == 1).mean())
    assert spread[-1] >= spread[0]


def test_adapted():
    assert K.adapted(np.array([1] * 95 + [9] * 5), 8) == K.LEAST_LIST
    assert K.adapted(np.array([6] * 100), 8) == 6
    assert K.adapted(np.array([9] * 100), 8) == 16


@pytest.mark.parametrize("start", [1, 4, 16])
def test_list_length_changes_nothing(spark, start):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    want = sorted((r.vec_id, r.code, r.error) for r in K.compress(df)[0].collect())
    assert sorted((r.vec_id, r.code, r.error) for r in K.compress(df, start=start)[0].collect()) == want


def test_embeddings(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    assert result(op13_vector_codes(spark, "/root/testdata/sf0.001")) == brute(rows)


def test_ties_repeats_nulls(spark):
    """Few distinct values (ties everywhere), repeated rows, unusable vectors, a null label, few ids."""
    rng = random.Random(4)
    rows = [(rng.randrange(100), [rng.choice([0.0, 0.004, -0.004, 1.0]) for _ in range(16)], rng.choice([1, 2, None])) for _ in range(200)]
    rows += rows[:20]
    rows += [(1, None, 1), (2, [None] * 16, 1), (3, [math.nan] * 16, 2), (4, [math.inf] + [0.0] * 15, 2), (5, [], None)]
    assert result(coded(frame(spark, rows))) == brute(rows)
    few = [(i, [float(i % 3), -float(i)] * 16, None) for i in range(7)]
    assert result(coded(frame(spark, few))) == brute(few)


def test_large_components(spark):
    """Products beyond 64 bits inside the distances."""
    rng = random.Random(7)
    rows = [(i, [rng.uniform(-1, 1) * 10.0 ** rng.randint(0, 6) for _ in range(32)], 0) for i in range(90)]
    assert result(coded(frame(spark, rows, "double"))) == brute(rows)


def test_other_edges(spark):
    assert coded(frame(spark, [])).count() == 0
    assert coded(frame(spark, [(1, None, 1)])).columns == ["vec_id", "code", "error", "codebooks_sha256", "label_error"]
    rows = [(1, [0.5] * 16, 1), (2, [0.25] * 16, 1), (3, [0.5] * 32, 1), (None, [0.5] * 16, 2)]
    got = {r.vec_id: r for r in coded(frame(spark, rows)).collect()}
    assert set(got) == {1, 2, None} and got[None].code == got[1].code == "00" * 16
    assert coded(frame(spark, [(None, [0.5] * 16, 2)])).first().error == 0
    with pytest.raises(ValueError):
        coded(frame(spark, [(1, [0.5] * 17, 1)]))


def test_clashing_columns(spark):
    rng = random.Random(9)
    rows = [(i, [rng.random() for _ in range(16)], i % 2) for i in range(80)]
    df = frame(spark, rows).selectExpr("*", "vec_id AS x", "label AS code", "7 AS n", "8 AS ids", "9 AS v", "1 AS p")
    got = coded(df)
    assert set(got.columns) == {"vec_id", "x", "n", "ids", "v", "p", "code", "error", "label_error", "codebooks_sha256"}
    assert result(got) == brute(rows) and {(r.n, r.ids, r.v, r.p) for r in got.collect()} == {(7, 8, 9, 1)}
