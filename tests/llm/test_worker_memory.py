"""What a Python worker holds at once, whatever its batches."""

import tracemalloc

import pytest

from quire.llm import common as C
from quire.llm import jaccard, quality


@pytest.mark.parametrize("make", [jaccard.shingle_sets, quality.text_stats])
def test_runs_of_texts_need_little_memory(make):
    texts = [" ".join(f"w{(i * 7919 + j * j) % 5003}" for j in range(400)) for i in range(1200)]
    assert sum(map(len, texts)) > 2 << 20
    make(texts[:10])  # tables that stay
    tracemalloc.start()
    try:
        for s in C.text_slices(texts):
            make(texts[s])
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 12 << 20


def test_rows_come_out_whole_whatever_the_run(spark):
    rows = [(i, None if i % 7 == 0 else "é word " * (i * 300), i) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n long").repartition(2)
    out = C.by_text(df, "size long", lambda texts: {"size": [len(t or "") for t in texts]})
    assert sorted((r.doc_id, r.size, r.n) for r in out.collect()) == [(i, len(t or ""), n) for i, t, n in rows]
