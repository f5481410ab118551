"""The pipeline's stages, each on its own input, against brute force."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as P
from quire.llm import common, decontam, pii, quality
from quire.llm.queries import trusted_ids

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    out = [docs]
    for name, stage in P.STAGES:
        out.append(common.staged(stage(spark, out[-1], DIR), name.replace(" ", "-")))
    return out


def test_columns(stages):
    assert [n for n, _ in P.STAGES] == ["quality rules", "n-gram Jaccard join", "benchmark decontamination", "PII", "BPE encoding and decoding"]
    for s in stages[1:-1]:
        assert s.dtypes == stages[0].dtypes
    assert "doc_id" in stages[-1].columns


def test_decisions(spark, stages):
    start, good, single, clean, masked, tokens = stages
    verdict = {r.doc_id: r.kept for r in quality.quality_rules(start, trusted_ids(spark, DIR)).collect()}
    assert sorted(r.doc_id for r in good.collect()) == sorted(d for d, k in verdict.items() if k)
    from test_jaccard import brute
    comp = brute([(r.doc_id, r.text) for r in good.collect()])
    assert sorted(r.doc_id for r in single.collect()) == sorted({c for _, n, c in comp if n} | {d for d, n, _ in comp if not n})
    bad = {r.doc_id for r in decontam.contamination(single, spark.read.parquet(f"{DIR}/benchmark.parquet")).collect()}
    assert bad and {r.doc_id for r in clean.collect()} == {r.doc_id for r in single.collect()} - bad
    texts = {r.doc_id: r.text for r in clean.collect()}
    for r in masked.collect():
        assert pii.base_spans(r.text) == [] and r.n_chars == len(r.text)
        if not pii.find(pii.default_model(), [texts[r.doc_id]])[1][0]:
            assert r.text == texts[r.doc_id]
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = {r.doc_id: r.text for r in masked.collect()}
    rows = tokens.collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = lib.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert list(r.ids) == ids and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()


def test_empty(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet").limit(0)
    for _, stage in P.STAGES:
        docs = stage(spark, docs, DIR)
    assert docs.count() == 0
