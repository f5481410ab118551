"""Personal data: base spans against the stated patterns, the field against enumeration of all label sequences."""

import hashlib
import itertools
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quire.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def good(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 9 <= len(digits) <= 15
    return True


def brute(text):
    return [(k, *m.span()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if good(k, m[0])]


PIECES = ["a@b.co", "x.y%z+@q-r.example.org", "@", "@@", ".", "..", "-", "+", " ", "1", "22", "333", "1.2.3.4", "256.1.1.1", "001.002.003.004",
          "4111111111111111", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (555) 010-0000", "+49.30.123456", "(", ")", "é", "\U0001f600", "w", "\n"]


@settings(max_examples=600, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=14).map("".join))
def test_base_spans(text):
    assert pii.base_spans(text) == brute(text)


def test_documents(spark, small):
    for r in pii.personal_data(small).collect():
        b = brute(r.text)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s[0] == k for s in b) for k in PATTERNS)
        said = ",".join(f"{k}:{i}:{j}" for k, i, j in b)
        assert r.base_sha256 == hashlib.sha256(said.encode()).hexdigest()
        spans = r.spans.split(",") if r.spans else []
        assert set(said.split(",")) - {""} <= set(spans)
        order = [(pii.KINDS.index(s.split(":")[0]), int(s.split(":")[1])) for s in spans]
        assert order == sorted(order)


def test_edges(edges, nothing):
    rows = pii.personal_data(edges.selectExpr("*", "'old' AS spans")).collect()
    assert len(rows) == edges.count() and all(r.n == 5 for r in rows)
    assert {r.spans for r in rows if not r.text} == {""}
    assert pii.personal_data(nothing).count() == 0 and pii.mask(nothing).count() == 0


def test_viterbi_is_exact():
    rng = np.random.default_rng(3)
    k, width = len(pii.LABELS), 5 * pii.WIDTH + 1
    model = {"emit": rng.normal(size=(width, k)), "move": rng.normal(size=(k + 1, k + 1))}
    runs = [rng.integers(0, 2, (n, width)).astype(float) for n in (1, 2, 3, 4, 2)]
    for x, got in zip(runs, pii.viterbi(model, runs), strict=True):
        score = x @ model["emit"]

        def total(y, score=score):
            s = model["move"][k, y[0]] + model["move"][y[-1], k] + sum(score[i, c] for i, c in enumerate(y))
            return s + sum(model["move"][a, b] for a, b in itertools.pairwise(y))

        best = max(itertools.product(range(k), repeat=len(x)), key=total)
        assert total(tuple(got)) == pytest.approx(total(best))


def test_field_on_new_rows():
    """The field labels made sentences that it was not trained on."""
    model, hit, n = pii.default_model(), 0, 0
    for tokens, labels in pii.labelled_table(rows=600, seed=99):
        text = " ".join(tokens)
        want = {x for x in labels if x != "O"}
        got = {s[0] for s in pii.field_spans(model, [text])[0]}
        hit += got == want
        n += 1
    assert hit >= 0.97 * n


def test_mask(spark):
    docs = spark.createDataFrame([(1, "mail a@b.co or +1 (555) 010-0000, not 12.", "x"), (2, None, "y"), (3, "", "z")],
                                 "doc_id long, text string, spans string")
    rows = {r.doc_id: r for r in pii.mask(docs).collect()}
    assert rows[1].text == "mail <email> or <phone>, not 12." and rows[1].spans == "x"
    assert rows[2].text is None and rows[3].text == ""
