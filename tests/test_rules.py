"""Rule sets: per-check cases, order of checks, reasons, regex dialect."""

import pytest

from quire.functions import regex as R
from quire.operators import rules as RL

LONG = "This is a sufficiently long description that certainly exceeds fifty bytes in total."


def decide(spark, rows, config, names):
    rs = RL.compile_rule_sets(config)
    df = spark.createDataFrame([(i, t, d) for i, (t, d) in enumerate(rows)], "item_pos int, title string, description string")
    out = RL.apply_rules(df, names, rs).orderBy("item_pos").collect()
    return [(r.include, r.reason) for r in out]


def test_min_length_bytes(spark):
    got = decide(spark, [("T", LONG), ("T", "Too short"), ("", "é" * 30)], {"f": {"min_length": 50}}, ["f"])
    assert got == [(True, None), (False, "f:min_length"), (True, None)]  # 61 bytes, 31 characters


def test_min_words(spark):
    fifteen = " ".join(f"w{i}" for i in range(14))
    got = decide(spark, [("T", fifteen), ("Few", "only three words")], {"f": {"min_words": 10}}, ["f"])
    assert got == [(True, None), (False, "f:min_words")]


def test_word_boundaries(spark):
    # apostrophes and combining marks split words; digits form words too
    text = "don't e\u0301x 42"  # don | t | e | x | 42
    assert decide(spark, [("", text)], {"f": {"min_words": 5}}, ["f"]) == [(True, None)]
    assert decide(spark, [("", text)], {"f": {"min_words": 6}}, ["f"]) == [(False, "f:min_words")]


def test_cyrillic_patterns(spark):
    cfg = {"c": {"exclude_patterns": ["^[Сс]рочно", "^[Рр]еклама", "^[Кк]онкурс"]}}
    rows = [("Срочно: новости", "x"), ("срочно новости", "x"), ("Реклама дня", "x"), ("Новости: срочно", "x")]
    got = decide(spark, rows, cfg, ["c"])
    assert got == [(False, "c:exclude_pattern[^[Сс]рочно]"), (False, "c:exclude_pattern[^[Сс]рочно]"),
                   (False, "c:exclude_pattern[^[Рр]еклама]"), (True, None)]


def test_paragraphs(spark):
    rows = [("T", "First paragraph.\n\nSecond paragraph."), ("", "single line"), ("A", "b\nc"),
            ("", "\n  \n x"), ("", "x\n \n"), ("", "x\n\u00a0\u2003\n")]
    got = decide(spark, rows, {"p": {"require_paragraphs": True}}, ["p"])
    assert got == [(True, None), (False, "p:require_paragraphs"), (True, None),
                   (False, "p:require_paragraphs"), (False, "p:require_paragraphs"),
                   (False, "p:require_paragraphs")]  # no-break and em spaces are blank


def test_order_and_reason(spark):
    cfg = {"patterns": {"min_length": 30, "min_words": 5, "exclude_patterns": ["(?i)spam"]}}
    got = decide(spark, [("Buy now", "this is spam content with many words")], cfg, ["patterns"])
    assert got == [(False, "patterns:exclude_pattern[(?i)spam]")]


def test_chain_first_failure_unknown_and_empty(spark):
    cfg = {"a": {"min_length": 5}, "b": {"min_words": 100}}
    rows = [("x", "long enough text")]
    assert decide(spark, rows, cfg, ["missing", "a", "b"]) == [(False, "b:min_words")]
    assert decide(spark, rows, cfg, []) == [(True, None)]
    assert decide(spark, [("", "")], cfg, ["a", "b"]) == [(False, "a:min_length")]


def test_invalid_pattern_dropped(spark):
    cfg = {"f": {"exclude_patterns": ["(?=x)", "(", "bad"]}}
    assert [p for p, _ in RL.compile_rule_sets(cfg)["f"].compiled] == ["bad"]
    assert decide(spark, [("a bad title", "")], cfg, ["f"]) == [(False, "f:exclude_pattern[bad]")]


@pytest.mark.parametrize("pattern,text,match", [
    ("end$", "the end\n", False),          # RE2 $ is end of text
    ("end$", "the end", True),
    ("(?m)end$", "the end\nx", True),
    ("a.b", "a\rb", True),                 # '.' excludes only newline
    ("a.b", "a\nb", False),
    ("(?i)привет", "ПРИВЕТ", True),        # case folding beyond ASCII
    (r"a\sb", "a\x0bb", False),            # RE2 \s has no vertical tab
    (r"\bcat\b", "écat", True),            # ASCII word boundary
    ("(?P<w>ab)", "xab", True),
    ("[[:digit:]]+", "a1", True),
    ("^[[:^digit:]]+$", "abc", True),
    ("^[[:^digit:]]+$", "ab1", False),
    ("^[x[:space:]]+$", "x \t", True),
])
def test_dialect(spark, pattern, text, match):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(df.t.rlike(R.to_java(pattern))).first()[0] is match
