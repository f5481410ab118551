"""Main text of pages against the known parts of made pages, and the tree matching against its recurrence."""

import functools
import html
import random
import re

import pytest

from quire.llm import wrapper


def test_pages_keep_the_article(spark):
    """The article's blocks, by a reading of its own of the table's pages, all of which have one article element."""
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    for r in wrapper.main_text(pages).collect():
        m = re.search(r"<article[^>]*>(.*?)</article>", r.html, re.S)
        if not m or re.search(r"<(aside|form|nav|div|section|script|style|footer|header|button)", m[1]):
            continue
        blocks = re.split(r"</?(?:p|h[1-6]|ul|ol|li|blockquote|table|tr|td|pre)\b[^>]*>", re.sub(r"<!--.*?-->", "", m[1], flags=re.S))
        texts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", re.sub(r"<br\s*/?>", " ", b))).split()) for b in blocks]
        want = "\n".join(t for t in texts if t)
        assert r.text == want and r.n_chars == len(want)


def plain_page(i, host="h.example.org"):
    rng = random.Random(i)
    body = "".join(f"<div><span>{' '.join(rng.choice('abcdefgh') * rng.randint(2, 8) for _ in range(30))}</span></div>" for _ in range(3))
    return (i, f"https://{host}/p/{i}", "<html><body><div><span>Site name</span></div><div><ul><li>Home</li><li>About us</li></ul></div>"
            f"<div id='x'>{body}</div><div><span>All rights reserved</span></div></body></html>")


def test_constant_nodes_go(spark):
    """Without any telling element the parts that all pages of a host share are template."""
    pages = spark.createDataFrame([plain_page(i) for i in range(12)], "page_id long, url string, html string")
    for r in wrapper.main_text(pages).collect():
        assert "Site name" not in r.text and "About us" not in r.text and "All rights reserved" not in r.text
        assert len(r.text.split("\n")) == 3


def test_odd_first_page_does_not_disable_the_host(spark):
    """Empty and error pages with the smallest ids, and a second layout, leave the templates of both layouts found."""
    other = [(i, u, h.replace("<body><div>", "<body><section class='top'><b>Other name</b></section><div>"))
             for i, u, h in map(plain_page, range(20, 32))]
    rows = [(-3, plain_page(0)[1], None), (-2, plain_page(0)[1], ""),
            (-1, plain_page(0)[1], "<html><body><div>Error 500</div></body></html>"), *map(plain_page, range(12)), *other]
    for r in wrapper.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect():
        if r.page_id >= 0:
            assert not re.search("Site name|About us|All rights reserved|Other name", r.text) and len(r.text.split("\n")) == 3


EDGES = [(1, None, "<p>a &amp; b &#233; &nbsp; c</p>"), (2, "http://x.example.com/", None), (3, "http://x.example.com/", ""),
         (4, "no address", "plain   text"), (5, "http://y.example.com", "<article><p>one<p>two<br>three <b>bo</b>ld<script>x</script></article>"),
         (5, "http://y.example.com", "<article><p>one<p>two<br>three <b>bo</b>ld<script>x</script></article>"),
         (6, "http://z.example.com", "<div" + " <div>" * 3000 + "deep"), (7, "http://z.example.com", "<!-- open"), (None, None, "<ul><li>x<li>y"),
         (8, "http://z.example.com", "<article>" + "<p>word</p>" * 20000 + "<div class='comments'>reader</div></article>")]


def test_edges(spark):
    pages = spark.createDataFrame([(*r, 5) for r in EDGES], "page_id long, url string, html string, text int")
    rows = wrapper.main_text(pages.selectExpr("*", "'h' AS host", "1 AS seed", "2 AS node")).collect()
    text = {r.page_id: r.text for r in rows}
    assert len(rows) == len(EDGES) and all(r.host == "h" and r.n_chars == len(r.text) for r in rows)
    assert text[1] == "a & b é c" and text[2] == "" and text[3] == "" and text[4] == "plain text"
    assert text[5] == "one\ntwo three bold" and text[None] == "x\ny" and text[8] == "\n".join(["word"] * 20000)
    assert wrapper.main_text(pages.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(30))
def test_tree_matching(seed):
    rng = random.Random(seed)

    def tree(depth=0):
        tag = rng.choice(["div", "span", "b", "i"])
        inner = "".join(tree(depth + 1) for _ in range(rng.randint(0, 3 if depth < 3 else 0)))
        return f"<{tag}>{inner}</{tag}>"

    a, b = (wrapper.Tree("".join(tree() for _ in range(3))) for _ in "ab")
    ka, kb = a.kids(), b.kids()

    @functools.cache
    def size(x, y):
        if a.label[x] != b.label[y]:
            return 0
        xs, ys = ka[x], kb[y]
        m = [[0] * (len(ys) + 1) for _ in range(len(xs) + 1)]
        for i, u in enumerate(xs, 1):
            for j, v in enumerate(ys, 1):
                m[i][j] = max(m[i - 1][j], m[i][j - 1], m[i - 1][j - 1] + size(u, v))
        return m[-1][-1] + 1

    pairs = wrapper.align(a, b)
    assert len(pairs) == size(0, 0)
    assert len({x for x, _ in pairs}) == len({y for _, y in pairs}) == len(pairs)
    assert all(a.label[x] == b.label[y] for x, y in pairs)
