"""Web items read landed pages; the digest sink writes ordered text parts."""

import glob
import os

from pyspark.sql import functions as F

from quire.operators import content as CT
from quire.operators import state as ST
from quire.plans import run as R

PAGES = [("https://w/1", "<html><body><nav>menu</nav><article><h1>One</h1><p>Body one.</p></article></body></html>"),
         ("https://w/2", "<html><body><script>x()</script><footer>f</footer></body></html>")]
RES = ("resource_pos int, feed_url string, feed_title string, parser string, type string, "
       "agents array<string>, enabled boolean, filters array<string>")


def _setup(spark):
    pages = spark.createDataFrame(PAGES, "url string, html string")
    items = spark.createDataFrame([(0, 1, "One", "https://w/1", "", 100), (0, 2, "Two", "https://w/2", "", 200),
                                   (0, 3, "Gone", "https://w/3", "", 300), (1, 1, "Note", "", "**hi**", None)],
                                  "resource_pos int, item_pos long, title string, link string, description string, ts long")
    items = items.select("resource_pos", "item_pos", "title", "link", "description",
                         F.when(F.col("ts").isNotNull(), F.timestamp_seconds("ts")).alias("published"),
                         F.col("item_pos").cast("string").alias("guid"))
    res = spark.createDataFrame([(0, "https://w/feed", "Web", "web", "rss", [], None, []),
                                 (1, "https://t.me/c", "Chan", "telegram", "telegram_channel", [], None, [])], RES)
    return pages, items, res


def test_pages_run_and_digest(spark, scratch):
    pages, items, res = _setup(spark)
    store = ST.StateStore(spark, os.path.join(scratch, "state"))
    out = os.path.join(scratch, "out")
    first = R.run_once(spark, items, res, {}, store, R.RunOptions(now=1000, out_dir=out),
                       parse=CT.parse_with_pages(pages))
    got = {(r.resource_pos, r.item_pos): r.content for r in first.pages.collect()}
    assert got == {(0, 1): "<h1>One</h1><p>Body one.</p>", (1, 1): "<p><strong>hi</strong></p>"}
    errs = sorted((r.item_pos, r.message) for r in first.errors.collect())
    assert errs == [(2, "readability returned empty article for 'https://w/2'"),
                    (3, "could not go to 'https://w/3': page not landed")]
    # failed parses still move the mark (they are lost for later runs unless include-all)
    assert {r.feed_url: r.last_processed_at for r in first.marks.collect()} == {"https://w/feed": 300}

    lines = []
    for part in sorted(glob.glob(os.path.join(first.digest_path, "part-*"))):
        with open(part, encoding="utf-8") as f:
            lines += f.read().splitlines()
    assert lines[0] == "<!DOCTYPE html>" and lines[-1] == "</html>"
    toc = lines.index('<h1 class="toc-title">Table of Contents</h1>')
    assert lines[toc + 1] == '<h2 class="toc-resource-name">Web</h2>'
    arts = [l for l in lines if l.startswith('<h1 class="article-title">')]
    assert arts == ['<h1 class="article-title">One</h1>', '<h1 class="article-title">Note</h1>']
    assert lines.index("</nav>") < lines.index(arts[0])

    # rerun: the good page comes from the parser cache, the failed ones are tried again
    again = R.run_once(spark, items, res, {}, store, R.RunOptions(now=2000, include_all=True),
                       parse=CT.parse_with_pages(pages))
    assert {(r.resource_pos, r.item_pos): r.content for r in again.pages.collect()} == got
    assert again.errors.count() == 2
