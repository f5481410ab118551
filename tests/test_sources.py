"""Landed files and source edge cases: syndication XML, subtitle files."""

import os

from pyspark.sql import functions as F

from quire.sources import feeds as FD
from quire.sources import subtitles as SUB

RSS = """<?xml version="1.0"?>
<rss version="2.0"><channel><title>News</title><description>Daily</description>
<item><title>One</title><link>https://n/1</link><description>a &amp; b</description><guid>g1</guid>
<pubDate>Mon, 01 Jan 2024 10:00:00 +0000</pubDate></item>
<item><title>Two</title><description>no link, no date</description><guid>g2</guid></item>
<item><title>Three</title><link>https://n/3</link><pubDate>Tue, 2 Jan 2024 08:30:00 GMT</pubDate></item>
</channel></rss>"""
ATOM = """<feed><title>Blog</title><subtitle>Notes</subtitle>
<entry><title>A</title><link href="https://b/a"/><summary>s</summary><id>ia</id><updated>2024-02-01T00:00:00Z</updated></entry>
<entry><title>B</title><link href="https://b/b"/><id>ib</id><published>2024-03-01T12:00:00+02:00</published>
<updated>2024-04-01T00:00:00Z</updated></entry>
</feed>"""
BROKEN = "<rss><channel><title>x</title><item><title>y</item>"


def _write(d, name, text):
    with open(os.path.join(d, name), "w", encoding="utf-8") as f:
        f.write(text)


def test_rss_and_atom_files(spark, scratch):
    for n, t in (("news.xml", RSS), ("blog.xml", ATOM), ("broken.xml", BROKEN)):
        _write(scratch, n, t)
    feeds, items, errors = FD.parse(FD.read_documents(spark, scratch))
    got = {(r.feed_title, r.title): (r.link, r.description, r.guid,
                                    None if r.published is None else int(r.published.timestamp()))
           for r in items.collect()}
    assert got[("News", "One")] == ("https://n/1", "a & b", "g1", 1704103200)
    assert got[("News", "Two")] == ("", "no link, no date", "g2", None)
    assert got[("News", "Three")][3] == 1704184200
    assert got[("Blog", "A")] == ("https://b/a", "s", "ia", 1706745600)     # only updated
    assert got[("Blog", "B")][3] == 1709287200                             # published wins
    assert {r.feed_title: r.feed_description for r in feeds.collect()} == {"News": "Daily", "Blog": "Notes"}
    errs = errors.collect()
    assert len(errs) == 1 and errs[0].feed_id.endswith("broken.xml")


def test_item_order_within_feed(spark, scratch):
    _write(scratch, "news.xml", RSS)
    _, items, _ = FD.parse(FD.read_documents(spark, scratch))
    assert [r.title for r in items.orderBy("item_pos").collect()] == ["One", "Two", "Three"]


def test_vtt_files(spark, scratch):
    _write(scratch, "a.en.vtt", "WEBVTT\n\n1\n00:00:01.000 --> 00:00:02.000\nHello\n\n2\n00:00:03.000 --> 00:00:04.000\nBye\n")
    _write(scratch, "b.en.vtt", "WEBVTT\n\n00:01.500 --> 00:02.000\n<c>x</c> y\n")
    segs = SUB.segments(SUB.read_vtt_files(spark, scratch))
    got = sorted((os.path.basename(r.file_id), r.start, r.text) for r in segs.collect())
    assert got == [("a.en.vtt", 1.0, "Hello"), ("a.en.vtt", 3.0, "Bye"), ("b.en.vtt", 1.5, "x y")]


def test_parse_date_formats(spark):
    df = spark.createDataFrame([("Mon, 01 Jan 2024 10:00:00 +0000",), ("2024-01-01T10:00:00Z",),
                                ("2024-01-01T12:00:00.250+02:00",), ("not a date",)], "s string")
    got = [r[0] for r in df.select(F.unix_seconds(FD.parse_date("s"))).collect()]
    assert got == [1704103200, 1704103200, 1704103200, None]
