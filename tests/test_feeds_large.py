"""Feed documents read an item a record, alternate links, dates and feeds without items."""

import os

import pytest
from pyspark.sql import functions as F

from quire.sources import feeds as FD

ITEMS = 4000


def _write(d, name, text):
    with open(os.path.join(d, name), "w", encoding="utf-8") as f:
        f.write(text)


def rss(n=ITEMS):
    items = "".join(f"<item><title>T{i} &amp; é</title>\n<link>https://n/{i}</link><description><![CDATA[<p>{'x' * 200}</p>]]>"
                    f"</description><guid>g{i}</guid><pubDate>Mon, 01 Jan 2024 10:00:{i % 60:02d} +0000</pubDate></item>\n"
                    for i in range(n))
    return f'<?xml version="1.0"?>\n<rss version="2.0"><channel><title>Big</title><description>D &lt;1&gt;</description>\n{items}</channel></rss>\n'


def atom(n=ITEMS):
    entries = "".join(f'<entry xml:lang="en"><title>A{i}</title><link rel="self" href="https://b/self/{i}"/>'
                      f'<link rel="alternate" href="https://b/{i}"/><link rel="enclosure" href="https://b/mp3/{i}"/>'
                      f"<summary>s</summary><id>i{i}</id><updated>2024-02-01T00:00:00Z</updated></entry>" for i in range(n))
    return f'<feed xmlns="http://www.w3.org/2005/Atom"><title>Blog</title><subtitle>Notes</subtitle>{entries}</feed>'


COLS = ["title", "link", "description", "guid", "published"]


@pytest.mark.parametrize("dialect,text", [("rss", rss()), ("atom", atom())])
def test_same_rows_as_the_whole_document_from_many_tasks(spark, scratch, dialect, text):
    _write(scratch, "big.xml", text)
    feeds, items, errors = FD.parse(FD.read_documents(spark, scratch))
    want = sorted(items.select(*COLS).collect())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(64 << 10))
        big_feeds, big, big_errors = FD.read_large(spark, scratch, dialect)
        assert big.rdd.getNumPartitions() > 4
        assert sorted(big.select(*COLS).collect()) == want and len(want) == ITEMS
        assert [tuple(r)[1:] for r in big_feeds.collect()] == [tuple(r)[1:] for r in feeds.collect()]
        assert big_errors.count() == errors.count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_broken_items_cut_documents_and_empty_ones(spark, scratch):
    _write(scratch, "a.xml", "<rss><channel><title>A</title><item><title>1</title></item><item><title>2<b></title></item>"
                             "<item><title>3</title></item></channel></rss>")
    _write(scratch, "b.xml", "<rss><channel><title>B</title><item><title>1</title></item><item><title>cut")
    _write(scratch, "c.xml", "<rss><channel><title>C</title><description>none</description></channel></rss>")
    _write(scratch, "d.xml", "")
    feeds, items, errors = FD.read_large(spark, scratch)
    name = F.substring_index("feed_id", "/", -1)
    assert sorted(tuple(r) for r in items.select(name, "title").collect()) == [("a.xml", "1"), ("a.xml", "3"), ("b.xml", "1")]
    assert sorted(r[0] for r in errors.select(name).collect()) == ["a.xml", "b.xml"]
    assert sorted(tuple(r) for r in feeds.select(name, "feed_title", "feed_description").collect()) == [
        ("a.xml", "A", ""), ("b.xml", "B", ""), ("c.xml", "C", "none")]


def test_alternate_links_and_feeds_without_items(spark):
    docs = spark.createDataFrame([
        ("two", '<feed><title>F</title><entry><id>1</id><link rel="edit" href="e"/><link href="page"/><link href="other"/></entry>'
                '<entry><id>2</id><link rel="enclosure" href="x"/></entry><entry><id>3</id></entry></feed>'),
        ("empty", "<feed><title>Empty</title></feed>"), ("channel", "<rss><channel><title>None</title></channel></rss>"),
        ("no", "not a feed"), ("null", None)], "feed_id string, xml string")
    feeds, items, errors = FD.parse(docs)
    assert {r.guid: r.link for r in items.collect()} == {"1": "page", "2": "", "3": ""}
    assert {r.feed_id for r in feeds.collect()} == {"two", "empty", "channel"}
    assert "no" in {r.feed_id for r in errors.collect()}


def test_more_date_layouts(spark):
    at = 1704103200  # 2024-01-01 10:00 UTC
    dates = {"Mon, 01 Jan 2024 10:00 +0000": at, "Monday, 1 Jan 2024 10:00:00 GMT": at, "Mon, 1 Jan 24 10:00:00 +0000": at,
             "1 Jan 2024 10:00:00": at, "1 Jan 2024": at - 36000, "1 January 2024 10:00:00 +0000": at,
             "2024-01-01T10:00:00.123456Z": at, "2024-01-01T10:00:00+0000": at, "2024-01-01T12:00+02:00": at,
             "2024-01-01T10:00:00": at, "2024-01-01 10:00:00 +0000": at, "2024-01-01": at - 36000, "Mon 1 Jan 2024 10:00:00 GMT": at,
             "yesterday": None, "": None, "2024-13-01": None}
    df = spark.createDataFrame([(k,) for k in dates], "s string")
    assert {r[0]: r[1] for r in df.select("s", F.unix_seconds(FD.parse_date("s"))).collect()} == dates
