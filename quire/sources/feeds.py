"""Syndication documents (RSS 2.0 and Atom) to feed and item rows.

One XML schema covers both dialects; `from_xml` keeps a malformed document
as a corrupt record, which becomes an error row instead of failing the run.
`read_large` reads documents too large for one task, an item a record.

An item's link is its RSS link or, of its Atom links, the first that is the
page itself (rel missing, empty or "alternate"), else none. Its date is the
published one, else the updated one; a date in no layout of DATE_FORMATS is none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import text as T

_ITEM = "struct<title:string,link:string,description:string,guid:string,pubDate:string>"
_ENTRY = ("struct<title:string,link:array<struct<_href:string,_rel:string>>,summary:string,id:string,"
          "published:string,updated:string>")
FEED_SCHEMA = (f"struct<channel:struct<title:string,description:string,item:array<{_ITEM}>>,"
               f"title:string,subtitle:string,entry:array<{_ENTRY}>,_corrupt:string>")
PART_SCHEMA = f"struct<item:{_ITEM},entry:{_ENTRY},_corrupt:string>"
HEAD_SCHEMA = "struct<title:string,description:string,subtitle:string,_corrupt:string>"
XML_OPTIONS = {"columnNameOfCorruptRecord": "_corrupt", "ignoreSurroundingSpaces": "false",
               "mode": "PERMISSIVE"}
# Accepted date layouts (weekday names are removed first).
DATE_FORMATS = ["dd MMM yyyy HH:mm:ss Z", "d MMM yyyy HH:mm:ss Z", "dd MMM yyyy HH:mm:ss z",
                "d MMM yyyy HH:mm:ss z", "yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd'T'HH:mm:ss.SSSXXX",
                "yyyy-MM-dd HH:mm:ss", "d MMM yyyy HH:mm Z", "d MMM yyyy HH:mm z", "d MMM yy HH:mm:ss Z",
                "d MMM yy HH:mm:ss z", "d MMM yyyy HH:mm:ss", "d MMM yyyy", "d MMMM yyyy HH:mm:ss Z",
                "yyyy-MM-dd'T'HH:mm:ss[.SSSSSSSSS][.SSSSSS][.SS][.S]XXX", "yyyy-MM-dd'T'HH:mm:ssZ",
                "yyyy-MM-dd'T'HH:mmXXX", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ssXXX", "yyyy-MM-dd HH:mm:ss Z",
                "yyyy-MM-dd"]
ITEM_END, ENTRY_END = "</item>", "</entry>"
PARSE_ERROR = "failed to parse RSS feed"


def parse_date(x) -> F.Column:
    s = F.regexp_replace(F.trim(T._c(x)), r"^[A-Za-z]{3,9},?\s+(?=\d)", "")
    return F.coalesce(*[F.try_to_timestamp(s, F.lit(f)) for f in DATE_FORMATS])


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Landed feed documents -> (feed_id = file path, xml)."""
    return (spark.read.text(path, wholetext=True)
            .select(F.col("_metadata.file_path").alias("feed_id"), F.col("value").alias("xml")))


def _item(i) -> F.Column:
    return F.struct(
        T.s(i["title"]).alias("title"), T.s(i["link"]).alias("link"), T.s(i["description"]).alias("description"),
        T.s(i["guid"]).alias("guid"), parse_date(i["pubDate"]).alias("published"))


def _entry(e) -> F.Column:
    page = F.filter(e["link"], lambda x: F.coalesce(x["_rel"], F.lit("")).isin("", "alternate") & x["_href"].isNotNull())
    return F.struct(
        T.s(e["title"]).alias("title"), T.s(F.get(page, F.lit(0))["_href"]).alias("link"), T.s(e["summary"]).alias("description"),
        T.s(e["id"]).alias("guid"), F.coalesce(parse_date(e["published"]), parse_date(e["updated"])).alias("published"))


def parse(docs: DataFrame, feed_id: str = "feed_id", xml: str = "xml") -> tuple[DataFrame, DataFrame, DataFrame]:
    """docs(feed_id, xml) -> (feeds, items, errors). Each document is parsed once;
    RSS items and Atom entries are mapped to one item struct and exploded once.
    A feed without items is a feed, as long as it has a channel or a title."""
    f = F.from_xml(xml, FEED_SCHEMA, XML_OPTIONS)
    rss = F.transform(F.coalesce(f["channel"]["item"], F.array()), _item)
    atom = F.transform(F.coalesce(f["entry"], F.array()), _entry)
    ok = f["_corrupt"].isNull() & (f["channel"].isNotNull() | f["entry"].isNotNull() | f["title"].isNotNull())
    p = docs.select(feed_id, F.struct(
        ok.alias("ok"),
        T.s(F.coalesce(f["channel"]["title"], f["title"])).alias("feed_title"),
        T.s(F.coalesce(f["channel"]["description"], f["subtitle"])).alias("feed_description"),
        F.concat(rss, atom).alias("items")).alias("p"))
    good = p.where("p.ok")
    feeds = good.select(feed_id, "p.feed_title", "p.feed_description")
    items = good.select(feed_id, "p.feed_title", F.posexplode("p.items").alias("item_pos", "i")).select(
        feed_id, "feed_title", "item_pos", "i.title", "i.link", "i.description", "i.guid", "i.published")
    errors = p.where(~F.col("p.ok")).select(feed_id, F.lit("fetch").alias("stage"), F.lit(PARSE_ERROR).alias("message"))
    return feeds, items, errors


def _parts(spark: SparkSession, path: str, end: str, glob: str | None) -> DataFrame:
    """(feed_id, part): the documents cut after each `end`; Spark splits a large file over tasks at these places."""
    r = spark.read.option("lineSep", end)
    r = r.option("pathGlobFilter", glob) if glob else r
    return r.text(path).select(F.col("_metadata.file_path").alias("feed_id"), F.col("value").alias("part"))


def read_large(spark: SparkSession, path: str, dialect: str = "rss",
               glob: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Landed documents of one dialect ("rss" or "atom") -> (feeds, items, errors), an item a record.

    The end tag of an item is the record separator of the text source, so one
    document is read by many tasks and none holds it whole; items are not numbered.
    Unlike `parse`, a broken item is one error row and the others stay. The
    title and description of a feed are those before its first item; it is a feed
    if its root has a channel (RSS) or a feed element (Atom) there. Text after the
    last item that begins another one is an error row: the document was cut short.
    Tags are lower case and without a namespace prefix; an end tag of an item
    within a CDATA section makes that item an error row.
    """
    tag, end, root = ("item", ITEM_END, "channel") if dialect == "rss" else ("entry", ENTRY_END, "feed")
    begins = rf"<{tag}(?=[\s>/])"
    part = F.col("part")
    cut = F.regexp_instr(part, F.lit(begins))
    p = _parts(spark, path, end, glob).select("feed_id", "part", F.when(cut > 0, cut).alias("at"))
    body = F.expr("substring(part, at)")
    whole = F.concat(F.lit("<r>"), body, F.lit(end + "</r>"))
    x = F.from_xml(F.when(F.col("at").isNotNull(), whole), PART_SCHEMA, XML_OPTIONS)
    read = p.select("feed_id", "part", "at", x.alias("x"))
    # the last piece of a document has no end tag: it parses only by the one that is added, so a root must have closed after it
    got = F.col(f"x.{tag}").isNotNull() & F.col("x._corrupt").isNull()
    made = (_item if dialect == "rss" else _entry)(F.col(f"x.{tag}"))
    items = read.where(got).select("feed_id", made.alias("i")).select(
        "feed_id", "i.title", "i.link", "i.description", "i.guid", "i.published")
    before = F.coalesce(F.expr("substring(part, 1, at - 1)"), part)
    opened = rf"(?s)<{root}(?:\s[^>]*)?>(.*)$"
    head = F.regexp_replace(F.regexp_extract(before, opened, 1), rf"(?s)</{root}>.*$", "")
    h = F.from_xml(F.concat(F.lit("<r>"), head, F.lit("</r>")), HEAD_SCHEMA, XML_OPTIONS)
    feeds = p.where(before.rlike(opened)).select("feed_id", h.alias("h")).select(
        "feed_id", T.s("h.title").alias("feed_title"),
        T.s(F.coalesce(F.col("h.description"), F.col("h.subtitle"))).alias("feed_description"))
    errors = read.where(F.col("at").isNotNull() & ~F.coalesce(got, F.lit(False))).select(
        "feed_id", F.lit("fetch").alias("stage"), F.lit(PARSE_ERROR).alias("message"))
    return feeds, items, errors


def xml_escape(x) -> F.Column:
    c = T._c(x)
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c
