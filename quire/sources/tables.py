"""Readers for the landed tables and the domain views built on them.

Documents stand in for syndicated feed items: each `source` is one configured
feed, each document one item of that feed.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.session import RESOURCE_BYTES, bounded_broadcast, local_table, spread

# Fixed values of the document-to-item mapping.
EPOCH_BASE = 1704067200          # 2024-01-01T00:00:00Z
SECONDS_PER_DOC = 3600
UNDATED_EVERY = 10               # every tenth document carries no date
LINK_BASE = "https://example.com/"
PARSERS = ["web", "telegram", "youtube"]
AGENT_LISTS = [[], ["summary"], ["summary", "format"]]
FILTER_LISTS = [[], ["quality"], ["quality", "privacy"], ["privacy", "missing"]]


# Tables whose rows carry long texts and feed regex-heavy operators, with their ids.
TEXT_TABLES = {"documents": ["doc_id"], "pages": ["page_id"], "conversations": ["conv_id", "turn"]}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    return spread(df, TEXT_TABLES[name]) if name in TEXT_TABLES else df


def source_number(source) -> F.Column:
    return F.regexp_extract(T._c(source), r"(\d+)$", 1).try_cast("int")


def items_from_documents(docs: DataFrame) -> DataFrame:
    """items(resource_pos, item_pos, title, link, description, published, guid)."""
    return docs.select(
        source_number("source").alias("resource_pos"),
        F.col("doc_id").alias("item_pos"),
        F.concat(F.lit("Doc "), F.col("doc_id").cast("string")).alias("title"),
        F.concat(F.lit(LINK_BASE), F.col("source"), F.lit("/"), F.col("doc_id").cast("string")).alias("link"),
        T.s("text").alias("description"),
        F.when(F.col("doc_id") % UNDATED_EVERY == 0, F.lit(None).cast("timestamp"))
         .otherwise(F.timestamp_seconds(F.lit(EPOCH_BASE) + F.lit(SECONDS_PER_DOC) * F.col("doc_id")))
         .alias("published"),
        F.col("doc_id").cast("string").alias("guid"),
    )


def _pick(lists, idx) -> F.Column:
    branches = None
    for i, v in enumerate(lists):
        val = F.array(*[F.lit(x) for x in v]).cast("array<string>")
        branches = F.when(idx == i, val) if branches is None else branches.when(idx == i, val)
    return branches


def resources_from_documents(docs: DataFrame) -> DataFrame:
    """One configured resource per distinct document source."""
    n = F.col("resource_pos")
    parser = F.element_at(F.array(*[F.lit(p) for p in PARSERS]), (n % len(PARSERS)) + 1)
    return (docs.select(source_number("source").alias("resource_pos"), F.col("source"))
            .distinct()
            .select(
                n,
                F.concat(F.lit(LINK_BASE), F.col("source"), F.lit("/feed")).alias("feed_url"),
                F.col("source").alias("feed_title"),
                parser.alias("parser"),
                F.when(parser == "telegram", "telegram_channel").otherwise("rss").alias("type"),
                _pick(AGENT_LISTS, F.floor(n / 3) % 3).alias("agents"),
                F.when(n % 5 == 0, F.lit(None).cast("boolean")).otherwise(n % 5 != 4).alias("enabled"),
                _pick(FILTER_LISTS, n % 4).alias("filters"),
            ))


# --- events as an item stream, orders as generation history ----------------

def epoch_seconds(ts) -> F.Column:
    """Whole epoch seconds (floor) of a timestamp or a session-UTC local timestamp."""
    return F.unix_seconds(T._c(ts).cast("timestamp"))


def event_items(events: DataFrame) -> DataFrame:
    """items(feed_url, event_id, ts): one feed per user, epoch-second times."""
    return events.select(F.col("user_id").cast("string").alias("feed_url"), "event_id",
                         epoch_seconds("ts").alias("ts"))


def event_cutoff(items: DataFrame) -> DataFrame:
    """Scalar: the middle of the event time range (first run covers the first half)."""
    return items.agg(((F.min("ts") + F.max("ts")) / 2).cast("long").alias("c"))


def event_history(items: DataFrame) -> DataFrame:
    """History of a first run over the first half of the events."""
    cut = event_cutoff(items).scalar()  # scalar subquery, evaluated once
    return (items.where(F.col("ts") <= cut).groupBy("feed_url")
            .agg(F.max("ts").alias("last_processed_at"))
            .select(F.col("feed_url").cast("long").alias("id"), "feed_url", "last_processed_at",
                    cut.alias("created_at")))


def orders_history(orders: DataFrame) -> DataFrame:
    return orders.select(F.col("o_orderkey").alias("id"),
                         F.col("o_custkey").cast("string").alias("feed_url"),
                         F.col("o_totalprice").cast("long").alias("last_processed_at"),
                         epoch_seconds("o_orderdate").alias("created_at"))


# --- caches derived from labelled documents ---------------------------------
# Labels decide what an earlier run left behind:
#   quality 1, toxic 0 -> agent output for the resource's pipeline + parser output
#   quality 1, toxic 1 -> parser output only
#   quality 0, toxic 0 -> unreadable parser payload, agent output of an old pipeline
#   quality 0, toxic 1 -> parser payload written by another parser type

def labelled_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    items = items_from_documents(docs)
    res = bounded_broadcast(resources_from_documents(docs).select("resource_pos", "parser", "agents"), row_bytes=RESOURCE_BYTES)
    lab = read(spark, sf_dir, "labels").select(F.col("doc_id").alias("item_pos"), "quality", "toxic")
    return items.join(res, "resource_pos").join(lab, "item_pos", "left")


def derived_parser_cache(li: DataFrame) -> DataFrame:
    from quire.operators import cache as C
    lab = li.where(F.col("quality").isNotNull())
    other = F.when(F.col("parser") == "web", F.lit("youtube")).otherwise(F.lit("web"))
    payload_type = F.when((F.col("quality") == 0) & (F.col("toxic") == 1), other).otherwise(F.col("parser"))
    payload = F.when(F.col("parser") == "youtube",
                     F.to_json(F.struct(payload_type.alias("parser_type"), F.struct(F.struct(
                         F.col("title").alias("title"), F.lit("en").alias("language"),
                         F.array(F.struct(F.lit(0.0).alias("start"), F.lit(2.0).alias("end"),
                                          F.col("description").alias("text"))).alias("segments"))
                         .alias("Transcription")).alias("data"))))
    payload = payload.otherwise(C.encode_html(payload_type, F.col("description")))
    out = F.when((F.col("quality") == 0) & (F.col("toxic") == 0), F.lit("{not json")).otherwise(payload)
    return lab.select(F.col("link").alias("url"), F.col("parser").alias("parser_type"),
                      out.alias("output_data"), F.col("item_pos").alias("created_at"),
                      F.col("item_pos").alias("accessed_at"))


def derived_agent_cache(li: DataFrame) -> DataFrame:
    from quire.operators import cache as C
    lab = li.where(F.col("toxic") == 0)
    pipe = F.when(F.col("quality") == 1, C.pipeline_key("agents")).otherwise(F.lit("legacy"))
    return lab.select(F.col("link").alias("url"), F.col("parser").alias("parser_type"),
                      pipe.alias("agent_pipeline"),
                      F.concat(F.lit("["), pipe, F.lit("] "), F.col("description")).alias("output_data"),
                      (F.col("item_pos") + 1000000).alias("created_at"),
                      (F.col("item_pos") + 1000000).alias("accessed_at"))


# --- landed web pages as the items of web feeds ---------------------------------
PAGE_LANGS = ["en", "fr", "de", "es"]   # one web feed per language folder of the URL
PAGE_RESOURCE_BASE = 100


def page_lang(url) -> F.Column:
    return F.regexp_extract(T._c(url), r"^https?://[^/]+/([a-z]{2})/", 1)


def items_from_pages(pages: DataFrame) -> DataFrame:
    """items(resource_pos, item_pos, title, link, description, published, guid): page links as feed items."""
    lang = page_lang("url")
    pos = F.array_position(F.array(*[F.lit(x) for x in PAGE_LANGS]), lang).cast("int")
    return pages.select(
        (F.lit(PAGE_RESOURCE_BASE) + pos).alias("resource_pos"),
        F.col("page_id").alias("item_pos"),
        F.regexp_extract(T.s("html"), r"(?s)<title\b[^>]*>(.*?)</title>", 1).alias("title"),
        F.col("url").alias("link"),
        F.lit("").alias("description"),
        F.timestamp_seconds(F.lit(EPOCH_BASE) + F.lit(SECONDS_PER_DOC) * F.col("page_id")).alias("published"),
        F.col("page_id").cast("string").alias("guid"))


def resources_from_pages(spark: SparkSession) -> DataFrame:
    """The web feeds: fixed configuration rows (one per language folder)."""
    rows = [(PAGE_RESOURCE_BASE + i + 1, f"https://example.com/{lang}/feed", f"Web {lang}", "web", "rss",
             ["summary"] if i % 2 else [], None, []) for i, lang in enumerate(PAGE_LANGS)]
    return local_table(spark, rows, "resource_pos int, feed_url string, feed_title string, parser string, "
                                    "type string, agents array<string>, enabled boolean, filters array<string>")
