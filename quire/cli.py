"""Command line: one digest run from a TOML configuration over landed sources.

    python -m quire --config feeds.toml [--clean] [--include-all] [--regenerate]

Configuration (the resource and filter tables of the original, plus folders):

    output_directory  = "/shared/digests"
    state_directory   = "/shared/state"       # run history, feed marks, caches
    landing_directory = "/shared/landing"     # what the fetchers land
    agents = "my.module:make_registry"        # returns {agent name: callable}; needed when a resource names agents

    [[resources]]
    feed_url = "https://example.com/feed.xml"
    parser   = "web"                          # web | telegram | youtube
    type     = "rss"                          # rss | telegram_channel
    agents   = []
    filters  = ["quality"]
    # enabled = false

    [filters.quality]
    min_length = 300
    min_words = 80
    exclude_patterns = ["(?i)copyright"]
    require_paragraphs = true

Landing layout, one folder per feed key (first 16 hex chars of the SHA-256 of
the feed URL, or of the item link for subtitles):
    rss/<key>/*.xml                 syndication documents
    telegram_channel/<key>/         parquet of raw messages (see sources.messages)
    pages/                          parquet (url, html) of fetched web pages
    subtitles/<key>/*.vtt           subtitle files of a video link
"""

from __future__ import annotations

import argparse
import hashlib
import importlib
import os
import tomllib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire import fs
from quire.functions import text as T
from quire.operators import cache as C
from quire.operators import content as CT
from quire.operators import rules as RL
from quire.operators.state import StateStore
from quire.plans import run as R
from quire.session import bounded_broadcast, get_session, local_table
from quire.sources import feeds as FD
from quire.sources import messages as M
from quire.sources import subtitles as SUB

RES_SCHEMA = ("resource_pos int, feed_url string, feed_title string, parser string, type string, "
              "agents array<string>, enabled boolean, filters array<string>, feed_key string")
ITEM_COLS = ["resource_pos", "item_pos", "title", "link", "description", "published", "guid"]
# Fixed value: the error of a video item without a landed subtitle file.
NO_SUBTITLES_ERROR = "No subtitle files found. This video may not have subtitles available."
MESSAGES_SCHEMA = ("msg_id long, date long, kind string, text string, media_kind string, "
                   "sizes array<struct<type:string,w:int,h:int>>, photo_id long, download_ok boolean")


def key_of(s: str) -> str:
    return hashlib.sha256(s.encode()).hexdigest()[:16]


def key_col(c) -> F.Column:
    return F.substring(F.sha2(T.s(c), 256), 1, 16)


def load_config(path: str) -> dict:
    with open(path, "rb") as f:
        return tomllib.load(f)


def resources_frame(spark: SparkSession, conf: dict) -> DataFrame:
    rows = []
    for i, r in enumerate(conf.get("resources", [])):
        rows.append((i, r["feed_url"], "", r.get("parser", ""), r.get("type", ""), list(r.get("agents", [])),
                     r.get("enabled"), list(r.get("filters", [])), key_of(r["feed_url"])))
    return local_table(spark, rows, RES_SCHEMA)


def registry_of(conf: dict):
    """The function that makes the agents, from `package.module:function`; None when the configuration names none."""
    if not conf.get("agents"):
        return None
    module, _, name = conf["agents"].partition(":")
    return getattr(importlib.import_module(module), name)


def _landed(spark: SparkSession, path: str) -> bool:
    return fs.exists(spark, path)


def rss_items(spark: SparkSession, landing: str, res: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Items, feed titles and errors of every landed syndication document."""
    path = os.path.join(landing, "rss")
    if not _landed(spark, path):
        return (None, spark.createDataFrame([], "resource_pos int, feed_title string"),
                spark.createDataFrame([], "resource_pos int, message string"))
    docs = FD.read_documents(spark, os.path.join(path, "*", "*.xml")).withColumn(
        "feed_key", F.element_at(F.split("feed_id", "/"), -2))
    feeds, items, errors = FD.parse(docs)
    keyed = bounded_broadcast(res.where(F.col("type") == "rss").select("resource_pos", "feed_key"))
    fk = docs.select("feed_id", "feed_key")
    items = (items.join(fk, "feed_id").join(keyed, "feed_key")
             .withColumn("item_pos", F.col("item_pos").cast("long")))
    titles = feeds.join(fk, "feed_id").join(keyed, "feed_key").groupBy("resource_pos") \
        .agg(F.first("feed_title").alias("feed_title"))
    errors = errors.join(fk, "feed_id").join(keyed, "feed_key").select("resource_pos", "message")
    return items.select(*ITEM_COLS), titles, errors


# Fixed value: the error of a channel resource whose URL names no channel.
CHANNEL_URL_ERROR = "invalid channel URL: %s"


def channel_errors(res: DataFrame) -> DataFrame:
    """Enabled channel resources whose URL names no channel."""
    bad = (F.col("type") == "telegram_channel") & F.coalesce("enabled", F.lit(True)) & T.channel_name("feed_url").isNull()
    return res.where(bad).select("resource_pos", F.format_string(CHANNEL_URL_ERROR, "feed_url").alias("message"))


def channel_items(spark: SparkSession, landing: str, res: DataFrame) -> DataFrame | None:
    path = os.path.join(landing, "telegram_channel")
    if not _landed(spark, path):
        return None
    raw = (spark.read.schema(MESSAGES_SCHEMA).parquet(os.path.join(path, "*"))
           .withColumn("feed_key", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)))
    chans = bounded_broadcast(res.where(F.col("type") == "telegram_channel")
                              .select("resource_pos", "feed_key", T.channel_name("feed_url").alias("channel"))
                              .where(F.col("channel").isNotNull()))
    msgs = raw.join(chans, "feed_key")
    items = M.message_items(msgs)
    pos = msgs.select("channel", "resource_pos").distinct()
    return items.join(bounded_broadcast(pos), "channel").select(*ITEM_COLS, "media")


def parse_function(spark: SparkSession, landing: str):
    """Parser dispatch: web reads landed pages, telegram renders markup, youtube
    assembles the transcript of the chosen subtitle file of the link."""
    pages_path = os.path.join(landing, "pages")
    pages = (spark.read.parquet(pages_path) if _landed(spark, pages_path)
             else spark.createDataFrame([], "url string, html string"))
    with_pages = CT.parse_with_pages(pages)
    subs_path = os.path.join(landing, "subtitles")

    def parse(df: DataFrame) -> DataFrame:
        out = with_pages(df)
        if not _landed(spark, subs_path):
            return out
        lines = SUB.read_vtt_files(spark, os.path.join(subs_path, "*", "*.vtt"))
        files = lines.select("file_id").distinct().select(
            F.element_at(F.split("file_id", "/"), -2).alias("video"),
            F.element_at(F.split("file_id", "/"), -1).alias("name"), "file_id")
        chosen = SUB.choose_file(files.select("video", "name")).join(files, ["video", "name"])
        segs = SUB.segments(lines.join(chosen.select("file_id"), "file_id", "left_semi"))
        tr = SUB.transcripts(segs, chosen.select("file_id", "video", F.lit("en").alias("language"),
                                                 F.lit("").alias("title_")).withColumnRenamed("title_", "title"))
        tr = tr.join(chosen.select("file_id", "video"), "file_id")
        yt = (out.where(F.col("parser") == "youtube").withColumn("video", key_col("link"))
              .join(tr.select("video", F.col("language").alias("_lang"), F.col("segments").alias("_segs")), "video", "left"))
        t = F.struct(T.s("title").alias("title"), F.col("_lang").alias("language"), F.col("_segs").alias("segments"))
        ok = F.col("_segs").isNotNull() & (F.size("_segs") > 0)
        yt = (yt.withColumn("fresh", F.when(ok, T.render_transcript(T.s("title"), "_lang", "_segs")))
              .withColumn("fresh_payload", F.when(ok, C.encode_transcript(t)))
              .withColumn("parse_error", F.when(~ok, F.lit(NO_SUBTITLES_ERROR)))
              .drop("video", "_lang", "_segs"))
        return out.where(F.col("parser") != "youtube").unionByName(yt)
    return parse


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> R.RunResult:
    ap = argparse.ArgumentParser(prog="quire")
    ap.add_argument("--config", required=True)
    ap.add_argument("--clean", action="store_true", help="remove all cache entries")
    ap.add_argument("--include-all", action="store_true", help="ignore the last processed times (writes none)")
    ap.add_argument("--regenerate", action="store_true", help="delete the latest generation, then run")
    ap.add_argument("--now", type=int, default=None, help=argparse.SUPPRESS)
    a = ap.parse_args(argv)
    conf = load_config(a.config)
    spark = spark or get_session()
    store = StateStore(spark, conf.get("state_directory"))
    landing = conf["landing_directory"]
    rule_sets = RL.compile_rule_sets(conf.get("filters", {}))
    res = resources_frame(spark, conf)
    opts = R.RunOptions(include_all=a.include_all, regenerate=a.regenerate, clean=a.clean, now=a.now,
                        out_dir=conf.get("output_directory"), make_registry=registry_of(conf), strict_agents=True)
    rss, titles, unread = rss_items(spark, landing, res)
    unread = unread.unionByName(channel_errors(res))
    chan = channel_items(spark, landing, res)
    parts = [p for p in (rss, chan) if p is not None]
    if not parts:
        raise SystemExit("nothing landed under " + landing)
    media_type = "array<struct<type:string,local_path:string,width:int,height:int,caption:string>>"
    items = parts[0] if "media" in parts[0].columns else parts[0].withColumn("media", F.lit(None).cast(media_type))
    for p in parts[1:]:
        items = items.unionByName(p if "media" in p.columns else p.withColumn("media", F.lit(None).cast(media_type)))
    res = res.drop("feed_title").join(titles, "resource_pos", "left") \
        .withColumn("feed_title", F.coalesce("feed_title", "feed_url"))
    return R.run_once(spark, items, res.drop("feed_key"), rule_sets, store, opts,
                      parse=parse_function(spark, landing), fetch_errors=unread)
