"""Message channels as item sources.

Raw messages(channel, msg_id, date, kind, text, media_kind, sizes, photo_id,
download_ok) become feed items: the newest messages per channel are kept,
service and wholly empty messages dropped, titles cut to 100 bytes, and the
largest photo size chosen for each photo.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from quire.functions import text as T

# Fixed values
MESSAGE_LIMIT = 50                 # newest messages read per channel and run
MEDIA_TMP = "telegram-media"       # folder of downloaded photos
NO_SIZE_ERROR = "Error downloading photo: no suitable photo size found"
DOWNLOAD_ERROR = "Error downloading photo: failed to download photo: download interrupted"
DEFAULT_ABOUT = "Telegram channel @%s"

MEDIA_TYPE = "array<struct<type:string,local_path:string,width:int,height:int,caption:string>>"


def messages_from_conversations(conv: DataFrame) -> DataFrame:
    """Raw channel messages derived from conversation turns.

    channel = 'chan' || conv_id % 10, msg_id = conv_id * 100 + turn,
    system turns are service messages, every sixth turn has no text, every
    fifth message carries a photo (every third of those fails to download)
    and some later turns a non-photo document.
    """
    mid = F.col("conv_id") * 100 + F.col("turn")
    sizes = F.array(
        F.struct(F.lit("s").alias("type"), F.lit(90).alias("w"), F.lit(90).alias("h")),
        F.struct(F.lit("m").alias("type"), F.lit(320).alias("w"), (F.lit(240) + mid % 7).cast("int").alias("h")),
        F.struct(F.lit("x").alias("type"), (F.lit(800) - mid % 3 * 80).cast("int").alias("w"), F.lit(600).alias("h")),
        F.struct(F.lit("y").alias("type"), F.lit(640).alias("w"), F.lit(750).alias("h")),
    )
    return conv.select(
        F.concat(F.lit("chan"), (F.col("conv_id") % 10).cast("string")).alias("channel"),
        mid.alias("msg_id"),
        (F.lit(1704067200) + mid).alias("date"),
        F.when(F.col("role") == "system", "service").otherwise("message").alias("kind"),
        F.when(F.col("turn") % 6 == 5, F.lit("")).otherwise(T.s("text")).alias("text"),
        F.when(mid % 5 == 0, "photo").when((mid % 5 == 1) & (F.col("turn") > 2), "document").alias("media_kind"),
        F.when(mid % 5 == 0, F.when(mid % 4 == 0, F.array().cast("array<struct<type:string,w:int,h:int>>"))
               .otherwise(sizes)).alias("sizes"),
        (mid * 7).alias("photo_id"),
        (mid % 3 != 0).alias("download_ok"),
    )


def newest_per_channel(messages: DataFrame, limit: int = MESSAGE_LIMIT) -> DataFrame:
    """The newest `limit` messages of each channel (service messages count too).

    `row_number() <= k` lets the optimizer insert a map-side group limit, so
    at most k rows per channel leave each task even for a very hot channel.
    """
    w = Window.partitionBy("channel").orderBy(F.col("msg_id").desc())
    return messages.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= limit).drop("_rn")


def largest_size(sizes) -> F.Column:
    """Greatest width*height; the first listed size wins ties; none when no size has pixels."""
    scored = F.transform(T._c(sizes), lambda s, i: F.struct(
        (s["w"] * s["h"]).alias("px"), (-i).alias("npos"), s["w"].alias("w"), s["h"].alias("h")))
    return F.array_max(F.filter(scored, lambda x: x["px"] > 0))


def photo_media(m: DataFrame) -> F.Column:
    """At most one attachment per message: a photo, with path or with an error caption."""
    best = largest_size("sizes")
    path = F.concat(F.lit(MEDIA_TMP + "/photo_"), F.col("msg_id").cast("string"), F.lit("_"),
                    F.col("photo_id").cast("string"), F.lit(".jpg"))
    att = F.struct(
        F.lit("photo").alias("type"),
        F.when(best.isNotNull() & F.col("download_ok"), path).otherwise(F.lit("")).alias("local_path"),
        F.coalesce(best["w"], F.lit(0)).cast("int").alias("width"),
        F.coalesce(best["h"], F.lit(0)).cast("int").alias("height"),
        F.when(best.isNull(), F.lit(NO_SIZE_ERROR))
         .when(~F.col("download_ok"), F.lit(DOWNLOAD_ERROR)).otherwise(F.lit("")).alias("caption"),
    )
    return F.when(F.col("media_kind") == "photo", F.array(att)).otherwise(F.array().cast(MEDIA_TYPE))


def message_items(messages: DataFrame, limit: int | None = MESSAGE_LIMIT) -> DataFrame:
    """items(channel, item_pos, title, link, description, published, guid, media). limit: None takes every message."""
    m = (messages if limit is None else newest_per_channel(messages, limit)).where(F.col("kind") == "message")
    m = m.withColumn("media", photo_media(m))
    n = F.size("media")
    title = (F.when(F.col("text") != "", T.truncate_bytes("text"))
             .when(n == 1, F.lit("Photo"))
             .when(n > 1, F.format_string("Album (%d photos)", n))
             .otherwise(F.lit("")))
    return (m.withColumn("title", title)
            .where(~((F.col("title") == "") & (n == 0)))
            .select("channel", F.col("msg_id").alias("item_pos"), "title",
                    T.permalink("channel", "msg_id").alias("link"),
                    F.col("text").alias("description"),
                    F.timestamp_seconds("date").alias("published"),
                    F.col("msg_id").cast("string").alias("guid"), "media"))


def channel_feed(channels: DataFrame) -> DataFrame:
    """Feed metadata: title, and the about text or a default sentence."""
    return channels.select(
        "channel", F.col("title").alias("feed_title"),
        F.coalesce(F.nullif(T.s("about"), F.lit("")),
                   F.format_string(DEFAULT_ABOUT, F.col("channel"))).alias("feed_description"))


def media_manifest(items: DataFrame) -> DataFrame:
    """Distinct downloaded photos of the included items: source path -> media/<basename>."""
    return (items.select(F.explode("media").alias("m"))
            .where((F.col("m.type") == "photo") & (F.col("m.local_path") != ""))
            .select(F.col("m.local_path").alias("local_path"))
            .dropDuplicates(["local_path"])
            .withColumn("file_name", T.media_basename("local_path")))
