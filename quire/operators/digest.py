"""Digest assembly: ordered HTML lines of a table of contents and the articles.

The digest is emitted as rows (section, resource_pos, item_pos, line_no, line)
so that no step holds a whole digest; the sink range-partitions on that key
and sorts within partitions, so the part files read in name order form the
document.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.session import materialize

# The page skeleton (styles kept out) and the line templates.
HEAD = ['<!DOCTYPE html>', '<html>', '<head>', '<meta charset="UTF-8">', '<title>%s</title>', '</head>',
        '<body>', '<div class="container">', '<nav class="toc">', '<h1 class="toc-title">Table of Contents</h1>']
MIDDLE = ['</nav>']
TAIL = ['</div>', '</body>', '</html>']
TOC_RESOURCE = '<h2 class="toc-resource-name">%s</h2>'
TOC_PAGE = '<li><a href="#%s">%s</a></li>'
ARTICLE_OPEN = '<article class="article" id="%s">'
ARTICLE_TITLE = '<h1 class="article-title">%s</h1>'
SOURCE_LINE = '<div class="article-source">Source: <a href="%s">%s</a>%s</div>'
PUBLISHED = '<br>Published: %s'
CONTENT_LINE = '<div class="article-content">%s</div>'
ARTICLE_CLOSE = '</article>'


def _e(c, escape: bool):
    return T.escape_html(T.s(c)) if escape else T.s(c)


def digest_lines(pages: DataFrame, resources: DataFrame, escape: bool = False) -> DataFrame:
    """pages(resource_pos, item_pos, title, link, content, page_id, published),
    resources(resource_pos, feed_title) -> lines; resources without pages get none."""
    toc_pages = pages.select(F.lit(1).alias("section"), "resource_pos", "item_pos", F.lit(0).alias("line_no"),
                             F.format_string(TOC_PAGE, "page_id", _e("title", escape)).alias("line"))
    names = (pages.select("resource_pos").distinct()
             .join(resources.select("resource_pos", "feed_title"), "resource_pos", "left")
             .select(F.lit(1).alias("section"), "resource_pos", F.lit(-1).cast("long").alias("item_pos"),
                     F.lit(0).alias("line_no"), F.format_string(TOC_RESOURCE, _e("feed_title", escape)).alias("line")))
    pub = F.when(F.col("published").isNotNull(), F.format_string(PUBLISHED, T.published_label("published"))) \
        .otherwise(F.lit(""))
    src = F.when(T.s("link") != "", F.format_string(SOURCE_LINE, _e("link", escape), _e("link", escape), pub))
    arts = pages.select("resource_pos", "item_pos", F.posexplode(F.array(
        F.format_string(ARTICLE_OPEN, "page_id"),
        F.format_string(ARTICLE_TITLE, _e("title", escape)),
        src,
        F.format_string(CONTENT_LINE, T.s("content")),
        F.lit(ARTICLE_CLOSE))).alias("line_no", "line")).where(F.col("line").isNotNull())
    arts = arts.select(F.lit(3).alias("section"), "resource_pos", "item_pos", "line_no", "line")
    return names.unionByName(toc_pages).unionByName(arts)


def skeleton(spark, title: str) -> DataFrame:
    rows = ([(0, i, (h % title) if "%s" in h else h) for i, h in enumerate(HEAD)]
            + [(2, i, h) for i, h in enumerate(MIDDLE)] + [(4, i, h) for i, h in enumerate(TAIL)])
    return spark.createDataFrame([(s, -1, -1, i, line) for s, i, line in rows],
                                 "section int, resource_pos int, item_pos long, line_no int, line string")


def write_digest(lines: DataFrame, out_dir: str, run_date: str, title: str = "Digest",
                 partitions: int | None = None) -> str:
    """Write ordered lines under <out_dir>/run_date=<yyyy_MM_dd>/ as text parts."""
    spark = lines.sparkSession
    allx = skeleton(spark, title).unionByName(lines)
    key = ["section", "resource_pos", "item_pos", "line_no"]
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = os.path.join(out_dir, f"run_date={run_date}")
    (allx.repartitionByRange(n, *key).sortWithinPartitions(*key).select("line")
     .write.mode("overwrite").text(path))
    return path


def positions(lines: DataFrame, partitions: int | None = None) -> DataFrame:
    """lines plus `position`: the number of each line, from 1, in the whole digest.

    Ranges of the order are sorted apart and written once to the checkpoint
    folder; the lines of the ranges before a line's own come from one count per
    range. No window over all lines or over one resource: a resource of any
    size spans several ranges. Lines of equal keys are ordered by their text.
    """
    n = partitions or int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = ["section", "resource_pos", "item_pos", "line_no", "line"]
    ranged = lines.repartitionByRange(n, *key).sortWithinPartitions(*key).withColumn("_id", F.monotonically_increasing_id())
    ranged = materialize(ranged.select("*", F.shiftright("_id", 33).alias("_range"), F.col("_id").bitwiseAND((1 << 33) - 1).alias("_row")))
    counts = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("n"))  # one row per range
    before = counts.select("_range", (F.sum("n").over(Window.orderBy("_range")) - F.col("n")).alias("_before"))
    return ranged.join(F.broadcast(before), "_range").select(
        *lines.columns, (F.col("_before") + F.col("_row") + 1).alias("position"))


def run_totals(pages: DataFrame) -> DataFrame:
    return pages.agg(F.countDistinct("resource_pos").alias("resources"), F.count(F.lit(1)).alias("pages"))


def pages_per_resource(pages: DataFrame) -> DataFrame:
    return pages.groupBy("resource_pos").agg(F.count(F.lit(1)).alias("n_pages"),
                                             F.min("item_pos").alias("first_item"),
                                             F.max("item_pos").alias("last_item"))
