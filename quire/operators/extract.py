"""Main-content extraction of landed web pages, with native regex Columns.

Contract: the body of the page's <article> (first opening tag to last
closing tag; the whole <body> when there is none), with scripts, styles,
comments, navigation, asides, forms, footers and ad blocks removed. An
empty result is a parse error for the item.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions import text as T

# What counts as boilerplate inside the main block.
ARTICLE_RE = r"(?s)<article\b[^>]*>(.*)</article>"
BODY_RE = r"(?s)<body\b[^>]*>(.*)</body>"
TITLE_RE = r"(?s)<title\b[^>]*>(.*?)</title>"
BOILERPLATE_RE = (r"(?s)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->|<nav\b.*?</nav>|"
                  r"<aside\b.*?</aside>|<form\b.*?</form>|<footer\b.*?</footer>|"
                  r"<div class=\"ad\">.*?</div>")
TAG_RE = r"<[^>]+>"
EMPTY_ERROR = "readability returned empty article for '%s'"


def _main_block(html):
    h = T.s(html)
    main = F.when(h.rlike(ARTICLE_RE), F.regexp_extract(h, ARTICLE_RE, 1)).otherwise(F.regexp_extract(h, BODY_RE, 1))
    clean = F.regexp_replace(F.regexp_replace(main, BOILERPLATE_RE, ""), rf"^[{T.WS_CLASS}]+|[{T.WS_CLASS}]+$", "")
    text_bytes = F.octet_length(F.regexp_replace(F.regexp_replace(clean, TAG_RE, ""), rf"[{T.WS_CLASS}]+", "")) \
        .cast("long")
    return clean, text_bytes


def main_content(html) -> F.Column:
    """HTML of the page's main block, or NULL when it holds no text."""
    clean, text_bytes = _main_block(html)
    return F.when(text_bytes > 0, clean)


def extract_main_content(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """pages -> + title, content (HTML of the main block), text_bytes, error."""
    clean, text_bytes = _main_block(html)
    return (pages.withColumn("_tb", text_bytes)
            .withColumn("title", F.regexp_extract(T.s(html), TITLE_RE, 1))
            .withColumn("content", F.when(F.col("_tb") > 0, clean))
            .withColumnRenamed("_tb", "text_bytes")
            .withColumn("error", F.when(F.col("text_bytes") == 0, F.format_string(EMPTY_ERROR, T.s(url)))))
