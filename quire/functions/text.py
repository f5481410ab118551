"""Column functions (Column -> Column). All run inside whole-stage codegen.

Byte semantics: the rule engine measures lengths in UTF-8 bytes, so lengths use
`octet_length` and the title cut works on the binary form.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values --------------------------------------------------------------
# Unicode White_Space as seen by a Unicode-aware TrimSpace: ASCII controls,
# NEL and the Z categories (space, line and paragraph separators).
WS_CLASS = r"\t\n\x0B\f\r\x{85}\p{Z}"
WORD_RE = r"[\p{L}\p{N}]+"
# Two non-blank lines: a non-space char, the rest of its line, a newline, and a
# later non-space char. Anchored so that the scan starts only once.
PARAGRAPHS_RE = rf"\A[{WS_CLASS}]*[^{WS_CLASS}][^\n]*\n(?s:.)*?[^{WS_CLASS}]"
ZERO_TIME_UNIX = -62135596800  # seconds of 0001-01-01T00:00:00Z ("no date")
TITLE_MAX_BYTES = 100
ELLIPSIS = "..."
RETRYABLE_RE = r"resource_exhausted|quota exceeded|rate limit|429|503|500"
# Chat markup rules, applied in this order after HTML escaping.
CHAT_RULES = [
    (r"```([^`]+)```", "<pre><code>$1</code></pre>"),
    (r"`([^`]+)`", "<code>$1</code>"),
    (r"\*\*([^\*]+)\*\*", "<strong>$1</strong>"),
    (r"__([^_]+)__", "<em>$1</em>"),
    (r"~~([^~]+)~~", "<del>$1</del>"),
    (r"\[([^\]]+)\]\(([^\)]+)\)", '<a href="$2">$1</a>'),
]
HTML_ESCAPES = [("&", "&amp;"), ("'", "&#39;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&#34;")]
# ---------------------------------------------------------------------------


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def s(x) -> Column:
    """Go strings are never NULL: read NULL as the empty string."""
    return F.coalesce(_c(x), F.lit(""))


def filter_text(title, description) -> Column:
    return F.concat(s(title), F.lit(" "), s(description))


def byte_length(x) -> Column:
    return F.octet_length(_c(x))


_W, _NW = r"[\p{L}\p{N}]", r"[^\p{L}\p{N}]"


def word_count(x) -> Column:
    """Runs of letters/numbers. Each word and the gap after it collapse to one
    char, so the count is a length, without materialising the words."""
    c = _c(x)
    return F.when(c.rlike(_W), F.length(F.regexp_replace(c, f"{_NW}*{_W}+{_NW}*", "x"))).otherwise(F.lit(0))


def has_paragraphs(x) -> Column:
    return _c(x).rlike(PARAGRAPHS_RE)


def unix_ts(published) -> Column:
    """Epoch seconds of an item's date; undated items get the zero time."""
    return F.coalesce(F.unix_seconds(_c(published)), F.lit(ZERO_TIME_UNIX))


def page_id(link) -> Column:
    return F.substring(F.sha2(s(link), 256), 1, 16)


def escape_html(x) -> Column:
    c = _c(x)
    for a, b in HTML_ESCAPES:
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def chat_to_html(x) -> Column:
    t = s(x)
    c = escape_html(t)
    for pat, rep in CHAT_RULES:
        c = F.regexp_replace(c, pat, rep)
    c = F.replace(c, F.lit("\n"), F.lit("<br>\n"))
    return F.when(t == "", F.lit("")).otherwise(F.concat(F.lit("<p>"), c, F.lit("</p>")))


def truncate_bytes(x, max_bytes: int = TITLE_MAX_BYTES) -> Column:
    """Cut to `max_bytes` bytes, back up to the last space when it lies past
    half of the limit, and append '...'. A cut inside a multi-byte character
    is repaired to U+FFFD."""
    t = s(x)
    b = F.substring(t.cast("binary"), 1, max_bytes)
    tail = F.substring_index(b.cast("string"), " ", -1)
    idx = F.octet_length(b) - F.octet_length(tail) - 1
    cut = F.when(idx > max_bytes // 2, F.substring(b, F.lit(1), idx)).otherwise(b)
    out = F.make_valid_utf8(F.concat(cut, F.lit(ELLIPSIS).cast("binary")).cast("string"))
    return F.when(F.octet_length(t) <= max_bytes, t).otherwise(out)


def channel_name(url) -> Column:
    """Channel username from a channel URL, or NULL when it is not usable."""
    u = F.regexp_replace(s(url), rf"^[{WS_CLASS}]+|[{WS_CLASS}]+$", "")
    for prefix in (r"^https://", r"^http://", r"^t\.me/", r"^@"):
        u = F.regexp_replace(u, prefix, "")
    u = F.regexp_replace(u, r"/\z", "")
    return F.when((u == "") | u.contains("/"), F.lit(None).cast("string")).otherwise(u)


def permalink(channel, msg_id) -> Column:
    return F.format_string("https://t.me/%s/%d", _c(channel), _c(msg_id))


def published_label(published) -> Column:
    return F.coalesce(F.date_format(_c(published), "yyyy-MM-dd HH:mm:ss 'UTC'"), F.lit(""))


def run_date(ts) -> Column:
    return F.date_format(_c(ts), "yyyy_MM_dd")


def media_basename(path) -> Column:
    return F.element_at(F.split(s(path), "/"), -1)


# Errors and retries ---------------------------------------------------------

def is_retryable(msg) -> Column:
    return F.coalesce(F.lower(_c(msg)).rlike(RETRYABLE_RE), F.lit(False))


def _seconds_of(dur: Column, allow_fraction: bool) -> Column:
    num = r"(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)" if allow_fraction else r"[0-9]+"
    valid = dur.rlike(rf"^(?:{num}s)+$") | (dur == "0")
    parts = F.filter(F.split(dur, "s"), lambda p: p != "")
    total = F.aggregate(parts, F.lit(0.0), lambda acc, p: acc + p.cast("double"))
    return F.when(valid, F.when(dur == "0", F.lit(0.0)).otherwise(total))


def retry_delay_seconds(msg) -> Column:
    """Suggested delay in an API error: 'retry in <d>' first, then 'retryDelay:<d>'."""
    m = s(msg)
    a = F.regexp_extract(m, r"retry in ([0-9.s]*)", 1)
    b = F.regexp_extract(m, r"retryDelay:([0-9s]*)", 1)
    va = _seconds_of(a, True)
    vb = _seconds_of(b, False)
    return (F.when((a != "") & va.isNotNull(), va)
            .when((b != "") & vb.isNotNull(), vb)
            .otherwise(F.lit(0.0)))


def backoff_seconds(attempt, msg, initial: float = 1.0, cap: float = 30.0) -> Column:
    base = F.least(F.lit(initial) * F.pow(F.lit(2.0), _c(attempt).cast("double")), F.lit(cap))
    d = retry_delay_seconds(msg)
    return F.when(d > 0, F.least(d, F.lit(cap))).otherwise(base)


# Subtitles and transcripts -------------------------------------------------

def vtt_seconds(x) -> Column:
    """H:M:S, M:S or S (comma as decimal mark) to seconds."""
    p = F.split(F.replace(_c(x), F.lit(","), F.lit(".")), ":")
    n = F.size(p)
    g = lambda i: F.element_at(p, i)
    return (F.when(n == 3, g(1).try_cast("long") * 3600 + g(2).try_cast("long") * 60 + g(3).try_cast("double"))
            .when(n == 2, g(1).try_cast("long") * 60 + g(2).try_cast("double"))
            .otherwise(g(1).try_cast("double")))


def render_transcript(title, language, segments) -> Column:
    lines = F.transform(
        _c(segments),
        lambda seg: F.format_string(
            "[%02d:%02d] %s\n\n",
            F.floor(seg["start"].cast("long") / 60).cast("long"),
            F.pmod(seg["start"].cast("long"), F.lit(60)),
            seg["text"]))
    return F.concat(F.lit("# "), s(title), F.lit("\n\n**Language:** "), s(language),
                    F.lit("\n\n## Transcription\n\n"), F.array_join(lines, ""))


def normalise_words(x) -> Column:
    """Lower-case, drop all but ASCII word/space chars, split on spaces."""
    t = F.regexp_replace(F.lower(s(x)), r"[^\w\t\n\f\r ]+", "")  # \w spelt out as ranges takes many times as long
    return F.array_remove(F.split(t, r"[\t\n\f\r ]+"), "")
