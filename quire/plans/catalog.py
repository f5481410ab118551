"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the landed tables (or views Spark derives from them) in
full; `ORACLE` holds the matching DuckDB statement where SQL can state it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators import rules
from quire.plans import oracle as O
from quire import session as SESSION
from quire.session import bounded_broadcast
from quire.sources import tables as S

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _rule_sets():
    return rules.compile_rule_sets(rules.DEFAULT_RULE_SETS)


def _items(spark, sf_dir):
    return S.items_from_documents(S.read(spark, sf_dir, "documents"))


# --- rule sets (F4-F13, C1, C2, C7) -------------------------------------------

@register("rule_report", f"""
SELECT coalesce(reason, 'kept') AS verdict, count(*) AS n
FROM ({O.decided_items()}) GROUP BY 1""")
def rule_report(spark, sf_dir):
    """Flagship: two rule sets in order over every item, reasons counted."""
    decided = rules.apply_rules(_items(spark, sf_dir), rules.FLAGSHIP_LIST, _rule_sets())
    return rules.rejection_report(decided)


@register("rule_decisions", f"""
SELECT item_pos, reason, reason IS NULL AS include FROM ({O.decided_items()})""")
def rule_decisions(spark, sf_dir):
    decided = rules.apply_rules(_items(spark, sf_dir), rules.FLAGSHIP_LIST, _rule_sets())
    return decided.select("item_pos", "reason", "include")


@register("rule_rejections", f"""WITH {O.ITEMS},
t AS (SELECT *, title || ' ' || description AS ftext FROM items),
d AS (SELECT item_pos, link, {O.chain_case(rules.FLAGSHIP_LIST)} AS reason FROM t)
SELECT item_pos, reason, link FROM d WHERE reason IS NOT NULL""")
def rule_rejections(spark, sf_dir):
    """Rejection report (F13): each filtered item with its reason and URL."""
    decided = rules.apply_rules(_items(spark, sf_dir), rules.FLAGSHIP_LIST, _rule_sets())
    return rules.rejections(decided)


@register("rule_checks", r"""
WITH t AS (SELECT doc_id, 'Doc ' || CAST(doc_id AS VARCHAR) || ' ' || coalesce(text, '') AS ftext FROM documents)
SELECT doc_id, strlen(ftext) AS n_bytes,
       len(regexp_extract_all(ftext, '[\p{L}\p{N}]+')) AS n_words,
       len(list_filter(string_split(ftext, chr(10)), lambda l: regexp_matches(l, '[^\t\n\x0B\f\r\x{85}\p{Z}]'))) >= 2 AS paragraphs
FROM t""")
def rule_checks(spark, sf_dir):
    """Single checks (byte length, word count, paragraph test) per document."""
    d = S.read(spark, sf_dir, "documents")
    t = T.filter_text(F.concat(F.lit("Doc "), F.col("doc_id").cast("string")), F.col("text"))
    return d.select("doc_id", T.byte_length(t).cast("long").alias("n_bytes"), T.word_count(t).cast("long").alias("n_words"),
                    T.has_paragraphs(t).alias("paragraphs"))


# Patterns over what the two dialects read differently.
DIALECT = [
    r"the(?i) [A-F]", r"[?+]", r"\++", r"\x{1F600}|\x2e", r"\Q$\E[0-9]", r"\Qa.b\E|\Q(\E[a-z]+\Q)", r"(?m:^[A-Z][a-z]+ [a-z]+.$)",
    r"(?m:^a)|[.]$", r"(?U)a.+e{1,2}", r"\bla\b", r"\Bing\b", r"[[:punct:]]{2}", r"\p{Lu}\p{Ll}+ \p{Lu}", r"[^[:ascii:]]",
    r"(?s)License.*[.]", r"License.*[.]", r"\s$", r"(?i)É|ß|ſ", r"[\d\-]{5,}", r"\A\w+\b", r"x{0,3}y{1}", r"(?P<y>20[0-9]{2})",
    r"[a-c&&[b]]", r"[^\S\n]{2}", r"(?i:[k-m]{2})(?-i)[A-C]?Z", r"e{,2}|\w\x{A}$", r"[]a]b", r"(?i)[^\W_]+[^[:^digit:]]", r"\PL\pN{2}\PL",
    r"a++", r"(?=x)", r"\1", r"a{2000}",
]


@register("pattern_matches", "\nUNION ALL ".join(
    f"SELECT doc_id, {i} AS pattern_no FROM documents WHERE regexp_matches(coalesce(text, ''), {O._q(p)})"
    for i, p in enumerate(DIALECT[:-4])))
def pattern_matches(spark, sf_dir):
    """Patterns in the RE2 dialect over every document: each pattern that a text matches (refused ones match none)."""
    docs = S.read(spark, sf_dir, "documents").select("doc_id", "text")
    return rules.pattern_matches(docs, DIALECT)


@register("kept_pages", f"""
WITH d AS ({O.resource_decided()})
SELECT resource_pos, item_pos, title, link, substr(sha256(link), 1, 16) AS page_id
FROM d WHERE reason IS NULL AND coalesce(enabled, TRUE)""")
def kept_pages(spark, sf_dir):
    """Per-resource rule lists (F11) on enabled resources, kept items with page id."""
    docs = S.read(spark, sf_dir, "documents")
    res = S.resources_from_documents(docs).where(F.coalesce("enabled", F.lit(True)))
    # decisions materialised before filtering, as in run_once: the filter then reads
    # stored reasons instead of being pushed into the join with the rule expressions inlined
    decided = SESSION.materialize(rules.apply_resource_rules(S.items_from_documents(docs), res, _rule_sets(),
                                                             filter_lists=S.FILTER_LISTS))
    return (decided.where("include")
            .select("resource_pos", "item_pos", "title", "link", T.page_id("link").alias("page_id")))


# --- incremental skip, marks, history (J2, F2, A1, W1, T1, A6, D1, D2, D7, J9, J10) --

from quire.operators import incremental as INC  # noqa: E402
from quire.operators import state as ST  # noqa: E402


def _event_run(spark, sf_dir):
    items = S.event_items(S.read(spark, sf_dir, "events"))
    hist = S.event_history(items)
    passed = INC.skip_processed(items, ST.latest_marks(hist))
    feeds_old = hist.select(F.col("feed_url").alias("url"),
                            F.concat(F.lit("user "), F.col("feed_url")).alias("title"), "last_processed_at")
    return items, hist, passed, feeds_old


@register("skip_processed", f"WITH {O.EVENTS} SELECT event_id, feed_url, ts FROM passed")
def skip_processed(spark, sf_dir):
    """Second run over the events: items at or below their feed's mark are skipped."""
    _, _, passed, _ = _event_run(spark, sf_dir)
    return passed.select("event_id", "feed_url", "ts")


@register("include_all", "WITH ev AS (SELECT CAST(user_id AS VARCHAR) AS feed_url, event_id FROM events) "
          "SELECT event_id, feed_url FROM ev")
def include_all(spark, sf_dir):
    """include-all ignores the history: every item passes."""
    items, hist, _, _ = _event_run(spark, sf_dir)
    return INC.skip_processed(items, ST.latest_marks(hist), include_all=True).select("event_id", "feed_url")


@register("run_marks", f"""WITH {O.EVENTS}
SELECT url, title, last_processed_at FROM (
  SELECT feed_url AS url, 'user ' || feed_url AS title, last_processed_at FROM newmarks
  UNION ALL
  SELECT * FROM feeds_old WHERE url NOT IN (SELECT feed_url FROM newmarks))""")
def run_marks(spark, sf_dir):
    """New mark per feed (A1) upserted into the feed table (D1)."""
    _, _, passed, feeds_old = _event_run(spark, sf_dir)
    new = INC.new_marks(passed).select(F.col("feed_url").alias("url"),
                                       F.concat(F.lit("user "), F.col("feed_url")).alias("title"),
                                       "last_processed_at")
    return ST.upsert(feeds_old, new, ["url"])


def _history_after(spark, sf_dir):
    items, hist, passed, feeds_old = _event_run(spark, sf_dir)
    created = items.agg(F.max("ts")).first()[0] + 1
    return ST.append_history(hist, INC.new_marks(passed), created), feeds_old


@register("history_after_run", f"WITH {O.EVENTS} SELECT * FROM hist_after")
def history_after_run(spark, sf_dir):
    """History append (D2): one shared created_at for the rows of a run."""
    h, _ = _history_after(spark, sf_dir)
    return h.select("feed_url", "last_processed_at", "created_at")


@register("history_orphans", f"""WITH {O.EVENTS}
SELECT * FROM hist_after WHERE feed_url NOT IN (SELECT url FROM feeds_old)""")
def history_orphans(spark, sf_dir):
    """History rows whose feed has no feed-table row (declared foreign key)."""
    h, feeds_old = _history_after(spark, sf_dir)
    return ST.history_orphans(h, feeds_old).select("feed_url", "last_processed_at", "created_at")


@register("feed_lookup", f"""WITH {O.EVENTS}
SELECT d.feed_url, f.title, f.last_processed_at FROM (SELECT DISTINCT feed_url FROM ev) d
LEFT JOIN feeds_old f ON d.feed_url = f.url""")
def feed_lookup(spark, sf_dir):
    items, _, _, feeds_old = _event_run(spark, sf_dir)
    return ST.feed_lookup(items.select("feed_url").distinct(), feeds_old)


@register("latest_marks", f"""WITH {O.ORDERS_HISTORY}
SELECT feed_url, last_processed_at FROM (
  SELECT *, row_number() OVER (PARTITION BY feed_url ORDER BY created_at DESC, id DESC) AS rn FROM oh)
WHERE rn = 1""")
def latest_marks(spark, sf_dir):
    """Mark of each feed's newest run (W1) over orders-as-history."""
    return ST.latest_marks(S.orders_history(S.read(spark, sf_dir, "orders")))


@register("latest_generation", f"WITH {O.ORDERS_HISTORY} SELECT max(created_at) AS created_at FROM oh")
def latest_generation(spark, sf_dir):
    return ST.latest_generation_time(S.orders_history(S.read(spark, sf_dir, "orders")))


@register("regenerate_history", f"""WITH {O.ORDERS_HISTORY}
SELECT * FROM oh WHERE created_at <> (SELECT max(created_at) FROM oh)""")
def regenerate_history(spark, sf_dir):
    """Delete the latest generation: every row sharing the global newest created_at (D7)."""
    return ST.delete_latest_generation(S.orders_history(S.read(spark, sf_dir, "orders")))


# --- content cache (J3-J6, W3, D3, D5, A2-A5, C14-C16) -------------------------

from quire.operators import cache as C  # noqa: E402
from quire.operators import content as CT  # noqa: E402

RUN_TIME = 1800000000  # fixed "now" of the bundled cache runs (epoch seconds)


def _cascade(spark, sf_dir):
    # the labelled items feed the run's items and both derived caches: materialise once
    li = SESSION.materialize(S.labelled_items(spark, sf_dir))
    pc, ac = S.derived_parser_cache(li), S.derived_agent_cache(li)
    items = li.drop("quality", "toxic")
    return C.resolve(items, pc, ac, CT.parse_landed), pc, ac


@register("content_cascade", f"""WITH {O.ITEMS}, {O.RESOURCES}, {O.LABELLED}, {O.CASCADE}
SELECT resource_pos, item_pos, content_source, content FROM casc""")
def content_cascade(spark, sf_dir):
    """Agent cache, else parser cache (decoded envelope), else a fresh parse."""
    res, _, _ = _cascade(spark, sf_dir)
    return res.select("resource_pos", "item_pos", "content_source", "content")


@register("cache_stats", f"""WITH {O.ITEMS}, {O.RESOURCES}, {O.LABELLED}
SELECT (SELECT count(*) FROM pc) AS parser_entries, (SELECT count(*) FROM ac) AS agent_entries,
       (SELECT CASE WHEN min(created_at) > 0 THEN min(created_at) END FROM
          (SELECT created_at FROM pc UNION ALL SELECT created_at FROM ac)) AS oldest_entry""")
def cache_stats(spark, sf_dir):
    li = S.labelled_items(spark, sf_dir)
    return C.stats(S.derived_parser_cache(li), S.derived_agent_cache(li))


@register("parser_cache_after_run", f"""WITH {O.ITEMS}, {O.RESOURCES}, {O.LABELLED}, {O.CASCADE},
kept AS (SELECT pc.url, pc.parser_type, li.title, li.description, pc.created_at,
                CASE WHEN EXISTS (SELECT 1 FROM casc c WHERE c.link = pc.url AND c.parser = pc.parser_type AND c.parser_hit)
                     THEN {RUN_TIME} ELSE pc.accessed_at END AS accessed_at, pc.kind
         FROM pc JOIN li ON li.link = pc.url AND li.parser = pc.parser_type),
fresh_rows AS (SELECT c.link AS url, c.parser AS parser_type, li.title, li.description
               FROM casc c JOIN li ON li.link = c.link AND li.parser = c.parser
               WHERE c.content_source = 'parsed')
SELECT url, parser_type, {O.cached('parser_type', 'title', 'description')} AS content, created_at, accessed_at
FROM kept WHERE NOT EXISTS (SELECT 1 FROM fresh_rows f WHERE f.url = kept.url AND f.parser_type = kept.parser_type)
UNION ALL
SELECT url, parser_type,
       CASE WHEN parser_type = 'telegram' THEN {O.chat_html('description')} ELSE {O.cached('parser_type', 'title', 'description')} END,
       {RUN_TIME}, {RUN_TIME}
FROM fresh_rows""")
def parser_cache_after_run(spark, sf_dir):
    """Hits touched (D5), fresh parses stored with reset timestamps (D3); payload decoded (C15)."""
    res, pc, _ = _cascade(spark, sf_dir)
    touched = C.touch(pc, res.where("parser_hit").select(F.col("link").alias("url"), F.col("parser").alias("parser_type")),
                      ["url", "parser_type"], RUN_TIME)
    fresh = res.where(F.col("content_source") == "parsed").select(
        F.col("link").alias("url"), F.col("parser").alias("parser_type"), F.col("fresh_payload").alias("output_data"))
    after = C.put(touched, fresh, ["url", "parser_type"], RUN_TIME)
    return after.select("url", "parser_type", C.decode("output_data", "parser_type").alias("content"),
                        "created_at", "accessed_at")


# --- message channels (S3, S4, F14, F16, T2, T3, C3-C6, C10, A11, S11, A13) ------

from quire.sources import messages as M  # noqa: E402


def _message_items(spark, sf_dir, **options):
    return M.message_items(M.messages_from_conversations(S.read(spark, sf_dir, "conversations")), **options)


@register("message_items", f"""WITH {O.MESSAGES}
SELECT channel, item_pos, title, link, description, published_ts, guid, n_media,
       photo_path, photo_width, photo_height, photo_caption FROM items_m""")
def message_items(spark, sf_dir):
    """Newest 50 per channel, service/empty dropped, byte-cut titles, largest photo size."""
    it = _message_items(spark, sf_dir)
    p = F.try_element_at("media", F.lit(1))
    return it.select("channel", "item_pos", "title", "link", "description",
                     F.unix_seconds("published").alias("published_ts"), "guid",
                     F.size("media").alias("n_media"), p["local_path"].alias("photo_path"),
                     p["width"].alias("photo_width"), p["height"].alias("photo_height"),
                     p["caption"].alias("photo_caption"))


@register("message_render", f"""WITH {O.ALL_MESSAGES}
SELECT item_pos, {O.img_html('photo_path', 'photo_caption', 'photo_width', 'photo_height')} || {O.chat_html('description')} AS content
FROM items_m""")
def message_render(spark, sf_dir):
    """Chat parser over every message: photos (img or error box), then the markup rendered to HTML."""
    it = _message_items(spark, sf_dir, limit=None)
    return it.select("item_pos", CT.render_message("description", "media").alias("content"))


@register("media_manifest", f"""WITH {O.ALL_MESSAGES}
SELECT DISTINCT photo_path AS local_path, regexp_extract(photo_path, '[^/]*$') AS file_name
FROM items_m WHERE photo_path <> ''""")
def media_manifest(spark, sf_dir):
    return M.media_manifest(_message_items(spark, sf_dir, limit=None))


CHANNEL_URL_FORMS = ["https://t.me/%s", "http://t.me/%s/", "t.me/%s", "@%s", "  %s\t", "https://t.me/%s/42"]


@register("channel_names", """
SELECT conv_id, url, CASE WHEN conv_id % 6 = 5 THEN NULL ELSE 'chan' || CAST(conv_id % 10 AS VARCHAR) END AS channel
FROM (SELECT DISTINCT conv_id, CASE conv_id % 6
        WHEN 0 THEN 'https://t.me/chan' || CAST(conv_id % 10 AS VARCHAR)
        WHEN 1 THEN 'http://t.me/chan' || CAST(conv_id % 10 AS VARCHAR) || '/'
        WHEN 2 THEN 't.me/chan' || CAST(conv_id % 10 AS VARCHAR)
        WHEN 3 THEN '@chan' || CAST(conv_id % 10 AS VARCHAR)
        WHEN 4 THEN '  chan' || CAST(conv_id % 10 AS VARCHAR) || chr(9)
        ELSE 'https://t.me/chan' || CAST(conv_id % 10 AS VARCHAR) || '/42' END AS url
      FROM conversations)""")
def channel_names(spark, sf_dir):
    """Channel username from the configured URL forms; deep links are rejected (NULL)."""
    conv = S.read(spark, sf_dir, "conversations").select("conv_id").distinct()
    name = F.concat(F.lit("chan"), (F.col("conv_id") % 10).cast("string"))
    forms = F.array(*[F.format_string(f, name) for f in CHANNEL_URL_FORMS])
    url = F.element_at(forms, (F.col("conv_id") % len(CHANNEL_URL_FORMS) + 1).cast("int"))
    return conv.select("conv_id", url.alias("url")).withColumn("channel", T.channel_name("url"))


@register("channel_feeds", """
SELECT channel, channel AS feed_title,
       CASE WHEN n % 2 = 0 THEN 'Telegram channel @' || channel ELSE 'Notes of ' || channel END AS feed_description
FROM (SELECT DISTINCT 'chan' || CAST(conv_id % 10 AS VARCHAR) AS channel, conv_id % 10 AS n FROM conversations)""")
def channel_feeds(spark, sf_dir):
    """Feed title and description: the about text, else a default sentence."""
    ch = (S.read(spark, sf_dir, "conversations").select((F.col("conv_id") % 10).alias("n")).distinct()
          .select(F.concat(F.lit("chan"), F.col("n").cast("string")).alias("channel"),
                  F.when(F.col("n") % 2 == 0, F.lit("")).otherwise(
                      F.concat(F.lit("Notes of chan"), F.col("n").cast("string"))).alias("about")))
    return M.channel_feed(ch.withColumn("title", F.col("channel")))


# --- subtitles and transcripts (S6, S7, W2, C11-C13, C22-C24) --------------------

from quire.operators import transcripts as TR  # noqa: E402
from quire.sources import subtitles as SUB  # noqa: E402


def _segments(spark, sf_dir):
    return SUB.segments(SUB.vtt_lines_from_conversations(S.read(spark, sf_dir, "conversations")))


@register("subtitle_segments", f"""WITH {O.SUBTITLES}
SELECT file_id, seg_pos, start, "end", text FROM segs""")
def subtitle_segments(spark, sf_dir):
    """Cue segments of one subtitle file per conversation (header/NOTE skipped, tags removed)."""
    return _segments(spark, sf_dir)


@register("transcript_render", f"""WITH {O.SUBTITLES}
SELECT file_id, '# Conversation ' || CAST(file_id AS VARCHAR) || chr(10) || chr(10) || '**Language:** en'
       || chr(10) || chr(10) || '## Transcription' || chr(10) || chr(10)
       || string_agg(printf('[%02d:%02d] %s', CAST(trunc(start) AS BIGINT) // 60, CAST(trunc(start) AS BIGINT) % 60, text)
                     || chr(10) || chr(10), '' ORDER BY seg_pos) AS content
FROM segs GROUP BY file_id""")
def transcript_render(spark, sf_dir):
    """Transcription rendered as title, language and '[mm:ss] text' lines."""
    segs = _segments(spark, sf_dir)
    titles = segs.select("file_id").distinct().select(
        "file_id", F.concat(F.lit("Conversation "), F.col("file_id").cast("string")).alias("title"),
        F.lit("en").alias("language"))
    tr = SUB.transcripts(segs, titles).where(F.size("segments") > 0)
    return tr.select("file_id", T.render_transcript("title", "language", "segments").alias("content"))


def _expected(spark, sf_dir):
    conv = S.read(spark, sf_dir, "conversations")
    st = F.col("turn") * 5
    raw = F.concat(F.lit("["), F.format_string("%02d:%02d:%02d", (st / 3600).cast("int"), ((st % 3600) / 60).cast("int"),
                                               (st % 60).cast("int")),
                   F.lit("] "), F.replace(T.s("text"), F.lit("\n"), F.lit(" ")))
    return TR.parse_expected(conv.select(F.col("conv_id").alias("file_id"), "turn", raw.alias("raw")))


@register("transcript_similarity", f"""WITH {O.SUBTITLES}, {O.SIMILARITY}
SELECT file_id, n_expected, n_actual, common,
       CASE WHEN n_expected = 0 AND n_actual = 0 THEN 1.0 WHEN n_expected = 0 OR n_actual = 0 THEN 0.0
            ELSE least(n_actual / n_expected, n_expected / n_actual) * 0.3 + common / n_expected * 0.7 END AS similarity
FROM sim""")
def transcript_similarity(spark, sf_dir):
    """Expected '[HH:MM:SS] text' segments against the parsed subtitles, per conversation."""
    exp = _expected(spark, sf_dir).select("file_id", "text")
    act = _segments(spark, sf_dir).select("file_id", "text")
    return TR.similarity(exp, act, key="file_id")


@register("pair_similarity", f"""WITH
ew AS (SELECT item_id, w, count(*) AS n FROM (SELECT item_id, unnest({O._norm_words("coalesce(text, '')")}) AS w FROM benchmark) GROUP BY ALL),
aw AS (SELECT doc_id, w, count(*) AS n FROM (SELECT doc_id, unnest({O._norm_words("coalesce(text, '')")}) AS w FROM documents) GROUP BY ALL),
h AS (SELECT w, count(*) AS df FROM aw GROUP BY w),
r AS (SELECT item_id, w FROM (SELECT item_id, w, row_number() OVER (PARTITION BY item_id ORDER BY df, w) AS k FROM ew JOIN h USING (w)) WHERE k <= 8),
p AS (SELECT item_id, doc_id FROM r JOIN aw USING (w) GROUP BY item_id, doc_id
      HAVING count(*) >= least(3, (SELECT count(*) FROM r x WHERE x.item_id = r.item_id))),
c AS (SELECT p.item_id, p.doc_id, coalesce(sum(aw.n) FILTER (ew.w IS NOT NULL), 0) AS common, sum(aw.n) AS n_actual
      FROM p JOIN aw USING (doc_id) LEFT JOIN ew ON ew.item_id = p.item_id AND ew.w = aw.w GROUP BY ALL),
t AS (SELECT item_id, sum(n) AS n_expected FROM ew GROUP BY item_id)
SELECT item_id, doc_id, CAST(n_expected AS BIGINT) AS n_expected, CAST(n_actual AS BIGINT) AS n_actual, CAST(common AS BIGINT) AS common,
       least(n_actual / n_expected, n_expected / n_actual) * 0.3 + common / n_expected * 0.7 AS similarity FROM c JOIN t USING (item_id)""")
def pair_similarity(spark, sf_dir):
    """Benchmark items against the documents that share their rarest words: the similarity score over differing texts."""
    exp = S.read(spark, sf_dir, "benchmark").select(F.col("item_id").alias("e"), "text")
    act = S.read(spark, sf_dir, "documents").select(F.col("doc_id").alias("a"), "text")
    return TR.pair_similarity(exp, act).select(F.col("e").alias("item_id"), F.col("a").alias("doc_id"),
                                               "n_expected", "n_actual", "common", "similarity")


@register("transcript_validity", f"""WITH {O.SUBTITLES}
SELECT file_id, count(*) AS n_segments, CAST(sum(CASE WHEN start < 0 THEN 1 ELSE 0 END) AS BIGINT) AS bad_start,
       CAST(sum(CASE WHEN "end" <= start THEN 1 ELSE 0 END) AS BIGINT) AS bad_timing,
       CAST(sum(CASE WHEN regexp_replace(text, '^{O.WS}+|{O.WS}+$', '', 'g') = '' THEN 1 ELSE 0 END) AS BIGINT) AS blank_text
FROM segs GROUP BY file_id""")
def transcript_validity(spark, sf_dir):
    return TR.validity(_segments(spark, sf_dir))


@register("subtitle_choice", """
WITH f AS (SELECT DISTINCT source AS video,
             source || '.' || lang || CASE WHEN n_chars % 2 = 0 THEN '.auto' ELSE '' END || '.vtt' AS name FROM documents)
SELECT video, arg_min(name, (CASE WHEN contains(name, '.en.') AND NOT contains(name, '.auto.') THEN 0
                                  WHEN contains(name, '.auto.') OR contains(name, '.en.') THEN 1 ELSE 2 END, name)) AS name
FROM f GROUP BY video""")
def subtitle_choice(spark, sf_dir):
    """Subtitle file per video: manual English, else automatic, else any (by name)."""
    d = S.read(spark, sf_dir, "documents")
    name = F.concat(F.col("source"), F.lit("."), F.col("lang"),
                    F.when(F.col("n_chars") % 2 == 0, F.lit(".auto")).otherwise(F.lit("")), F.lit(".vtt"))
    return SUB.choose_file(d.select(F.col("source").alias("video"), name.alias("name")).distinct())


# --- page extraction (S5, E6) ----------------------------------------------------

from quire.operators import config as CFG  # noqa: E402
from quire.operators import errors as ERR  # noqa: E402
from quire.operators import extract as EX  # noqa: E402
from quire.operators import readability as RD  # noqa: E402

_BP = EX.BOILERPLATE_RE.replace("'", "''")


@register("page_extract", f"""
WITH p AS (SELECT page_id, url, coalesce(html, '') AS h FROM pages),
m AS (SELECT *, CASE WHEN regexp_matches(h, '{EX.ARTICLE_RE}') THEN regexp_extract(h, '{EX.ARTICLE_RE}', 1)
                     ELSE regexp_extract(h, '{EX.BODY_RE}', 1) END AS main FROM p),
c AS (SELECT *, regexp_replace(regexp_replace(main, '{_BP}', '', 'g'), '^{O.WS}+|{O.WS}+$', '', 'g') AS clean FROM m),
t AS (SELECT *, strlen(regexp_replace(regexp_replace(clean, '<[^>]+>', '', 'g'), '{O.WS}+', '', 'g')) AS text_bytes FROM c)
SELECT page_id, url, regexp_extract(h, '{EX.TITLE_RE}', 1) AS title,
       CASE WHEN text_bytes > 0 THEN clean END AS content, text_bytes,
       CASE WHEN text_bytes = 0 THEN 'readability returned empty article for ''' || coalesce(url, '') || '''' END AS error
FROM t""")
def page_extract(spark, sf_dir):
    """Main block of every landed page, boilerplate removed; empty result is an error."""
    return EX.extract_main_content(S.read(spark, sf_dir, "pages")).drop("html")


@register("web_items_content", f"""
WITH x AS ({ORACLE["page_extract"]})
SELECT 100 + list_position(['en', 'fr', 'de', 'es'], regexp_extract(url, '^https?://[^/]+/([a-z]{{2}})/', 1)) AS resource_pos,
       page_id AS item_pos, content, CASE WHEN content IS NULL THEN error END AS parse_error
FROM x""")
def web_items_content(spark, sf_dir):
    """Web-feed items read their landed page (link = url) and keep its main block (S5, E5, E6)."""
    pages = S.read(spark, sf_dir, "pages")
    items = S.items_from_pages(pages).withColumn("parser", F.lit("web"))
    return CT.parse_with_pages(pages)(items).select("resource_pos", "item_pos", F.col("fresh").alias("content"),
                                                    "parse_error")


_P = "array_to_string(list_transform(string_split({0}, '<'), lambda x: CASE WHEN contains(x, '>') THEN substr(x, strpos(x, '>') + 1) ELSE x END), '')"


@register("page_main", f"""
WITH a AS (SELECT page_id, url, coalesce(string_split(string_split(html, '<title>')[2], '</title>')[1], '') AS title,
                  string_split(string_split(html, '<article')[2], '</article>')[1] AS inside FROM pages),
c AS (SELECT *, trim(substr(inside, strpos(inside, '>') + 1), ' ' || chr(9) || chr(10) || chr(13)) AS content FROM a),
t AS (SELECT *, strlen(regexp_replace({_P.format("content")}, '{O.WS}+', '', 'g')) AS text_bytes FROM c)
SELECT page_id, url, title, CASE WHEN text_bytes > 0 THEN content END AS content, coalesce(text_bytes, 0) AS text_bytes,
       CASE WHEN text_bytes > 0 THEN 'article' END AS rule FROM t""")
def page_main(spark, sf_dir):
    """Main content of every landed page by the stack pass, and the rule that chose it.

    The statement states the pages of the test tables, whose articles hold nothing that is left out.
    """
    return RD.with_main_content(S.read(spark, sf_dir, "pages")).drop("html")


# --- error triage and retry schedule (C19-C21, A12) --------------------------------

ERROR_TEMPLATES = [  # fixed values: API error messages, %d = whole part of the event value
    "RESOURCE_EXHAUSTED: please retry in %d.5s",
    "Error 429: rate limit exceeded",
    "Error 503: service unavailable, retryDelay:%ds",
    "invalid input",
    "authentication failed",
    "googleapi: Error 500: retry in %ds.",
    "quota exceeded: retry in 1s2s then retryDelay:%ds",
    "deadline exceeded after %ds",
]


def _api_errors(spark, sf_dir):
    ev = S.read(spark, sf_dir, "events").where(F.col("event_type") == "error")
    v = F.floor("value").cast("int")
    k = (F.col("event_id") % len(ERROR_TEMPLATES)).cast("int")
    msg = None
    for i, tpl in enumerate(ERROR_TEMPLATES):
        m = F.format_string(tpl, v) if "%d" in tpl else F.lit(tpl)
        msg = F.when(k == i, m) if msg is None else msg.when(k == i, m)
    return ev.select("event_id", msg.alias("message"), (F.col("event_id") % 11).alias("attempt"))


def _tpl_sql() -> str:
    whens = []
    for i, tpl in enumerate(ERROR_TEMPLATES):
        parts = tpl.split("%d")
        expr = " || CAST(CAST(floor(value) AS INTEGER) AS VARCHAR) || ".join(O._q(p) for p in parts)
        whens.append(f"WHEN {i} THEN {expr}")
    return f"CASE event_id % {len(ERROR_TEMPLATES)} " + " ".join(whens) + " END"


def _dur_sql(x: str, frac: bool) -> str:
    num = r"(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)" if frac else r"[0-9]+"
    valid = f"(regexp_matches({x}, '^(?:{num}s)+$') OR {x} = '0')"
    total = f"coalesce(list_sum(list_transform(list_filter(string_split({x}, 's'), lambda p: p <> ''), lambda p: CAST(p AS DOUBLE))), 0.0)"
    return f"CASE WHEN {x} <> '' AND {valid} THEN {total} END"


@register("error_triage", f"""
WITH e AS (SELECT event_id, {_tpl_sql()} AS message, event_id % 11 AS attempt FROM events WHERE event_type = 'error'),
d AS (SELECT *, regexp_extract(message, 'retry in ([0-9.s]*)', 1) AS a, regexp_extract(message, 'retryDelay:([0-9s]*)', 1) AS b FROM e),
v AS (SELECT *, coalesce({_dur_sql('a', True)}, {_dur_sql('b', False)}, 0.0) AS delay_s FROM d)
SELECT event_id, message, attempt,
       regexp_matches(lower(message), '{T.RETRYABLE_RE}') AS retryable, delay_s,
       CASE WHEN delay_s > 0 THEN least(delay_s, 30.0) ELSE least(pow(2.0, attempt), 30.0) END AS backoff_s
FROM v""")
def error_triage(spark, sf_dir):
    """Transient-error test, suggested delay and backoff per failed agent call."""
    return ERR.triage(_api_errors(spark, sf_dir))


@register("error_counts", f"""
WITH e AS (SELECT event_id, {_tpl_sql()} AS message FROM events WHERE event_type = 'error'),
x AS ({ORACLE["page_extract"]})
SELECT stage, count(*) AS n FROM (
  SELECT 'agent' AS stage FROM e WHERE NOT regexp_matches(lower(message), '{T.RETRYABLE_RE}')
  UNION ALL SELECT 'fetch' FROM (SELECT DISTINCT conv_id FROM conversations) WHERE conv_id % 6 = 5
  UNION ALL SELECT 'parse' FROM x WHERE error IS NOT NULL) GROUP BY stage""")
def error_counts(spark, sf_dir):
    """Error table of a run (fetch, parse, agent stages) counted by stage."""
    agent = ERR.triage(_api_errors(spark, sf_dir)).where(~F.col("retryable")).select(F.lit("agent").alias("stage"))
    fetch = channel_names(spark, sf_dir).where(F.col("channel").isNull()).select(F.lit("fetch").alias("stage"))
    parse = page_extract(spark, sf_dir).where(F.col("error").isNotNull()).select(F.lit("parse").alias("stage"))
    return ERR.counts_by_stage(agent.unionByName(fetch).unionByName(parse))


# --- configuration (S8, S12, F1, F17, A7, A8) --------------------------------------

def _resources(spark, sf_dir):
    return S.resources_from_documents(S.read(spark, sf_dir, "documents"))


@register("enabled_resources", f"""WITH {O.RESOURCES}
SELECT resource_pos, feed_url, parser, type, array_to_string(agents, ',') AS agents,
       array_to_string(filters, ',') AS filters FROM resources WHERE coalesce(enabled, TRUE)""")
def enabled_resources(spark, sf_dir):
    return CFG.enabled(_resources(spark, sf_dir)).select(
        "resource_pos", "feed_url", "parser", "type", F.array_join("agents", ",").alias("agents"),
        F.array_join("filters", ",").alias("filters"))


@register("agent_types", f"""WITH {O.RESOURCES}
SELECT DISTINCT unnest(agents) AS agent FROM resources WHERE coalesce(enabled, TRUE)""")
def agent_types(spark, sf_dir):
    return CFG.agent_types(_resources(spark, sf_dir))


@register("parser_types", f"""WITH {O.RESOURCES}
SELECT DISTINCT parser FROM resources WHERE coalesce(enabled, TRUE)""")
def parser_types(spark, sf_dir):
    return CFG.parser_types(_resources(spark, sf_dir))


@register("unknown_types", f"""WITH {O.RESOURCES}
SELECT resource_pos, 'type' AS kind, type AS value FROM resources
WHERE coalesce(enabled, TRUE) AND type NOT IN ('rss', 'telegram_channel')
UNION ALL SELECT resource_pos, 'parser', parser FROM resources
WHERE coalesce(enabled, TRUE) AND parser NOT IN ('web', 'telegram', 'youtube')""")
def unknown_types(spark, sf_dir):
    """Dispatch check: enabled resources naming an unregistered source or parser type."""
    return CFG.unknown_types(spark, _resources(spark, sf_dir))


# --- agents (E1-E4, E8) -------------------------------------------------------------

from quire.operators import enrich as EN  # noqa: E402

FAST_RETRY = EN.RetryPolicy(max_retries=10, initial_backoff=0.0, max_backoff=0.0, timeout=60.0)


@register("agent_chain", f"""WITH {O.ITEMS}, {O.RESOURCES}, {O.LABELLED}, {O.CASCADE}
SELECT resource_pos, item_pos, pipeline,
       CASE WHEN contains(content, 'License') THEN content ELSE 'summary: ' || content END AS output,
       CASE WHEN contains(content, 'License') THEN 'failed' ELSE 'ok' END AS status,
       CASE WHEN contains(content, 'License') OR pipeline = 'summary,format' THEN 1 ELSE 0 END AS n_errors
FROM casc WHERE pipeline <> '' AND NOT agent_hit""")
def agent_chain(spark, sf_dir):
    """Agent chains over cache misses: unknown agents skipped, failures stop the chain."""
    res, _, _ = _cascade(spark, sf_dir)
    todo = res.where((F.col("pipeline") != "") & ~F.col("agent_hit")).select(
        "resource_pos", "item_pos", "pipeline", "agents", "content")
    out = EN.enrich(todo, EN.stand_in_registry, FAST_RETRY)
    return out.select("resource_pos", "item_pos", "pipeline", F.col("enriched").alias("output"),
                      F.col("agent_status").alias("status"), F.size("agent_errors").alias("n_errors"))


@register("agent_requests", f"""WITH {O.ITEMS}, {O.RESOURCES}, {O.LABELLED}, {O.CASCADE}
SELECT resource_pos, item_pos, replace({O._q(EN.SUMMARY_PROMPT)}, '{{{{content}}}}', content) AS request
FROM casc WHERE contains(pipeline, 'summary') AND NOT agent_hit""")
def agent_requests(spark, sf_dir):
    """Prompt requests of the summary agent: the template with the content filled in."""
    res, _, _ = _cascade(spark, sf_dir)
    return (res.where(F.array_contains("agents", "summary") & ~F.col("agent_hit"))
            .select("resource_pos", "item_pos", EN.prompt_request("content").alias("request")))


# --- syndication documents (S1, S2, S13) ---------------------------------------------

import os  # noqa: E402
import uuid  # noqa: E402

from quire import session as SESSION  # noqa: E402
from quire.operators import digest as DG  # noqa: E402
from quire.sources import feeds as FD  # noqa: E402


def _rss_item() -> F.Column:
    date = F.concat(F.lit("<pubDate>"), F.date_format("published", "EEE, dd MMM yyyy HH:mm:ss Z"), F.lit("</pubDate>"))
    return F.concat(F.lit("<item><title>"), F.col("title"), F.lit("</title><link>"), F.col("link"), F.lit("</link><description>"),
                    FD.xml_escape("description"), F.lit("</description><guid>"), F.col("guid"), F.lit("</guid>"),
                    F.coalesce(date, F.lit("")), F.lit("</item>"))


def _feed_documents(spark, sf_dir):
    """One landed feed document per document row: RSS for even ids, Atom for odd ids;
    the document of an item labelled toxic arrives cut short (malformed)."""
    toxic = bounded_broadcast(S.read(spark, sf_dir, "labels").where(F.col("toxic") == 1)
                              .select(F.col("doc_id").alias("item_pos"), F.lit(True).alias("_cut")))
    it = (_items(spark, sf_dir).join(toxic, "item_pos", "left")
          .withColumn("source", F.regexp_extract("link", r"^https://example\.com/([^/]+)/", 1)))
    d = F.col("item_pos")
    pub = F.col("published")
    iso = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ssXXX")
    atom_date = (F.when(pub.isNull(), F.lit(""))
                 .when(d % 4 == 1, F.concat(F.lit("<updated>"), iso(pub), F.lit("</updated>")))
                 .otherwise(F.concat(F.lit("<published>"), iso(pub), F.lit("</published><updated>"),
                                     iso(pub + F.expr("INTERVAL 1 DAY")), F.lit("</updated>"))))
    desc = FD.xml_escape("description")
    rss = F.concat(F.lit('<rss version="2.0"><channel><title>'), F.col("source"), F.lit("</title><description>Feed "),
                   F.col("source"), F.lit("</description>"), _rss_item(), F.lit("</channel></rss>"))
    atom = F.concat(F.lit("<feed><title>"), F.col("source"), F.lit("</title><entry><title>"), F.col("title"),
                    F.lit('</title><link href="'), F.col("link"), F.lit('"/><summary>'), desc, F.lit("</summary><id>"),
                    F.col("guid"), F.lit("</id>"), atom_date, F.lit("</entry></feed>"))
    xml = F.when(F.col("_cut"), F.expr("substring(xml_doc, 1, length(xml_doc) - 20)")).otherwise(F.col("xml_doc"))
    return it.select(F.col("item_pos").alias("feed_id"), "_cut", F.when(d % 2 == 0, rss).otherwise(atom).alias("xml_doc")) \
        .select("feed_id", xml.alias("xml"))


@register("feed_items", f"""WITH {O.ITEMS}
SELECT regexp_extract(link, '^https://example\\.com/([^/]+)/', 1) AS feed_title, item_pos, title, link, description,
       CASE WHEN ts IS NULL THEN NULL ELSE ts END AS published_ts, guid
FROM items WHERE item_pos NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)""")
def feed_items(spark, sf_dir):
    """RSS items and Atom entries parsed from landed XML; date = published, else updated."""
    _, items, _ = FD.parse(_feed_documents(spark, sf_dir))
    return items.select(
        "feed_title", F.col("guid").cast("long").alias("item_pos"), "title", "link", "description",
        F.unix_seconds("published").alias("published_ts"), "guid")


@register("feed_items_large", f"""WITH {O.ITEMS}
SELECT regexp_extract(link, '^https://example\\.com/([^/]+)/', 1) AS feed_title, item_pos, title, link, description,
       ts AS published_ts, guid FROM items""")
def feed_items_large(spark, sf_dir):
    """One landed RSS document per feed with all its items, read an item a record by many tasks."""
    root = os.path.join(SESSION.checkpoint_dir(spark), f"feeds-{uuid.uuid4().hex}")
    it = _items(spark, sf_dir).withColumn("source", F.regexp_extract("link", r"^https://example\.com/([^/]+)/", 1))
    feeds = it.select("source").distinct()
    head = F.concat(F.lit('<rss version="2.0"><channel><title>'), F.col("source"), F.lit("</title>"))
    lines = (it.select("source", F.lit(1).alias("k"), _rss_item().alias("value"))
             .unionByName(feeds.select("source", F.lit(0).alias("k"), head.alias("value")))
             .unionByName(feeds.select("source", F.lit(2).alias("k"), F.lit("</channel></rss>").alias("value"))))
    (lines.repartition("source").sortWithinPartitions("source", "k").select("source", "value")
     .write.partitionBy("source").text(root))
    found, items, _ = FD.read_large(spark, root)
    return items.join(found, "feed_id").select(
        "feed_title", F.col("guid").cast("long").alias("item_pos"), "title", "link", "description",
        F.unix_seconds("published").alias("published_ts"), "guid")


@register("feed_errors", "SELECT count(*) AS n FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def feed_errors(spark, sf_dir):
    """Malformed feed documents become error rows; the other feeds go on."""
    _, _, errors = FD.parse(_feed_documents(spark, sf_dir))
    return errors.agg(F.count(F.lit(1)).alias("n"))


# --- digest (S10, A9, A10, T4, C17, F15) ----------------------------------------------

def _digest_pages(spark, sf_dir):
    docs = S.read(spark, sf_dir, "documents")
    res = CFG.enabled(S.resources_from_documents(docs))
    kept = SESSION.materialize(rules.apply_resource_rules(S.items_from_documents(docs), res, _rule_sets(),
                                                          filter_lists=S.FILTER_LISTS)).where("include")
    casc, _, _ = _cascade(spark, sf_dir)
    pages = kept.select("resource_pos", "item_pos", "title", "link", "published").join(
        casc.select("resource_pos", "item_pos", "content"), ["resource_pos", "item_pos"])
    # several consumers per query (contents, headers, articles, totals): cut the lineage once
    return SESSION.materialize(pages.withColumn("page_id", T.page_id("link"))), res


@register("digest_lines", f"""WITH {O.digest_pages()}
SELECT 1 AS section, resource_pos, CAST(-1 AS BIGINT) AS item_pos, 0 AS line_no,
       '<h2 class="toc-resource-name">' || feed_title || '</h2>' AS line
FROM (SELECT DISTINCT resource_pos FROM dpages) JOIN resources USING (resource_pos)
UNION ALL SELECT 1, resource_pos, item_pos, 0, '<li><a href="#' || page_id || '">' || title || '</a></li>' FROM dpages
UNION ALL SELECT 3, resource_pos, item_pos, 0, '<article class="article" id="' || page_id || '">' FROM dpages
UNION ALL SELECT 3, resource_pos, item_pos, 1, '<h1 class="article-title">' || title || '</h1>' FROM dpages
UNION ALL SELECT 3, resource_pos, item_pos, 2, '<div class="article-source">Source: <a href="' || link || '">' || link || '</a>'
       || CASE WHEN ts IS NULL THEN '' ELSE '<br>Published: ' || strftime(make_timestamp(ts * 1000000), '%Y-%m-%d %H:%M:%S') || ' UTC' END
       || '</div>' FROM dpages WHERE link <> ''
UNION ALL SELECT 3, resource_pos, item_pos, 3, '<div class="article-content">' || content || '</div>' FROM dpages
UNION ALL SELECT 3, resource_pos, item_pos, 4, '</article>' FROM dpages""")
def digest_lines(spark, sf_dir):
    """Ordered digest lines: contents per non-empty resource, then one article per page."""
    pages, res = _digest_pages(spark, sf_dir)
    return DG.digest_lines(pages, res)


@register("digest_positions", f"""SELECT section, resource_pos, item_pos, line_no, line,
       row_number() OVER (ORDER BY section, resource_pos, item_pos, line_no, line) AS position
FROM ({ORACLE["digest_lines"]}) lines""")
def digest_positions(spark, sf_dir):
    """Every digest line with its number in the whole digest."""
    pages, res = _digest_pages(spark, sf_dir)
    return DG.positions(DG.digest_lines(pages, res))


@register("run_totals", f"""WITH {O.digest_pages()}
SELECT count(DISTINCT resource_pos) AS resources, count(*) AS pages FROM dpages""")
def run_totals(spark, sf_dir):
    pages, _ = _digest_pages(spark, sf_dir)
    return DG.run_totals(pages)


@register("pages_per_resource", f"""WITH {O.digest_pages()}
SELECT resource_pos, count(*) AS n_pages, min(item_pos) AS first_item, max(item_pos) AS last_item
FROM dpages GROUP BY resource_pos""")
def pages_per_resource(spark, sf_dir):
    pages, _ = _digest_pages(spark, sf_dir)
    return DG.pages_per_resource(pages)


# --- streaming marks (K1, K3, K5) ------------------------------------------------------

from quire.streaming import marks as SM  # noqa: E402


@register("stream_marks", """
SELECT CAST(user_id AS VARCHAR) AS url, max(CAST(epoch_us(ts) // 1000000 AS BIGINT)) AS last_processed_at
FROM events GROUP BY 1 HAVING max(CAST(epoch_us(ts) // 1000000 AS BIGINT)) > 0""")
def stream_marks(spark, sf_dir):
    """Events land as time slices; a foreachBatch stream keeps per-feed marks; final feed table."""
    root = os.path.join(SESSION.checkpoint_dir(spark), f"stream-{uuid.uuid4().hex}")
    items = S.event_items(S.read(spark, sf_dir, "events"))
    lo_hi = items.agg(F.min("ts"), F.max("ts")).first()
    width = max(1, (lo_hi[1] - lo_hi[0] + 1) // 4 + 1)
    (items.withColumn("slice", ((F.col("ts") - lo_hi[0]) / width).cast("int"))
     .repartition(4, "slice").write.partitionBy("slice").parquet(os.path.join(root, "landing")))
    stream = (spark.readStream.schema("feed_url string, event_id long, ts long, slice int")
              .option("maxFilesPerTrigger", 1).parquet(os.path.join(root, "landing")))
    store = ST.StateStore(spark, os.path.join(root, "state"))
    q, job = SM.run(spark, stream, store, os.path.join(root, "checkpoint"))
    q.awaitTermination()
    return job.feed_state().select("url", "last_processed_at")


# --- keyed streaming state (K2) -----------------------------------------------------------

from quire.streaming import keyed as SK  # noqa: E402

SLICES = 3  # landing slices of the streams


@register("stream_marks_keyed", """
SELECT CAST(user_id AS VARCHAR) AS feed_url, max(CAST(epoch_us(ts) // 1000000 AS BIGINT)) AS last_processed_at
FROM events GROUP BY 1 HAVING max(CAST(epoch_us(ts) // 1000000 AS BIGINT)) > 0""")
def stream_marks_keyed(spark, sf_dir):
    """Time slices streamed through per-feed ValueState; marks of the passed items."""
    root = os.path.join(SESSION.checkpoint_dir(spark), f"keyed-{uuid.uuid4().hex}")
    items = S.event_items(S.read(spark, sf_dir, "events"))
    lo_hi = items.agg(F.min("ts"), F.max("ts")).first()
    width = max(1, (lo_hi[1] - lo_hi[0] + 1) // 4 + 1)
    (items.withColumn("slice", ((F.col("ts") - lo_hi[0]) / width).cast("int"))
     .repartition(4, "slice").write.partitionBy("slice").parquet(os.path.join(root, "landing")))
    stream = (spark.readStream.schema("feed_url string, event_id long, ts long, slice int")
              .option("maxFilesPerTrigger", 1).parquet(os.path.join(root, "landing")))
    out = os.path.join(root, "passed")
    q = (SK.passed_items(stream).writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", os.path.join(root, "checkpoint")).trigger(availableNow=True).start())
    q.awaitTermination()
    passed = spark.read.schema("feed_url string, event_id long, ts long").parquet(out)
    return INC.new_marks(passed)


def _late_slices(spark, sf_dir):
    """(feed table of the first half, items of the second half by landing slice): some items land a slice late, some twice."""
    items = S.event_items(S.read(spark, sf_dir, "events"))
    first = S.event_history(items).select("feed_url", "last_processed_at")
    lo, hi = (F.col(c) for c in ("_lo", "_hi"))
    ends = items.agg(((F.min("ts") + F.max("ts")) / 2).cast("long").alias("_lo"), F.max("ts").alias("_hi"))
    late = F.when(F.col("event_id") % 17 == 5, 1).otherwise(0)
    slice_ = F.least(F.lit(SLICES - 1), F.floor((F.col("ts") - lo - 1) * SLICES / (hi - lo)) + late).cast("int")
    after = items.join(F.broadcast(ends), F.col("ts") > lo).withColumn("slice", slice_).drop("_lo", "_hi")
    again = after.where((F.col("event_id") % 23 == 3) & (F.col("slice") < SLICES - 1)).withColumn("slice", F.col("slice") + 1)
    return first, after.unionByName(again)


@register("stream_marks_handover", f"""WITH
i AS (SELECT CAST(user_id AS VARCHAR) AS feed_url, event_id, CAST(epoch_us(ts) // 1000000 AS BIGINT) AS ts FROM events),
e AS (SELECT CAST(floor((min(ts) + max(ts)) / 2) AS BIGINT) AS lo, max(ts) AS hi FROM i),
first AS (SELECT feed_url, max(ts) AS mark FROM i, e WHERE ts <= lo GROUP BY feed_url),
s AS (SELECT feed_url, event_id, ts, CAST(least({SLICES} - 1, floor((ts - lo - 1) * {SLICES} / (hi - lo))
        + CASE WHEN event_id % 17 = 5 THEN 1 ELSE 0 END) AS INTEGER) AS slice FROM i, e WHERE ts > lo),
landed AS (SELECT * FROM s UNION ALL SELECT feed_url, event_id, ts, slice + 1 FROM s WHERE event_id % 23 = 3 AND slice < {SLICES} - 1),
m AS (SELECT *, max(ts) OVER (PARTITION BY feed_url ORDER BY slice RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM landed),
p AS (SELECT m.feed_url, m.ts FROM m LEFT JOIN first f USING (feed_url) WHERE m.ts <= 0 OR m.ts > greatest(coalesce(m.before, 0), coalesce(f.mark, 0)))
SELECT feed_url, max(ts) FILTER (ts > 0) AS last_processed_at, CAST(sum(n) AS BIGINT) AS n_passed
FROM (SELECT feed_url, mark AS ts, 0 AS n FROM first UNION ALL SELECT feed_url, ts, 1 FROM p) GROUP BY feed_url""")
def stream_marks_handover(spark, sf_dir):
    """The feed table of a batch run over the first half is handed to keyed state, which takes up the rest.

    Each slice lands and the stream is started again from its checkpoint; late and replayed items are skipped.
    """
    root = os.path.join(SESSION.checkpoint_dir(spark), f"handover-{uuid.uuid4().hex}")
    first, items = _late_slices(spark, sf_dir)
    marks, items = SESSION.materialize(first), SESSION.materialize(items)
    landing, out = os.path.join(root, "landing"), os.path.join(root, "passed")
    for k in range(SLICES):
        items.where(F.col("slice") == k).drop("slice").write.parquet(os.path.join(landing, f"slice={k}"))
        stream = spark.readStream.schema(SK.PASSED_SCHEMA).parquet(landing).drop("slice")
        SK.run(stream, out, os.path.join(root, "checkpoint"), marks).awaitTermination()
    return SK.marks_after(spark.read.schema(SK.PASSED_SCHEMA).parquet(out), marks)


# --- whole runs: a stream of commits, errors by stage (K1, K3, K5, S10, S13, A12, D2) ------

from quire.plans import run as RUN  # noqa: E402
from quire.streaming import runs as SRUN  # noqa: E402


def _landed_slices(items: DataFrame):
    """The items in the order they land: slices by position; some come one slice late."""
    lo, hi = items.agg(F.min("item_pos"), F.max("item_pos")).first()
    width = (hi - lo) // SLICES + 1
    late = F.when(F.col("item_pos") % 17 == 5, 1).otherwise(0)
    return items.withColumn("slice", F.least(F.lit(SLICES - 1), F.floor((F.col("item_pos") - lo) / width) + late).cast("int"))


@register("stream_run_pages", f"""WITH d AS ({O.resource_decided()}), {O.RESOURCES},
w AS (SELECT min(doc_id) AS lo, (max(doc_id) - min(doc_id)) // {SLICES} + 1 AS width FROM documents),
k AS (SELECT d.*, r.parser, least({SLICES - 1}, (item_pos - lo) // width + CASE WHEN item_pos % 17 = 5 THEN 1 ELSE 0 END) AS slice
      FROM d JOIN resources r USING (resource_pos), w WHERE reason IS NULL AND coalesce(d.enabled, TRUE)),
m AS (SELECT *, max(ts) OVER (PARTITION BY resource_pos ORDER BY slice RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mark FROM k)
SELECT resource_pos, item_pos, title, link, substr(sha256(link), 1, 16) AS page_id, {O.fresh()} AS content
FROM m WHERE NOT coalesce(ts > 0 AND ts <= coalesce(mark, 0), FALSE)""")
def stream_run_pages(spark, sf_dir):
    """Whole runs over a stream of items, one commit a batch: the pages that the committed batches delivered.

    Items that arrive late, at or below the mark their feed has by then, are skipped.
    """
    root = os.path.join(SESSION.checkpoint_dir(spark), f"runs-{uuid.uuid4().hex}")
    docs = S.read(spark, sf_dir, "documents")
    items = _landed_slices(S.items_from_documents(docs))
    store = ST.StateStore(spark, os.path.join(root, "state"))
    landing = os.path.join(root, "landing")
    opts = RUN.RunOptions(now=RUN_TIME, out_dir=os.path.join(root, "out"), keep_pages=True)
    resources = SESSION.materialize(S.resources_from_documents(docs))
    for k in range(SLICES):  # a slice lands, the stream takes it up as one batch
        items.where(F.col("slice") == k).drop("slice").write.parquet(os.path.join(landing, f"slice={k}"))
        stream = spark.readStream.schema(items.drop("slice").schema).parquet(landing).drop("slice")
        q, _ = SRUN.run(spark, stream, resources, _rule_sets(), store, opts, os.path.join(root, "checkpoint"))
        q.awaitTermination()
    return store.read("pages", RUN.PAGES_SCHEMA).select("resource_pos", "item_pos", "title", "link", "page_id", "content")


def _landed_pages(spark, sf_dir):
    """Fetched pages of the item links: one in four was not landed, one in four has no main content."""
    d = F.col("item_pos")
    body = F.when(d % 4 == 1, F.lit("<article> </article>")).otherwise(
        F.concat(F.lit("<article><p>"), FD.xml_escape("description"), F.lit("</p></article>")))
    return _items(spark, sf_dir).where(d % 4 != 0).select(
        F.col("link").alias("url"), F.concat(F.lit("<html><body>"), body, F.lit("</body></html>")).alias("html"))


@register("run_errors", f"""WITH d AS ({O.resource_decided()}), {O.RESOURCES},
bad AS (SELECT doc_id FROM labels WHERE toxic = 1),
i AS (SELECT d.*, r.parser, array_to_string(r.agents, ',') AS pipeline FROM d JOIN resources r USING (resource_pos)
      WHERE coalesce(d.enabled, TRUE) AND item_pos NOT IN (SELECT doc_id FROM bad)),
k AS (SELECT *, parser = 'web' AND item_pos % 4 IN (0, 1) AS unread FROM i WHERE reason IS NULL)
SELECT 'rejected' AS kind, count(*) AS n FROM i WHERE reason IS NOT NULL
UNION ALL SELECT 'errors_fetch', count(*) FROM bad JOIN documents USING (doc_id)
UNION ALL SELECT 'errors_parse', count(*) FROM k WHERE unread
UNION ALL SELECT 'errors_agent', count(*) FROM k WHERE NOT unread AND pipeline <> ''
          AND (pipeline = 'summary,format' OR contains(description, 'License'))
UNION ALL SELECT 'pages', count(*) FROM k WHERE NOT unread""")
def run_errors(spark, sf_dir):
    """A run over landed feeds, pages and agents: rejections, pages and errors of each stage, counted as they are written."""
    _, parsed, broken = FD.parse(_feed_documents(spark, sf_dir))
    items = parsed.select(S.source_number("feed_title").alias("resource_pos"), F.col("guid").cast("long").alias("item_pos"),
                          "title", "link", "description", "published", "guid")
    docs = S.read(spark, sf_dir, "documents")
    store = RUN.state_store(spark, f"errors-{uuid.uuid4().hex}")
    opts = RUN.RunOptions(now=RUN_TIME, make_registry=EN.stand_in_registry, policy=FAST_RETRY)
    unread = broken.select(F.lit(None).cast("int").alias("resource_pos"), "message")
    res = RUN.run_once(spark, items, S.resources_from_documents(docs), _rule_sets(), store, opts,
                       parse=CT.parse_with_pages(_landed_pages(spark, sf_dir)), fetch_errors=unread)
    return SESSION.local_table(spark, [(k, res.info[k]) for k in ("rejected", "errors_fetch", "errors_parse", "errors_agent", "pages")],
                               "kind string, n long")


@register("agent_cache_after_run", f"""WITH d AS ({O.resource_decided()}), {O.RESOURCES},
k AS (SELECT d.*, r.parser, array_to_string(r.agents, ',') AS pipeline FROM d JOIN resources r USING (resource_pos)
      WHERE reason IS NULL AND coalesce(d.enabled, TRUE)),
c AS (SELECT *, {O.fresh()} AS content FROM k WHERE pipeline <> '')
SELECT link AS url, parser AS parser_type, pipeline AS agent_pipeline,
       CASE WHEN contains(content, 'License') THEN content ELSE 'summary: ' || content END AS output_data,
       CASE WHEN contains(content, 'License') THEN 'failed' WHEN pipeline = 'summary,format' THEN 'incomplete' ELSE 'ok' END AS status
FROM c""")
def agent_cache_after_run(spark, sf_dir):
    """The agent cache that a run leaves (D4): finished chains, chains that failed part way, chains that skipped a name."""
    docs = S.read(spark, sf_dir, "documents")
    store = RUN.state_store(spark, f"agents-{uuid.uuid4().hex}")
    opts = RUN.RunOptions(now=RUN_TIME, make_registry=EN.stand_in_registry, policy=FAST_RETRY)
    RUN.run_once(spark, S.items_from_documents(docs), S.resources_from_documents(docs), _rule_sets(), store, opts)
    return store.read("agent_cache", C.AGENT_CACHE_STORED, RUN.AGENT_KEYS).select(
        "url", "parser_type", "agent_pipeline", "output_data", "status")


# --- links that several feeds carry (J3-J6, W3, S9) -----------------------------------------

@register("repeated_links", f"""WITH {O.ITEMS}, {O.RESOURCES},
i AS (SELECT i.* EXCLUDE (link), 'https://example.com/shared/' || item_pos % 97 AS link, item_pos % 97 AS k, r.parser,
             array_to_string(r.agents, ',') AS pipeline FROM items i JOIN resources r USING (resource_pos)),
a AS (SELECT *, pipeline = 'summary' AND k % 7 = 0 AS agent_hit, k % 5 = 0 AND parser <> 'youtube' AS stored FROM i),
f AS (SELECT link, parser, arg_min({O.fresh()}, CAST(resource_pos AS BIGINT) * 1000000000 + item_pos) AS fresh FROM a WHERE NOT agent_hit GROUP BY link, parser)
SELECT resource_pos, item_pos, link, parser,
       CASE WHEN agent_hit THEN 'agent_cache' WHEN stored THEN 'parser_cache' ELSE 'parsed' END AS content_source,
       CASE WHEN agent_hit THEN 'agent ' || link WHEN stored THEN CASE WHEN k % 10 = 0 THEN 'new ' ELSE 'old ' END || link ELSE fresh END AS content
FROM a LEFT JOIN f USING (link, parser)""")
def repeated_links(spark, sf_dir):
    """Items of several feeds and agent lists that share links: stored results by key, and one parse per (link, parser)."""
    docs = S.read(spark, sf_dir, "documents")
    res = S.resources_from_documents(docs).select("resource_pos", "parser", "agents")
    items = S.items_from_documents(docs).withColumn(
        "link", F.concat(F.lit(S.LINK_BASE + "shared/"), (F.col("item_pos") % 97).cast("string"))).join(res, "resource_pos")
    items = SESSION.materialize(items)
    store = RUN.state_store(spark, f"links-{uuid.uuid4().hex}")
    k = F.regexp_extract("link", r"(\d+)$", 1).cast("int")
    keys = items.select("link", "parser").distinct().withColumn("k", k)
    stamps = (F.lit(1).cast("long").alias("created_at"), F.lit(1).cast("long").alias("accessed_at"))
    for word, every in (("old ", 5), ("new ", 10)):  # two commits; the second stores some links again
        rows = keys.where((F.col("k") % every == 0) & (F.col("parser") != "youtube")).select(
            F.col("link").alias("url"), F.col("parser").alias("parser_type"),
            C.encode_html("parser", F.concat(F.lit(word), F.col("link"))).alias("output_data"), *stamps)
        store.append("parser_cache", rows, bucket_by="url")
    stored = keys.where(F.col("k") % 7 == 0).select(
        F.col("link").alias("url"), F.col("parser").alias("parser_type"), F.lit("summary").alias("agent_pipeline"),
        F.concat(F.lit("agent "), F.col("link")).alias("output_data"), *stamps, F.lit("ok").alias("status"))
    store.append("agent_cache", stored, bucket_by="url")
    links = items.select(F.col("link").alias("url")).distinct()
    pc = store.read_for("parser_cache", C.PARSER_CACHE_SCHEMA, RUN.PARSER_KEYS, links)
    ac = store.read_for("agent_cache", C.AGENT_CACHE_STORED, RUN.AGENT_KEYS, links)
    return C.resolve(items, pc, ac, CT.parse_landed).select("resource_pos", "item_pos", "link", "parser", "content_source", "content")
