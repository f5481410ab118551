"""DuckDB statements that state each registered query independently.

DuckDB's regex engine is RE2, the dialect the rule sets are written in, so
patterns go in unchanged here while Spark sees their Java translation.
"""

from __future__ import annotations

from quire.operators.rules import DEFAULT_RULE_SETS, FLAGSHIP_LIST

ITEMS = r"""items AS (
  SELECT CAST(regexp_extract(source, '(\d+)$', 1) AS INTEGER) AS resource_pos,
         doc_id AS item_pos,
         'Doc ' || CAST(doc_id AS VARCHAR) AS title,
         'https://example.com/' || source || '/' || CAST(doc_id AS VARCHAR) AS link,
         coalesce(text, '') AS description,
         CASE WHEN doc_id % 10 = 0 THEN NULL ELSE 1704067200 + 3600 * doc_id END AS ts,
         CAST(doc_id AS VARCHAR) AS guid
  FROM documents)"""

RESOURCES = r"""resources AS (
  SELECT resource_pos,
         'https://example.com/' || source || '/feed' AS feed_url,
         source AS feed_title,
         ['web', 'telegram', 'youtube'][resource_pos % 3 + 1] AS parser,
         CASE WHEN resource_pos % 3 = 1 THEN 'telegram_channel' ELSE 'rss' END AS type,
         CASE (resource_pos // 3) % 3 WHEN 0 THEN []::VARCHAR[] WHEN 1 THEN ['summary']
              ELSE ['summary', 'format'] END AS agents,
         CASE WHEN resource_pos % 5 = 0 THEN NULL ELSE resource_pos % 5 <> 4 END AS enabled,
         CASE resource_pos % 4 WHEN 0 THEN []::VARCHAR[] WHEN 1 THEN ['quality']
              WHEN 2 THEN ['quality', 'privacy'] ELSE ['privacy', 'missing'] END AS filters
  FROM (SELECT DISTINCT CAST(regexp_extract(source, '(\d+)$', 1) AS INTEGER) AS resource_pos, source
        FROM documents))"""

NS = r"[^\t\n\x0B\f\r\x{85}\p{Z}]"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def rule_case(name: str, text: str = "ftext") -> str:
    c = DEFAULT_RULE_SETS[name]
    whens = []
    if c.get("min_length", 0) > 0:
        whens.append(f"WHEN strlen({text}) < {c['min_length']} THEN {_q(name + ':min_length')}")
    if c.get("min_words", 0) > 0:
        whens.append(f"WHEN len(regexp_extract_all({text}, '[\\p{{L}}\\p{{N}}]+')) < {c['min_words']} "
                     f"THEN {_q(name + ':min_words')}")
    for p in c.get("exclude_patterns", []):
        if "(?=" in p:  # RE2 refuses look-ahead: the pattern is dropped
            continue
        whens.append(f"WHEN regexp_matches({text}, {_q(p)}) THEN {_q(name + ':exclude_pattern[' + p + ']')}")
    if c.get("require_paragraphs"):
        whens.append(f"WHEN len(list_filter(string_split({text}, chr(10)), lambda l: regexp_matches(l, '{NS}'))) < 2 "
                     f"THEN {_q(name + ':require_paragraphs')}")
    return "CASE " + " ".join(whens) + " END"


def chain_case(names: list[str], text: str = "ftext") -> str:
    parts = [rule_case(n, text) for n in names if n in DEFAULT_RULE_SETS]
    if not parts:
        return "CAST(NULL AS VARCHAR)"
    return parts[0] if len(parts) == 1 else "coalesce(" + ", ".join(parts) + ")"


def decided_items() -> str:
    return f"""WITH {ITEMS},
    t AS (SELECT *, title || ' ' || description AS ftext FROM items)
    SELECT item_pos, resource_pos, {chain_case(FLAGSHIP_LIST)} AS reason FROM t"""


def resource_decided() -> str:
    cases = []
    for lst in ([], ["quality"], ["quality", "privacy"], ["privacy", "missing"]):
        cases.append(f"WHEN array_to_string(r.filters, ',') = {_q(','.join(lst))} THEN {chain_case(lst)}")
    return f"""WITH {ITEMS}, {RESOURCES},
    t AS (SELECT i.*, i.title || ' ' || i.description AS ftext, r.filters, r.enabled FROM items i JOIN resources r USING (resource_pos))
    SELECT t.*, CASE {' '.join(cases).replace('r.filters', 't.filters')} END AS reason FROM t"""

EVENTS = r"""ev AS (SELECT CAST(user_id AS VARCHAR) AS feed_url, event_id,
                  CAST(epoch_us(ts) // 1000000 AS BIGINT) AS ts FROM events),
cut AS (SELECT (min(ts) + max(ts)) // 2 AS c FROM ev),
hist AS (SELECT CAST(feed_url AS BIGINT) AS id, feed_url, max(ts) AS last_processed_at,
                (SELECT c FROM cut) AS created_at
         FROM ev WHERE ts <= (SELECT c FROM cut) GROUP BY feed_url),
passed AS (SELECT e.* FROM ev e LEFT JOIN hist h USING (feed_url)
           WHERE NOT (e.ts > 0 AND e.ts <= coalesce(h.last_processed_at, 0))),
newmarks AS (SELECT feed_url, max(ts) AS last_processed_at FROM passed GROUP BY feed_url HAVING max(ts) > 0),
feeds_old AS (SELECT feed_url AS url, 'user ' || feed_url AS title, last_processed_at FROM hist),
hist_after AS (SELECT feed_url, last_processed_at, created_at FROM hist
               UNION ALL
               SELECT feed_url, last_processed_at, (SELECT max(ts) + 1 FROM ev) AS created_at FROM newmarks)"""

ORDERS_HISTORY = r"""oh AS (SELECT o_orderkey AS id, CAST(o_custkey AS VARCHAR) AS feed_url,
                  CAST(trunc(o_totalprice) AS BIGINT) AS last_processed_at,
                  CAST(epoch_us(o_orderdate) // 1000000 AS BIGINT) AS created_at FROM orders)"""

NL = "chr(10)"

LABELLED = r"""li AS (SELECT i.*, r.parser, r.agents, array_to_string(r.agents, ',') AS pipeline, l.quality, l.toxic
       FROM items i JOIN resources r USING (resource_pos) LEFT JOIN labels l ON l.doc_id = i.item_pos),
pc AS (SELECT link AS url, parser AS parser_type, item_pos AS created_at, item_pos AS accessed_at,
              CASE WHEN quality = 0 AND toxic = 0 THEN 'bad' WHEN quality = 0 THEN 'other' ELSE 'ok' END AS kind
       FROM li WHERE quality IS NOT NULL),
ac AS (SELECT link AS url, parser AS parser_type,
              CASE WHEN quality = 1 THEN pipeline ELSE 'legacy' END AS agent_pipeline,
              '[' || CASE WHEN quality = 1 THEN pipeline ELSE 'legacy' END || '] ' || description AS output_data,
              item_pos + 1000000 AS created_at, item_pos + 1000000 AS accessed_at
       FROM li WHERE toxic = 0)"""


def chat_html(col: str) -> str:
    e = f"replace(replace(replace(replace(replace({col}, '&', '&amp;'), '''', '&#39;'), '<', '&lt;'), '>', '&gt;'), '\"', '&#34;')"
    rules = [(r"```([^`]+)```", r"<pre><code>\1</code></pre>"), (r"`([^`]+)`", r"<code>\1</code>"),
             (r"\*\*([^\*]+)\*\*", r"<strong>\1</strong>"), (r"__([^_]+)__", r"<em>\1</em>"),
             (r"~~([^~]+)~~", r"<del>\1</del>"), (r"\[([^\]]+)\]\(([^\)]+)\)", r'<a href="\2">\1</a>')]
    for p, r in rules:
        e = f"regexp_replace({e}, {_q(p)}, {_q(r)}, 'g')"
    e = f"replace({e}, {NL}, '<br>' || {NL})"
    return f"CASE WHEN coalesce({col}, '') = '' THEN '' ELSE '<p>' || {e} || '</p>' END"


def one_segment_transcript(title: str, text: str) -> str:
    return (f"'# ' || {title} || {NL} || {NL} || '**Language:** en' || {NL} || {NL} || '## Transcription' || {NL} || {NL}"
            f" || '[00:00] ' || {text} || {NL} || {NL}")


def fresh(parser: str = "parser", title: str = "title", text: str = "description") -> str:
    return (f"CASE WHEN {parser} = 'youtube' THEN {one_segment_transcript(title, text)} "
            f"WHEN {parser} = 'telegram' THEN {chat_html(text)} ELSE {text} END")


def cached(parser: str = "parser", title: str = "title", text: str = "description") -> str:
    return f"CASE WHEN {parser} = 'youtube' THEN {one_segment_transcript(title, text)} ELSE {text} END"


CASCADE = f"""casc AS (
  SELECT li.resource_pos, li.item_pos, li.link, li.parser, li.pipeline,
         (ac.output_data IS NOT NULL AND li.pipeline <> '') AS agent_hit,
         (pc.kind IS NOT NULL AND NOT (ac.output_data IS NOT NULL AND li.pipeline <> '')) AS parser_hit,
         CASE WHEN ac.output_data IS NOT NULL AND li.pipeline <> '' THEN 'agent_cache'
              WHEN pc.kind = 'ok' THEN 'parser_cache' ELSE 'parsed' END AS content_source,
         CASE WHEN ac.output_data IS NOT NULL AND li.pipeline <> '' THEN ac.output_data
              WHEN pc.kind = 'ok' THEN {cached('li.parser', 'li.title', 'li.description')}
              ELSE {fresh('li.parser', 'li.title', 'li.description')} END AS content
  FROM li LEFT JOIN ac ON ac.url = li.link AND ac.parser_type = li.parser AND ac.agent_pipeline = li.pipeline
          LEFT JOIN pc ON pc.url = li.link AND pc.parser_type = li.parser)"""

MESSAGES = r"""m0 AS (
  SELECT 'chan' || CAST(conv_id % 10 AS VARCHAR) AS channel, conv_id * 100 + turn AS msg_id, turn,
         1704067200 + conv_id * 100 + turn AS date,
         CASE WHEN role = 'system' THEN 'service' ELSE 'message' END AS kind,
         CASE WHEN turn % 6 = 5 THEN '' ELSE coalesce(text, '') END AS text
  FROM conversations),
m1 AS (
  SELECT *, CASE WHEN msg_id % 5 = 0 THEN 'photo' WHEN msg_id % 5 = 1 AND turn > 2 THEN 'document' END AS media_kind,
         CASE WHEN msg_id % 5 = 0 AND msg_id % 4 <> 0 THEN
           [{'type': 's', 'w': 90, 'h': 90}, {'type': 'm', 'w': 320, 'h': CAST(240 + msg_id % 7 AS INTEGER)},
            {'type': 'x', 'w': CAST(800 - msg_id % 3 * 80 AS INTEGER), 'h': 600}, {'type': 'y', 'w': 640, 'h': 750}]
         END AS sizes,
         msg_id % 3 <> 0 AS download_ok
  FROM m0),
m2 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY channel ORDER BY msg_id DESC) AS rn FROM m1)
       WHERE rn <= 50 AND kind = 'message'),
m3 AS (SELECT *, list_max(list_filter(list_transform(sizes, lambda s, i: {'px': s.w * s.h, 'npos': -i, 'w': s.w, 'h': s.h}),
                                      lambda x: x.px > 0)) AS best FROM m2),
m4 AS (SELECT *, CASE WHEN media_kind = 'photo' THEN 1 ELSE 0 END AS n_media,
         CASE WHEN media_kind = 'photo' AND best IS NOT NULL AND download_ok
              THEN 'telegram-media/photo_' || CAST(msg_id AS VARCHAR) || '_' || CAST(msg_id * 7 AS VARCHAR) || '.jpg'
              WHEN media_kind = 'photo' THEN '' END AS photo_path,
         CASE WHEN media_kind = 'photo' THEN coalesce(best.w, 0) END AS photo_width,
         CASE WHEN media_kind = 'photo' THEN coalesce(best.h, 0) END AS photo_height,
         CASE WHEN media_kind <> 'photo' OR media_kind IS NULL THEN NULL
              WHEN best IS NULL THEN 'Error downloading photo: no suitable photo size found'
              WHEN NOT download_ok THEN 'Error downloading photo: failed to download photo: download interrupted'
              ELSE '' END AS photo_caption,
         encode(text)[1:100] AS b FROM m3),
m5 AS (SELECT *, CASE WHEN regexp_matches(hex(b), '^(?:[0-9A-F]{2})*20')
                      THEN strlen(regexp_extract(hex(b), '^((?:[0-9A-F]{2})*)20', 1)) // 2 ELSE -1 END AS idx FROM m4),
m6 AS (SELECT *, CASE WHEN idx > 50 THEN b[1:idx] ELSE b END AS cut FROM m5),
m7 AS (SELECT *, coalesce(try(decode(cut)),
                 decode(from_hex(regexp_replace(hex(cut), '^((?:[0-9A-F]{2})*?)[C-F][0-9A-F](?:[89AB][0-9A-F]){0,2}$', '\1')))
                 || chr(65533)) AS cutstr FROM m6),
mi AS (SELECT channel, msg_id AS item_pos,
         CASE WHEN text <> '' THEN (CASE WHEN strlen(text) <= 100 THEN text ELSE cutstr || '...' END)
              WHEN n_media = 1 THEN 'Photo' WHEN n_media > 1 THEN 'Album (' || n_media || ' photos)' ELSE '' END AS title,
         'https://t.me/' || channel || '/' || CAST(msg_id AS VARCHAR) AS link,
         text AS description, date AS published_ts, CAST(msg_id AS VARCHAR) AS guid,
         n_media, photo_path, photo_width, photo_height, photo_caption
       FROM m7),
items_m AS (SELECT * FROM mi WHERE NOT (title = '' AND n_media = 0))"""

# every message, not only the newest of each channel
ALL_MESSAGES = MESSAGES.replace("rn <= 50 AND ", "")


def img_html(path: str, caption: str, w: str, h: str) -> str:
    esc = (f"replace(replace(replace(replace(replace({caption}, '&', '&amp;'), '''', '&#39;'), '<', '&lt;'), "
           f"'>', '&gt;'), '\"', '&#34;')")
    img = (f"'<img src=\"media/' || regexp_extract({path}, '[^/]*$') || '\" alt=\"' || {esc} || "
           f"'\" style=\"max-width: 100%; height: auto; margin-bottom: 1em;\" width=\"' || CAST({w} AS VARCHAR) || "
           f"'\" height=\"' || CAST({h} AS VARCHAR) || '\">' || chr(10)")
    box = (f"'<div style=\"padding: 1em; background: #fee; border: 1em solid #fcc; margin-bottom: 1em;\">' || {esc} || "
           f"'</div>' || chr(10)")
    return (f"CASE WHEN {path} IS NULL THEN '' WHEN {path} <> '' THEN {img} "
            f"WHEN {caption} <> '' THEN {box} ELSE '' END")

STRIP = r"[\t\n\x0B\f\r\x{85}\p{Z}\x1C-\x1F]"
TIMING = r"^([0-9:.,]+)[\t\n\x0B\f\r \x1C-\x1F\x{85}\p{Z}]*-->[\t\n\x0B\f\r \x1C-\x1F\x{85}\p{Z}]*([0-9:.,]+)"


def _stamp(sec: str) -> str:
    hms = f"printf('%02d:%02d:%06.3f', {sec} // 3600, ({sec} % 3600) // 60, CAST({sec} % 60 AS DOUBLE))"
    ms = f"printf('%02d:%06.3f', {sec} // 60, CAST({sec} % 60 AS DOUBLE))"
    return f"CASE WHEN style = 0 THEN {hms} WHEN style = 1 THEN replace({ms}, '.', ',') ELSE {ms} END"


def _secs(x: str) -> str:
    p = f"string_split(replace({x}, ',', '.'), ':')"
    return (f"CASE len({p}) WHEN 3 THEN TRY_CAST({p}[1] AS BIGINT) * 3600 + TRY_CAST({p}[2] AS BIGINT) * 60 + TRY_CAST({p}[3] AS DOUBLE) "
            f"WHEN 2 THEN TRY_CAST({p}[1] AS BIGINT) * 60 + TRY_CAST({p}[2] AS DOUBLE) "
            f"ELSE TRY_CAST({p}[1] AS DOUBLE) END")


SUBTITLES = f"""cl AS (SELECT conv_id AS file_id, turn, text, conv_id % 3 AS style, turn * 5 AS st, turn * 5 + 4 AS en
       FROM conversations),
stamps AS (SELECT *, {_stamp('st')} AS a, {_stamp('en')} AS b FROM cl),
fl AS (SELECT file_id, turn,
         (CASE WHEN turn = 0 THEN (CASE WHEN file_id % 4 = 0 THEN ['WEBVTT', '', 'NOTE timing --> checked', '']
                                        ELSE ['WEBVTT', ''] END) ELSE []::VARCHAR[] END)
         || [CAST(turn + 1 AS VARCHAR), a || ' --> ' || b]
         || list_transform(string_split(coalesce(text, ''), chr(10)),
                           lambda x, i: CASE WHEN i = 1 AND turn % 2 = 0 THEN regexp_replace(x, '^(\\S+)', '<i>\\1</i>') ELSE x END)
         || [''] AS lines FROM stamps),
ln AS (SELECT file_id, turn * 100000 + generate_subscripts(lines, 1) - 1 AS pos, unnest(lines) AS line FROM fl),
l1 AS (SELECT *, contains(line, '-->') AS arrow,
              regexp_replace(line, '^{STRIP}+|{STRIP}+$', '', 'g') AS s FROM ln),
l2 AS (SELECT *, s = '' AS blank,
              sum(CASE WHEN arrow THEN 1 ELSE 0 END) OVER (PARTITION BY file_id ORDER BY pos
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS grp FROM l1),
l3 AS (SELECT *, max(CASE WHEN blank THEN 1 ELSE 0 END) OVER (PARTITION BY file_id, grp ORDER BY pos
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS blank_seen FROM l2),
heads AS (SELECT file_id, grp, pos AS seg_pos,
                 {_secs("regexp_extract(s, '" + TIMING + "', 1)")} AS start,
                 {_secs("regexp_extract(s, '" + TIMING + "', 2)")} AS "end"
          FROM l3 WHERE arrow AND NOT starts_with(s, 'WEBVTT') AND NOT starts_with(s, 'NOTE')
                AND regexp_matches(s, '{TIMING}')),
body AS (SELECT file_id, grp, string_agg(t, ' ' ORDER BY pos) AS text
         FROM (SELECT *, regexp_replace(s, '<[^>]+>', '', 'g') AS t FROM l3
               WHERE NOT arrow AND grp > 0 AND blank_seen = 0) WHERE t <> '' GROUP BY file_id, grp),
segs AS (SELECT h.file_id, h.seg_pos, h.start, h."end", b.text FROM heads h JOIN body b USING (file_id, grp)
         WHERE h.start IS NOT NULL AND h."end" IS NOT NULL)"""

WS = r"[\t\n\x0B\f\r\x{85}\p{Z}]"


def _norm_words(x: str) -> str:
    t = f"regexp_replace(lower({x}), '[^0-9A-Za-z_\\t\\n\\f\\r ]', '', 'g')"
    t = f"regexp_replace(regexp_replace({t}, '^[\\t\\n\\f\\r ]+|[\\t\\n\\f\\r ]+$', '', 'g'), '[\\t\\n\\f\\r ]+', ' ', 'g')"
    return f"CASE WHEN {t} = '' THEN []::VARCHAR[] ELSE string_split({t}, ' ') END"


SIMILARITY = f"""ex AS (SELECT conv_id AS file_id, turn,
         '[' || printf('%02d:%02d:%02d', (turn * 5) // 3600, ((turn * 5) % 3600) // 60, (turn * 5) % 60) || '] '
         || replace(coalesce(text, ''), chr(10), ' ') AS raw FROM conversations),
exp AS (SELECT file_id, turn, regexp_replace(regexp_extract(raw, '\\[(\\d{{2}}):(\\d{{2}}):(\\d{{2}})\\](.*)', 4),
                '^{WS}+|{WS}+$', '', 'g') AS text
        FROM ex WHERE regexp_matches(raw, '\\[(\\d{{2}}):(\\d{{2}}):(\\d{{2}})\\](.*)')),
ej AS (SELECT file_id, {_norm_words("string_agg(text, ' ' ORDER BY turn)")} AS ew FROM exp GROUP BY file_id),
aj AS (SELECT file_id, {_norm_words("string_agg(text, ' ' ORDER BY seg_pos)")} AS aw FROM segs GROUP BY file_id),
sim AS (SELECT k.file_id, CAST(len(coalesce(ew, [])) AS BIGINT) AS n_expected, CAST(len(coalesce(aw, [])) AS BIGINT) AS n_actual,
               CAST(len(list_filter(coalesce(aw, []), lambda w: list_contains(ew, w))) AS BIGINT) AS common
        FROM (SELECT file_id FROM ej UNION SELECT file_id FROM aj) k LEFT JOIN ej USING (file_id) LEFT JOIN aj USING (file_id))"""


def digest_pages() -> str:
    """kept pages of enabled resources with their resolved content."""
    return f"""{ITEMS}, {RESOURCES}, {LABELLED}, {CASCADE},
kept AS (SELECT * FROM ({resource_decided()}) WHERE reason IS NULL AND coalesce(enabled, TRUE)),
dpages AS (SELECT k.resource_pos, k.item_pos, k.title, k.link, c.content, substr(sha256(k.link), 1, 16) AS page_id, k.ts
           FROM kept k JOIN casc c ON c.resource_pos = k.resource_pos AND c.item_pos = k.item_pos)"""
