"""DuckDB statements for the operators that SQL can express, written from the contracts."""

from __future__ import annotations

# words of every text: white space is space, tab, newline, vertical tab, form feed, carriage return
_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"
_LOW = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP3 = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, {_WORDS.replace("coalesce(text, '')", _LOW.format("coalesce(text, '')"))} AS w FROM documents
), g AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(generate_series(1, len(w) - 4), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM d
), c AS (
  SELECT min(doc_id) AS id, len(any_value(s)) AS n, any_value(list_sort(s)) AS s FROM g WHERE len(s) > 0 GROUP BY list_sort(s)
), m AS (
  SELECT g.doc_id, c.id FROM g JOIN c ON list_sort(g.s) = c.s
), e AS (
  SELECT id, n, unnest(s) AS h FROM c
), p AS (
  SELECT a.id AS x, b.id AS y FROM e a JOIN e b ON a.h = b.h AND a.id < b.id
  GROUP BY a.id, b.id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
), l AS (
  SELECT x, y FROM p UNION ALL SELECT y, x FROM p
), r AS (
  SELECT id AS x, id AS root FROM c UNION SELECT l.y, r.root FROM r JOIN l ON l.x = r.x
), k AS (
  SELECT x, min(root) AS root FROM r GROUP BY x
)
SELECT g.doc_id, CAST(len(g.s) AS BIGINT) AS n_shingles, coalesce(k.root, g.doc_id) AS component_id
FROM g LEFT JOIN m USING (doc_id) LEFT JOIN k ON k.x = m.id
"""

OP6 = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents
), s AS (
  SELECT r, unnest(generate_series(1, len(w) - 34)) AS i FROM d WHERE len(w) >= 35
), k AS (
  SELECT s.r, s.i, md5(array_to_string(d.w[s.i:s.i + 34], ' ')) AS k FROM s JOIN d USING (r)
), h AS (
  SELECT r, list(i) AS places FROM (SELECT r, i, count(*) OVER (PARTITION BY k) AS n FROM k) WHERE n > 1 GROUP BY r
), c AS (
  SELECT r, list_distinct(flatten(list_transform(places, lambda i: generate_series(i, i + 34)))) AS gone FROM h
), f AS (
  SELECT d.r, list(w.x ORDER BY w.i) AS kept FROM d,
    LATERAL (SELECT unnest(d.w) AS x, unnest(generate_series(1, len(d.w))) AS i) w
    LEFT JOIN (SELECT r, unnest(gone) AS i FROM c) o ON o.r = d.r AND o.i = w.i WHERE o.i IS NULL GROUP BY d.r
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(len(c.gone), 0) AS BIGINT) AS n_removed,
  sha256(coalesce(array_to_string(f.kept, ' '), '')) AS kept_sha256
FROM d LEFT JOIN c USING (r) LEFT JOIN f USING (r)
"""


def vector_code_sql(parts: int = 16, entries: int = 64, rounds: int = 2) -> str:
    """Integer k-means written out: one table of nearest entries and one of new entries a round."""
    steps = [f"""v AS (SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
x AS (SELECT r, vec_id, label, p, e[p * (len(e) // {parts}) + 1:(p + 1) * (len(e) // {parts})] AS x
  FROM v, (SELECT unnest(generate_series(0, {parts - 1})) AS p)),
s AS (SELECT r, row_number() OVER (ORDER BY vec_id) - 1 AS j FROM v ORDER BY vec_id LIMIT {entries}),
c0 AS (SELECT p, j, x AS c FROM x JOIN s USING (r))"""]
    square = "list_sum(list_transform(list_zip(x.x, c.c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    for k in range(rounds + 1):
        steps.append(f"""a{k} AS (SELECT r, p, min({square} * {entries} + j) AS m FROM x JOIN c{k} c USING (p) GROUP BY r, p)""")
        if k < rounds:
            steps.append(f"""f{k} AS (SELECT x.p, m % {entries} AS j, i, sum(x.x[i]) AS s, count(*) AS n
  FROM x JOIN a{k} USING (r, p), LATERAL (SELECT unnest(generate_series(1, len(x.x))) AS i) GROUP BY x.p, m % {entries}, i),
m{k} AS (SELECT p, j, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c FROM f{k} GROUP BY p, j),
c{k + 1} AS (SELECT p, j, coalesce(m.c, c.c) AS c FROM c{k} c LEFT JOIN m{k} m USING (p, j))""")
    end = rounds
    return f"""WITH {", ".join(steps)},
h AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, j)) AS codebooks_sha256 FROM c{end}),
o AS (SELECT r, string_agg(printf('%02x', CAST(m % {entries} AS INTEGER)), '' ORDER BY p) AS code, CAST(sum(m // {entries}) AS BIGINT) AS error FROM a{end} GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM v JOIN o USING (r), h"""


def licence_sql(phrases, templates, threshold) -> str:
    split = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    words = lambda s: f"list_filter(regexp_split_to_array({s}, '{split}'), lambda w: w <> '')"
    places = ", ".join("list_filter(generate_series(0, len(w) - 1), lambda i: " + " AND ".join(
        f"coalesce(w[i + {k + 1}], '') = '{x}'" for k, x in enumerate(phrase.split(" "))) + f") AS p{i}"
        for i, (phrase, _) in enumerate(phrases))
    starts = "flatten([" + ", ".join(f"p{i}" for i in range(len(phrases))) + "])"
    base = "list_filter([" + ", ".join(f"CASE WHEN len(p{i}) > 0 THEN '{lab}' END" for i, (_, lab) in enumerate(phrases)) + "], lambda x: x IS NOT NULL)"
    rows = ", ".join(f"('{lab}', {sorted(set(text.split(' ')))!r})" for lab, text in templates)
    return f"""
WITH t(label, tokens) AS (VALUES {rows}),
d AS (SELECT row_number() OVER () AS r, doc_id, {_LOW.format("coalesce(text, '')")} AS low FROM documents),
w AS (SELECT r, doc_id, {words("low")} AS w FROM d),
b AS (SELECT r, {words("line")} AS b FROM (SELECT r, unnest(string_split(low, chr(10))) AS line FROM d)),
s AS (SELECT r, label, max(len(list_intersect(b, tokens)) / len(tokens)) AS share FROM b, t
  WHERE len(list_intersect(b, tokens)) >= {threshold} * len(tokens) - 1e-9 GROUP BY r, label),
m AS (SELECT r, list(label) AS labels, max(share) AS score FROM s GROUP BY r),
p AS (SELECT r, doc_id, w, {places} FROM w)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len({starts}) AS BIGINT) AS n_base,
  CAST(list_min({starts}) AS BIGINT) AS first_word, CAST(list_max({starts}) AS BIGINT) AS last_word,
  array_to_string(list_sort(list_distinct({base})), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat({base}, coalesce(labels, [])))), ',') AS labels,
  coalesce(score, CAST(0 AS DOUBLE)) AS score
FROM p LEFT JOIN m USING (r)
"""


def _licences() -> str:
    from . import licenses as L
    return licence_sql(L.PHRASES, L.TEMPLATES, L.THRESHOLD)


ORACLE = {"op3_ngram_jaccard": OP3, "op6_substring_dedup": OP6, "op8_license_scan": _licences(),
          "op13_vector_codes": vector_code_sql()}
