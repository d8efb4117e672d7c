"""DuckDB SQL for the queries that SQL can express, over whole tables."""

from __future__ import annotations

WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def shingles(table: str, key: str, extra: str = "") -> str:
    """(row, key, shingle) of the distinct 5-word shingles, or of the whole sequence of fewer words."""
    return f"""(
  SELECT DISTINCT id, {key}, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
  FROM (SELECT row_number() OVER () AS id, {key}, {WORDS.format(LOWER)} AS w FROM {table} {extra})
)"""


#: Documents that hold 80 % of the distinct shingles of an item, by all shingles they share.
DECONTAMINATE = f"""
WITH d AS MATERIALIZED {shingles('documents', 'doc_id')},
i AS MATERIALIZED {shingles('benchmark', 'item_id')},
n AS (SELECT id, COUNT(*) AS n FROM i GROUP BY 1),
held AS (SELECT d.id, d.doc_id, i.id AS item, i.item_id, COUNT(*) AS shared FROM d JOIN i ON i.s = d.s GROUP BY ALL)
SELECT doc_id, item_id, n.n AS item_shingles, shared, shared / n.n AS containment
FROM held JOIN n ON n.id = held.item WHERE shared >= ceil(round(0.8 * n.n, 9))"""

#: Links between distinct sets; the least doc_id that links reach. Equal sets are one node.
JACCARD = f"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT row_number() OVER () AS id, doc_id, {WORDS.format(LOWER)} AS w FROM documents
),
sets AS MATERIALIZED (
  SELECT id, doc_id, list_sort(list_distinct(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS s FROM d
),
node AS MATERIALIZED (SELECT row_number() OVER () AS node, s, len(s) AS n FROM (SELECT DISTINCT s FROM sets WHERE len(s) > 0)),
one AS MATERIALIZED (SELECT node, n, unnest(s) AS x FROM node),
shared AS (SELECT a.node AS a, b.node AS b, a.n AS na, b.n AS nb, COUNT(*) AS k FROM one a JOIN one b ON a.x = b.x AND a.node <> b.node GROUP BY ALL),
links AS MATERIALIZED (SELECT a, b FROM shared WHERE 100 * k >= 80 * (na + nb - k)),
reach AS (SELECT node AS a, node AS b FROM node UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
least AS (SELECT r.a AS node, MIN(t.doc_id) AS c FROM reach r JOIN node v ON v.node = r.b JOIN sets t ON t.s = v.s GROUP BY 1)
SELECT t.doc_id, len(t.s) AS n_shingles, coalesce(l.c, t.doc_id) AS component_id
FROM sets t LEFT JOIN node v ON v.s = t.s LEFT JOIN least l ON l.node = v.node"""

#: Targets by water-filling, then the documents of a source in the order of their hash-random key.
MIX = f"""
WITH d AS MATERIALIZED (
  SELECT doc_id, source, coalesce(len({WORDS.format('text')}), 0) AS size, md5(coalesce(CAST(doc_id AS VARCHAR), 'null')) AS key FROM documents
),
s AS (SELECT source, CAST(SUM(size) AS BIGINT) AS source_size FROM d GROUP BY 1),
w AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place, CASE place % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight, source_size * 2.0::DOUBLE AS cap FROM s),
o AS (
  SELECT *, coalesce(SUM(cap) OVER below, 0.0) AS caps, coalesce(SUM(weight) OVER below, 0.0) AS weights, SUM(weight) OVER () AS all_weights, SUM(source_size) OVER () AS total
  FROM w WINDOW below AS (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
level AS (SELECT MAX((CAST(total AS DOUBLE) * 1.5::DOUBLE - caps) / (all_weights - weights)) AS level FROM o),
t AS (SELECT source, source_size, least(cap, weight * level) AS target FROM w, level),
e AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs, CAST(floor(target) AS BIGINT) - epochs * source_size AS rest FROM t),
k AS (SELECT source, key, SUM(size) AS size, COUNT(*) AS ties FROM d GROUP BY ALL),
r AS (SELECT *, coalesce(SUM(size) OVER (PARTITION BY source ORDER BY key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM k),
cut AS (SELECT r.source, r.key AS at, CAST((rest - before) // ties AS BIGINT) AS part FROM r JOIN e ON e.source IS NOT DISTINCT FROM r.source WHERE before <= rest AND rest < before + r.size)
SELECT d.doc_id, d.size, e.source_size, e.target,
  CAST(e.epochs * d.size + CASE WHEN d.key < cut.at THEN d.size WHEN d.key = cut.at THEN least(cut.part, d.size) ELSE 0 END AS BIGINT) AS taken
FROM d JOIN e ON e.source IS NOT DISTINCT FROM d.source LEFT JOIN cut ON cut.source IS NOT DISTINCT FROM d.source"""

INK = r"[^\x20\x09-\x0D]"

#: The counts, and every rule on them; a row is told by its place, as ids may repeat.
QUALITY = rf"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS t FROM documents),
w AS MATERIALIZED (SELECT id, doc_id, t, {WORDS.format('t')} AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{INK}')) AS l FROM d),
grams AS (SELECT id, i, array_to_string(w[i:i + 2], ' ') AS g FROM (SELECT id, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
twice AS (SELECT id, i FROM (SELECT id, i, COUNT(*) OVER (PARTITION BY id, g) AS n FROM grams) WHERE n > 1),
hit AS (SELECT id, COUNT(DISTINCT i + k) AS n FROM twice, range(3) o(k) GROUP BY 1),
pairs AS (SELECT id, MAX(n) AS n FROM (SELECT id, g, COUNT(*) AS n FROM (SELECT id, array_to_string(w[i:i + 1], ' ') AS g FROM (SELECT id, w, unnest(range(1, len(w))) AS i FROM w)) GROUP BY ALL) GROUP BY 1),
c AS (
  SELECT w.id, doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars, len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
    len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(hit.n, 0) AS n_repeat_words, len(l) AS n_lines,
    len(regexp_extract_all(t, '[A-Z]')) AS upper_, len(regexp_extract_all(t, '[a-z]')) AS lower_, len(regexp_extract_all(t, '!')) AS bangs,
    len(list_filter(w, lambda x: regexp_matches(x, '[A-Za-z]|[^\x00-\x7f]'))) AS plain,
    len(list_filter(l, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*+•]'))) AS bullets,
    len(list_filter(l, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) AS cut,
    CASE WHEN pairs.n > 1 THEN 2 * pairs.n ELSE 0 END AS top_
  FROM w LEFT JOIN hit ON hit.id = w.id LEFT JOIN pairs ON pairs.id = w.id
)
SELECT doc_id, n_words, CAST(word_chars AS BIGINT) AS word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 10 * n_symbols > 3 * n_words OR upper_ > lower_ OR 4 * bangs > n_words
    OR word_chars > 16 * n_words OR word_chars < 2 * n_words OR 10 * n_dup_lines > 3 * n_lines OR 10 * plain < 6 * n_words
    OR (n_lines > 2 AND 10 * bullets > 9 * n_lines) OR (n_lines > 2 AND 10 * cut > 3 * n_lines) OR 10 * top_ > 3 * n_words) AS kept
FROM c"""

SQL = {"op2_decontaminate": DECONTAMINATE, "op4_jaccard_join": JACCARD, "op6_mix": MIX, "op8_quality_rules": QUALITY}
