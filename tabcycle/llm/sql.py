"""DuckDB SQL that gives the rows of the queries."""

from __future__ import annotations

SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
WORD = r"[^\x20\x09-\x0D]+"

MIX = rf"""
sizes AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT % 32 AS slice
  FROM DOCS),
celled AS (
  SELECT *, length(size::VARCHAR) * 10 + substr(size::VARCHAR, 1, 1)::INT AS cell FROM sizes),
per AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS nth, 3 * source_size AS cap,
         (sum(source_size) OVER ())::BIGINT AS total FROM per),
weighed AS (SELECT *, nth % 3 + 1 AS weight FROM ranked),
levels AS (
  SELECT *,
    (total - coalesce(sum(cap) OVER (ORDER BY cap / weight, nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS left_over,
    (sum(weight) OVER (ORDER BY cap / weight, nth ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS weights
  FROM weighed),
level AS (
  SELECT left_over AS lv, weights AS ov FROM levels
  WHERE left_over * weight <= cap * weights ORDER BY cap / weight, nth LIMIT 1),
targets AS (
  SELECT source, source_size, nth,
         coalesce(least(cap::DOUBLE, lv::DOUBLE * weight::DOUBLE / ov::DOUBLE), 0.0) AS target
  FROM weighed LEFT JOIN level ON true),
placed AS (
  SELECT doc_id, size, source_size, target,
    row_number() OVER (PARTITION BY c.source ORDER BY cell, slice, size, doc_id NULLS FIRST)::DOUBLE AS nth_row,
    CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate,
    ('0x' || substr(md5('mix:' || nth), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS shift
  FROM celled c JOIN targets t ON c.source IS NOT DISTINCT FROM t.source),
mixed AS (
  SELECT *, (floor(nth_row * rate + shift) - floor((nth_row - 1) * rate + shift))::BIGINT AS copies FROM placed)
"""

LINES = f"""
lines AS (
  SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS pos
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM DOCS)),
keyed AS (
  SELECT *, translate(trim(line, {SPACES}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
often AS (
  SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
judged AS (
  SELECT doc_id, line, pos, coalesce(doc_id <> last, false) AS dropped FROM keyed LEFT JOIN often USING (key)),
freed AS (
  SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (dropped)::BIGINT AS n_dropped,
         coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '') AS text
  FROM judged GROUP BY doc_id)
"""

HOST_RULES = rf"""
words AS (
  SELECT doc_id, source, unnest(w) AS word, generate_subscripts(w, 1) AS pos
  FROM (SELECT doc_id, source, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents)),
grams AS (
  SELECT doc_id, pos, word || ' ' || lead(word) OVER d || ' ' || lead(word, 2) OVER d AS gram
  FROM words WINDOW d AS (PARTITION BY doc_id ORDER BY pos)),
often AS (
  SELECT doc_id, pos FROM grams WHERE gram IS NOT NULL
  QUALIFY count(*) OVER (PARTITION BY doc_id, gram) > 1),
repeated AS (
  SELECT doc_id, count(DISTINCT pos + s) AS n FROM often, (SELECT unnest([0, 1, 2]) AS s) GROUP BY doc_id),
lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents),
dups AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n, count(*) AS n_lines
  FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
counted AS (
  SELECT d.doc_id, d.source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS n_words,
         length(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]'))::BIGINT AS n_symbols,
         coalesce(dups.n, 0)::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words,
         coalesce(dups.n_lines, 0) AS n_lines
  FROM documents d LEFT JOIN dups USING (doc_id) LEFT JOIN repeated r USING (doc_id)),
ruled AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         10 * n_symbols > word_chars OR (n_dup_lines > 0 AND 2 * n_dup_lines >= n_lines) AS more_failed
  FROM counted),
hosts AS (
  SELECT source, count(*) AS docs, count(*) FILTER (base_failed OR more_failed) AS failed FROM ruled GROUP BY source),
prior AS (
  SELECT avg(failed / docs) AS m, var_pop(failed / docs) AS v FROM hosts),
rated AS (
  SELECT source, CASE WHEN v > 0 AND m * (1 - m) / v - 1 > 0
      THEN (m * (m * (1 - m) / v - 1) + failed) / ((m * (1 - m) / v - 1) + docs)
      WHEN v > 0 THEN failed / docs ELSE m END AS rate
  FROM hosts, prior)
"""

TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'", "'abcdefghijklmnopqrstuvwxyz'"

MERKLE = """
neighbours AS (
  SELECT doc_id, coalesce(text, '') AS own,
         coalesce(lead(coalesce(text, '')) OVER d, first_value(coalesce(text, '')) OVER d) AS beside
  FROM documents WINDOW d AS (ORDER BY doc_id DESC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
edits AS (
  SELECT doc_id, own, beside, substr(own, 1, length(own) - length(own) // 2) || substr(beside, 1, length(own) // 2) AS edited
  FROM neighbours),
texts AS (
  SELECT doc_id, 'own' AS kind, own AS t FROM edits UNION ALL SELECT doc_id, 'beside', beside FROM edits
  UNION ALL SELECT doc_id, 'edited', edited FROM edits),
trees AS (
  SELECT doc_id, kind, t, list_transform(string_split(t, chr(10)), lambda p:
    string_split(array_to_string(list_transform(string_split(p, ' '),
      lambda w: w || CASE WHEN substr(md5(w), 1, 1) < '4' THEN chr(10) ELSE ' ' END), '')[:-2], chr(10))) AS tree
  FROM texts),
digests AS (
  SELECT doc_id, kind, t, list_distinct(flatten(tree)) AS leaves,
    list_transform(tree, lambda p: sha256(array_to_string(list_transform(p, lambda x: sha256(x)), ''))) AS paragraphs
  FROM trees),
parts AS (
  SELECT *, list_transform(string_split(array_to_string(list_transform(paragraphs, lambda d:
    d || CASE WHEN d[1] = '0' OR d = sha256(sha256('')) THEN chr(10) ELSE ' ' END), '')[:-2], chr(10)), lambda s: sha256(s)) AS sections
  FROM digests),
fingers AS (
  SELECT doc_id, kind, t, leaves, sections, paragraphs, sha256(array_to_string(sections, '')) AS root,
    list_sum(list_transform(leaves, lambda x: length(x) + 1)) AS weight FROM parts)
"""
MERKLE_ROWS = """
SELECT o.doc_id, length(o.t)::BIGINT AS n_chars, sha256(e.t) AS edited_sha256, o.root AS fingerprint, e.root AS edited_fingerprint,
  2.0::DOUBLE * coalesce(list_sum(list_transform(list_intersect(o.leaves, e.leaves), lambda x: length(x) + 1)), 0)::DOUBLE
    / (o.weight + e.weight)::DOUBLE AS near_edited,
  2.0::DOUBLE * coalesce(list_sum(list_transform(list_intersect(o.leaves, b.leaves), lambda x: length(x) + 1)), 0)::DOUBLE
    / (o.weight + b.weight)::DOUBLE AS near_next,
  len(o.sections)::INTEGER AS n_sections, len(o.paragraphs)::INTEGER AS n_paragraphs,
  len(list_distinct(list_intersect(o.sections, e.sections)))::INTEGER AS same_sections,
  len(list_distinct(list_intersect(o.paragraphs, e.paragraphs)))::INTEGER AS same_paragraphs
FROM fingers o JOIN fingers e ON o.doc_id = e.doc_id AND o.kind = 'own' AND e.kind = 'edited'
JOIN fingers b ON o.doc_id = b.doc_id AND b.kind = 'beside'"""

DIVERGENCE = f"""
clean AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
terms AS (
  SELECT doc_id, lang, source, unnest(regexp_extract_all(translate(text, {UPPER}, {LOWER}), '{TERM}')) AS term FROM clean),
kept AS (SELECT lang, term FROM terms GROUP BY ALL HAVING count(DISTINCT doc_id) >= 30),
counts AS (SELECT lang, source, term, count(*) AS n FROM terms JOIN kept USING (lang, term) GROUP BY ALL),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
groups AS (
  SELECT lang, source, coalesce(sum(n), 0)::HUGEINT AS total FROM (SELECT DISTINCT lang, source FROM clean) LEFT JOIN counts USING (lang, source)
  GROUP BY ALL),
dense AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (total + 5 * v.v) AS p
  FROM groups g JOIN kept k USING (lang) JOIN v USING (lang) LEFT JOIN counts c USING (lang, source, term)),
whole AS (
  SELECT lang, term, 1 + (1000000000::HUGEINT * (sum(n) + 5)) // ((sum(sum(n)) OVER (PARTITION BY lang)) + 5 * any_value(v)) AS q
  FROM counts JOIN v USING (lang) GROUP BY lang, term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce((SELECT sum(abs(x.p - y.p)) FROM dense x JOIN dense y
      ON x.lang = y.lang AND x.term = y.term WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source),
above AS (
  SELECT lang, source, term AS item, (p - q)::BIGINT AS value FROM dense JOIN whole USING (lang, term) WHERE n > 0 AND p > q)
"""
DIVERGENCE_ROWS = """
SELECT lang, source, 'pair' AS part, item, value, (row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item))::INTEGER AS rank
FROM pairs
UNION ALL SELECT * FROM (
  SELECT lang, source, 'term' AS part, item, value, (row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item))::INTEGER AS rank
  FROM above) WHERE rank <= 50"""

SQL: dict[str, str] = {
    "op3_host_rules": f"""WITH {HOST_RULES}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT rate > 0.5 AS kept
FROM ruled JOIN rated ON ruled.source IS NOT DISTINCT FROM rated.source""",
    "op5_mix_sources": f"WITH {MIX} SELECT doc_id, size, source_size, target, copies * size AS taken FROM mixed".replace(
        "DOCS", "documents"
    ),
    "op8_line_dedup": f"WITH {LINES} SELECT doc_id, n_lines, n_dropped, sha256(text) AS kept_sha256 FROM freed".replace(
        "DOCS", "documents"
    ),
    "op12_merkle": f"WITH {MERKLE} {MERKLE_ROWS}",
    "op13_source_divergence": f"WITH {DIVERGENCE} {DIVERGENCE_ROWS}",
}
