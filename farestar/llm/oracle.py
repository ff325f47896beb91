"""Expected results in DuckDB SQL, for the operators that SQL can express."""

from __future__ import annotations

from farestar.llm.quality import BASE, BIT, RULES

EXACT = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents),
g AS (SELECT text_sha256, count(*) AS group_size FROM d GROUP BY text_sha256),
k AS (
  SELECT doc_id AS keep_id, text_sha256,
         row_number() OVER (PARTITION BY text_sha256 ORDER BY length(text) DESC, doc_id) AS rank
  FROM d)
SELECT d.doc_id, k.keep_id, g.group_size, d.doc_id = k.keep_id AS kept, d.text_sha256
FROM d JOIN g USING (text_sha256) JOIN k ON k.text_sha256 = d.text_sha256 AND k.rank = 1
"""

_WORD = r"[^\x20\x09-\x0D]+"


def _quality() -> str:
    bits = " + ".join(f"CASE WHEN {test} THEN {BIT[rule]} ELSE 0 END" for rule, test in RULES.items())
    base = " OR ".join(RULES[rule] for rule in BASE)
    return rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '{_WORD}') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '{_WORD}')) AS lines
  FROM documents),
windows AS (
  SELECT doc_id, unnest(range(1, len(words) - 1)) AS i, words FROM d),
grams AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, words[i], words[i + 1], words[i + 2]) AS n
  FROM windows),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM grams WHERE n > 1) GROUP BY doc_id),
m AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) AS BIGINT) AS n_lines,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN covered USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       ({base}) AS base_failed, ({bits}) = 0 AS kept, CAST({bits} AS BIGINT) AS failure_bits
FROM m
"""


AUDIT = rf"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '{_WORD}') AS words
  FROM documents),
firsts AS (SELECT text, min(doc_id) AS least FROM d GROUP BY text),
marks AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
         max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id),
fails AS (
  SELECT d.doc_id, part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         CASE WHEN len(words) < 50 THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 'B' ELSE '' END
         || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN least < d.doc_id THEN 'E' ELSE '' END AS failed
  FROM d JOIN firsts USING (text) LEFT JOIN marks ON marks.doc_id = d.doc_id),
combos AS (
  SELECT part, failed, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM fails GROUP BY part, failed),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
steps AS (
  SELECT filter_order, CAST(s AS INTEGER) AS step, filter_order[s] AS f, substr(filter_order, 1, s - 1) AS before
  FROM orders, range(1, 6) AS r(s)),
met AS (
  SELECT part, filter_order, step, f, n, good, toxic, failed,
         contains(failed, f) AS fails, translate(failed, before, '') <> failed AS gone
  FROM combos, steps),
counted AS (
  SELECT part, filter_order, step, f,
         sum(CASE WHEN NOT fails AND NOT gone THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN fails AND NOT gone THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN fails AND gone THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN failed = f THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN fails AND NOT gone THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN fails AND NOT gone THEN toxic ELSE 0 END) AS toxic_lost
  FROM met GROUP BY part, filter_order, step, f),
averaged AS (SELECT part, f, sum(removed) AS shapley FROM counted GROUP BY part, f)
SELECT part, filter_order, step,
       CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(shapley AS BIGINT) AS shapley
FROM counted JOIN averaged USING (part, f)
"""


def all_sql() -> dict[str, str]:
    return {"op4_quality": _quality(), "op6_exact": EXACT, "op11_audit": AUDIT}
