"""SQL for those check queries of the training-data operators that SQL can express."""

from __future__ import annotations

from rillflow.llm.quality_rules import Limits

_LIMITS = Limits()
_WORD = r"[^\x20\x09-\x0D]+"


def _windows(name: str, size: int) -> str:
    """Word windows of ``size`` that occur twice or more in their text: row ``r`` and first word ``i``."""
    return f"""{name}_all AS (
      SELECT r, unnest(range(1, len(w) - {size} + 2)) AS i,
        unnest(list_transform(range(1, len(w) - {size} + 2), lambda x: array_to_string(w[x : x + {size} - 1], ' '))) AS win
      FROM d WHERE len(w) >= {size}),
    {name} AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS c FROM {name}_all) WHERE c > 1)"""


QUALITY_RULES = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
{_windows("short", _LIMITS.run_words)},
{_windows("long", _LIMITS.max_run_words + 1)},
covered AS (SELECT DISTINCT r, i + k AS p FROM short, (SELECT unnest(range(0, {_LIMITS.run_words})) AS k)),
rep AS (SELECT r, count(*) AS n, sum(length(w[p])) AS chars FROM covered JOIN d USING (r) GROUP BY r),
counts AS (
  SELECT d.r, doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines,
    CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(chars, 0) AS BIGINT) AS n_repeat_chars
  FROM d LEFT JOIN rep USING (r)),
judged AS (
  SELECT *, n_words < {_LIMITS.min_words} OR 100 * n_repeat_words > {_LIMITS.max_repeat_percent} * n_words AS base_failed FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND 100 * n_repeat_chars <= {_LIMITS.max_covered_percent} * word_chars AND r NOT IN (SELECT r FROM long) AS kept, n_repeat_chars
FROM judged"""

_ITEM_WORD = r"[0-9a-z\x{80}-\x{10FFFF}]+"


def _shingles(table: str, row_id: str, size: int = 5) -> str:
    """Distinct word shingles of a table."""
    return f"""SELECT DISTINCT {row_id}, unnest(CASE
        WHEN len(w) >= {size} THEN list_transform(range(1, len(w) - {size} + 2), lambda x: array_to_string(w[x : x + {size} - 1], ' '))
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
      FROM (SELECT {row_id}, regexp_extract_all(lower(text), '{_ITEM_WORD}') AS w FROM {table})"""


DECONTAMINATION = f"""
WITH ds AS ({_shingles("documents", "doc_id")}),
bs AS ({_shingles("benchmark", "item_id")}),
brief AS (SELECT item_id, regexp_extract_all(lower(text), '{_ITEM_WORD}') AS w FROM benchmark WHERE len(regexp_extract_all(lower(text), '{_ITEM_WORD}')) BETWEEN 1 AND 4),
runs AS (
  SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - k + 2, 1)), lambda x: array_to_string(w[x : x + k - 1], ' '))) AS s
  FROM (SELECT doc_id, regexp_extract_all(lower(text), '{_ITEM_WORD}') AS w FROM documents), (SELECT DISTINCT len(w) AS k FROM brief)),
brief_hits AS (SELECT doc_id, item_id, 1 AS m FROM runs JOIN brief ON s = array_to_string(w, ' ')),
total AS (SELECT item_id, count(*) AS n FROM bs GROUP BY item_id),
hits AS (
  SELECT doc_id, item_id, count(*) AS m FROM ds JOIN bs USING (s) WHERE item_id NOT IN (SELECT item_id FROM brief) GROUP BY doc_id, item_id
  UNION ALL SELECT * FROM brief_hits)
SELECT doc_id, item_id, CAST(n AS BIGINT) AS n_item_shingles, CAST(m AS BIGINT) AS n_shared, m / CAST(n AS DOUBLE) AS containment
FROM hits JOIN total USING (item_id) WHERE m / CAST(n AS DOUBLE) >= 0.8"""

LINE_DEDUP = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(0, len(string_split(text, chr(10))))) AS pos FROM documents),
solid AS (
  SELECT doc_id, pos, line, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS seq FROM lines WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
runs AS (
  SELECT doc_id, seq, line AS l1, lead(line, 1) OVER w AS l2, lead(line, 2) OVER w AS l3,
    len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) AS n1, lead(len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')), 1) OVER w AS n2
  FROM solid WINDOW w AS (PARTITION BY doc_id ORDER BY seq)),
ranked AS (
  SELECT doc_id, seq, 3 AS size, row_number() OVER (PARTITION BY l1, l2, l3 ORDER BY doc_id, seq) AS copy FROM runs WHERE l3 IS NOT NULL
  UNION ALL SELECT doc_id, seq, 2, row_number() OVER (PARTITION BY l1, l2 ORDER BY doc_id, seq) FROM runs WHERE l2 IS NOT NULL AND n1 + n2 > 50
  UNION ALL SELECT doc_id, seq, 1, row_number() OVER (PARTITION BY l1 ORDER BY doc_id, seq) FROM runs WHERE n1 > 50),
gone AS (SELECT DISTINCT doc_id, seq + k AS seq FROM ranked, (SELECT unnest([0, 1, 2]) AS k) WHERE copy > 1 AND k < size),
places AS (SELECT doc_id, pos FROM gone JOIN solid USING (doc_id, seq)),
left_over AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) AS t FROM lines ANTI JOIN places USING (doc_id, pos) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS c FROM places GROUP BY doc_id)
SELECT doc_id, CAST(len(string_split(text, chr(10))) AS BIGINT) AS n_lines, CAST(coalesce(c, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM documents LEFT JOIN left_over USING (doc_id) LEFT JOIN n USING (doc_id)"""

COLLOCATIONS = """
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS r, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
p AS (SELECT lang, regexp_extract_all(piece, '[^ \\t]+') AS w FROM d),
grams AS (
  SELECT lang, m, unnest(list_transform(range(1, greatest(len(w) - m + 2, 1)), lambda i: array_to_string(w[i : i + m - 1], ' '))) AS phrase
  FROM p, (SELECT unnest([1, 2, 3]) AS m)),
f AS MATERIALIZED (SELECT lang, m, phrase, count(*) AS c FROM grams GROUP BY ALL),
n AS (SELECT lang, CAST(sum(c) AS BIGINT) AS n FROM f WHERE m = 1 GROUP BY lang),
cand AS MATERIALIZED (SELECT lang, m, phrase, c AS a, string_split(phrase, ' ') AS w FROM f WHERE m > 1 AND c >= 10),
often AS MATERIALIZED (SELECT lang, phrase, c FROM f WHERE c >= 10),
halves AS MATERIALIZED (
  SELECT lang, m, phrase, a, k, array_to_string(w[1 : k], ' ') AS head, array_to_string(w[k + 1 : m], ' ') AS tail
  FROM (SELECT *, unnest(range(1, m)) AS k FROM cand)),
cuts AS (
  SELECT h.lang, h.m, h.phrase, a, k, x.c AS l, y.c AS r, (CAST(1000000 AS HUGEINT) * a * a) // (CAST(x.c AS HUGEINT) * y.c) AS score
  FROM halves h JOIN often x ON x.lang = h.lang AND x.phrase = head JOIN often y ON y.lang = h.lang AND y.phrase = tail),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
longer AS (
  SELECT lang, phrase, max(a) AS b FROM (SELECT lang, a, unnest([array_to_string(w[1 : 2], ' '), array_to_string(w[2 : 3], ' ')]) AS phrase FROM cand WHERE m = 3)
  GROUP BY ALL),
kept AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, CAST(score AS BIGINT) AS score
  FROM best LEFT JOIN longer USING (lang, phrase) WHERE b IS NULL OR 100 * b < 50 * a)
SELECT lang, rank, phrase, a, l, r, n, score FROM kept JOIN n USING (lang) WHERE rank <= 2000"""

# CRC-32 of the text of an id: its bytes, eight steps of one bit each.
_CRC32 = """xor(4294967295, list_reduce(list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, ignored: xor(v >> 1, 3988292384 * (v & 1)))))"""

PERIODIC_RUNS = f"""
WITH ids AS (SELECT doc_id, {_CRC32} AS h, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS own FROM documents),
cut AS (SELECT *, len(own) AS n, h // 10 AS g, CASE WHEN h % 10 = 0 AND len(own) > 0 THEN (h // 10) % len(own) END AS a FROM ids),
d AS (
  SELECT doc_id, CASE WHEN a IS NULL THEN own ELSE list_transform(range(0, n),
    lambda i: own[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END]) END AS w FROM cut),
words AS (SELECT doc_id, unnest(w) AS x, unnest(range(0, len(w))) AS i, len(w) AS n FROM d),
pairs AS (SELECT a.doc_id, a.i, b.i - a.i AS p FROM words a JOIN words b ON a.doc_id = b.doc_id AND a.x = b.x AND b.i > a.i AND 2 * (b.i - a.i) <= a.n),
stretches AS (
  SELECT doc_id, p, min(i) AS s, count(*) + p AS len
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, p ORDER BY i) AS island FROM pairs) GROUP BY doc_id, p, island),
runs AS (SELECT doc_id, s, len, min(p) AS p FROM stretches WHERE len >= greatest(12, 2 * p) GROUP BY doc_id, s, len),
per AS (
  SELECT doc_id, count(*) AS c, string_agg(s || ',' || len || ',' || p || chr(10), '' ORDER BY s, p) AS lines, arg_min((s, len, p), (-len, s, p)) AS best
  FROM runs GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(s + p, s + len)) AS i FROM runs),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS t FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(c, 0) AS BIGINT) AS n_runs, CAST(best[1] AS BIGINT) AS start, CAST(best[2] AS BIGINT) AS length, CAST(best[3] AS BIGINT) AS period,
  CAST(1000 * best[2] // best[3] AS BIGINT) AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(t, '')) AS collapsed_sha256
FROM documents LEFT JOIN per USING (doc_id) LEFT JOIN kept USING (doc_id)"""

ORACLES: dict[str, str] = {
    "op4_decontamination": DECONTAMINATION,
    "op5_quality_rules": QUALITY_RULES,
    "op6_line_dedup": LINE_DEDUP,
    "op12_collocations": COLLOCATIONS,
    "op13_periodic_runs": PERIODIC_RUNS,
}
