"""DuckDB's SQL for the queries that SQL can express, beside those in :mod:`legtrail.llm.queries`."""

from legtrail.llm import line_runs, mixing, secret_scan

#: Windows of lines by comparing all pairs of lines of a document; runs are compared as texts.
LINE_DEDUP = f"""
WITH d AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (
  SELECT doc_id, pos, lines[pos] AS line, len(regexp_extract_all(lines[pos], '\\S+')) AS words
  FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS pos FROM d)),
c AS (SELECT *, sum(words) OVER (PARTITION BY doc_id ORDER BY pos) AS upto FROM l),
enough AS (
  SELECT doc_id, a.pos AS first, b.pos AS last FROM c a JOIN c b USING (doc_id)
  WHERE a.pos <= b.pos AND b.upto - a.upto + a.words >= {line_runs.LEAST_WORDS}),
w AS (
  SELECT doc_id, first, min(last) AS last FROM enough GROUP BY doc_id, first
  UNION SELECT doc_id, max(first), last FROM enough GROUP BY doc_id, last),
runs AS (
  SELECT doc_id, first, last, array_to_string(lines[first:last], chr(10)) AS run FROM w JOIN d USING (doc_id)),
copies AS (
  SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY run ORDER BY doc_id, first) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(first, last + 1)) AS pos FROM copies),
spans AS (
  SELECT doc_id, string_agg(first || '-' || last, ',' ORDER BY first) AS removed, sum(last - first)::BIGINT AS n FROM (
    SELECT doc_id, min(pos) - 1 AS first, max(pos) AS last
    FROM (SELECT *, pos - row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS island FROM gone)
    GROUP BY doc_id, island)
  GROUP BY doc_id),
kept AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) AS text FROM l ANTI JOIN gone USING (doc_id, pos)
  GROUP BY doc_id)
SELECT doc_id, len(lines)::BIGINT AS n_lines, coalesce(n, 0) AS n_removed, coalesce(removed, '') AS removed,
  sha256(coalesce(kept.text, '')) AS text_sha256
FROM d LEFT JOIN spans USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


def _spans(number: int, rule: secret_scan.Rule) -> str:
    """SQL of the list of (start, kind, end) of a rule's matches in ``t``."""
    pattern = "'" + rule.pattern.replace("'", "''") + "'"
    total = lambda texts: f"coalesce(list_sum(list_transform({texts}, lambda x: length(x))), 0)"
    return f"""(
  SELECT list_transform(
    list_filter(range(1, len(m) + 1), lambda i: length(g[i]) >= {rule.least}),
    lambda i: {{'s': ({total('p[1:i]')} + {total('m[1:i - 1]')})::BIGINT, 'k': {number},
                'e': ({total('p[1:i]')} + {total('m[1:i]')})::BIGINT}})
  FROM (SELECT regexp_extract_all(t, {pattern}, 0) AS m, regexp_extract_all(t, {pattern}, {rule.group}) AS g,
               string_split_regex(t, {pattern}) AS p))"""


_KINDS = ", ".join(f"'{rule.kind}'" for rule in secret_scan.RULES)
_LISTS = ", ".join(f"{_spans(i, rule)} AS l{i}" for i, rule in enumerate(secret_scan.RULES))
_ALL = " || ".join(f"l{i}" for i in range(len(secret_scan.RULES)))
_BASE = len(secret_scan.BASE_RULES)
_TEXT = "array_to_string(list_transform({}, lambda x: ([{}])[x.k + 1] || ':' || x.s || ':' || x.e), ',')"

SECRETS = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
f AS (SELECT doc_id, {_LISTS} FROM d),
s AS (SELECT doc_id, l0, l1, l2, list_sort({_ALL}) AS spans FROM f)
SELECT doc_id, len(l0) AS n_assign, len(l1) AS n_access, len(l2) AS n_hex,
  sha256({_TEXT.format(f"list_filter(spans, lambda x: x.k < {_BASE})", _KINDS)}) AS base_sha256,
  {_TEXT.format("spans", _KINDS)} AS spans
FROM s
"""

#: The exponent by bisection as a recursive query.
MIXING = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, md5(coalesce(text, '')) AS h, source, count(*) AS copies,
    any_value(len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\r\\n]+'))) AS tokens
  FROM documents GROUP BY doc_id, md5(coalesce(text, '')), source),
s AS (SELECT source, sum(tokens * copies)::BIGINT AS st FROM d GROUP BY source HAVING sum(tokens * copies) > 0),
steps AS (
  SELECT 0 AS i, 0.0::DOUBLE AS low, 1.0::DOUBLE AS high
  UNION ALL
  SELECT i + 1, if(fits, low, middle), if(fits, middle, high) FROM (
    SELECT i, low, high, (low + high) / 2 AS middle, max(w / st) / min(w / st) <= {mixing.MOST_REPEATS} AS fits FROM (
      SELECT i, low, high, st, pow(st / top, (low + high) / 2) AS w
      FROM steps, s, (SELECT max(st)::DOUBLE AS top FROM s) WHERE i < 50)
    GROUP BY i, low, high)),
e AS (SELECT round((low + high) / 2, 9) AS exponent FROM steps WHERE i = 50),
w AS (
  SELECT source, st, w / sum(w) OVER () AS weight
  FROM (SELECT source, st, pow(st / (SELECT max(st) FROM s), exponent) AS w FROM s, e)),
p AS (
  SELECT source, st, weight, greatest(round(weight * max(st / weight) OVER ()), st)::BIGINT AS target FROM w),
plan AS (SELECT *, target // st AS whole, target % st AS rest FROM p),
r AS (SELECT d.*, weight, whole, rest FROM d LEFT JOIN plan ON d.source IS NOT DISTINCT FROM plan.source),
last AS (
  SELECT *, sum(tokens * copies) OVER (
    PARTITION BY source ORDER BY md5(concat_ws(':', doc_id, h, whole)), doc_id, h) - tokens * copies AS begin
  FROM r WHERE tokens > 0),
epochs AS (
  SELECT doc_id, source, tokens, weight, copies, 0 AS epoch FROM r WHERE tokens = 0
  UNION ALL SELECT doc_id, source, tokens, weight, copies, unnest(range(whole)) FROM r WHERE tokens > 0
  UNION ALL SELECT doc_id, source, tokens, weight, copies, whole FROM last WHERE begin < rest)
SELECT doc_id, source, tokens, round(weight, 9) AS weight, epoch::INTEGER AS epoch
FROM (SELECT *, unnest(range(copies)) FROM epochs)
"""

TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
    list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q, v c WHERE q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM s QUALIFY rank <= 5
"""

COLLOCATIONS = """
WITH t AS (
  SELECT coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (
  SELECT lang, regexp_extract_all(unnest(string_split_regex(t, '[.,;:!?\\x0A-\\x0D]')), '[^\\x20\\x09]+') AS w FROM t),
g AS (
  SELECT lang, w[i:i + size - 1] AS g, count(*) AS f
  FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM (SELECT lang, w, unnest([1, 2, 3]) AS size FROM p))
  GROUP BY ALL),
c AS (SELECT lang, g, f AS a FROM g WHERE len(g) > 1 AND f >= 10),
cuts AS (
  SELECT c.*, k, l.f AS l, r.f AS r, (1000000::HUGEINT * a * a) // (l.f::HUGEINT * r.f) AS score
  FROM (SELECT *, unnest(range(1, len(g))) AS k FROM c) c
  JOIN g l ON l.lang = c.lang AND l.g = c.g[1:k] JOIN g r ON r.lang = c.lang AND r.g = c.g[k + 1:]),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
longer AS (
  SELECT lang, g[i:i + 1] AS g, max(a) AS f FROM (SELECT *, unnest([1, 2]) AS i FROM c WHERE len(g) = 3)
  GROUP BY ALL),
kept AS (
  SELECT best.*, array_to_string(best.g, ' ') AS phrase
  FROM best LEFT JOIN longer ON longer.lang = best.lang AND longer.g = best.g
  WHERE coalesce(100 * longer.f < 50 * a, true)),
n AS (SELECT lang, sum(f) AS n FROM g WHERE len(g) = 1 GROUP BY lang)
SELECT kept.lang, row_number() OVER (PARTITION BY kept.lang ORDER BY score DESC, a DESC, phrase) AS rank,
  phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score
FROM kept JOIN n ON n.lang = kept.lang QUALIFY rank <= 2000
"""

NEGATIVES = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
    list_sum(list_transform(list_zip(a.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v a, v c WHERE a.vec_id % 100 = 0 AND c.vec_id <> a.vec_id),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
  (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id))::INTEGER AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""
