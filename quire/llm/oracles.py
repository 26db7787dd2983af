"""DuckDB SQL for the operators that SQL can express, over the driver's tables."""

from __future__ import annotations

from quire.llm.license_diagonals import COVERAGE, LOWER, UPPER, band_width, templates

WORDS = r"'[^\x20\x09-\x0D]+'"
LETTERS = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"


def top_k_sql(k: int = 5, every: int = 50, scale: int = 256) -> str:
    return f"""
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, len(embedding) AS dims, list_transform(embedding, lambda x: floor({scale} * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (
  SELECT a.r, a.vec_id AS query_id, b.vec_id, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.r <> b.r AND a.dims = b.dims WHERE a.vec_id % {every} = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= {k}"""


def near_vectors_sql(threshold: float = 0.98) -> str:
    return f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (
  SELECT a.vec_id AS u, b.vec_id AS w FROM v a JOIN v b ON a.label = b.label AND len(a.x) = len(b.x) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.x, b.x) >= {threshold}),
reach AS (SELECT u, w FROM l UNION SELECT r.u, l.w FROM reach r JOIN l ON r.w = l.u),
c AS (SELECT u, least(u, min(w)) AS component FROM reach GROUP BY u),
n AS (SELECT u, count(*) AS n FROM l GROUP BY u)
SELECT e.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, coalesce(c.component, e.vec_id) AS component_id,
       coalesce(c.component, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN n ON n.u = e.vec_id LEFT JOIN c ON c.u = e.vec_id"""


def licenses_sql() -> str:
    rows = ", ".join(
        f"({i}, '{label}', {str(phrase).lower()}, {len(w) - 1}, CAST({band_width(phrase, len(w))} AS DOUBLE), {at}, '{a}', '{b}')"
        for i, label, phrase, w in templates()
        for at, (a, b) in enumerate(zip(w, w[1:]))
    )
    return f"""
WITH tp AS (SELECT * FROM (VALUES {rows}) AS t(template, label, phrase, pairs, width, t, a, b)),
d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), {LETTERS}) AS w
  FROM documents),
p AS (SELECT r, i - 1 AS place, w[i] AS a, w[i + 1] AS b FROM (SELECT r, w, unnest(range(1, len(w))) AS i FROM d)),
h AS (SELECT r, template, label, phrase, pairs, width, t, place - t AS diagonal FROM p JOIN tp USING (a, b)),
c AS (
  SELECT *, CAST(count(DISTINCT t) OVER (PARTITION BY r, template ORDER BY diagonal / width RANGE BETWEEN CURRENT ROW AND 1.0 FOLLOWING) AS DOUBLE) / pairs AS coverage
  FROM h),
g AS (SELECT DISTINCT r, template, label, phrase, diagonal AS place, coverage FROM c WHERE coverage >= CASE WHEN phrase THEN 1.0 ELSE {COVERAGE} END)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words,
       CAST(count(g.place) FILTER (WHERE g.phrase) AS BIGINT) AS n_base,
       CAST(min(g.place) FILTER (WHERE g.phrase) AS BIGINT) AS first_word,
       CAST(max(g.place) FILTER (WHERE g.phrase) AS BIGINT) AS last_word,
       coalesce(string_agg(DISTINCT g.label, ',' ORDER BY g.label) FILTER (WHERE g.phrase), '') AS base_labels,
       coalesce(string_agg(DISTINCT g.label, ',' ORDER BY g.label), '') AS labels,
       CAST(coalesce(max(g.coverage), 0.0) AS DOUBLE) AS score
FROM d LEFT JOIN g ON g.r = d.r GROUP BY d.r, d.doc_id, d.w"""


def substrings_sql(window: int = 50) -> str:
    return f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {WORDS}) AS w FROM documents),
win AS (
  SELECT doc_id, i, md5(array_to_string(w[i : i + {window - 1}], ' ')) AS k
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - {window - 2})) AS i FROM d)),
first_in AS (SELECT k, min(doc_id) AS m FROM win GROUP BY k),
hit AS (SELECT DISTINCT win.doc_id, i FROM win JOIN first_in USING (k) WHERE m < win.doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + {window})) AS p FROM hit),
word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (
  SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t, count(*) AS n
  FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(len(d.w) - coalesce(kept.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""


def lines_sql(min_chars: int = 20, min_docs: int = 3) -> str:
    blanks = " || ".join(f"chr({n})" for n in (9, 10, 11, 12, 13, 32))
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
x AS (SELECT r, doc_id, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS p FROM d),
k AS (SELECT *, translate(trim(line, {blanks}), '{UPPER}', '{LOWER}') AS key FROM x),
f AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= {min_chars} GROUP BY key HAVING count(DISTINCT doc_id) >= {min_docs}),
g AS (SELECT k.r, k.p, k.line, f.key IS NOT NULL AND k.doc_id <> f.keeper AS gone FROM k LEFT JOIN f ON f.key = k.key),
s AS (
  SELECT r, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
         coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (WHERE NOT gone), '') AS kept
  FROM g GROUP BY r)
SELECT doc_id, n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM d JOIN s USING (r)"""


def negatives_sql(every: int = 100, keep: int = 5, least: int = 80, scale: int = 256) -> str:
    return f"""
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, len(embedding) AS dims,
         list_transform(embedding, lambda x: floor({scale} * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (
  SELECT a.r, a.vec_id AS anchor_id, b.vec_id, b.r AS other, a.label = b.label AS same, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.r <> b.r AND a.dims = b.dims WHERE a.vec_id % {every} = 0),
p AS (
  SELECT r, anchor_id, vec_id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id, other) AS k
  FROM s WHERE same QUALIFY k <= {keep})
SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.r, k ORDER BY score DESC, vec_id, other) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.r = p.r AND NOT same AND {least} * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= {keep}"""
