"""Queries of this package in SQL for another engine, where SQL can express them.

The others encode with a tokenizer, hash with XXH64, fit a model or partition numbers; tests hold
them against plain versions.
"""

from __future__ import annotations

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"coalesce(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])"

DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
items AS (SELECT item_id, w, least(13, len(w)) AS m FROM (SELECT item_id, {_WORDS} AS w FROM benchmark)
          WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, m, list_slice(w, k, k + m - 1) AS part
            FROM (SELECT item_id, w, m, unnest(range(1, CAST(len(w) - m + 2 AS BIGINT))) AS k FROM items)),
places AS (SELECT doc_id, m, k, list_slice(w, k, k + m - 1) AS part
           FROM (SELECT doc_id, w, m, unnest(range(1, CAST(len(w) - m + 2 AS BIGINT))) AS k
                 FROM d, (SELECT DISTINCT m FROM items) WHERE len(w) >= m)),
found AS (SELECT doc_id, k, m, item_id FROM places JOIN windows USING (m, part)),
hit AS (SELECT doc_id, count(DISTINCT place) AS n_hit
        FROM (SELECT doc_id, unnest(range(k, k + m)) AS place FROM found) GROUP BY 1),
listed AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
             string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
           FROM found GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN listed USING (doc_id)"""

VECTORS = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
          WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
reach AS (SELECT vec_id, vec_id AS other FROM v
          UNION SELECT reach.vec_id, links.b FROM reach JOIN links ON reach.other = links.a),
degree AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY 1)
SELECT vec_id, coalesce(any_value(n), 0) AS n_links, min(other) AS component_id,
  min(other) = vec_id AS kept
FROM reach LEFT JOIN degree USING (vec_id) GROUP BY vec_id"""

_TERMS = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

DIVERGENCE = rf"""
WITH t AS (SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
             regexp_extract_all({_TERMS}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
u AS MATERIALIZED (SELECT doc, lang, source, unnest(w) AS term FROM t),
kept AS MATERIALIZED (SELECT lang, term FROM u GROUP BY ALL HAVING count(DISTINCT doc) >= 10),
counts AS (SELECT lang, source, term, count(*) AS n FROM u JOIN kept USING (lang, term) GROUP BY ALL),
totals AS (SELECT lang, term, sum(n) AS n FROM counts GROUP BY ALL),
langs AS (SELECT lang, count(term) AS v, coalesce(sum(n), 0) AS all_n
          FROM (SELECT DISTINCT lang FROM t) LEFT JOIN totals USING (lang) GROUP BY lang),
groups AS (SELECT lang, source, any_value(v) AS v, any_value(all_n) AS all_n, coalesce(sum(n), 0) AS group_n
           FROM (SELECT DISTINCT lang, source FROM t) JOIN langs USING (lang)
           LEFT JOIN counts USING (lang, source) GROUP BY lang, source),
p AS MATERIALIZED (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 2) // (g.group_n + 2 * g.v) AS p,
    1 + CAST(1000000000 AS HUGEINT) * (k.n + 2) // (g.all_n + 2 * g.v) AS q
  FROM groups g JOIN totals k USING (lang) LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source
    AND c.term = k.term),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
          FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
ranked AS (
  SELECT g.lang, g.source, 'pair' AS part, h.source AS item, coalesce(value, 0) AS value
  FROM groups g JOIN groups h ON g.lang = h.lang AND g.source <> h.source
  LEFT JOIN pairs ON pairs.lang = g.lang AND pairs.source = g.source AND pairs.item = h.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM ranked)
WHERE part = 'pair' OR rank <= 10"""


def _codes(rounds: int = 4) -> str:
    """Entries e0, e1, ... and parts assigned to them, one after the other.

    The components are whole numbers far below 2^26, so inner products in double precision are exact.
    """
    length = "(len(embedding) // 4)"
    steps = [f"""
WITH k AS MATERIALIZED (
  SELECT vec_id, label, embedding,
    list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
  SELECT vec_id, p, x, list_inner_product(x, x) AS xx
  FROM (SELECT vec_id, p, v[p * {length} + 1 : (p + 1) * {length}] AS x FROM k, range(4) AS r(p))),
e0 AS MATERIALIZED (
  SELECT p, e, x FROM parts JOIN (
    SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM k ORDER BY vec_id LIMIT 256) USING (vec_id))"""]
    for r in range(rounds + 1):
        steps.append(f"""
a{r} AS MATERIALIZED (
  SELECT vec_id, p, any_value(x) AS x, arg_min(e, d * 256 + e) AS e, min(d) AS d
  FROM (SELECT vec_id, p, parts.x AS x, e.e, xx + list_inner_product(e.x, e.x)
          - 2 * list_inner_product(parts.x, e.x) AS d FROM parts JOIN e{r} e USING (p))
  GROUP BY vec_id, p)""")
        if r < rounds:
            steps.append(f"""
m{r} AS (SELECT p, e, list(floor(s / n) ORDER BY i) AS x
         FROM (SELECT p, e, i, sum(c) AS s, count(*) AS n
               FROM (SELECT p, e, unnest(x) AS c, generate_subscripts(x, 1) AS i FROM a{r}) GROUP BY ALL)
         GROUP BY p, e),
e{r + 1} AS MATERIALIZED (SELECT p, e, coalesce(m.x, e{r}.x) AS x FROM e{r} LEFT JOIN m{r} m USING (p, e))""")
    return ",".join(steps) + f""",
listed AS (SELECT string_agg(CAST(CAST(c AS BIGINT) AS VARCHAR), ',' ORDER BY p, e, i) AS all_c
           FROM (SELECT p, e, unnest(x) AS c, generate_subscripts(x, 1) AS i FROM e{rounds})),
coded AS (SELECT vec_id, string_agg(lpad(lower(to_hex(e)), 2, '0'), '' ORDER BY p) AS code,
            CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  sha256(all_c) AS codebooks_sha256
FROM coded JOIN k USING (vec_id), listed"""


CODES = _codes()


def oracle_sql() -> dict[str, str]:
    return {
        "op2_pstable_hashing": VECTORS,
        "op4_wu_manber": DECONTAMINATION,
        "op11_segment_trees": DIVERGENCE,
        "op13_sequency_codes": CODES,
    }
