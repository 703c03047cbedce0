"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

from . import linetree, urltree

ORACLES: dict[str, str] = {}

ORACLES["op3_topk"] = """
WITH v AS (
    SELECT row_number() OVER () AS rid, vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) = len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)])
), s AS (
    SELECT q.rid AS qid, q.vec_id AS query_id, c.rid AS rid, c.vec_id AS vec_id,
           CAST(list_inner_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
    FROM v q, v c
    WHERE q.vec_id % 20 = 0 AND c.rid <> q.rid AND len(q.e) = len(c.e)
), r AS (
    SELECT query_id, row_number() OVER (PARTITION BY qid ORDER BY score DESC, vec_id NULLS LAST, rid) AS rank, vec_id, score FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20
"""

ORACLES["op1_url_filter"] = urltree.oracle()
ORACLES["op4_line_dedup"] = linetree.oracle()
ORACLES["op5_decontaminate"] = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
    SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), bw AS (
    SELECT DISTINCT item_id, m, array_to_string(w[s : s + m - 1], ' ') AS win
    FROM (SELECT item_id, w, least(13, len(w)) AS m, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS s FROM b WHERE len(w) > 0)
), dw AS (
    SELECT doc_id, m, s, array_to_string(w[s : s + m - 1], ' ') AS win
    FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS s FROM d, (SELECT DISTINCT m FROM bw) WHERE len(w) >= m)
), h AS (SELECT doc_id, m, s, win FROM dw SEMI JOIN bw USING (m, win)),
hit AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(s, s + m)) AS p FROM h) GROUP BY doc_id),
items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
    FROM (SELECT DISTINCT doc_id, item_id FROM h JOIN bw USING (m, win)) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""
ORACLES["op7_recompression"] = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), win AS (
    SELECT doc_id, s, array_to_string(w[s : s + 34], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS s FROM d WHERE len(w) >= 35)
), again AS (SELECT k FROM win GROUP BY k HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 35)) AS p FROM win SEMI JOIN again USING (k)),
kept AS (
    SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS kept
    FROM (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d) ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
