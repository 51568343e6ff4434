"""DuckDB SQL for the operators that SQL can express on whole tables.

The others are tested in tests/llm against brute-force versions, exact round
trips or held-out accuracy.
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_BLANK = rf"regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+')"

#: From linked pairs ``link(a, b)``, both ways: the least id each one reaches.
_REACH = """
reach(a, b) AS (
    SELECT a, b FROM link
    UNION
    SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a
)"""

ORACLE_SQL = {
    "op5_decontamination": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_ALNUM} AS w FROM documents),
i AS (SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item, {_ALNUM} AS w FROM benchmark),
iw AS (SELECT DISTINCT item, least(10, len(w)) AS k, array_to_string(w[p:p + least(10, len(w)) - 1], ' ') AS g
       FROM i, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS t(p) WHERE len(w) > 0),
dw AS (SELECT r, p, k, array_to_string(w[p:p + k - 1], ' ') AS g
       FROM d, (SELECT DISTINCT k FROM iw) AS ks, unnest(range(1, len(w) - k + 2)) AS t(p)),
hit AS (SELECT r, p, dw.k AS k, item FROM dw JOIN iw ON dw.k = iw.k AND dw.g = iw.g),
hw AS (SELECT r, count(DISTINCT q) AS n FROM hit, unnest(range(p, p + k)) AS u(q) GROUP BY r),
hi AS (SELECT r, count(*) AS n, sha256(string_agg(item, ',' ORDER BY item)) AS s
       FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(hw.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(hi.n, 0) AS BIGINT) AS n_items, coalesce(hi.s, sha256('')) AS items_sha256,
       coalesce(hw.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hw ON d.r = hw.r LEFT JOIN hi ON d.r = hi.r""",
    "op7_embedding_dedup": f"""
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS (SELECT * FROM v WHERE label IS NOT NULL AND len(e) > 0 AND list_count(e) = len(e)
       AND isfinite(list_sum(e)) AND list_max(e) - list_min(e) + abs(list_sum(e)) > 0),
link(a, b) AS (SELECT x.vec_id, y.vec_id FROM ok AS x JOIN ok AS y
    ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.e) = len(y.e)
    AND list_cosine_similarity(x.e, y.e) >= 0.98),
{_REACH},
c AS (SELECT a, least(a, min(b)) AS m FROM reach GROUP BY a),
n AS (SELECT a, count(DISTINCT b) AS k FROM link GROUP BY a)
SELECT v.vec_id AS vec_id, CAST(coalesce(n.k, 0) AS BIGINT) AS n_links, coalesce(c.m, v.vec_id) AS component_id,
       coalesce(c.m, v.vec_id) = v.vec_id AS kept
FROM v LEFT JOIN c ON v.vec_id = c.a LEFT JOIN n ON v.vec_id = n.a""",
    "op10_minhash_dedup": f"""
WITH RECURSIVE d AS (SELECT doc_id, {_BLANK} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[p:p + least(5, len(w)) - 1], ' ') AS g
      FROM d, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS t(p) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS k FROM s GROUP BY doc_id),
both_in AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k
            FROM s AS x JOIN s AS y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
link(a, b) AS (SELECT a, b FROM both_in JOIN n AS x ON a = x.doc_id JOIN n AS y ON b = y.doc_id
               WHERE 100 * both_in.k >= 85 * (x.k + y.k - both_in.k)),
{_REACH},
c AS (SELECT a, least(a, min(b)) AS m FROM reach GROUP BY a)
SELECT d.doc_id AS doc_id, CAST(coalesce(n.k, 0) AS BIGINT) AS n_shingles, coalesce(c.m, d.doc_id) AS component_id,
       coalesce(c.m, d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN c ON d.doc_id = c.a""",
}
