"""The registered queries of this subpackage and their oracle SQL."""

from __future__ import annotations

from pluvio.llm.decontaminate import op11_prefix_decontamination
from pluvio.llm.idfiles import op4_simple8b_ids
from pluvio.llm.htmltext import op10_html_mincut
from pluvio.llm.jaccard import op7_ngram_jaccard_join
from pluvio.llm.neighbours import op2_cross_polytope
from pluvio.llm.negatives import op12_onebit_hard_negatives
from pluvio.llm.packing import op6_best_fit_packing
from pluvio.llm.quality import op5_quality
from pluvio.llm.segment import op1_gumbel_segmentations
from pluvio.llm.toolcalls import op9_tool_call_linking
from pluvio.llm.topk import op3_mtree_topk
from pluvio.llm.toxicity import op8_toxicity
from pluvio.llm.walsh import ROUNDS, op13_walsh_clustering

QUERIES = {
    f.__name__: f for f in (
        op1_gumbel_segmentations, op2_cross_polytope, op3_mtree_topk, op4_simple8b_ids, op5_quality, op6_best_fit_packing, op7_ngram_jaccard_join, op8_toxicity,
        op9_tool_call_linking, op10_html_mincut, op11_prefix_decontamination, op12_onebit_hard_negatives,
        op13_walsh_clustering,
    )
}

def _clustering_sql(rounds: int) -> str:
    """Rounds of assigning and averaging, one after the other."""
    best = """a{n} AS (
    SELECT r, vec_id, q, k, d FROM (
        SELECT r, vec_id, v.q, k, list_sum(list_transform(list_zip(v.q, c{n}.q), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d FROM v, c{n})
    QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, k) = 1
)"""
    mean = """s{n} AS (SELECT k, i, sum(q[i])::BIGINT AS s, count(*) AS n FROM a{n}, range(1, 65) AS t(i) GROUP BY k, i),
m{n} AS (SELECT k, list((s - ((s % n) + n) % n) // n ORDER BY i) AS q FROM s{n} GROUP BY k),
c{next} AS (SELECT c{n}.k, coalesce(m{n}.q, c{n}.q) AS q FROM c{n} LEFT JOIN m{n} ON c{n}.k = m{n}.k)"""
    steps = [x.format(n=n, next=n + 1) for n in range(rounds) for x in (best, mean)] + [best.format(n=rounds)]
    return f"""
WITH v AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS q FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id), q) - 1 AS k, q FROM v WHERE vec_id IS NOT NULL
    QUALIFY row_number() OVER (ORDER BY sha256('3:' || vec_id), q) <= 8
), {", ".join(s.replace(" AS (", " AS MATERIALIZED (") for s in steps)}
SELECT vec_id, a{rounds}.k::INT AS cluster, d AS distance, sum(d) OVER (PARTITION BY a{rounds}.k)::BIGINT AS cluster_inertia,
    sum(d) OVER ()::BIGINT AS inertia, sha256(array_to_string(c{rounds}.q, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} ON a{rounds}.k = c{rounds}.k
"""


ORACLES: dict[str, str] = {
    "op13_walsh_clustering": _clustering_sql(ROUNDS),
    "op12_onebit_hard_negatives": """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q
    FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT a.vec_id AS a, o.vec_id AS o, a.label = o.label AS same, list_sum(list_transform(list_zip(a.q, o.q), lambda p: p[1] * p[2]))::BIGINT AS score
    FROM v a JOIN v o ON a.vec_id % 100 = 0 AND a.vec_id <> o.vec_id AND len(a.q) = len(o.q)
), p AS (SELECT a, o, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, o) <= 5)
SELECT p.a AS anchor_id, p.o AS positive_id, row_number() OVER (PARTITION BY p.a, p.o ORDER BY s.score DESC, s.o)::INT AS rank, s.o AS negative_id,
    p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON p.a = s.a AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
QUALIFY rank <= 10
""",
    "op3_mtree_topk": """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT q.vec_id AS query_id, c.vec_id,
        max(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])))::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
    GROUP BY q.vec_id, c.vec_id
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM s
QUALIFY rank <= 5
""",
    "op9_tool_call_linking": r"""
WITH m AS (
    SELECT conv_id, turn::BIGINT AS turn, role, coalesce(text, '') AS text,
        len(list_filter(regexp_split_to_array(coalesce(text, ''), '[ \n]+'), lambda x: x <> '')) AS n
    FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL
), calls AS (
    SELECT conv_id, turn, conv_id || '-' || turn AS call_id, CASE WHEN length(text) <= 200 THEN 'lookup' ELSE 'answer' END AS name,
        CASE WHEN length(text) <= 200 THEN '{"limit":' || n || ',"query":' || to_json(text) || '}'
            ELSE '{"question":' || to_json(text) || ',"style":"' || CASE WHEN n < 40 THEN 'short' ELSE 'wordy' END || '","words":' || n || '}' END AS arguments,
        list_filter(CASE WHEN length(text) <= 200 THEN [
                CASE WHEN n > 30 THEN 'large limit' END, CASE WHEN n < 1 THEN 'small limit' END, CASE WHEN text = '' THEN 'small query' END]
            ELSE [CASE WHEN n > 60 THEN 'large words' END, CASE WHEN n < 10 THEN 'small words' END, CASE WHEN n >= 40 THEN 'value style' END]
            END, lambda x: x IS NOT NULL) AS errors
    FROM m WHERE role = 'user'
), results AS (
    SELECT conv_id, conv_id || '-' || (turn - 1) AS call_id, arg_min(text, turn) AS content, min(turn) AS turn, count(*) AS n_results
    FROM m WHERE role = 'assistant' GROUP BY ALL
), j AS (
    SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, coalesce(c.turn, r.turn) AS turn, coalesce(c.call_id, r.call_id) AS call_id,
        c.name, c.errors, r.content, coalesce(r.n_results, 0) AS n_results, c.arguments,
        CASE WHEN c.call_id IS NULL THEN 'orphan' WHEN count(c.call_id) OVER (PARTITION BY c.conv_id, c.call_id) > 1 THEN 'repeated'
            WHEN r.call_id IS NULL THEN 'pending' ELSE 'linked' END AS status
    FROM calls c FULL JOIN results r ON c.conv_id = r.conv_id AND c.call_id = r.call_id
)
SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, call_id)::BIGINT AS place, turn, call_id, name, status, n_results::BIGINT AS n_results,
    array_to_string(list_sort(errors), '; ') AS errors,
    md5('{"arguments":' || coalesce(arguments, 'null') || ',"call_id":' || to_json(call_id) || ',"conv_id":' || conv_id
        || CASE WHEN errors IS NULL THEN '' ELSE ',"errors":' || to_json(list_sort(errors)) END
        || CASE WHEN name IS NULL THEN '' ELSE ',"name":' || to_json(name) END
        || CASE WHEN content IS NULL THEN '' ELSE ',"result":' || to_json(content) END
        || ',"status":"' || status || '","turn":' || turn || '}') AS json_md5
FROM j
""",
    "op7_ngram_jaccard_join": r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS w
    FROM documents
), sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s
    FROM words
), one AS (SELECT min(doc_id) AS doc_id, s FROM (SELECT doc_id, list_sort(s) AS s FROM sets) WHERE len(s) > 0 GROUP BY s),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM one),
common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k, any_value(a.n) AS na, any_value(b.n) AS nb
    FROM items a JOIN items b ON a.x = b.x AND a.doc_id < b.doc_id AND 100 * a.n >= 85 * b.n AND 100 * b.n >= 85 * a.n
    GROUP BY a.doc_id, b.doc_id
), links AS (SELECT a, b FROM common WHERE 100 * k >= 85 * (na + nb - k)),
copies AS (SELECT sets.doc_id, one.doc_id AS rep FROM sets JOIN one ON list_sort(sets.s) = one.s),
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links UNION SELECT doc_id, doc_id FROM one),
reach AS (SELECT a, b FROM both_ways UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a),
least AS (SELECT a, min(b) AS component FROM reach GROUP BY a)
SELECT sets.doc_id, len(sets.s)::BIGINT AS n_shingles, coalesce(least.component, sets.doc_id)::BIGINT AS component_id
FROM sets LEFT JOIN copies ON copies.doc_id = sets.doc_id LEFT JOIN least ON least.a = copies.rep
""",
    "op11_prefix_decontamination": r"""
WITH words AS (
    SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), items AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), windows AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS x
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM windows), runs AS (
    SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS x
    FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM words, sizes WHERE len(w) >= n)
), hits AS (SELECT r, i, runs.n, item_id FROM runs JOIN windows USING (x)),
places AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r),
named AS (
    SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
    FROM (SELECT DISTINCT r, item_id::VARCHAR AS id FROM hits WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN places USING (r) LEFT JOIN named USING (r)
""",
}
