"""DuckDB statements for the operators whose results SQL can state."""

SOURCE_MIX = r"""
WITH d AS (
    SELECT doc_id, source, md5(concat_ws(':', '20', doc_id::VARCHAR)) AS k,
           len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
    FROM documents
), s AS (
    SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS place
    FROM d GROUP BY source
), w AS (
    SELECT *, ([3.0, 1.0, 2.0]::DOUBLE[])[((place - 1) % 3 + 1)::INT] AS weight, (2 * source_size)::DOUBLE AS cap FROM s
), b AS (
    SELECT 1.5::DOUBLE * sum(source_size)::DOUBLE AS budget, sum(weight) AS weights FROM w
), f AS (
    SELECT w.*, b.budget, cap / weight AS fill,
           (b.budget - coalesce(sum(cap) OVER before, 0.0)) / (b.weights - coalesce(sum(weight) OVER before, 0.0)) AS level
    FROM w, b
    WINDOW before AS (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), l AS (
    SELECT arg_min(level, (fill, place)) AS level FROM f WHERE fill > level
), t AS (
    SELECT f.source, f.source_size, f.budget, CASE WHEN l.level IS NULL THEN cap ELSE least(cap, weight * l.level) END AS target
    FROM f, l
), q AS (
    SELECT doc_id, source, size, sum(size) OVER o AS served, row_number() OVER o AS nth
    FROM d WINDOW o AS (PARTITION BY source ORDER BY k, size ROWS UNBOUNDED PRECEDING)
), r AS (
    SELECT q.*, t.source_size, t.target, t.budget, n.round,
           (n.round * t.source_size + q.served)::DOUBLE / nullif(t.target, 0) AS finish
    FROM q JOIN t ON q.source IS NOT DISTINCT FROM t.source, (SELECT unnest([0, 1]) AS round) n
), c AS (
    SELECT *, sum(size) OVER (ORDER BY finish NULLS LAST, source NULLS LAST, nth, round ROWS UNBOUNDED PRECEDING) AS spent FROM r
)
SELECT doc_id, source, size, source_size, target,
       sum(CASE WHEN spent <= budget THEN size ELSE 0 END)::BIGINT AS taken
FROM c GROUP BY doc_id, source, size, source_size, target, nth
"""

DECONTAMINATE = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), i AS (
    SELECT item_id::VARCHAR AS item,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), iw AS (
    SELECT DISTINCT item, least(13, len(w)) AS n, w[p:p + least(13, len(w)) - 1] AS win
    FROM i, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS u(p) WHERE len(w) > 0
), lens AS (SELECT DISTINCT n FROM iw
), dw AS (
    SELECT r, p, n, w[p:p + n - 1] AS win FROM d, lens, unnest(range(1, len(w) - n + 2)) AS u(p) WHERE len(w) >= n
), h AS (
    SELECT dw.r, dw.p, dw.n, iw.item FROM dw JOIN iw ON dw.n = iw.n AND dw.win = iw.win
), words AS (
    SELECT r, count(DISTINCT q) AS n_hit
    FROM (SELECT r, unnest(range(p, p + n)) AS q FROM (SELECT DISTINCT r, p, n FROM h)) GROUP BY r
), items AS (
    SELECT r, count(item) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
    FROM (SELECT DISTINCT r, item FROM h) GROUP BY r
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""

#: crc32 of an ASCII string, byte by byte over a table that is computed here.
_CRC32 = """
crc_table AS (
    SELECT list(v ORDER BY n) AS entries
    FROM (SELECT n, list_reduce(list_prepend(n::BIGINT, range(8)),
                                lambda c, step: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
          FROM range(256) AS t(n))
)"""


def _crc32(text: str) -> str:
    codes = f"list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)"
    step = "xor(c >> 8, crc_table.entries[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295, {codes}), lambda c, b: {step}), 4294967295)"


PREFIX_TRIE = f"""
WITH {_CRC32}, t AS (
    SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS p,
           coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
    SELECT c, c - c % 5 AS first, {_crc32("c::VARCHAR")} % 9 AS h FROM (SELECT DISTINCT c FROM t), crc_table
), rebuilt AS (
    SELECT convs.c, 0 AS part, p, role, text FROM convs JOIN t ON t.c = first AND p <= h
    UNION ALL
    SELECT convs.c, 1, p, role, text FROM convs JOIN t ON t.c = convs.c AND p > h
), placed AS (
    SELECT c, row_number() OVER (PARTITION BY c ORDER BY part, p) AS d, {{'role': role, 'text': text}} AS turn FROM rebuilt
), whole AS (
    SELECT convs.c, coalesce(s.path, []) AS path
    FROM convs LEFT JOIN (SELECT c, list(turn ORDER BY d) AS path FROM placed GROUP BY c) s ON s.c = convs.c
), member AS (
    SELECT c, d, path[1:d] AS path, d = len(path) AS ends FROM whole, unnest(range(0, len(path) + 1)) AS u(d)
), node AS (
    SELECT d, path, min(c) AS c, count(*) AS n, CASE WHEN d = 0 THEN 0 ELSE strlen(path[d].text) END AS bytes,
           sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE ends), '')) AS ends_sha256
    FROM member GROUP BY d, path
), kids AS (
    SELECT d - 1 AS d, path[1:d - 1] AS path, count(*) AS n FROM node WHERE d > 0 GROUP BY ALL
), below AS (
    SELECT a.d, a.path, sum((b.n - 1) * b.bytes)::BIGINT AS saved, count(*) FILTER (WHERE k.n IS NULL) AS leaves
    FROM node a JOIN node b ON b.d >= a.d AND b.path[1:a.d] = a.path LEFT JOIN kids k ON k.d = b.d AND k.path = b.path
    GROUP BY a.d, a.path
)
SELECT node.c AS conv_id, node.d AS depth, up.c AS parent_conv_id, node.n AS n_convs, coalesce(kids.n, 0)::BIGINT AS n_children,
       leaves AS n_leaves, saved AS saved_tokens, node.ends_sha256
FROM node JOIN below ON below.d = node.d AND below.path = node.path
LEFT JOIN kids ON kids.d = node.d AND kids.path = node.path
LEFT JOIN node up ON up.d = node.d - 1 AND up.path = node.path[1:node.d - 1]
"""

NEAR_VECTORS = """
WITH RECURSIVE v AS (
    SELECT row_number() OVER () AS r, vec_id, embedding::DOUBLE[] AS e FROM embeddings
), u AS MATERIALIZED (
    SELECT * FROM v
    WHERE len(e) > 0 AND len(list_filter(e, lambda x: coalesce(NOT isfinite(x), true))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
), link AS (
    SELECT a.r AS a, b.r AS b FROM u a JOIN u b ON a.r <> b.r AND len(a.e) = len(b.e)
    WHERE CASE WHEN len(a.e) = len(b.e) THEN list_cosine_similarity(a.e, b.e) >= 0.9 END
), reach AS (
    SELECT r, vec_id AS id FROM v
    UNION
    SELECT link.a, reach.id FROM reach JOIN link ON link.b = reach.r
), least AS (
    SELECT r, min(id) AS id FROM reach GROUP BY r
), n AS (
    SELECT a AS r, count(*) AS n FROM link GROUP BY a
)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, id AS component_id, vec_id IS NOT DISTINCT FROM id AS kept
FROM v JOIN least USING (r) LEFT JOIN n USING (r)
"""
