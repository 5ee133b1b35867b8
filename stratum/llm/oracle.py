"""DuckDB SQL that the operators' queries must equal, where SQL can express them."""

from __future__ import annotations

ORACLE = {
    "op11_merkle_manifest": """
WITH RECURSIVE fields AS (
    SELECT doc_id, source, text,
           list_transform([doc_id::VARCHAR, source, lang, n_chars::VARCHAR],
                          lambda v: coalesce(octet_length(encode(v))::VARCHAR || ':' || v, '-')) AS listed,
           list_reduce(
               list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
               lambda crc, c: list_reduce(
                   [xor(crc, c), 0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT],
                   lambda x, unused: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END
               )
           ) AS crc
    FROM documents
), leaves AS (
    SELECT doc_id, source,
           sha256(array_to_string(listed, '') || coalesce(octet_length(encode(text))::VARCHAR || ':' || text, '-')) AS leaf,
           CASE WHEN xor(crc, 4294967295::BIGINT) % 5 = 0
                THEN sha256(array_to_string(listed, '') || coalesce(octet_length(encode(text))::VARCHAR || ':'
                     || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) END AS now
    FROM fields
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
           count(*) OVER (PARTITION BY source) AS n,
           dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree
    FROM leaves
), nodes AS (
    SELECT 0 AS level, tree, place, leaf AS node, n FROM placed
    UNION ALL
    SELECT level + 1, tree, place // 16, sha256(string_agg(node, '' ORDER BY place)), (any_value(n) + 15) // 16
    FROM nodes WHERE n > 1 GROUP BY level, tree, place // 16
), tops AS (
    SELECT 0 AS level, tree AS place, node, count(*) OVER () AS n FROM nodes WHERE n = 1
    UNION ALL
    SELECT level + 1, place // 16, sha256(string_agg(node, '' ORDER BY place)), (any_value(n) + 15) // 16
    FROM tops WHERE n > 1 GROUP BY level, place // 16
), steps AS (
    SELECT tree, level, place, parent_runs.before, parent_runs.after, n FROM (
        SELECT a.tree, a.level, a.place, any_value(a.n) AS n, {
            'before': coalesce(string_agg(b.node, '' ORDER BY b.place) FILTER (WHERE b.place < a.place), ''),
            'after': coalesce(string_agg(b.node, '' ORDER BY b.place) FILTER (WHERE b.place > a.place), '')} AS parent_runs
        FROM (SELECT tree, level, place, node, n FROM nodes WHERE n > 1
              UNION ALL SELECT -1, level, place, node, n FROM tops WHERE n > 1) a
        JOIN (SELECT tree, level, place, node FROM nodes UNION ALL SELECT -1, level, place, node FROM tops) b
          ON b.tree = a.tree AND b.level = a.level AND b.place // 16 = a.place // 16
        GROUP BY a.tree, a.level, a.place)
), ways AS (
    SELECT doc_id, tree, p.place, 1 AS part, s.level, s.before, s.after, leaf, now
    FROM placed p JOIN steps s USING (tree) WHERE s.place = p.place // (16 ** s.level)::BIGINT
    UNION ALL
    SELECT doc_id, p.tree, p.place, 2, s.level, s.before, s.after, leaf, now
    FROM placed p JOIN steps s ON s.tree = -1 AND s.place = p.tree // (16 ** s.level)::BIGINT
), listed AS (
    SELECT tree, place, list({'before': before, 'after': after} ORDER BY part, level) AS steps,
           string_agg(before || after, '' ORDER BY part, level) AS siblings
    FROM ways GROUP BY tree, place
), folds AS (
    SELECT p.tree, p.place, 0 AS done, coalesce(p.now, p.leaf) AS node, coalesce(l.steps, []) AS steps
    FROM placed p LEFT JOIN listed l USING (tree, place)
    UNION ALL
    SELECT tree, place, done + 1, sha256(steps[done + 1].before || node || steps[done + 1].after), steps
    FROM folds WHERE done < len(steps)
)
SELECT p.doc_id, p.leaf, s.node AS subroot, r.node AS root, sha256(coalesce(l.siblings, '')) AS proof_sha256,
       f.node AS folded_root, f.node = r.node AS verified
FROM placed p
JOIN folds f ON f.tree = p.tree AND f.place = p.place AND f.done = len(f.steps)
LEFT JOIN listed l ON l.tree = p.tree AND l.place = p.place
JOIN nodes s ON s.tree = p.tree AND s.n = 1
CROSS JOIN (SELECT node FROM tops WHERE n = 1) r
""",
    "op12_hard_negatives": """
WITH rows AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(x::DOUBLE * 256)) AS parts
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
           list_inner_product(a.parts, b.parts)::BIGINT AS score
    FROM rows a JOIN rows b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.parts) = len(b.parts)
), positives AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score
    FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
), ranked AS (
    SELECT p.anchor_id, p.positive_id,
           row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id)::INTEGER AS rank,
           s.other_id AS negative_id, p.positive_score, s.score AS negative_score
    FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
     AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
)
SELECT * FROM ranked WHERE rank <= 3
""",
    "op13_suffix_dedup": """
WITH texts AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS bytes, octet_length(encode(coalesce(text, ''))) AS n
    FROM documents
), windows AS (
    SELECT doc_id, place, substr(bytes, 2 * place + 1, 100) AS piece
    FROM (SELECT doc_id, bytes, unnest(range(0, n - 49)) AS place FROM texts WHERE doc_id IS NOT NULL)
), hits AS (
    SELECT doc_id, place FROM windows
    JOIN (SELECT piece, min(doc_id) AS first_id FROM windows GROUP BY piece) USING (piece)
    WHERE first_id < doc_id
), stretches AS (
    SELECT doc_id, place, coalesce(place > max(place + 50) OVER (
        PARTITION BY doc_id ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS opens
    FROM hits
), spans AS (
    SELECT doc_id, min(place) AS first_byte, max(place) + 50 AS end_byte
    FROM (SELECT *, sum(opens::INTEGER) OVER (PARTITION BY doc_id ORDER BY place ROWS UNBOUNDED PRECEDING) AS span FROM stretches)
    GROUP BY doc_id, span
), gaps AS (
    SELECT doc_id, bytes, n, unnest([{'a': 0, 'b': n}]) AS gap FROM texts WHERE doc_id NOT IN (SELECT doc_id FROM spans)
    UNION ALL
    SELECT doc_id, bytes, n, {'a': coalesce(lag(end_byte) OVER earlier, 0), 'b': first_byte}
    FROM spans JOIN texts USING (doc_id) WINDOW earlier AS (PARTITION BY doc_id ORDER BY first_byte)
    UNION ALL
    SELECT doc_id, any_value(bytes), any_value(n), {'a': max(end_byte), 'b': any_value(n)}
    FROM spans JOIN texts USING (doc_id) GROUP BY doc_id
), kept AS (
    SELECT doc_id, any_value(n) AS n, string_agg(substr(bytes, 2 * gap.a + 1, 2 * (gap.b - gap.a)), '' ORDER BY gap.a) AS bytes
    FROM gaps GROUP BY doc_id
)
SELECT doc_id, n::BIGINT AS n_bytes, (n - length(bytes) // 2)::BIGINT AS n_removed,
       (SELECT count(*) FROM spans s WHERE s.doc_id = k.doc_id) AS n_spans, sha256(unhex(bytes)) AS kept_sha256
FROM kept k
""",
}
