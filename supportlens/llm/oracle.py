"""Equivalent SQL, for the queries that SQL can express."""

ORACLES: dict[str, str] = {
    "op1_warc": """
        WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS d FROM pages),
             f AS (SELECT *, min(page_id) OVER (PARTITION BY d) AS first FROM p)
        SELECT page_id, n AS payload_bytes, d AS payload_digest,
               CASE WHEN n >= 100 AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN n >= 100 AND first <> page_id THEN first END AS refers_to FROM f""",
    "op3_multi_index": """
        WITH RECURSIVE v AS (
            SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
                 WHERE list_dot_product(a.e, b.e) / sqrt(list_dot_product(a.e, a.e)) / sqrt(list_dot_product(b.e, b.e)) >= 0.95),
        reach(a, b) AS (SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a)
        SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(low, vec_id)) AS component_id,
               vec_id <= coalesce(low, vec_id) AS kept
        FROM embeddings LEFT JOIN (SELECT a, count(*) AS n FROM link GROUP BY a) d ON d.a = vec_id
        LEFT JOIN (SELECT a, min(b) AS low FROM reach GROUP BY a) r ON r.a = vec_id""",
    "op10_exact_dedup": r"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t,
                          regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS s FROM documents),
             r AS (SELECT doc_id, s, count(*) OVER (PARTITION BY s) AS group_size,
                          first_value(doc_id) OVER w AS keep_id, row_number() OVER w AS n
                   FROM d WINDOW w AS (PARTITION BY s ORDER BY length(t) DESC, doc_id))
        SELECT doc_id, keep_id, group_size, n = 1 AS kept, sha256(s) AS text_sha256 FROM r""",
    "op12_merkle_manifest": """
        WITH RECURSIVE d AS (
            SELECT row_number() OVER () AS r, doc_id, lang, text,
                   coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
                   || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head
            FROM documents),
        e AS (SELECT r, doc_id, lang, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
                     xor(4294967295, list_reduce(
                         list_prepend(CAST(4294967295 AS BIGINT), [ord(c) FOR c IN string_split(CAST(doc_id AS VARCHAR), '')]),
                         lambda c, b: list_reduce(list_prepend(xor(c, CAST(b AS BIGINT)), range(8)), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))
                     )) AS crc,
                     sha256(head || coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) AS low
              FROM d),
        leaves AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS i,
                          count(*) OVER (PARTITION BY lang) AS n FROM e),
        node AS (SELECT lang, 0 AS l, i, n, leaf AS h FROM leaves
                 UNION ALL
                 SELECT lang, l + 1, i // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY i)) FROM node WHERE n > 1
                 GROUP BY lang, l, i // 8, n),
        subroot AS (SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM node WHERE n = 1),
        top AS (SELECT 0 AS l, i, n, h FROM subroot
                UNION ALL
                SELECT l + 1, i // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY i)) FROM top WHERE n > 1 GROUP BY l, i // 8, n),
        side AS (SELECT lang, l, i, coalesce(string_agg(h, '') OVER (PARTITION BY lang, l, i // 8 ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS a,
                        coalesce(string_agg(h, '') OVER (PARTITION BY lang, l, i // 8 ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS b
                 FROM node WHERE n > 1),
        top_side AS (SELECT l, i, coalesce(string_agg(h, '') OVER (PARTITION BY l, i // 8 ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS a,
                            coalesce(string_agg(h, '') OVER (PARTITION BY l, i // 8 ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS b
                     FROM top WHERE n > 1),
        fold AS (SELECT r, lang, 0 AS l, i, n, CASE WHEN crc % 3 = 0 THEN low ELSE leaf END AS h, '' AS proof FROM leaves
                 UNION ALL
                 SELECT f.r, f.lang, f.l + 1, f.i // 8, (f.n + 7) // 8, sha256(a || f.h || b), f.proof || a || b
                 FROM fold f JOIN side s ON s.lang IS NOT DISTINCT FROM f.lang AND s.l = f.l AND s.i = f.i),
        top_fold AS (SELECT f.r, 0 AS l, s.i, s.n, f.h, f.proof
                     FROM fold f JOIN subroot s ON s.lang IS NOT DISTINCT FROM f.lang WHERE f.n = 1
                     UNION ALL
                     SELECT f.r, f.l + 1, f.i // 8, (f.n + 7) // 8, sha256(a || f.h || b), f.proof || a || b
                     FROM top_fold f JOIN top_side s ON s.l = f.l AND s.i = f.i)
        SELECT v.doc_id, v.leaf, s.h AS subroot, t.h AS root, sha256(f.proof) AS proof_sha256, f.h AS folded_root, f.h = t.h AS verified
        FROM leaves v JOIN subroot s ON s.lang IS NOT DISTINCT FROM v.lang JOIN top t ON t.n = 1
        JOIN top_fold f ON f.r = v.r AND f.n = 1""",
}
