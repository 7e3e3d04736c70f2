"""DuckDB SQL for the operators that SQL can express over the supplied tables,
whose ids are unique: repeated passages by grouping the digests of all windows,
and the Merkle manifest by recursion over the levels of its trees (with crc32
spelt out bit by bit)."""

from __future__ import annotations

SUBSTRING_DEDUP = r"""
WITH n AS (
    SELECT doc_id, words, len(words) AS n
    FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents)),
windows AS (
    SELECT doc_id, i, md5(array_to_string(words[i : i + 34], ' ')) AS h
    FROM (SELECT doc_id, words, unnest(range(1, n - 33)) AS i FROM n WHERE n >= 35)),
repeated AS (SELECT h FROM windows GROUP BY h HAVING count(*) > 1),
covered AS (
    SELECT DISTINCT doc_id, p
    FROM (SELECT doc_id, unnest(range(i, i + 35)) AS p FROM windows SEMI JOIN repeated USING (h))),
placed AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, n + 1)) AS p FROM n),
kept AS (
    SELECT doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY p) AS text
    FROM placed ANTI JOIN covered USING (doc_id, p) GROUP BY doc_id)
SELECT n.doc_id, n.n AS n_words, n.n - coalesce(k.n_kept, 0) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM n LEFT JOIN kept k ON n.doc_id = k.doc_id
"""

MERKLE_MANIFEST = r"""
WITH RECURSIVE coded AS (
    SELECT doc_id, source, text, coalesce(octet_length(encode(doc_id::VARCHAR)) || ':' || doc_id::VARCHAR, '-') || coalesce(octet_length(encode(source)) || ':' || source, '-')
        || coalesce(octet_length(encode(lang)) || ':' || lang, '-') || coalesce(octet_length(encode(n_chars::VARCHAR)) || ':' || n_chars::VARCHAR, '-') AS head,
        list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)), lambda h, c:
            list_reduce(list_prepend(xor(h, c), range(8)), lambda x, k: xor(x >> 1, (x & 1) * 3988292384))) AS crc
    FROM documents),
leaves AS (
    SELECT doc_id, source, sha256(head || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS leaf,
        CASE WHEN (crc & 1) = 1 THEN sha256(head || coalesce(octet_length(encode(replace(text, chr(10), ''))) || ':' || replace(text, chr(10), ''), '-')) END AS other,
        row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST) - 1 AS i,
        dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS s
    FROM coded),
low AS (
    SELECT s, 0 AS lvl, i, leaf AS d, count(*) OVER (PARTITION BY s) AS c FROM leaves
    UNION ALL
    SELECT s, lvl, i, d, count(*) OVER (PARTITION BY s) AS c FROM (
        SELECT s, lvl + 1 AS lvl, i // 3 AS i, sha256(string_agg(d, '' ORDER BY i)) AS d FROM low WHERE c > 1 GROUP BY s, lvl, i // 3)),
subroots AS (SELECT s, d FROM low WHERE c = 1),
high AS (
    SELECT 0 AS lvl, s AS i, d, count(*) OVER () AS c FROM subroots
    UNION ALL
    SELECT lvl, i, d, count(*) OVER () AS c FROM (
        SELECT lvl + 1 AS lvl, i // 3 AS i, sha256(string_agg(d, '' ORDER BY i)) AS d FROM high WHERE c > 1 GROUP BY lvl, i // 3)),
runs AS (
    SELECT s, lvl, i // 3 AS up, list(d ORDER BY i) AS ds FROM low WHERE c > 1 GROUP BY s, lvl, i // 3
    UNION ALL
    SELECT -1, lvl, i // 3, list(d ORDER BY i) FROM high WHERE c > 1 GROUP BY lvl, i // 3),
fold AS (
    SELECT s, i AS leaf_i, 0 AS part, 0 AS lvl, i, coalesce(other, leaf) AS x, '' AS proof FROM leaves
    UNION ALL
    SELECT f.s, f.leaf_i, CASE WHEN r.s IS NULL THEN 1 ELSE f.part END, CASE WHEN r.s IS NULL THEN 0 ELSE f.lvl + 1 END, CASE WHEN r.s IS NULL THEN f.s ELSE f.i // 3 END,
        CASE WHEN r.s IS NULL THEN x ELSE sha256(array_to_string(r.ds[: f.i % 3], '') || x || array_to_string(r.ds[f.i % 3 + 2 :], '')) END,
        CASE WHEN r.s IS NULL THEN proof ELSE proof || array_to_string(r.ds[: f.i % 3], '') || array_to_string(r.ds[f.i % 3 + 2 :], '') END
    FROM fold f LEFT JOIN runs r ON r.s = CASE WHEN f.part = 0 THEN f.s ELSE -1 END AND r.lvl = f.lvl AND r.up = f.i // 3
    WHERE r.s IS NOT NULL OR f.part = 0),
done AS (SELECT s, leaf_i, x, proof FROM fold QUALIFY row_number() OVER (PARTITION BY s, leaf_i ORDER BY part DESC, lvl DESC) = 1)
SELECT l.doc_id, l.leaf, b.d AS subroot, t.d AS root, sha256(o.proof) AS proof_sha256, o.x AS folded_root, o.x = t.d AS verified
FROM leaves l JOIN subroots b USING (s) JOIN done o ON o.s = l.s AND o.leaf_i = l.i CROSS JOIN (SELECT d FROM high WHERE c = 1) t
"""
