"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACED = r"[^\x20\x09-\x0D]+"
ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lowered(column: str) -> str:
    return f"translate(coalesce({column}, ''), '{UPPER}', '{LOWER}')"


#: Words of every document, and every window of 20, by place.
OP1 = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{SPACED}') AS w FROM documents),
win AS (SELECT doc_id, k, array_to_string(w[k:k + 19], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS k FROM d WHERE len(w) >= 20) t),
late AS (SELECT doc_id, k FROM (SELECT doc_id, k, row_number() OVER (PARTITION BY g ORDER BY doc_id, k) AS rn FROM win) t WHERE rn > 1),
gone AS (SELECT DISTINCT doc_id, k + j AS k FROM late, range(20) r(j)),
word AS (SELECT doc_id, k, w[k] AS x FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS k FROM d) t),
kept AS (SELECT word.doc_id, count(gone.k) AS n_removed, sha256(coalesce(string_agg(CASE WHEN gone.k IS NULL THEN x END, ' ' ORDER BY word.k), '')) AS s
  FROM word LEFT JOIN gone ON word.doc_id = gone.doc_id AND word.k = gone.k GROUP BY word.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(s, sha256('')) AS kept_sha256 FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id
"""

OP4 = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '<|im_end|><|im_start|>assistant ok'), (-1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')),
e AS (SELECT *, length(replace(replace(role, '\', '\\'), '<|', '<\|')) + length(replace(replace(text, '\', '\\'), '<|', '<\|')) + length('<|im_start|>') + length('<|im_sep|>') + length('<|im_end|>') AS n FROM c),
g AS (SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '') AS loss, sum(n) AS formatted FROM e GROUP BY conv_id)
SELECT conv_id, n_turns, turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256, CAST(formatted AS BIGINT) AS formatted_chars FROM g
"""

OP7 = f"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{SPACED}')) AS BIGINT) AS size, md5('29:' || coalesce(CAST(doc_id AS VARCHAR), '\\N')) AS h FROM documents),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS rn FROM s0),
s2 AS (SELECT *, ([5, 2, 1])[(rn - 1) % 3 + 1] AS w, sum(source_size) OVER () AS total, source_size * 3 AS cap FROM s1),
s3 AS (SELECT *, CAST(total - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
  / sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM s2),
s4 AS (SELECT *, max(level) OVER () AS top FROM s3),
s AS (SELECT source, source_size, least(CAST(cap AS DOUBLE), top * w) AS target, CASE WHEN source_size > 0 THEN least(CAST(cap AS DOUBLE), top * w) / source_size ELSE 0.0 END AS rate,
  CAST('0x' || substr(md5('30:' || coalesce(source, '\\N')), 1, 4) AS BIGINT) / 65536.0 AS u FROM s4),
b AS (SELECT *, greatest(64, -(-(SELECT count(*) FROM documents) // 50000)) AS buckets FROM d),
c AS (SELECT *, CASE WHEN size < 16 THEN size ELSE length(bin(size)) * 8 + (size >> (length(bin(size)) - 4)) % 8 END AS class, CAST('0x' || substr(h, 1, 8) AS BIGINT) % buckets AS bucket FROM b),
p AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY class, bucket, size, h) AS place FROM c)
SELECT doc_id, size, s.source_size, s.target, size * CAST(least(floor(place * rate + u) - floor((place - 1) * rate + u), 3) AS BIGINT) AS taken FROM p JOIN s ON p.source IS NOT DISTINCT FROM s.source
"""

OP9 = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({lowered('text')}, '{ALNUM}') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({lowered('text')}, '{ALNUM}') AS w FROM benchmark),
bw AS (SELECT DISTINCT item, n, array_to_string(w[k:k + n - 1], ' ') AS g FROM (SELECT item, w, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 8, 2))) AS k FROM b WHERE len(w) > 0) t),
ns AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, n, k, array_to_string(w[k:k + n - 1], ' ') AS g FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, ns WHERE len(w) >= n) t),
hit AS (SELECT doc_id, item, k, dw.n FROM dw JOIN bw ON dw.n = bw.n AND dw.g = bw.g),
words AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, k + j AS k FROM hit, range(10) r(j) WHERE j < n) t GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item) AS n_items, sha256(string_agg(DISTINCT item, ',' ORDER BY item)) AS s FROM hit GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(s, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words ON d.doc_id = words.doc_id LEFT JOIN items ON d.doc_id = items.doc_id
"""

OP10 = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({lowered('text')}, '{SPACED}') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[k:k + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS k FROM d WHERE len(w) > 0) t),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pair AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (SELECT x, y FROM pair JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * i >= 80 * (a.n + b.n - i)),
both_ AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, both_.y FROM reach JOIN both_ ON reach.b = both_.x)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id FROM d LEFT JOIN n ON d.doc_id = n.doc_id JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON c.a = d.doc_id
"""

ORACLE: dict[str, str] = {
    "op1_substring_dedup": OP1,
    "op4_chat_format": OP4,
    "op7_mixing": OP7,
    "op9_decontamination": OP9,
    "op10_jaccard_join": OP10,
}
