"""DuckDB SQL for the queries that SQL can express on whole tables."""

from __future__ import annotations

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"list_filter(string_split_regex({_LOWER}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"

OP3 = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(string_split_regex(t, '[ \t-\r]+'), lambda x: x <> '') AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \t-\r]')) AS l FROM d),
win AS (SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT rid, w, unnest(generate_series(1, len(w) - 2)) AS i FROM w WHERE len(w) >= 3)),
rep AS (SELECT rid, count(*) AS n FROM (SELECT DISTINCT rid, unnest([i, i + 1, i + 2]) AS p FROM (SELECT *, count(*) OVER (PARTITION BY rid, g) AS c FROM win) WHERE c > 1) GROUP BY rid),
m AS (SELECT w.rid, doc_id, stratum, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[ \t-\r]', '', 'g'))::BIGINT AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, len(l)::BIGINT AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
             coalesce(rep.n, 0)::BIGINT AS n_repeat_words FROM w LEFT JOIN rep ON w.rid = rep.rid),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
v AS (SELECT rid, doc_id, stratum, base_failed, unnest([
        {'rule': 'symbols', 'v': 1000 * n_symbols // n_words}, {'rule': 'dup_lines', 'v': 1000 * n_dup_lines // greatest(n_lines, 1)},
        {'rule': 'repeats', 'v': 1000 * n_repeat_words // n_words}, {'rule': 'long_words', 'v': 100 * word_chars // n_words},
        {'rule': 'short_words', 'v': 1000 * n_words // greatest(word_chars, 1)}], recursive := true) FROM b WHERE NOT base_failed),
good AS (SELECT DISTINCT doc_id FROM labels WHERE quality = 1),
grid AS (SELECT unnest([5, 10, 20, 30, 50, 75, 100, 150, 200, 250, 300, 400, 500, 600, 700, 800, 900, 1000, 1500, 2000, 3000]) AS cutoff),
h AS (SELECT stratum, rule, doc_id, max(v) AS v FROM v JOIN good USING (doc_id) GROUP BY stratum, rule, doc_id),
k AS (SELECT stratum, rule, cutoff, count(*) AS n, count(*) FILTER (v > cutoff) AS k FROM h, grid GROUP BY stratum, rule, cutoff),
p AS (SELECT *, CASE WHEN k >= n * 0.03 THEN 1.0 ELSE list_sum(list_transform(generate_series(0, k), lambda j:
        exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln(0.03) + (n - j) * ln(0.97)))) END AS p_value FROM k),
lim AS (SELECT 0.05 / greatest(1, count(*)) AS level FROM (SELECT DISTINCT stratum, rule FROM k)),
cut AS (SELECT stratum, rule, min(cutoff) FILTER (cutoff > coalesce(failed, -1)) AS cutoff FROM (
          SELECT p.*, max(CASE WHEN p_value > level THEN cutoff END) OVER (PARTITION BY stratum, rule) AS failed FROM p, lim) GROUP BY stratum, rule),
bad AS (SELECT DISTINCT rid FROM v JOIN cut USING (stratum, rule) WHERE v > cutoff)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND bad.rid IS NULL AS kept FROM b LEFT JOIN bad ON b.rid = bad.rid
"""

OP4 = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(strlen(text), 0)::BIGINT AS n_bytes,
                  ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h FROM documents),
t AS (SELECT rid, doc_id, n_bytes, h, unnest(generate_series(0, 60)) AS depth FROM d),
s AS (SELECT *, h >> (60 - depth) AS bucket, sum(n_bytes) OVER w AS shard_bytes, count(*) OVER w AS shard_docs, min(h) OVER w = max(h) OVER w AS one
      FROM t WINDOW w AS (PARTITION BY depth, h >> (60 - depth)))
SELECT doc_id, n_bytes, CASE WHEN depth = 0 THEN '' ELSE lpad(bin(bucket), depth::INT, '0') END AS shard, depth::INT AS depth, shard_docs, shard_bytes::BIGINT AS shard_bytes, shard_bytes > 1048576 AS oversized
FROM s WHERE one OR shard_bytes <= 1048576 QUALIFY row_number() OVER (PARTITION BY rid ORDER BY depth) = 1
"""

OP5 = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS host, string_split(text, chr(10)) AS lines, row_number() OVER () AS rid FROM documents),
l AS (SELECT rid, host, pos, lines[pos] AS line, regexp_replace(lines[pos], '^[ \t-\r]+|[ \t-\r]+$', '', 'g') AS k
      FROM (SELECT rid, host, lines, unnest(generate_series(1, len(lines))) AS pos FROM d)),
totals AS (SELECT host, count(*) AS total FROM d GROUP BY host),
bad AS (SELECT c.host, c.k FROM (SELECT host, k, count(DISTINCT rid) AS pages FROM l WHERE k <> '' GROUP BY host, k) c JOIN totals t ON c.host = t.host
        WHERE pages >= 5 AND pages::DOUBLE / total > 0.1),
kept AS (SELECT l.rid, count(*) FILTER (bad.k IS NOT NULL) AS n_dropped, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (bad.k IS NULL), '') AS t
         FROM l LEFT JOIN bad ON l.host = bad.host AND l.k = bad.k GROUP BY l.rid)
SELECT doc_id, coalesce(len(lines), 0)::BIGINT AS n_lines, coalesce(n_dropped, 0)::BIGINT AS n_dropped, sha256(coalesce(t, '')) AS text_sha256
FROM d LEFT JOIN kept ON d.rid = kept.rid
"""

OP6 = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce({_WORDS}, []) AS w FROM documents),
b AS (SELECT item_id::VARCHAR AS item_id, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS win
       FROM (SELECT item_id, w, unnest(generate_series(1, len(w) - least(len(w), 10) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT rid, n, i, array_to_string(w[i : i + n - 1], ' ') AS win
       FROM (SELECT rid, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, sizes WHERE len(w) >= n)),
hit AS (SELECT rid, dw.n, i, item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.win = bw.win),
cov AS (SELECT rid, count(*) AS n_hit FROM (SELECT DISTINCT rid, unnest(generate_series(i, i + n - 1)) AS p FROM hit) GROUP BY rid),
its AS (SELECT rid, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT rid, item_id FROM hit) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN cov ON d.rid = cov.rid LEFT JOIN its ON d.rid = its.rid
"""

OP7 = """
WITH p AS (SELECT page_id, coalesce(strlen(html), 0)::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
r AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 1000 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> first THEN first END AS refers_to FROM r
"""

SQL = {"op3_quality_rules": OP3, "op4_sharding": OP4, "op5_line_dedup": OP5, "op6_benchmark_decontamination": OP6, "op7_warc": OP7}
