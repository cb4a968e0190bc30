"""DuckDB SQL of the queries that SQL can express, over whole tables."""

from __future__ import annotations

WORD = r"'[^\x20\x09-\x0D]+'"

QUALITY = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, {WORD}) AS words,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, {WORD})) AS lines FROM d),
g AS (SELECT doc_id, i, array_to_string(words[i:i + 4], ' ') AS gram
      FROM w, unnest(range(1, len(words) - 3)) AS r(i)),
twice AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, gram) > 1),
rep AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, range(0, 5) AS r(k) GROUP BY doc_id),
m AS (SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words,
             CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
             CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
             CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words, CAST(len(lines) AS BIGINT) AS n_lines,
             CAST(len(regexp_extract_all(t, '!')) AS BIGINT) AS n_exclaim
      FROM w LEFT JOIN rep ON w.doc_id = rep.doc_id),
f AS (SELECT *, CAST(CASE WHEN n_words < 10 THEN 1 ELSE 0 END
          + CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END
          + CASE WHEN 10 * n_symbols > 3 * n_words THEN 4 ELSE 0 END
          + CASE WHEN word_chars > 15 * n_words OR word_chars < 2 * n_words THEN 8 ELSE 0 END
          + CASE WHEN 100 * n_dup_lines > 40 * n_lines THEN 16 ELSE 0 END
          + CASE WHEN 10 * n_exclaim > 5 * n_words THEN 32 ELSE 0 END AS BIGINT) AS failed FROM m)
SELECT *, failed & 3 <> 0 AS base_failed, failed = 0 AS kept FROM f"""

SUBSTRINGS = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
p AS (SELECT doc_id, i, substr(h, 2 * i + 1, 2) AS byte, substr(h, 2 * i + 1, 100) AS w
      FROM d, unnest(range(0, length(h) // 2)) AS r(i)),
first AS (SELECT w, min(doc_id) AS least FROM p WHERE length(w) = 100 GROUP BY w HAVING min(doc_id) < max(doc_id)),
hit AS (SELECT p.doc_id, i FROM p JOIN first USING (w) WHERE least < p.doc_id),
b AS (SELECT p.doc_id, p.i, byte, coalesce(max(hit.i) OVER (PARTITION BY p.doc_id ORDER BY p.i), -50) > p.i - 50 AS gone
      FROM p LEFT JOIN hit ON p.doc_id = hit.doc_id AND p.i = hit.i),
e AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS starts FROM b),
s AS (SELECT doc_id, count(*) AS n_bytes, count(*) FILTER (gone) AS n_removed, count(*) FILTER (starts) AS n_spans,
             sha256(unhex(coalesce(string_agg(byte, '' ORDER BY i) FILTER (NOT gone), ''))) AS kept_sha256
      FROM e GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n_bytes, 0) AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, coalesce(kept_sha256, sha256('')) AS kept_sha256
FROM d LEFT JOIN s ON d.doc_id = s.doc_id"""

SHARDING = """
WITH h AS (SELECT doc_id, CAST(coalesce(strlen(text), 0) AS BIGINT) AS n_bytes,
                  CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 8) AS BIGINT) AS hash
           FROM documents),
b AS (SELECT depth, hash >> (32 - depth) AS prefix, sum(n_bytes) AS shard_bytes, count(DISTINCT hash) AS hashes
      FROM h, range(0, 33) AS r(depth) GROUP BY ALL),
leaf AS (SELECT h.doc_id, h.n_bytes, h.hash, b.* FROM h JOIN b ON h.hash >> (32 - b.depth) = b.prefix
         WHERE shard_bytes <= 4194304 OR hashes = 1
         QUALIFY row_number() OVER (PARTITION BY h.doc_id ORDER BY depth) = 1)
SELECT doc_id, n_bytes, hash, substr(lpad(bin(prefix), 64, '0'), CAST(65 - depth AS INT), CAST(depth AS INT)) AS shard,
       CAST(depth AS INT) AS depth, CAST(shard_bytes AS BIGINT) AS shard_bytes, shard_bytes > 4194304 AS oversize
FROM leaf"""

MIXING = rf"""
WITH d AS (SELECT doc_id, source, source IS NULL AS gone, md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS k,
                  md5(coalesce(text, '')) AS tie,
                  CAST(len(regexp_extract_all(coalesce(text, ''), {WORD})) AS BIGINT) AS size FROM documents),
s AS (SELECT source, gone, sum(size) AS source_size FROM d GROUP BY ALL),
w AS (SELECT *, 2 * source_size AS most,
             [3, 1, 2][(row_number() OVER (ORDER BY gone, source) - 1) % 3 + 1] AS weight FROM s),
k AS (SELECT *, row_number() OVER (ORDER BY most / weight, source) AS n FROM w),
c AS (SELECT r.n, (1.5::DOUBLE * (SELECT sum(source_size) FROM k)
              - coalesce((SELECT sum(most) FROM k WHERE k.n < r.n), 0))
             / (SELECT sum(weight) FROM k WHERE k.n >= r.n) AS level, r.most, r.weight FROM k AS r),
level AS (SELECT level FROM c WHERE most > level * weight ORDER BY n LIMIT 1),
goal AS (SELECT source, gone, source_size, CASE WHEN most <= level * weight THEN most::DOUBLE ELSE level * weight END AS target
         FROM k, level),
q AS (SELECT d.*, g.source_size, g.target, sum(size) OVER (PARTITION BY d.gone, d.source ORDER BY k, tie
             ROWS UNBOUNDED PRECEDING) AS upto
      FROM d JOIN goal AS g ON d.source IS NOT DISTINCT FROM g.source),
v AS (SELECT *, (pass * source_size + upto) / target AS finish FROM q, range(0, 2) AS r(pass) WHERE size > 0),
served AS (SELECT *, sum(size) OVER (ORDER BY finish, gone, source, pass, k, tie ROWS UNBOUNDED PRECEDING) AS total FROM v),
t AS (SELECT doc_id, sum(size) AS taken FROM served
      WHERE total <= 1.5 * (SELECT sum(source_size) FROM s) GROUP BY doc_id)
SELECT q.doc_id, q.size, CAST(q.source_size AS BIGINT) AS source_size, q.target, CAST(coalesce(t.taken, 0) AS BIGINT) AS taken
FROM q LEFT JOIN t ON q.doc_id = t.doc_id"""

ARCHIVES = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, CAST(octet_length(payload) AS BIGINT) AS payload_bytes, sha256(payload) AS payload_digest FROM p),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest)
                     ELSE page_id END AS first FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to FROM f"""

FILL_IN = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t,
                  sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS x FROM documents),
u AS (SELECT doc_id, t, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS lines,
             [CAST('0x' || substr(x, CAST(8 * k + 1 AS INT), 8) AS BIGINT) FOR k IN range(4)] AS h FROM d),
c AS (SELECT *, len(lines) AS n, least(h[1] % (len(lines) + 1), h[2] % (len(lines) + 1)) AS a,
             greatest(h[1] % (len(lines) + 1), h[2] % (len(lines) + 1)) AS b,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') THEN 'plain'
                  WHEN h[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, coalesce(array_to_string(lines[1:a], ''), '') AS prefix,
             coalesce(array_to_string(lines[a + 1:b], ''), '') AS middle,
             coalesce(array_to_string(lines[b + 1:n], ''), '') AS suffix FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CAST(CASE WHEN form <> 'plain' THEN length(prefix) END AS BIGINT) AS prefix_chars,
       CAST(CASE WHEN form <> 'plain' THEN length(middle) END AS BIGINT) AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p"""

ORACLE = {"op2_quality_rules": QUALITY, "op3_suffix_array_dedup": SUBSTRINGS, "op4_extendible_sharding": SHARDING,
          "op6_fair_queue_mixing": MIXING, "op9_arc_to_warc": ARCHIVES, "op12_skip_list_fim": FILL_IN}
