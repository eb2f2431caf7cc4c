"""DuckDB SQL for the queries that SQL can express, in a direct form."""

from __future__ import annotations

OP2 = """
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l
  FROM documents
), win AS (
  SELECT rid, i, array_to_string(list_slice(w, i, i + 7), ' ') AS s
  FROM (SELECT rid, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)
), rep AS (
  SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nx
  FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, s) AS c FROM win) WHERE c > 1
), cov AS (
  SELECT rid, sum(CASE WHEN nx IS NULL OR nx - i > 8 THEN 8 ELSE nx - i END) AS n FROM rep GROUP BY rid
), m AS (
  SELECT doc_id, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN cov USING (rid)
), b AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m
), h AS (
  SELECT source, count(*) AS docs, sum(base_failed::INT) AS failed FROM b WHERE source IS NOT NULL GROUP BY source
), s AS (
  SELECT least(greatest(avg(failed / docs), 1e-6), 1 - 1e-6) AS m,
         coalesce(var_samp(failed / docs), 0) AS v, avg(1.0 / docs) AS inv FROM h
), p AS (
  SELECT m, CASE WHEN v - m * (1 - m) * inv > 0
    THEN least(greatest(m * (1 - m) / (v - m * (1 - m) * inv) - 1, 1), 1e6) ELSE 1e6 END AS k FROM s
), j AS (
  SELECT source, (failed + m * k) / (docs + k) <= 0.5 AS ok FROM h, p
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(ok, true) AS kept
FROM b LEFT JOIN j USING (source)
"""

OP3 = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS s FROM pages
), o AS (
  SELECT s, max(page_id) AS original FROM p WHERE n >= 1000 GROUP BY s
)
SELECT page_id, n::BIGINT AS payload_bytes, s AS payload_digest,
       CASE WHEN page_id < original THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < original THEN original END AS refers_to
FROM p LEFT JOIN o USING (s)
"""

#: The sums of 32-bit CRC are taken byte by byte, by a table made from its polynomial.
OP11 = """
WITH RECURSIVE crc AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) ORDER BY i) AS t
  FROM range(256) r(i)
), runs AS (
  SELECT doc_id, w, count(*) AS c FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\\x{C0}-\\x{FF}]+')) AS w
    FROM documents) GROUP BY 1, 2
), hashed AS (
  SELECT w, c, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, len(hx), 2), lambda k: ('0x' || substr(hx, k, 2))::BIGINT)),
                               lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) AS h
  FROM (SELECT *, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || w)) AS hx FROM runs WHERE length(w) >= 7), crc
), v AS (
  SELECT word, sum(c)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 31 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, c FROM hashed)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(c) >= 2
), cut AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS d FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)
), near AS (
  SELECT a.word, b.word AS other, b.n FROM cut a JOIN cut b ON a.d = b.d AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN v b ON a.d = b.word
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN v b ON a.d = b.word
), best AS (
  SELECT word, count(*) AS n_near, arg_min(other, (-n, other)) AS other, max(n) AS m FROM near GROUP BY word
), f AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 10 * v.n THEN other END AS form, CASE WHEN m >= 10 * v.n THEN m END AS form_n
  FROM v LEFT JOIN best USING (word)
), path AS (
  SELECT word, word AS root, 0 AS k FROM f
  UNION ALL SELECT path.word, f.form, k + 1 FROM path JOIN f ON f.word = path.root WHERE f.form IS NOT NULL
)
SELECT f.word, form, (SELECT arg_max(root, k) FROM path WHERE path.word = f.word) AS root, n, n_near::BIGINT AS n_near, form_n FROM f
"""

OP12 = """
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS t
  FROM documents
), s AS (
  SELECT count(*) AS docs, sum(len(t))::BIGINT AS l FROM d WHERE len(t) > 0
), q AS (
  SELECT DISTINCT qid, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS qid, item_id, text FROM benchmark)
), p AS (
  SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(t) AS term FROM d) GROUP BY rid, term
), w AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM (SELECT term, count(*) AS df FROM p GROUP BY term), s
), hit AS (
  SELECT qid, any_value(item_id) AS item_id, any_value(doc_id) AS doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * len(t) * docs) // l))))::BIGINT AS score
  FROM q JOIN w USING (term) JOIN p USING (term) JOIN d USING (rid), s GROUP BY qid, rid
)
SELECT item_id, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
FROM hit WHERE score > 0 QUALIFY rank <= 50
"""

ORACLES = {"op2_quality_rules": OP2, "op3_warc": OP3, "op11_spelling_variants": OP11, "op12_lexical_search": OP12}
