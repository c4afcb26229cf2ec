"""DuckDB SQL for the operators whose results SQL can say, over the same tables."""

OP1_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL
  SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), marked AS (
  SELECT *,
    len(regexp_extract_all(text, '[<\[]\\*(?:s>|/s>|INST\]|/INST\]|<SYS>>|</SYS>>)')) AS hits,
    CASE role WHEN 'user' THEN 13 WHEN 'assistant' THEN 7
      ELSE 16 + length(replace(url_encode(role), '%20', '+')) END AS frame
  FROM turns
)
SELECT conv_id,
  count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), ''))
    AS loss_sha256,
  CAST(sum(frame + length(text)) + sum(hits) AS BIGINT) AS formatted_chars,
  sum(hits) > 0 AS escaped
FROM marked GROUP BY conv_id
"""

OP4_SQL = r"""
WITH bytes AS (
  SELECT doc_id, encode(coalesce(text, '')) AS h FROM documents
), starts AS (
  SELECT doc_id, unnest(range(octet_length(h) - 99)) AS p, unnest(list_transform(range(octet_length(h) - 99),
    lambda p: md5_number(h[p + 1 : p + 100]))) AS string FROM bytes
), repeated AS (
  SELECT doc_id, p FROM starts
  QUALIFY row_number() OVER (PARTITION BY string ORDER BY doc_id, p) > 1
), runs AS (
  SELECT doc_id, p, p - row_number() OVER (PARTITION BY doc_id ORDER BY p) AS run FROM repeated
), stretches AS (
  SELECT doc_id, min(p) AS a, max(p) + 100 AS b FROM runs GROUP BY doc_id, run
), opened AS (
  SELECT *, coalesce(a > max(b) OVER (PARTITION BY doc_id ORDER BY a
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS opens FROM stretches
), numbered AS (
  SELECT *, sum(opens::INT) OVER (PARTITION BY doc_id ORDER BY a) AS span FROM opened
), spans AS (
  SELECT doc_id, span, min(a) AS a, max(b) AS b FROM numbered GROUP BY doc_id, span
), pieces AS (
  SELECT doc_id, coalesce(lag(b) OVER w, 0) AS a, a AS b FROM spans WINDOW w AS (PARTITION BY doc_id ORDER BY a)
  UNION ALL
  SELECT bytes.doc_id, coalesce(max(spans.b), 0), any_value(octet_length(h))
  FROM bytes LEFT JOIN spans ON bytes.doc_id = spans.doc_id GROUP BY bytes.doc_id
), kept AS (
  SELECT doc_id, unhex(string_agg(hex(h[a + 1 : b]), '' ORDER BY a)) AS k
  FROM pieces JOIN bytes USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, octet_length(h) AS n_bytes, octet_length(h) - octet_length(k) AS n_removed,
  (SELECT count(*) FROM spans s WHERE s.doc_id = bytes.doc_id) AS n_spans,
  sha256(k) AS kept_sha256,
  coalesce((SELECT string_agg(a || ':' || b, ',' ORDER BY a) FROM spans s WHERE s.doc_id = bytes.doc_id), '') AS spans
FROM bytes JOIN kept USING (doc_id)
"""

OP6_SQL = r"""
WITH lists AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), starts AS (
  SELECT doc_id, unnest(range(len(words) - 49)) AS p, unnest(list_transform(range(len(words) - 49),
    lambda p: md5_number(array_to_string(words[p + 1 : p + 50], ' ')))) AS string FROM lists
), repeated AS (
  SELECT doc_id, p FROM starts QUALIFY doc_id > min(doc_id) OVER (PARTITION BY string)
), runs AS (
  SELECT doc_id, p, p - row_number() OVER (PARTITION BY doc_id ORDER BY p) AS run FROM repeated
), stretches AS (
  SELECT doc_id, min(p) AS a, max(p) + 50 AS b FROM runs GROUP BY doc_id, run
), opened AS (
  SELECT *, coalesce(a > max(b) OVER (PARTITION BY doc_id ORDER BY a
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS opens FROM stretches
), numbered AS (
  SELECT *, sum(opens::INT) OVER (PARTITION BY doc_id ORDER BY a) AS span FROM opened
), spans AS (
  SELECT doc_id, span, min(a) AS a, max(b) AS b FROM numbered GROUP BY doc_id, span
), listed AS (
  SELECT doc_id, sum(b - a)::BIGINT AS gone, string_agg(a || ':' || b, ',' ORDER BY a) AS spans
  FROM spans GROUP BY doc_id
), pieces AS (
  SELECT doc_id, coalesce(lag(b) OVER w, 0) AS a, a AS b FROM spans WINDOW w AS (PARTITION BY doc_id ORDER BY a)
  UNION ALL
  SELECT lists.doc_id, coalesce(max(spans.b), 0), any_value(len(words))
  FROM lists LEFT JOIN spans ON lists.doc_id = spans.doc_id GROUP BY lists.doc_id
), kept AS (
  SELECT doc_id, string_agg(array_to_string(words[a + 1 : b], ' '), ' ' ORDER BY a) AS k
  FROM pieces JOIN lists USING (doc_id) WHERE b > a GROUP BY doc_id
)
SELECT doc_id, len(words) AS n_words, coalesce(gone, 0) AS n_removed,
  sha256(coalesce(k, '')) AS kept_sha256, coalesce(spans, '') AS spans
FROM lists LEFT JOIN listed USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

OP9_SQL = r"""
WITH RECURSIVE lists AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents
), sets AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 1 THEN words ELSE
    list_transform(range(1, len(words)), lambda p: words[p] || ' ' || words[p + 1]) END) AS shingle FROM lists
), sizes AS (
  SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id
), texts AS (
  SELECT min(doc_id) AS leader, words FROM lists WHERE len(words) > 0 GROUP BY words
), members AS (
  SELECT doc_id, leader FROM lists JOIN texts USING (words)
), numbered AS (
  SELECT doc_id, shingle, count(*) OVER (PARTITION BY shingle) AS held, n
  FROM sets JOIN sizes USING (doc_id) WHERE doc_id IN (SELECT leader FROM texts)
), prefix AS (
  -- Sets that share 80 of 100 shingles of their union share one of each one's rarest fifth.
  SELECT * FROM numbered
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY held, shingle) <= n - (8 * n + 9) // 10 + 1
), near AS (
  SELECT DISTINCT a.doc_id AS a, b.doc_id AS b FROM prefix a JOIN prefix b USING (shingle)
  WHERE a.doc_id < b.doc_id AND 10 * least(a.n, b.n) >= 8 * greatest(a.n, b.n)
), links AS (
  SELECT a, b FROM near JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b AND y.shingle = x.shingle
    JOIN sizes m ON m.doc_id = a JOIN sizes n ON n.doc_id = b
  GROUP BY a, b HAVING 100 * count(*) >= 80 * (any_value(m.n) + any_value(n.n) - count(*))
  UNION ALL SELECT leader, doc_id FROM members WHERE leader < doc_id
), both_ways AS (
  SELECT a, b FROM links UNION SELECT b, a FROM links
), reached AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT r.a, l.b FROM reached r JOIN both_ways l ON l.a = r.b
)
SELECT a AS doc_id, coalesce((SELECT n FROM sizes WHERE doc_id = a), 0) AS n_shingles,
  min(b) AS component_id, min(b) = a AS kept FROM reached GROUP BY a
"""

OP10_SQL = r"""
WITH bits AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload, lower(sha1(encode(coalesce(html, '')))) AS h FROM pages
), digests AS (
  -- Forty hex digits are 160 bits; every five of them are a letter or one of 2 to 7.
  SELECT page_id, payload, list_aggregate(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST(((CAST('0x' || substr(h || '0', CAST(5 * k // 4 + 1 AS BIGINT), 2) AS BIGINT) >> CAST(3 - 5 * k % 4 AS BIGINT)) & 31) + 1
      AS BIGINT), 1)), 'string_agg', '') AS payload_digest FROM bits
), grouped AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload) AS leader FROM digests
)
SELECT page_id, octet_length(payload) AS payload_bytes, payload_digest,
  CASE WHEN page_id = leader THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id < leader THEN leader END AS refers_to FROM grouped
"""

OP11_SQL = r"""
WITH lower AS (
  SELECT doc_id AS id, 'd' AS side, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
  UNION ALL
  SELECT item_id, 'q', translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz') FROM benchmark
), words AS (
  SELECT side, id, unnest(regexp_extract_all(text, '[0-9a-z\x{80}-\x{10FFFF}]+')) AS term FROM lower
), counted AS (
  SELECT side, id, term, count(*) AS tf FROM words GROUP BY ALL
), sizes AS (
  SELECT id, sum(tf)::BIGINT AS n FROM counted WHERE side = 'd' GROUP BY id
), corpus AS (
  SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM sizes
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM counted, corpus WHERE side = 'd' GROUP BY term, docs
), scored AS (
  SELECT q.id AS item_id, d.id AS doc_id, CAST(sum(q.tf * w *
    ((1000000000 * d.tf) // (1000 * d.tf + 8 * (100 - 75 + (75 * n * docs) // total)))) AS BIGINT) AS score
  FROM counted q JOIN counted d ON q.side = 'q' AND d.side = 'd' AND q.term = d.term
    JOIN weights w ON w.term = q.term JOIN sizes s ON s.id = d.id, corpus
  GROUP BY q.id, d.id
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank
  FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""

# The checksum's table is made by its rule, with the reversed polynomial 0xEDB88320.
OP13_SQL = r"""
WITH steps AS (
  SELECT list(list_reduce(list_prepend(b, range(8)), lambda c, k:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS step
  FROM range(256) r(b)
), texts AS (
  SELECT 'd' AS side, doc_id AS id, text FROM documents
  UNION ALL SELECT 'b', item_id, text FROM benchmark
), words AS (
  SELECT side, id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+')) AS word FROM texts
), counted AS (
  SELECT side, id, word, count(*) AS n FROM words GROUP BY ALL
), hexed AS (
  SELECT word, hex(encode(word)) AS h FROM (SELECT DISTINCT word FROM counted)
), hashed AS (
  SELECT word, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(length(h) // 2),
      lambda k: CAST('0x' || substr(h, CAST(2 * k + 1 AS BIGINT), 2) AS BIGINT))),
    lambda c, b: xor(c >> 8, step[(xor(c, b) & 255) + 1]))) % 10000 AS bucket
  FROM hexed, steps
), filled AS (
  SELECT bucket, coalesce(sum(n) FILTER (side = 'd'), 0)::BIGINT AS s,
    coalesce(sum(n) FILTER (side = 'b'), 0)::BIGINT AS t
  FROM counted JOIN hashed USING (word) GROUP BY bucket
), gains AS (
  SELECT bucket, CAST(floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE
    / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE))) AS BIGINT) AS gain FROM filled
), weighed AS (
  SELECT id, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight
  FROM counted JOIN hashed USING (word) JOIN gains USING (bucket) WHERE side = 'd' GROUP BY id
), scored AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    CAST('0x' || sha256('2024:' || doc_id)[1:8] AS BIGINT) AS h
  FROM documents LEFT JOIN weighed ON id = doc_id
), drawn AS (
  SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5)::DOUBLE / 4294967296))) AS BIGINT) AS score,
    n_features >= 20 AS able FROM scored
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY able ORDER BY score DESC, doc_id) AS place,
    count(*) FILTER (able) OVER () AS n FROM drawn
)
SELECT doc_id, n_features, weight, score,
  CASE WHEN able AND place <= 10 * n // 100 THEN place END AS rank FROM placed
"""
