"""The same results in SQL, for the queries of this subpackage that SQL can express."""

OP6 = """
WITH sound AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM (SELECT DISTINCT * FROM sound WHERE vec_id % 50 = 0) q
  JOIN sound c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v)
), ranked AS (
  SELECT query_id, vec_id, score,
    CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM pairs
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

OP8 = r"""
WITH words AS (
  SELECT row_number() OVER () AS row, doc_id,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), windows AS (
  SELECT row, i, array_to_string(w[i:i + 34], ' ') AS seq
  FROM words, unnest(range(1, len(w) - 33)) AS t(i)
), again AS (
  SELECT seq FROM windows GROUP BY seq HAVING count(*) > 1
), hit AS (
  SELECT DISTINCT row, i + k AS pos
  FROM windows SEMI JOIN again USING (seq), unnest(range(0, 35)) AS t(k)
), flat AS (
  SELECT row, i AS pos, w[i] AS word FROM words, unnest(range(1, len(w) + 1)) AS t(i)
), kept AS (
  SELECT row, string_agg(word, ' ' ORDER BY pos) AS body, count(*) AS n
  FROM flat ANTI JOIN hit USING (row, pos) GROUP BY row
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
  CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(body, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (row)
"""

OP3 = r"""
WITH sized AS (
  SELECT doc_id, source,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    [5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INTEGER)] AS weight
  FROM sized GROUP BY source
), levels AS (
  SELECT *, sum(source_size) OVER () AS total, sum(weight) OVER () AS weights,
    coalesce(sum(3 * source_size) OVER lower, 0) AS below,
    coalesce(sum(weight) OVER lower, 0) AS weight_below
  FROM sources
  WINDOW lower AS (ORDER BY 3.0 * source_size / weight, source
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), limited AS (
  SELECT *, 3 * source_size * (weights - weight_below) < weight * (total - below) AS full_up
  FROM levels
), shared AS (
  SELECT source, source_size,
    least(weight * CAST(total - coalesce(sum(3 * source_size) FILTER (full_up) OVER (), 0) AS DOUBLE)
            / CAST(sum(weight) FILTER (NOT full_up) OVER () AS DOUBLE),
          CAST(3 * source_size AS DOUBLE)) AS target
  FROM limited
), line AS (
  SELECT s.doc_id, s.source, s.size, source_size, target,
    CASE WHEN source_size > 0 THEN floor(target / source_size * 1048576) / 1048576 ELSE 0 END AS rate,
    CAST(row_number() OVER (PARTITION BY s.source ORDER BY s.size, s.doc_id NULLS FIRST) - 1 AS DOUBLE) AS k
  FROM sized s JOIN shared t ON s.source IS NOT DISTINCT FROM t.source
), tried AS (
  SELECT *, CAST('0x' || substr(md5('mix:' || i || ':' || coalesce(source, '')), 1, 5) AS INTEGER)
              / 1048576.0 AS u
  FROM line, range(32) AS t(i)
), taken AS (
  SELECT *, CAST(size * (floor(CAST(u AS DOUBLE) + (k + 1) * rate) - floor(CAST(u AS DOUBLE) + k * rate))
                 AS BIGINT) AS taken
  FROM tried
), best AS (
  SELECT source, i FROM taken GROUP BY source, target, i
  QUALIFY row_number() OVER (PARTITION BY source ORDER BY abs(sum(taken) - target), i) = 1
)
SELECT doc_id, size, source_size, target, taken
FROM taken t JOIN best b ON t.source IS NOT DISTINCT FROM b.source AND t.i = b.i
"""

OP13 = r"""
WITH terms AS (
  SELECT row_number() OVER () AS row, doc_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents
), asked AS (
  SELECT row_number() OVER () AS item, item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), sizes AS (
  SELECT row, count(*) AS n FROM terms GROUP BY row
), totals AS (
  SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS words FROM sizes
), held AS (
  SELECT row, doc_id, term, CAST(count(*) AS BIGINT) AS tf
  FROM terms SEMI JOIN asked USING (term) GROUP BY row, doc_id, term
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM held, totals GROUP BY term, docs
), scores AS (
  SELECT item, item_id, row, doc_id,
    CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // words)))) AS BIGINT) AS score
  FROM asked JOIN held USING (term) JOIN weights USING (term) JOIN sizes USING (row), totals
  GROUP BY item, item_id, row, doc_id
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank
  FROM scores WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""

SQL: dict[str, str] = {
    "op3_systematic_mix": OP3,
    "op13_ranked_search": OP13,
    "op6_maxscore_top_k": OP6,
    "op8_repeated_passages": OP8,
}
