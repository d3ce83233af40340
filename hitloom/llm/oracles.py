"""DuckDB SQL of the operators that SQL can express."""

_WORDS = "regexp_extract_all(translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

ORACLES: dict[str, str] = {
    "op3_warc": """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) || '0' AS x FROM pages
), least AS (
  SELECT x, min(page_id) AS least FROM p GROUP BY x
)
SELECT page_id, CAST(octet_length(encode(h)) AS BIGINT) AS payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         ((CAST('0x' || substr(x, 5 * i // 4 + 1, 2) AS INTEGER) >> (3 - (5 * i) % 4)) & 31) + 1, 1) FOR i IN range(32)], '') AS payload_digest,
       CASE WHEN page_id = least THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> least THEN least END AS refers_to
FROM p JOIN least USING (x)""",
    "op7_decontaminate": f"""
WITH item AS (
  SELECT item_id, {_WORDS.format("text")} AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[s:s + least(len(w), 10) - 1], ' ') AS phrase
  FROM item, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(s) WHERE len(w) > 0
), doc AS (
  SELECT row_number() OVER () AS row_id, doc_id, {_WORDS.format("text")} AS w FROM documents
), sizes AS (
  SELECT DISTINCT n FROM windows
), places AS (
  SELECT row_id, s, n, array_to_string(w[s:s + n - 1], ' ') AS phrase
  FROM doc, sizes, unnest(range(1, len(w) - n + 2)) AS t(s)
), hit AS (
  SELECT row_id, s, p.n, item_id FROM places p JOIN windows v ON p.phrase = v.phrase AND p.n = v.n
), counted AS (
  SELECT row_id, count(DISTINCT k) AS n_hit FROM hit, unnest(range(s, s + n)) AS t(k) GROUP BY row_id
), named AS (
  SELECT row_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT row_id, CAST(item_id AS VARCHAR) AS item_id FROM hit) GROUP BY row_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN counted USING (row_id) LEFT JOIN named USING (row_id)""",
    "op9_mixing": """
WITH RECURSIVE d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS n_tokens FROM documents
), totals AS (
  SELECT source, CAST(sum(n_tokens) AS BIGINT) AS tokens FROM d GROUP BY source HAVING sum(n_tokens) > 0
), whole AS (
  SELECT CAST(sum(tokens) AS BIGINT) AS budget, count(*) AS k FROM totals
), plain AS (
  SELECT (ln(sum(p)) - sum(p * ln(p)) / sum(p)) / ln(count(*)) >= 0.9 OR count(*) = 1 AS even_enough
  FROM (SELECT CAST(tokens AS DOUBLE) AS p FROM totals)
), halving AS (
  SELECT 0 AS step, CAST(0 AS DOUBLE) AS low, CAST(1 AS DOUBLE) AS high
  UNION ALL
  SELECT step + 1, CASE WHEN up THEN (low + high) / 2 ELSE low END, CASE WHEN up THEN high ELSE (low + high) / 2 END
  FROM (
    SELECT step, low, high,
      (ln(sum(p)) - sum(p * ln(p)) / sum(p)) / ln(count(*)) >= 0.9 OR max(p / tokens) * any_value(budget) / sum(p) > 4.0 AS up
    FROM (SELECT step, low, high, tokens, budget, pow(CAST(tokens AS DOUBLE), (low + high) / 2) AS p FROM halving, totals, whole WHERE step < 24)
    GROUP BY step, low, high
  )
), power AS (
  SELECT CASE WHEN (SELECT even_enough FROM plain) THEN 1.0 ELSE (SELECT high FROM halving WHERE step = 24) END AS a
), weighted AS (
  SELECT source, tokens, pow(CAST(tokens AS DOUBLE), a) AS p, sum(pow(CAST(tokens AS DOUBLE), a)) OVER () AS s FROM totals, power
), planned AS (
  SELECT source, tokens, CAST(round(p / s * budget) AS BIGINT) AS quota FROM weighted, whole
), budgeted AS (
  SELECT source, tokens, quota // tokens AS epochs, quota % tokens AS rest FROM planned
), uses AS (
  SELECT doc_id, d.source, n_tokens, epochs, rest, epoch,
    CAST('0x' || substr(md5('7|' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) % CAST(ceil(tokens / 100000.0) AS BIGINT) AS block
  FROM d JOIN budgeted b ON d.source IS NOT DISTINCT FROM b.source, unnest(range(0, epochs + 1)) AS t(epoch)
  WHERE epoch < epochs OR rest > 0
), blocks AS (
  SELECT source, epoch, block,
    coalesce(sum(block_tokens) OVER (PARTITION BY source, epoch ORDER BY md5('7|' || epoch || '|block|' || block), block
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS block_start
  FROM (SELECT source, epoch, block, sum(n_tokens) AS block_tokens FROM uses GROUP BY ALL)
), placed AS (
  SELECT u.*, block_start + coalesce(sum(n_tokens) OVER (PARTITION BY u.source, u.epoch, u.block
      ORDER BY substr(md5('7|' || u.epoch || '|' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13), doc_id, n_tokens
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM uses u JOIN blocks k ON u.source IS NOT DISTINCT FROM k.source AND u.epoch = k.epoch AND u.block = k.block
)
SELECT doc_id, source, n_tokens, CAST(epoch AS BIGINT) AS epoch, CAST(block AS BIGINT) AS block, CAST(start AS BIGINT) AS start
FROM placed WHERE epoch < epochs OR start + n_tokens <= rest""",
}
