"""The corpus operators bound to the given tables, with a SQL twin where SQL can state the rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sparquill.llm import html_main, jaccard, line_dedup, mixing, near_vectors, pieces, pii, prefix_trie, quality, shards, token_counts, urls, whitening
from sparquill.session import use_utc


TOKENIZER = "/opt/tokenizers/piece_bpe_32k.model"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    use_utc(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_digests(_table(spark, sf_dir, "documents"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_digests(_table(spark, sf_dir, "documents"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_digests(_table(spark, sf_dir, "documents"))


def op4_html_main(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_main.extract(_table(spark, sf_dir, "pages"))


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.groups(_table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_table(spark, sf_dir, "documents"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(_table(spark, sf_dir, "pages"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard(_table(spark, sf_dir, "documents"))


def op9_embedding_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_groups(_table(spark, sf_dir, "embeddings"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trip(_table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(_table(spark, sf_dir, "conversations"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), TOKENIZER)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_line_dedup, op2_pii, op3_mixing, op4_html_main, op5_ngram_jaccard, op6_quality, op7_url_filter, op8_sharding, op9_embedding_dups, op10_sentencepiece,
        op11_prefix_trie, op12_whitening, op13_token_counts,
    )
}

SQL = {
    "op1_line_dedup": """
WITH docs AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
keyed AS (
  SELECT doc_id, lines, list_transform(lines, lambda l: translate(
    trim(l, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS keys
  FROM docs),
often AS (
  SELECT key FROM (SELECT doc_id, unnest(keys) AS key FROM keyed) WHERE length(key) >= 1
  GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
lines AS (
  SELECT doc_id, len(lines) AS n_lines, unnest(lines) AS line, unnest(keys) AS key, unnest(range(len(lines))) AS pos FROM keyed)
SELECT l.doc_id, any_value(n_lines) AS n_lines, count(o.key) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE o.key IS NULL), '')) AS kept_sha256
FROM lines l LEFT JOIN often o ON l.key = o.key GROUP BY l.doc_id
""",
    "op3_mixing": """
WITH docs AS (
  SELECT doc_id, source, text, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source),
weighted AS (
  SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::BIGINT AS weight, sum(source_size) OVER () AS total FROM sources),
sorted AS (
  SELECT *, 3.0 * source_size / weight AS ratio,
    coalesce(sum(3 * source_size) OVER (ORDER BY 3.0 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
    sum(weight) OVER (ORDER BY 3.0 * source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM weighted),
level AS (SELECT total - capped AS words, rest FROM sorted WHERE (total - capped) <= ratio * rest ORDER BY ratio, source NULLS LAST LIMIT 1),
targets AS (
  SELECT source, source_size, least(3.0::DOUBLE * source_size, (weight * (SELECT words FROM level))::DOUBLE / (SELECT rest FROM level)::DOUBLE) AS target FROM weighted),
rates AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 1.0 END AS rate,
    (('0x' || substr(md5('mix-1|' || coalesce(d.doc_id::VARCHAR, 'null') || '|' || md5(coalesce(d.text, ''))), 1, 13))::BIGINT)::DOUBLE / 4503599627370496.0 AS u
  FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, (floor(rate)::BIGINT + (u < rate - floor(rate))::BIGINT) * size AS taken FROM rates
""",
    "op5_ngram_jaccard": """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM words),
shingles AS (SELECT doc_id, len(s) AS n, hash(unnest(s)) AS h FROM sets),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, any_value(a.n) AS nx, any_value(b.n) AS ny, count(*) AS common
  FROM shingles a JOIN shingles b ON a.h = b.h AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM shared WHERE 100 * common >= 75 * (nx + ny - common)),
reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
SELECT s.doc_id, len(s.s) AS n_shingles, r.component_id FROM sets s JOIN (SELECT x, min(y) AS component_id FROM reach GROUP BY x) r ON s.doc_id = r.x
""",
    "op9_embedding_dups": """
WITH RECURSIVE vectors AS (
  SELECT vec_id, embedding::DOUBLE[] AS v, sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x))) AS norm FROM embeddings),
good AS (SELECT vec_id, list_transform(v, lambda x: x / norm) AS u FROM vectors WHERE norm > 0 AND isfinite(norm) AND NOT list_contains(list_transform(v, lambda x: x IS NULL), true)),
links AS (SELECT a.vec_id AS x, b.vec_id AS y FROM good a JOIN good b ON a.vec_id <> b.vec_id AND len(a.u) = len(b.u) AND list_dot_product(a.u, b.u) >= 0.9),
reach AS (SELECT vec_id AS x, vec_id AS y FROM embeddings UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
least AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x),
degree AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT e.vec_id, coalesce(d.n, 0) AS n_links, l.component_id, e.vec_id = l.component_id AS kept
FROM embeddings e JOIN least l ON e.vec_id = l.x LEFT JOIN degree d ON e.vec_id = d.x
""",
    # The fold is CRC-32 bit by bit: a code is mixed in, each -1 shifts once.
    "op11_prefix_trie": """
WITH turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list({'role': role, 'text': text} ORDER BY k) AS ts FROM turns GROUP BY 1),
heads AS (
  SELECT *, xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(conv_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295::BIGINT) % 4 AS h FROM own),
rebuilt AS (SELECT c.conv_id, list_concat(coalesce(b.ts, [])[1:c.h], c.ts[c.h + 1:]) AS ts FROM heads c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 20),
members AS (SELECT conv_id, len(ts) AS n, d, ts[1:d] AS node, ts[1:d - 1] AS above FROM (SELECT *, unnest(range(len(ts) + 1)) AS d FROM rebuilt)),
nodes AS (
  SELECT d, node, any_value(above) AS above, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = d), '')) AS ends_sha256 FROM members GROUP BY d, node),
children AS (SELECT d - 1 AS d, above AS node, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL),
full_nodes AS (SELECT n.*, coalesce(c.n_children, 0) AS n_children, CASE WHEN d > 0 THEN (n_convs - 1) * len(regexp_extract_all(node[d].text, '[^\\x20\\x09-\\x0D]+')) ELSE 0 END AS saved
  FROM nodes n LEFT JOIN children c USING (d, node)),
below AS (SELECT t AS d, node[1:t] AS node, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved)::BIGINT AS saved_tokens
  FROM (SELECT *, unnest(range(d + 1)) AS t FROM full_nodes) GROUP BY ALL)
SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, b.n_leaves, b.saved_tokens, n.ends_sha256
FROM full_nodes n JOIN below b USING (d, node) LEFT JOIN nodes p ON n.d > 0 AND p.d = n.d - 1 AND p.node = n.above
""",
    # On the given tables no label is trusted, so all spans are base spans; tests/llm plant labels that are.
    "op2_pii": """
WITH kinds AS (SELECT * FROM (VALUES
  ('email', 1, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+'), ('ip', 2, '[0-9]+(\\.[0-9]+)(\\.[0-9]+)(\\.[0-9]+)'),
  ('card', 3, '[0-9]([\\x20-]?[0-9])+'), ('phone', 4, '\\+[0-9][\\x20().0-9-]+[0-9]')) k(kind, rank, pattern)),
parts AS (
  SELECT doc_id, kind, rank, regexp_extract_all(coalesce(text, ''), pattern) AS ms, string_split_regex(coalesce(text, ''), pattern) AS gs FROM documents, kinds),
places AS (SELECT doc_id, kind, rank, generate_subscripts(ms, 1) AS i, unnest(ms) AS m, unnest(gs[1:len(ms)]) AS g FROM parts WHERE len(ms) > 0),
found AS (
  SELECT *, (sum(length(g) + length(m)) OVER (PARTITION BY doc_id, kind ORDER BY i))::BIGINT AS fin, regexp_replace(m, '[^0-9]', '', 'g') AS digits FROM places),
luhn AS (
  SELECT *, list_sum(list_transform(range(1, length(digits) + 1), lambda k: CASE WHEN k % 2 = 1 THEN reverse(digits)[k]::INT
    WHEN reverse(digits)[k]::INT >= 5 THEN 2 * reverse(digits)[k]::INT - 9 ELSE 2 * reverse(digits)[k]::INT END)) AS total FROM found),
base AS (
  SELECT doc_id, kind, rank, fin - length(m) AS start, kind || ':' || (fin - length(m)) || ':' || fin AS said FROM luhn WHERE CASE kind
    WHEN 'email' THEN true WHEN 'card' THEN length(digits) BETWEEN 14 AND 19 AND total % 10 = 0 WHEN 'phone' THEN length(digits) BETWEEN 10 AND 15
    ELSE len(list_filter(string_split(m, '.'), lambda x: length(ltrim(x, '0')) > 3 OR coalesce(try_cast(x AS HUGEINT), 256) > 255)) = 0 END),
said AS (
  SELECT doc_id, count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip, count(*) FILTER (kind = 'card') AS n_card,
    count(*) FILTER (kind = 'phone') AS n_phone, string_agg(said, ',' ORDER BY start, rank) AS spans FROM base GROUP BY 1)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card, coalesce(n_phone, 0) AS n_phone,
  sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans, 0::BIGINT AS n_found
FROM documents LEFT JOIN said USING (doc_id)
""",
}
