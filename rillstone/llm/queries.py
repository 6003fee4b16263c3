"""The registered queries of this subpackage, with production parameters over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rillstone.llm import bpe, divergence, embeddings, html, jaccard, lines, lm, merkle, packing, pii, quality, toxicity, trie
from rillstone.llm.common import table


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"), cosine=0.9)


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.round_trip(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.digests(table(spark, sf_dir, "documents"), least=10)


def op4_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join_classes(table(spark, sf_dir, "documents"), size=3, percent=90)


def op6_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.with_next(table(spark, sf_dir, "documents"))


def op7_backoff_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.held_out_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.spans(table(spark, sf_dir, "documents"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack_documents(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, added=True)


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(table(spark, sf_dir, "documents"), least=30, top=50)


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.conversation_trie(table(spark, sf_dir, "conversations"))


def op13_quality_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.held_out_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = [
        op1_embedding_near_dedup, op2_byte_bpe, op3_line_dedup, op4_html_main_text, op5_ngram_jaccard,
        op6_document_fingerprints, op7_backoff_lm, op8_toxicity, op9_personal_data, op10_best_fit_packing,
        op11_source_divergence, op12_conversation_trie, op13_quality_neighbours,
    ]
    return {f.__name__: f for f in named}


LINES_SQL = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM d),
k AS (SELECT *, translate(trim(line, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
f AS (SELECT k.*, c.key IS NOT NULL AS gone FROM k LEFT JOIN c ON k.key = c.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM f GROUP BY doc_id
"""


#: Documents link through shingles they share; `reach` follows the links.
JOIN_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) >= 3
    THEN list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM w),
n AS (SELECT doc_id, len(s) AS n FROM s),
e AS (SELECT doc_id, unnest(s) AS x FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 90 * (na.n + nb.n - c)),
reach AS (SELECT a, b FROM l UNION SELECT reach.a, l.b FROM reach JOIN l ON reach.b = l.a)
SELECT n.doc_id, CAST(n.n AS BIGINT) AS n_shingles, least(n.doc_id, coalesce(min(reach.b), n.doc_id)) AS component_id
FROM n LEFT JOIN reach ON reach.a = n.doc_id GROUP BY n.doc_id, n.n
"""

VECTORS_SQL = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
reach AS (SELECT a, b FROM l UNION SELECT reach.a, l.b FROM reach JOIN l ON reach.b = l.a),
c AS (SELECT a, min(b) AS least FROM reach GROUP BY a), k AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, coalesce(k.n, 0) AS n_links, least(vec_id, coalesce(c.least, vec_id)) AS component_id,
  vec_id = least(vec_id, coalesce(c.least, vec_id)) AS kept
FROM embeddings LEFT JOIN c ON c.a = vec_id LEFT JOIN k ON k.a = vec_id
"""


#: Every kept term of a language for every source of it, counted or not.
DIVERGENCE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
k AS (SELECT lang, term, count(*) AS n FROM t GROUP BY ALL HAVING count(DISTINCT r) >= 30),
v AS (SELECT lang, count(*) AS v, sum(n) AS n FROM k GROUP BY lang),
c AS (SELECT t.lang, t.source, t.term, count(*) AS n FROM t JOIN k USING (lang, term) GROUP BY ALL),
f AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.n AS of_lang,
  sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source) AS total
  FROM g JOIN k ON k.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
p AS (SELECT f.lang, source, term, f.n,
  1 + (1000000000::HUGEINT * (f.n + 5)) // (total + 5 * v.v) AS p,
  1 + (1000000000::HUGEINT * (of_lang + 5)) // (v.n + 5 * v.v) AS q FROM f JOIN v ON v.lang = f.lang),
s AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
x AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
  CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM x QUALIFY part = 'pair' OR rank <= 50
"""


#: A prefix is known by the hash of its turns' hashes; `above` leads from each node to itself and all nodes above it.
TRIE_SQL = r"""
WITH RECURSIVE bits AS (
  SELECT i, i AS c, 0 AS n FROM range(256) r(i)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n + 1 FROM bits WHERE n < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE n = 8),
turns AS (
  SELECT conv_id AS c, turn, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k,
    strlen(coalesce(text, '')) AS z FROM conversations WHERE conv_id IS NOT NULL),
t AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, k) AS i FROM turns),
h AS (
  SELECT c, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''),
    lambda x: ascii(x)::BIGINT)), lambda s, b: xor(s >> 8, crc.t[1 + (xor(s, b) & 255)])), 4294967295) % 9 AS h
  FROM (SELECT DISTINCT c FROM t), crc),
r AS (
  SELECT h.c, 0 AS part, i, k, z FROM h JOIN t ON t.c = h.c - h.c % 5 AND i <= h
  UNION ALL SELECT h.c, 1, i, k, z FROM h JOIN t ON t.c = h.c AND i > h),
s AS (
  SELECT h.c, coalesce(list(k ORDER BY part, i) FILTER (k IS NOT NULL), []) AS ks,
    coalesce(list(z ORDER BY part, i) FILTER (k IS NOT NULL), []) AS zs FROM h LEFT JOIN r ON r.c = h.c GROUP BY h.c),
p AS (
  SELECT c, d, md5(array_to_string(ks[1:d], '')) AS p, md5(array_to_string(ks[1:d - 1], '')) AS up, zs[d] AS z, d = len(ks) AS ends
  FROM (SELECT *, unnest(range(len(ks) + 1)) AS d FROM s)),
n AS (
  SELECT p, d, min(c) AS c, count(*) AS n, any_value(up) AS up, any_value(z) AS z,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS ends FROM p GROUP BY p, d),
k AS (SELECT up, count(*) AS n FROM n WHERE d > 0 GROUP BY up),
above AS (
  SELECT a.p, count(*) FILTER (k.n IS NULL) AS leaves, sum((n.n - 1) * coalesce(n.z, 0)) AS saved
  FROM n JOIN p a ON a.c = n.c AND a.d <= n.d LEFT JOIN k ON k.up = n.p GROUP BY a.p)
SELECT n.c AS conv_id, n.d AS depth, CASE WHEN n.d > 0 THEN u.c END AS parent_conv_id, n.n AS n_convs,
  coalesce(k.n, 0) AS n_children, above.leaves AS n_leaves, CAST(above.saved AS BIGINT) AS saved_tokens, n.ends AS ends_sha256
FROM n JOIN above USING (p) LEFT JOIN n u ON n.d > 0 AND u.p = n.up LEFT JOIN k ON k.up = n.p
"""


def oracle_sql() -> dict[str, str]:
    """SQL for the queries it can express; the others have brute-force versions in the tests."""
    return {
        "op1_embedding_near_dedup": VECTORS_SQL,
        "op3_line_dedup": LINES_SQL,
        "op5_ngram_jaccard": JOIN_SQL,
        "op11_source_divergence": DIVERGENCE_SQL,
        "op12_conversation_trie": TRIE_SQL,
    }
