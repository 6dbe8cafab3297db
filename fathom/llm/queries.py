"""The registered queries of this subpackage: one for each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fathom.llm._store import table

TOKENIZER_FILE = "byte_bpe_50k.json"


def tokenizer_path(name: str = TOKENIZER_FILE) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fathom.llm.pii import find

    return find(table(spark, sf_dir, "documents"))


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fathom.llm.minhash import classes

    return classes(table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fathom.llm.quality import score, train

    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels")))


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fathom.llm.vectors import near_duplicates

    return near_duplicates(table(spark, sf_dir, "embeddings"))


def op10_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fathom.llm.vectors import exact_top_k

    return exact_top_k(table(spark, sf_dir, "embeddings"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fathom.llm.toxicity import score, train

    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels")))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fathom.llm.sentencepiece import encode

    return encode(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fathom.llm.html import extract, train

    pages = table(spark, sf_dir, "pages")
    return extract(pages, train(pages))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fathom.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fathom.llm.sharding import shard

    return shard(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fathom.llm.spelling import variants

    return variants(table(spark, sf_dir, "documents"))


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fathom.llm.fill_middle import digests

    return digests(table(spark, sf_dir, "documents"))


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fathom.llm.fingerprint import against_next

    return against_next(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": op1_pii,
    "op2_minhash_near_dedup": op2_minhash_near_dedup,
    "op3_quality": op3_quality,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_html_extraction": op5_html_extraction,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_sharding": op7_sharding,
    "op8_embedding_near_dedup": op8_embedding_near_dedup,
    "op9_toxicity": op9_toxicity,
    "op10_exact_top_k": op10_exact_top_k,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_fill_middle": op12_fill_middle,
    "op13_fingerprints": op13_fingerprints,
}
ORACLE_SQL: dict[str, str] = {
    "op8_embedding_near_dedup": """
WITH RECURSIVE e AS (
  SELECT row_number() OVER () AS r, vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
), n AS (
  SELECT *, sqrt(list_inner_product(v, v)) AS norm FROM e
  WHERE label IS NOT NULL AND v IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT a.r AS a, b.r AS b FROM n a JOIN n b ON a.label = b.label AND len(a.v) = len(b.v) AND a.r <> b.r
  WHERE a.norm > 0 AND b.norm > 0 AND list_inner_product(a.v, b.v) / (a.norm * b.norm) >= 0.93
), reach AS (
  SELECT r AS a, r AS b FROM e UNION SELECT reach.a, pairs.b FROM reach JOIN pairs ON reach.b = pairs.a
), least AS (
  SELECT reach.a, min(e.vec_id) AS component_id FROM reach JOIN e ON e.r = reach.b GROUP BY reach.a
), degree AS (
  SELECT a, count(*) AS n FROM pairs GROUP BY a
)
SELECT e.vec_id, coalesce(degree.n, 0) AS n_links, least.component_id, e.vec_id = least.component_id AS kept
FROM e JOIN least ON least.a = e.r LEFT JOIN degree ON degree.a = e.r
""",
    "op10_exact_top_k": """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::HUGEINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])), 0)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.r <> q.r
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
""",
    "op11_spelling_variants": r"""
WITH RECURSIVE tokens AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS run FROM documents
), runs AS (
  SELECT id, run, count(*) AS times, hex(encode(id || ':' || run)) AS bytes FROM tokens WHERE length(run) >= 6 GROUP BY id, run
), sums AS (
  SELECT run, times, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, len(bytes)::BIGINT, 2), lambda i: ('0x' || substr(bytes, i, 2))::BIGINT)),
    lambda c, b: xor(list_reduce([xor(c, b) & 255, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1))), c >> 8))) AS h FROM runs
), cut AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, times FROM sums
), w AS (
  SELECT word, sum(times)::BIGINT AS n FROM cut WHERE length(word) >= 6 GROUP BY word HAVING sum(times) >= 5
), pairs AS (
  SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM w a JOIN w b ON abs(length(a.word) - length(b.word)) <= 1 AND levenshtein(a.word, b.word) BETWEEN 1 AND 2 -- in bytes
  WHERE CASE length(a.word) - length(b.word) WHEN 0 THEN len(list_filter(range(1, length(a.word) + 1), lambda i: substr(a.word, i, 1) <> substr(b.word, i, 1))) = 1
    WHEN 1 THEN len(list_filter(range(1, length(a.word) + 1), lambda i: substr(a.word, 1, i - 1) || substr(a.word, i + 1) = b.word)) > 0
    ELSE len(list_filter(range(1, length(b.word) + 1), lambda i: substr(b.word, 1, i - 1) || substr(b.word, i + 1) = a.word)) > 0 END
), ranked AS (
  SELECT *, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS k FROM pairs
), forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 5 * w.n THEN near END AS form, CASE WHEN near_n >= 5 * w.n THEN near_n END AS form_n FROM w LEFT JOIN ranked r ON r.word = w.word AND r.k = 1
), chain AS (
  SELECT word, word AS root, form AS ahead FROM forms UNION ALL SELECT c.word, f.word, f.form FROM chain c JOIN forms f ON f.word = c.ahead
)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n FROM forms f JOIN chain c ON c.word = f.word AND c.ahead IS NULL
""",
    "op12_fill_middle": r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS x FROM documents
), u AS (
  SELECT *, regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units,
    ('0x' || substr(x, 1, 8))::BIGINT AS h1, ('0x' || substr(x, 9, 8))::BIGINT AS h2, ('0x' || substr(x, 17, 8))::BIGINT AS h3, ('0x' || substr(x, 25, 8))::BIGINT AS h4 FROM d
), c AS (
  SELECT *, len(units)::BIGINT AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a, greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM u
), p AS (
  SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle, array_to_string(units[b + 1:], '') AS suffix FROM c
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(text) AS restored_sha256
FROM p
""",
}
