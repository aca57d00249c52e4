"""The registered queries of this subpackage: each operator over its whole table, and SQL where that can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tripline.llm import byte_bpe, decontamination, language, passage_dedup, quality_rules, substring_dedup, token_files, toxicity, vector_codes
from tripline.llm.hard_negatives import hard_negatives
from tripline.llm.licenses import license_scan
from tripline.llm.mixing import mixture
from tripline.llm.near_duplicates import near_duplicates
from tripline.llm.quality_rules import quality
from tripline.llm.sampling import remainder
from tripline.llm.store import new_path

Query = Callable[[SparkSession, str], DataFrame]


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_documents(spark, sf_dir))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.digest(decontamination.contamination(_documents(spark, sf_dir), items))


_OP2_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size, list_slice(w, i, i + least(len(w), 10) - 1) AS win
  FROM b, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS t(i) WHERE len(w) > 0
), places AS (
  SELECT r, i, size, list_slice(w, i, i + size - 1) AS win
  FROM d, (SELECT DISTINCT size FROM windows) AS s, unnest(range(1, greatest(len(w) - size + 2, 1))) AS t(i)
), hits AS (
  SELECT r, i, p.size, item_id FROM places AS p JOIN windows AS v ON p.size = v.size AND p.win = v.win
), hit_words AS (
  SELECT r, count(DISTINCT k) AS n_hit FROM hits, unnest(range(i, i + size)) AS t(k) GROUP BY r
), hit_items AS (
  SELECT r, count(DISTINCT item_id) AS n_items,
         string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items
  FROM hits GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words USING (r) LEFT JOIN hit_items USING (r)"""


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    left = remainder(F.col("doc_id"), 4) == 2
    found = language.identify(docs, language.learn(docs.where(~left)))
    return found.select("doc_id", left.alias("held_out"), "lang_pred", "score")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    machine = toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    held_out = (remainder(F.col("doc_id"), 5) == 0).alias("held_out")
    return toxicity.toxicity(docs, machine).select("doc_id", held_out, "score", "predicted")


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = new_path(spark, "tokens")
    token_files.write_tokens(_documents(spark, sf_dir), path, public_tokenizers.path("word_bpe_49k.json"))
    return token_files.digest(token_files.read_tokens(spark, path))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digest(substring_dedup.without_repeats(_documents(spark, sf_dir)))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(_documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


# What may end a sentence, and what may close it, as in the rules.
_ENDS = "".join([*quality_rules.SENTENCE_ENDS, *quality_rules.WIDE_SENTENCE_ENDS])

_OP7_SQL = (
    r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), lines AS (
  SELECT r, i, string_split(text, chr(10))[i] AS line
  FROM d, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS t(i)
), measured AS (
  SELECT r, i, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS w,
         translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lowered
  FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), judged AS (
  SELECT r, row_number() OVER (PARTITION BY r, line ORDER BY i) > 1 AS dup,
         length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')) AS chars,
         NOT regexp_matches(line, '[@ENDS@]["'')\]”’»]*([\x20\x09-\x0D]|$)')
         AND 2 * len(regexp_extract_all(line, '[\x{0E00}-\x{0EFF}]')) <= length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g'))
         OR 100 * len(regexp_extract_all(line, '[#*$%&|<>!]')) > 50 * len(w)
         OR (len([x FOR x IN w IF regexp_full_match(x, '[|>]+|[»·•]')]) >= 2
             AND 100 * len([x FOR x IN w IF regexp_full_match(x, '[|>]+|[»·•]')]) >= 20 * len(w))
         OR regexp_matches(lowered, 'all rights reserved|terms of use|terms of service|privacy policy|cookie policy|use of cookies|uses cookies|enable javascript|click here|sign up for|subscribe to our|back to top|skip to content|share this|powered by') AS failed
  FROM measured
), by_lines AS (
  SELECT r, count(*) FILTER (dup) AS n_dup, coalesce(sum(chars) FILTER (failed), 0) AS lost FROM judged GROUP BY r
), windows AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, list_slice(w, i, i + 2)) AS n
  FROM d, unnest(range(1, greatest(len(w) - 1, 1))) AS t(i)
), repeats AS (
  SELECT r, count(DISTINCT k) AS n FROM windows, unnest(range(i, i + 3)) AS t(k) WHERE windows.n > 1 GROUP BY r
), base AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(coalesce(n_dup, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(repeats.n, 0) AS BIGINT) AS n_repeat_words,
         len(w) < 50 OR 100 * coalesce(repeats.n, 0) > 50 * len(w) AS base_failed, coalesce(lost, 0) AS lost
  FROM d LEFT JOIN by_lines USING (r) LEFT JOIN repeats USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 100 * lost <= 50 * word_chars AS kept
FROM base""".replace("@ENDS@", _ENDS)
)


def op8_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passage_dedup.digest(passage_dedup.without_repeated_passages(_documents(spark, sf_dir)))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture(_documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


_OP9_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS HUGEINT) AS size,
         md5('mix' || coalesce(':' || CAST(doc_id AS VARCHAR), '') || coalesce(':' || md5(text), '')) AS draw
  FROM documents
), sources AS (
  SELECT source, sum(size) AS s,
         CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS HUGEINT) AS w
  FROM d GROUP BY source
), levels AS (
  SELECT *, (SELECT sum(size) FROM d) AS total, coalesce(sum(3 * s) OVER (r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS passed,
         sum(w) OVER (r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS behind
  FROM sources WINDOW r AS (ORDER BY CAST(s AS DOUBLE) / w, source NULLS LAST)
), caps AS (
  SELECT *, 3 * s * behind <= w * (total - passed) AS capped FROM levels
), shares AS (
  SELECT *, w * (total - coalesce((SELECT sum(3 * s) FROM caps WHERE capped), 0)) AS share,
         (SELECT sum(w) FROM caps WHERE NOT capped) AS open
  FROM caps
), targets AS (
  SELECT source, s, CASE WHEN capped THEN CAST(3 * s AS DOUBLE) ELSE CAST(share AS DOUBLE) / CAST(open AS DOUBLE) END AS target,
         CASE WHEN capped THEN 3 ELSE share // (open * s) END AS whole,
         CASE WHEN capped THEN 0 ELSE share % (open * s) END AS rest,
         CASE WHEN capped THEN 1 ELSE open END AS open
  FROM shares
), placed AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY draw, doc_id NULLS LAST, size
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d
)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(s AS BIGINT) AS source_size, target,
       CAST(size * (whole + CASE WHEN (2 * before + size) * open <= 2 * rest THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM placed JOIN targets ON placed.source IS NOT DISTINCT FROM targets.source"""


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(_documents(spark, sf_dir)).drop("spans")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.digest(vector_codes.compressed(_embeddings(spark, sf_dir)))


# A vector takes part if it has components and all of them are numbers.
_VECTORS_SQL = r"""embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""


def _op11_sql(positions: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """The rounds written out one after the other."""

    def assigned(k: int) -> str:
        return f"""a{k} AS MATERIALIZED (
  SELECT r, p, min(d * {entries} + e) % {entries} AS e, min(d * {entries} + e) // {entries} AS d
  FROM (SELECT r, m.p, e, CAST(list_dot_product(m.c, m.c) - 2 * list_dot_product(m.c, b.c) + list_dot_product(b.c, b.c) AS BIGINT) AS d
        FROM m JOIN b{k} AS b USING (p)) GROUP BY r, p
)"""

    def updated(k: int) -> str:
        return f"""s{k} AS MATERIALIZED (
  SELECT p, e, i, floor(CAST(sum(c[i]) AS DOUBLE) / count(*)) AS x
  FROM a{k - 1} JOIN m USING (r, p), unnest(range(1, len(c) + 1)) AS t(i) GROUP BY p, e, i
), b{k} AS MATERIALIZED (
  SELECT p, e, coalesce(n.c, old.c) AS c
  FROM b{k - 1} AS old LEFT JOIN (SELECT p, e, list(x ORDER BY i) AS c FROM s{k} GROUP BY p, e) AS n USING (p, e)
)"""

    steps = [assigned(0)] + [step for k in range(1, rounds + 1) for step in (updated(k), assigned(k))]
    return rf"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * 1024)) AS c
  FROM embeddings WHERE {_VECTORS_SQL}
), m AS MATERIALIZED (
  SELECT r, p, list_slice(c, p * (len(c) // {positions}) + 1, (p + 1) * (len(c) // {positions})) AS c
  FROM v, unnest(range({positions})) AS t(p)
), first AS (
  SELECT r, row_number() OVER (ORDER BY vec_id NULLS LAST, c) - 1 AS e FROM v QUALIFY e < {entries}
), b0 AS MATERIALIZED (
  SELECT p, e, c FROM first JOIN m USING (r)
), {", ".join(steps)}, coded AS (
  SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY r
), book AS (
  SELECT string_agg(CAST(CAST(c[i] AS BIGINT) AS VARCHAR), ',' ORDER BY p, e, i) AS text
  FROM b{rounds}, unnest(range(1, len(c) + 1)) AS t(i)
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       sha256((SELECT text FROM book)) AS codebooks_sha256
FROM v JOIN coded USING (r)"""


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    shifted = F.expr("CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS LONG) + 1) % 10 ELSE label END")
    vectors = _embeddings(spark, sf_dir).withColumn("label", shifted)
    return hard_negatives(vectors, F.col("vec_id") % 100 == 0)


_OP12_SQL = rf"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * 256)) AS c
  FROM embeddings WHERE label IS NOT NULL AND {_VECTORS_SQL}
), scores AS MATERIALIZED (
  SELECT a.r AS a, a.vec_id AS anchor_id, b.r AS r, b.vec_id AS vec_id, a.label = b.label AS same,
         CAST(list_dot_product(a.c, b.c) AS BIGINT) AS score
  FROM v AS a JOIN v AS b ON a.r <> b.r WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id NULLS LAST, r) AS n
  FROM scores WHERE same QUALIFY n <= 5
)
SELECT p.anchor_id, p.vec_id AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.a, p.n ORDER BY s.score DESC, s.vec_id NULLS LAST) AS INTEGER) AS rank,
       s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM positives AS p JOIN scores AS s ON p.a = s.a AND NOT s.same
  AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score
QUALIFY rank <= 5"""


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    tokens = byte_bpe.encoded(_documents(spark, sf_dir), ranks, public_tokenizers.PATTERN)
    return byte_bpe.digest(byte_bpe.decoded(tokens, ranks))


_QUERIES: list[Query] = [
    op1_near_duplicates,
    op2_decontamination,
    op3_language,
    op4_toxicity,
    op5_token_files,
    op6_suffix_dedup,
    op7_quality_rules,
    op8_passage_dedup,
    op9_mixing,
    op10_licenses,
    op11_vector_codes,
    op12_hard_negatives,
    op13_byte_bpe,
]

_ORACLES: dict[str, str] = {
    "op2_decontamination": _OP2_SQL,
    "op7_quality_rules": _OP7_SQL,
    "op9_mixing": _OP9_SQL,
    "op11_vector_codes": _op11_sql(),
    "op12_hard_negatives": _OP12_SQL,
}


def queries() -> dict[str, Query]:
    return {query.__name__: query for query in _QUERIES} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)
