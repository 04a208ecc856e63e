"""Registered queries of the corpus operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklens.llm import (
    cover_tree,
    hard_negatives,
    langid,
    line_dedup,
    mixing,
    quality_rules,
    ranking,
    recompression,
    sentencepiece_fst,
    simhash,
    sketches,
    spelling,
    toxicity,
)
from tracklens.llm.common import remainder, stored

# The tokenizer model of the encoding query.
MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = langid.train(docs.where(remainder("doc_id", 4) != 2))
    found = langid.predict(docs.select("doc_id", "text"), model)
    held = (remainder("doc_id", 4) == 2).alias("held_out")
    return found.select("doc_id", held, "lang_pred", "score", "accepted")


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = sentencepiece_fst.encode(docs, MODEL_PATH, check=True)
    return found.select("doc_id", "n_tokens", "tokens", "round_trip")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    weights = toxicity.train(docs, toxicity.learning_rows(labels, "doc_id", 5, 0))
    found = toxicity.score(docs.select("doc_id", "text"), weights)
    held = (remainder("doc_id", 5) == 0).alias("held_out")
    return found.select("doc_id", held, "score", toxicity.predicted().alias("predicted"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_components(_table(spark, sf_dir, "documents"), width=4, radius=4)
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", hexed.alias("fingerprint"), "component_id")


def op5_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.embedding_components(_table(spark, sf_dir, "embeddings"), least=0.93)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = quality_rules.quality_ledger(_table(spark, sf_dir, "documents"))
    return ledger.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~quality_rules.passes("v1")).alias("base_failed"),
        quality_rules.passes().alias("kept"),
        "failures",
    )


def op7_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "labels")
    # Texts are measured once, for learning and for scoring.
    docs = stored(ranking.measured(docs), "measured")
    ranker = ranking.train(docs, toxicity.learning_rows(labels, "doc_id", 5, 0), found="measures")
    found = ranking.score(docs, ranker, found="measures")
    held = (remainder("doc_id", 5) == 0).alias("held_out")
    predicted = (F.col("score") >= ranking.LIMIT).cast("int").alias("predicted")
    return found.select("doc_id", held, "score", predicted)


def op8_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = recompression.remove_repeats(docs)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    return kept.select("doc_id", "n_lines", "n_dropped", digest.alias("kept_sha256"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.plan_copies(_table(spark, sf_dir, "documents"))
    row = F.explode(F.sequence(F.lit(1), F.col("n_rows").cast("int")))
    return plan.withColumn("row", row).select(
        F.col("doc").alias("doc_id"), "size", "source_size", "target",
        (F.col("size") * F.col("copies")).alias("taken"), "source", "copies",
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors.withColumn("label", moved), anchor_every=50)


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(_table(spark, sf_dir, "documents"), typo_every=31)


def op13_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketches.fingerprints(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_langid": op1_langid,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_toxicity": op3_toxicity,
    "op4_simhash": op4_simhash,
    "op5_cover_tree": op5_cover_tree,
    "op6_quality_rules": op6_quality_rules,
    "op7_ranking": op7_ranking,
    "op8_recompression": op8_recompression,
    "op9_line_dedup": op9_line_dedup,
    "op10_mixing": op10_mixing,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_spelling": op12_spelling,
    "op13_sketches": op13_sketches,
}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_ALPHABET = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

ORACLE: dict[str, str] = {}

ORACLE["op5_cover_tree"] = """
WITH RECURSIVE vectors AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
), usable AS (
  SELECT vec_id, label, x, sqrt(list_inner_product(x, x)) AS size FROM vectors
  WHERE label IS NOT NULL AND len(x) > 0 AND len(list_filter(x, lambda v: v IS NULL OR NOT isfinite(v))) = 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
  WHERE a.size > 0 AND b.size > 0 AND list_inner_product(a.x, b.x) / (a.size * b.size) >= 0.93
), reached AS (
  SELECT vec_id AS a, vec_id AS b FROM vectors
  UNION
  SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b
), counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(any_value(n), 0) AS n_links, min(r.b) AS component_id, min(r.b) = vec_id AS kept
FROM vectors v JOIN reached r ON r.a = v.vec_id LEFT JOIN counted c ON c.a = v.vec_id
GROUP BY vec_id
"""

ORACLE["op6_quality_rules"] = rf"""
WITH base AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, {_WORDS} AS w,
         string_split(coalesce(text, ''), chr(10)) AS lines
  FROM documents
), spans AS (
  SELECT r, i, list_slice(w, i, i + 7) AS span
  FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM base WHERE len(w) >= 8)
), twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, span) AS n FROM spans) WHERE n > 1
), covered AS (
  SELECT r, count(DISTINCT i + k) AS n FROM (SELECT r, i, unnest(range(0, 8)) AS k FROM twice) GROUP BY r
), measured AS (
  SELECT r, doc_id, len(w) AS n_words,
         CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(list_filter(lines, lambda x: trim(x, {_BLANKS}) <> ''))
           - len(list_distinct(list_filter(lines, lambda x: trim(x, {_BLANKS}) <> ''))) AS n_dup_lines,
         len(lines) AS n_lines,
         length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS n_upper,
         length(text) - length(regexp_replace(text, '[a-z]', '', 'g')) AS n_lower,
         length(text) - length(regexp_replace(text, '[!?]', '', 'g')) AS n_marks,
         len(list_filter(w, lambda x: regexp_matches(x, '[A-Za-z]|[^\x00-\x7F]'))) AS n_letter_words
  FROM base
), ruled AS (
  SELECT m.*, coalesce(c.n, 0) AS n_repeat_words,
         CASE WHEN n_words < 20 THEN 1 ELSE 0 END
         + CASE WHEN 100 * coalesce(c.n, 0) > 30 * n_words THEN 2 ELSE 0 END
         + CASE WHEN 4 * n_symbols > n_words THEN 4 ELSE 0 END
         + CASE WHEN 10 * n_dup_lines > 3 * n_lines THEN 8 ELSE 0 END
         + CASE WHEN 10 * n_upper > 6 * (n_upper + n_lower) THEN 16 ELSE 0 END
         + CASE WHEN 2 * n_marks > n_words THEN 32 ELSE 0 END
         + CASE WHEN word_chars < 2 * n_words OR word_chars > 15 * n_words THEN 64 ELSE 0 END
         + CASE WHEN 2 * n_letter_words < n_words THEN 128 ELSE 0 END AS failures
  FROM measured m LEFT JOIN covered c USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       failures & 3 <> 0 AS base_failed, failures & 247 = 0 AS kept, CAST(failures AS BIGINT) AS failures
FROM ruled
"""

ORACLE["op8_recompression"] = rf"""
WITH base AS (
  SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents
), spans AS (
  SELECT r, doc_id, i, list_slice(w, i, i + 19) AS span
  FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM base WHERE len(w) >= 20)
), firsts AS (
  SELECT span, min(struct_pack(d := doc_id, i := i)) AS f FROM spans GROUP BY span HAVING count(*) > 1
), late AS (
  SELECT s.r, s.i FROM spans s JOIN firsts f USING (span) WHERE s.doc_id <> f.f.d OR s.i <> f.f.i
), gone AS (
  SELECT DISTINCT r, i + k AS i FROM (SELECT r, i, unnest(range(0, 20)) AS k FROM late)
), words AS (
  SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM base
), kept AS (
  SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS text FROM words ANTI JOIN gone USING (r, i) GROUP BY r
)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM base LEFT JOIN kept k USING (r)
"""

ORACLE["op9_line_dedup"] = f"""
WITH split AS (
  SELECT r, doc_id, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS no
  FROM (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines
        FROM documents)
), keyed AS (
  SELECT *, translate(trim(line, {_BLANKS}), {_ALPHABET}) AS k FROM split
), owners AS (
  SELECT k, min(doc_id) AS owner FROM keyed WHERE length(k) >= 10
  GROUP BY k HAVING count(DISTINCT doc_id) > 1
), marked AS (
  SELECT r, doc_id, no, line, o.k IS NOT NULL AND doc_id <> o.owner AS gone
  FROM keyed LEFT JOIN owners o USING (k)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY no) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY r, doc_id
"""

ORACLE["op11_hard_negatives"] = """
WITH vectors AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda v: floor(256 * CAST(v AS DOUBLE))) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0
), positives AS (
  SELECT a.vec_id AS anchor_id, a.label, a.x, p.vec_id AS positive_id,
         CAST(list_inner_product(a.x, p.x) AS BIGINT) AS positive_score
  FROM vectors a JOIN vectors p ON a.label = p.label AND a.vec_id <> p.vec_id
  WHERE a.vec_id % 50 = 0
  QUALIFY row_number() OVER (PARTITION BY a.vec_id ORDER BY positive_score DESC, p.vec_id) <= 5
), scored AS (
  SELECT p.anchor_id, p.positive_id, p.positive_score, n.vec_id AS negative_id,
         CAST(list_inner_product(p.x, n.x) AS BIGINT) AS negative_score
  FROM positives p JOIN vectors n ON n.label <> p.label
)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY negative_score DESC, negative_id) AS INTEGER) AS rank,
       negative_id, positive_score, negative_score
FROM scored
WHERE 50 * positive_score <= 100 * negative_score AND 100 * negative_score <= 95 * positive_score
QUALIFY rank <= 3
"""
