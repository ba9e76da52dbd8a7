"""The operators as registered queries over whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from veiltext.llm.op1_tokens import token_matrix
from veiltext.llm.op2_quality import quality
from veiltext.llm.op3_decontaminate import contaminated
from veiltext.llm.op4_rules import quality_rules
from veiltext.llm.op5_packing import pack
from veiltext.llm.op6_lines import line_dedup
from veiltext.llm.op7_simhash import near_duplicates
from veiltext.llm.op8_toxicity import toxicity
from veiltext.llm.op9_lm import lm_scores
from veiltext.llm.op10_substrings import repeated_passages
from veiltext.llm.op11_negatives import hard_negatives
from veiltext.llm.op12_urls import judge_urls
from veiltext.llm.op13_audit import filter_audit


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packed rows of token ids of all documents, with their segments."""
    return token_matrix(table(spark, sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_contaminated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the benchmark items they hold."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), rarity=False)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the lines that stay."""
    return line_dedup(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines", "n_dropped")


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"))


def op10_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraphs to remove, each with the one that stays."""
    return repeated_passages(table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector; every seventh row has the next label."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=moved)


#: The rules of the pages' urls.
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def op12_url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each step of all 120 orders of five filters keeps, removes and repeats, per language."""
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_token_matrix,
        op2_quality,
        op3_contaminated,
        op4_quality_rules,
        op5_packing,
        op6_line_dedup,
        op7_near_duplicates,
        op8_toxicity,
        op9_lm_scores,
        op10_repeated_passages,
        op11_hard_negatives,
        op12_url_verdicts,
        op13_filter_audit,
    )
} | {"pipeline": corpus_pipeline.run}

_HARD_NEGATIVES = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT * FROM (SELECT p.anchor_id, p.positive_id,
    row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id)::INT AS rank,
    s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 100 * s.score BETWEEN 30 * p.positive_score AND 90 * p.positive_score)
WHERE rank <= 10
"""

_FILTER_AUDIT = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words, coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), FALSE) AS copy FROM d),
m AS (SELECT part, CASE WHEN len(words) < 100 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 2 ELSE 0 END
    + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END + CASE WHEN copy THEN 16 ELSE 0 END AS mask,
    count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM w LEFT JOIN l USING (doc_id) GROUP BY 1, 2),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
o AS (SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM x a, x b, x c, x d, x e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
s AS (SELECT filter_order, step, 1 << (ascii(substr(filter_order, step, 1)) - 65) AS own,
    coalesce(list_sum(list_transform(range(1, step), lambda i: 1 << (ascii(substr(filter_order, i::INT, 1)) - 65))), 0)::INT AS before
  FROM o, (SELECT unnest(range(1, 6))::INT AS step)),
r AS (SELECT part, filter_order, step, own,
    coalesce(sum(n) FILTER (mask & (before | own) = 0), 0) AS kept,
    coalesce(sum(n) FILTER (mask & before = 0 AND mask & own > 0), 0) AS removed,
    coalesce(sum(n) FILTER (mask & before > 0 AND mask & own > 0), 0) AS redundant,
    coalesce(sum(n) FILTER (mask = own), 0) AS unique_fails,
    coalesce(sum(good) FILTER (mask & before = 0 AND mask & own > 0), 0) AS good_lost,
    coalesce(sum(toxic) FILTER (mask & before = 0 AND mask & own > 0), 0) AS toxic_lost
  FROM m, s GROUP BY ALL)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
  unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
  (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley FROM r
"""

#: The other operators have no SQL: each is a trained model, a hash of another library, a packing or an iteration.
#: Those are tested in tests/llm.
SQL: dict[str, str] = {"op11_hard_negatives": _HARD_NEGATIVES, "op13_filter_audit": _FILTER_AUDIT} | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
