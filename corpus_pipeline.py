"""Cleaning and packing of a corpus in five stages, each a written table for the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veiltext.llm.common import Work
from veiltext.llm.op3_decontaminate import drop_contaminated
from veiltext.llm.op5_packing import pack
from veiltext.llm.op6_lines import line_dedup
from veiltext.llm.op7_simhash import drop_near_duplicates
from veiltext.llm.op8_toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity of at least 0.3 go."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One line of each group of similar lines stays; n_chars is counted anew, all other columns stay as they are."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    own = dict(zip(docs.columns, names, strict=True))
    kept = line_dedup(docs.toDF(*names), own["doc_id"], own["text"]).select(*names).toDF(*docs.columns)
    return kept.withColumns({c: F.char_length("text").cast("long") for c in ("n_chars",) if c in docs.columns})


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (SimHash of 3-word shingles, 3 bits at most) stays."""
    return drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), rarity=False)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all pieces of the remaining documents in sequences of 4096 tokens."""
    return pack(docs)


STAGES = [("toxicity", toxicity), ("lines", lines), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate), ("packing", packing)]

#: The stages are a trained lexicon, MinHash and packing, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over documents; each stage's result is written before the next one reads it."""
    work = Work(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = work.save(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
