"""A corpus from raw documents to packed sequences; each stage applies one operator to what the last kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsgrid.llm import line_chunks, near_copies, packing, pfair, toxicity
from newsgrid.llm.common import cut_lineage, table
from newsgrid.llm.llm_queries import tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score stays below one half."""
    lexicon = toxicity.learn_lexicon(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score_toxicity(docs, lexicon, "__toxic_score")
    return scored.where(F.col("__toxic_score") < 0.5).drop("__toxic_score")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_chunks.line_chunk_dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each family of near copies: SimHash links, then bands for wider pairs, all verified."""
    return near_copies.keep_dissimilar(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pfair.mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

ORACLE_SQL = None  # learned scores, fingerprints and tokenizers have no SQL; tests/llm compares the stages with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
