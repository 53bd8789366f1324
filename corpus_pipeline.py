"""A training corpus from raw documents: language ID, line dedup, near-duplicate documents, repeated passages, packing.

Each stage takes what the one before it kept, as (spark, docs, sf_dir), and its
decisions take effect. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsight.functions.staging import stage
from tillsight.llm import jaccard_join, language, line_dedup, packing, substring_dedup
from tillsight.llm.queries import table, tokenizer_json


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which the model, fitted on the rows that are not held out, rejects none; ``lang`` stays as it is."""
    model = language.fit(docs.filter(~language.held_out()))
    found = language.predict(docs, model)
    return found.filter(~F.col(found.columns[-1])).select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of three-line runs go; ``n_chars`` follows the text."""
    kept = line_dedup.without_repeated_lines(docs)
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked documents one with the smallest id stays."""
    return jaccard_join.without_near_duplicates(docs).select(*docs.columns)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has too are cut out; ``n_chars`` follows the text."""
    kept = substring_dedup.without_repeated_passages(docs)
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2,048 tokens, with their ids."""
    return packing.pack_documents(docs, tokenizer_json())


STAGES = [("language_id", language_id), ("line_dedup", lines), ("near_duplicates", near_duplicates), ("passages", passages), ("packing", pack)]

#: Clustering, MinHash sampling, alignment and packing have no SQL; tests/llm/test_pipeline.py compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
