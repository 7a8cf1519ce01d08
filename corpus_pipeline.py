"""A corpus pipeline of five stages, each written as Parquet and read again by the next.

In all stages: rows with a null or empty text hold nothing that a filter looks for and pass it (near copies apart, where
texts without words are copies of each other and one stays); null ids stay; columns beyond those of ``documents`` are
kept as they are, whatever their names; an empty table gives an empty one; no row depends on the order of others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import decontam, pieces, pii, simhash, toxicity
from tickloom.llm.common import cut, table


def clean_of_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for toxic, with a score of 0.5 or more, go; each row is judged by itself."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return docs.where(toxicity.score_column(spark, model)(F.col("text")) < 0.5)


def near_duplicates_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest id; rows without an id all stay."""
    return simhash.one_of_each(docs)


def benchmark_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item within its error budget go."""
    return decontam.without_items(docs, table(spark, sf_dir, "benchmark"))


def personal_data_masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts gives way to the name of its kind."""
    masked = docs.withColumn("text", pii.mask_column(spark, pii.train(docs))(F.col("text")))
    return masked.withColumn("n_chars", F.length("text").cast("long"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, with counts and digests."""
    import public_tokenizers

    return pieces.encode_decode(docs, public_tokenizers.path("piece_bpe_32k.model"), check="texts", with_ids=True)


STAGES = [
    ("toxicity", clean_of_toxicity),
    ("near_duplicates", near_duplicates_out),
    ("decontamination", benchmark_out),
    ("personal_data", personal_data_masked),
    ("encoding", encoded),
]

#: Trained models, automata and tokenizers can't be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for n, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        docs = cut(docs) if n < len(STAGES) else docs
    return docs
