"""The registered queries of the text operators, with production parameters over whole tables.

The filter audit and exact dedup have their DuckDB text. The others can't be written in SQL as a whole (trained models,
automata, max-flow, XXH64, tokenizers) or would compare all words of a text with each other there (periodic runs); tests/llm
holds each against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import ann, audit, decontam, exact, html_text, periodic, pieces, pii, secrets, sharding, simhash, substrings, toxicity
from tickloom.llm.common import table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return secrets.secrets(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op5_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.without_repeats(table(spark, sf_dir, "documents"))


def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"))


def op7_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pieces.encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op8_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(table(spark, sf_dir, "documents"), 8)


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return periodic.periodic_runs(docs.withColumn("text", periodic.with_planted_periods(F.col("text"), F.col("doc_id"))))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_dedup(table(spark, sf_dir, "documents"), keep="largest")


QUERIES = {
    f.__name__: f
    for f in (
        op1_toxicity,
        op2_decontamination,
        op3_secrets,
        op4_main_text,
        op5_substrings,
        op6_nearest,
        op7_pieces,
        op8_shards,
        op9_personal_data,
        op10_simhash,
        op11_filter_audit,
        op12_periodic_runs,
        op13_exact_dedup,
    )
}
ORACLES: dict[str, str] = {"op11_filter_audit": audit.ORACLE, "op13_exact_dedup": exact.ORACLE}
