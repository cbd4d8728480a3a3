"""The registered queries of the text operators: each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leaksafe.llm import decontaminate, fill_in_middle, html_extract, language_id, line_winnow, ngram_join, oracle, packing, piece_codec, pii, secret_scan, syncmers, toxicity, whitening
from leaksafe.llm.shared import documents

QUERIES = {}
SQL: dict[str, str] = {"op1_ngram_join": oracle.OP1, "op3_secrets": oracle.OP3, "op13_fill_in_middle": oracle.OP13}


def query(name: str):
    def add(build):
        QUERIES[name] = build
        return build

    return add


@query("op1_ngram_join")
def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(documents(spark, sf_dir))


@query("op2_personal_data")
def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(documents(spark, sf_dir))


@query("op3_secrets")
def secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secrets(documents(spark, sf_dir))


@query("op4_packing")
def pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir))


@query("op5_decontamination")
def leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaked(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@query("op6_language_id")
def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.languages(documents(spark, sf_dir))


@query("op7_toxicity")
def toxic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxic_documents(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@query("op8_html_extraction")
def main_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.main_texts(spark.read.parquet(f"{sf_dir}/pages.parquet"))


@query("op9_line_dedup")
def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_winnow.dedup_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return cleaned.select("doc_id", "text", F.length("text").cast("long").alias("n_chars"), "lines_cut")


@query("op10_fingerprints")
def fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.edited_fingerprints(documents(spark, sf_dir))


@query("op11_piece_codec")
def piece_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_codec.round_trip(documents(spark, sf_dir))


@query("op12_whitening")
def whitened_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query("op13_fill_in_middle")
def fill_in_the_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.digests(documents(spark, sf_dir))
