"""The corpus pipeline: five text operators over `documents`, each on what the one before it kept.

Every stage is written as Parquet to the shared folder and read again as the next one's documents. All but the last
return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leaksafe.llm import decontaminate, language_id, line_winnow, ngram_join, packing
from leaksafe.llm.shared import documents, written


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are in no known language go; the others carry the predicted one."""
    models = language_id.train(docs.where(~language_id.held_out()))
    return language_id.known_language(docs, models)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeats of runs of lines are cut out; a document that was nothing but repeats goes."""
    cut = line_winnow.dedup_lines(docs)
    cut = cut.where((F.col("lines_cut") == 0) | (F.trim(F.col("text"), F.lit(" \n\r\t")) != ""))
    return cut.select(*[F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return ngram_join.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with passages of the benchmark go."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, as token windows."""
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", languages),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", pack),
]

# Language models, latent spaces and token ids are beyond SQL; a test holds the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
