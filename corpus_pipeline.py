"""From raw documents to token ids: the stages of a training-data pipeline, each calling one operator of modelwarden.llm.

Each stage takes (spark, docs, sf_dir); its result is written as Parquet and read again as the next one's docs.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modelwarden.llm import bpe, decontam, jaccard, lines, quality
from modelwarden.llm.common import shared_folder
from modelwarden.llm.queries import SITES, TOKENIZER, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier keeps."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their text without boilerplate lines; n_chars follows the text."""
    clean = lines.dedup_lines(docs, SITES)
    return clean.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))).select(*docs.columns)


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return jaccard.one_of_each(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document's text, and whether decoding gives the names of the same tokens."""
    file = public_tokenizers.path(TOKENIZER)
    coded = bpe.decode(bpe.encode(docs.select("doc_id", "lang", "source", "text"), file).drop("text"), file)
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("n-gram Jaccard join", near_copy_stage),
    ("benchmark decontamination", benchmark_stage),
    ("BPE encoding and decoding", token_stage),
]

#: The classifier and the tokenizer are beyond SQL; tests hold every stage against a plain Python version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder before the next one reads it."""
    docs, folder = table(spark, sf_dir, "documents"), shared_folder(spark)
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


QUERIES = {"pipeline": run}


def ORACLE() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
