"""Corpus pipeline: quality rules, near duplicates, benchmark passages, secrets, token ids.

Each stage takes what the one before it kept, as a written table, and its decisions take
effect: rejected documents go, one document of each near-duplicate class stays,
documents with a benchmark passage go, and secrets are replaced in the texts. All stages
but the last return the columns of ``documents``.

Rows with a null id or text, repeated rows and extra columns pass or go by the rules of
the operators (see their docstrings): a null or empty text fails the quality rules,
repeated rows leave one in the second stage, a row with a null id is judged by its text.
Empty tables give empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableflow.llm import bpe, decontaminate, jaccard, quality, secrets
from tableflow.llm.common import arrow_batches, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the calibrated model keep.

    The model learns from the labelled rows of the whole ``documents`` table.
    """
    labelled = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = quality.train(labelled, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.keep_good(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of five-word Jaccard similarity 0.8 or more: the one of least id."""
    return jaccard.keep_one(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with found secrets replaced by a mark; ``n_chars`` of a changed text is that of what is left."""
    return secrets.redact(docs, size_col="n_chars")


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each whole text (packed little-endian uint32), checked by decoding them again."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = bpe.encode(docs, path, keep=("doc_id", "lang", "source", "text"))
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return bpe.decode(encoded, path).select(
        "doc_id", "lang", "source", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), "ids",
        F.sha2("ids", 256).alias("ids_sha256"), (F.col("decoded") == text).alias("round_trip"))


STAGES = [("quality_rules", quality_rules), ("near_duplicates", near_duplicates), ("benchmark_passages", benchmark_passages),
          ("secret_scan", secret_scan), ("token_ids", token_ids)]

#: no SQL: the model's verdict and the token ids are not expressible; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; between two stages the documents are a table in the shared folder."""
    arrow_batches(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, name)
    return docs
