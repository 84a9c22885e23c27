"""Registered queries of the training-data operators: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tableflow.session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn

    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_decontamination")
def op1(spark, sf_dir):
    """Benchmark words in documents, by winnowing."""
    from tableflow.llm.decontaminate import contaminated

    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op2_secret_scan")
def op2(spark, sf_dir):
    """Secrets of every document, by a ledger of content-addressed texts."""
    from tableflow.llm.secrets import secret_digests

    return secret_digests(table(spark, sf_dir, "documents"))


@query("op3_byte_bpe")
def op3(spark, sf_dir):
    """Token ids of every document and their way back."""
    import public_tokenizers

    from tableflow.llm.bpe import bpe_digests

    return bpe_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


@query("op9_token_counts")
def op9(spark, sf_dir):
    """Token counts of every document."""
    import public_tokenizers

    from tableflow.llm.token_counts import count_tokens

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op8_chat_format")
def op8(spark, sf_dir):
    """All conversations, and one that says control strings, formatted and read back."""
    from tableflow.llm.chat import chat_digests

    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    tricky = spark.range(2).selectExpr("CAST(-7 AS BIGINT) AS conv_id", "id AS turn",
                                       "IF(id = 0, 'user', 'assistant') AS role", f"'{said}' AS text")
    return chat_digests(turns.unionByName(tricky))


@query("op7_quality_rules")
def op7(spark, sf_dir):
    """Base counts and the calibrated model's verdict of every document."""
    from tableflow.llm.quality import quality_verdicts

    return quality_verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op10_substring_dedup")
def op10(spark, sf_dir):
    """Words of every document without passages of 35 words that stand elsewhere too."""
    from tableflow.llm.repeats import repeat_digests

    return repeat_digests(table(spark, sf_dir, "documents"))


@query("op4_ngram_jaccard_join")
def op4(spark, sf_dir):
    """Class and links of every document at a five-word Jaccard similarity of 0.8 or more."""
    from tableflow.llm.jaccard import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


@query("op5_warc_fixity")
def op5(spark, sf_dir):
    """Records of the pages' WARC store that a damaged replica lost, changed or added."""
    from tableflow.llm.fixity import audit, damaged_replica

    return audit(*damaged_replica(table(spark, sf_dir, "pages"))).select("archive", "offset", "record_id", "status", "expected", "found")


@query("op6_lm_scoring")
def op6(spark, sf_dir):
    """Base and maximum-entropy scores of every document."""
    from tableflow.llm.language_model import score_texts

    return score_texts(table(spark, sf_dir, "documents"))


@query("op11_conversation_repair")
def op11(spark, sf_dir):
    """Damaged conversations, their faults and cheapest repair."""
    from tableflow.llm.repair import repair_damaged

    return repair_damaged(table(spark, sf_dir, "conversations"))


@query("op12_embedding_whitening")
def op12(spark, sf_dir):
    """Whitened components of every embedding."""
    from tableflow.llm.whitening import whiten

    return whiten(table(spark, sf_dir, "embeddings"))


@query("op13_html_extraction")
def op13(spark, sf_dir):
    """Main text of every page."""
    from tableflow.llm.html_text import main_text

    return main_text(table(spark, sf_dir, "pages"))
