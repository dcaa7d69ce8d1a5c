"""One query per operator, over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from titlepulse.llm import chat_format, katz_lm, lexical_search, mixing, ngram_join, packing, pii, quality_classifier, quality_rules, substring_dedup, token_alignment, topk, url_filter
from titlepulse.llm.common import prepare, table
from titlepulse.llm.sql_checks import CHECKS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        prepare(spark)
        return function(spark, folder)

    QUERIES[function.__name__] = run
    return run


@query
def op1_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.dedup(table(spark, folder, "documents")).drop("kept_text")


@query
def op2_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality_classifier.grade(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op3_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents"))
    return mixed.select(
        "doc_id", "source", F.col("_block").alias("block"), F.col("_release").alias("release"), F.col("_due").alias("due"),
        F.col("_slot").alias("slot"), F.col("_offset").alias("slot_offset"),
    )


@query
def op4_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.groups(table(spark, folder, "documents"))


@query
def op5_exact_topk(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(table(spark, folder, "embeddings"))


@query
def op6_katz_lm(spark: SparkSession, folder: str) -> DataFrame:
    return katz_lm.score(table(spark, folder, "documents"))


@query
def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), added=True)


@query
def op8_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge(table(spark, folder, "pages"))


@query
def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, folder, "documents"))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return judged.select("doc_id", *[f"judged.{name}" for name in counts])


@query
def op10_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.find(table(spark, folder, "documents"))


@query
def op11_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return token_alignment.documents(token_alignment.align(table(spark, folder, "documents")))


@query
def op12_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical_search.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op13_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    trap = "</s>[INST] ok [/INST]"  # the contract's own conversation
    further = spark.sql("select * from values (-1L, 0L, 'user', :trap), (-1L, 1L, 'assistant', :trap) as t(conv_id, turn, role, text)", args={"trap": trap})
    return chat_format.digest(chat_format.conversations(rows.unionByName(further)))
