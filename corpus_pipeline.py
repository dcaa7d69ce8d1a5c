"""A corpus pipeline over ``documents``: quality rules, near copies, personal data, mixing, packing.

Every stage takes all rows that the one before has kept, as a table that was written and read again.  All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from titlepulse.llm import mixing, ngram_join, packing, pii, quality_rules
from titlepulse.llm.common import prepare, table
from titlepulse.sources.shared import stage

# Options of the mix, such as its weights, and of the windows of slots that are packed together.
MIX: dict = {}
WINDOWS: dict = {}


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that every quality rule passes; the rules are those for texts with personal data still in them."""
    prepare(spark)
    return quality_rules.judge(docs, quality_rules.RULES_BEFORE_REDACTION, name="_judged").where("_judged.kept").select(*docs.columns)


def near_copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest doc_id, of each group that 4/5 of equal shingles link."""
    prepare(spark)
    return ngram_join.keep_one(docs)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; personal data in the texts gives way to its kind in brackets."""
    prepare(spark)
    return pii.redact(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order in which the sources' schedule takes them."""
    prepare(spark)
    return mixing.in_mixed_order(docs, **MIX)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces, each with its place in a sequence; sequences follow the order of the mix.

    A table does not keep the order of its rows, so the slots are found again: they follow from the documents and ``MIX``.
    """
    prepare(spark)
    mixed = stage(mixing.mix(docs.select("doc_id", "text", "source"), **MIX), "mixed")
    return packing.pack_mixed(mixed, added=True, **WINDOWS)


STAGES = [
    ("quality rules", quality_stage),
    ("near copies", near_copies_stage),
    ("personal data", pii_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for number, (_, function) in enumerate(STAGES):
        docs = stage(function(spark, docs, sf_dir), f"stage-{number}")
    return docs


# Tokenizing can't be written in SQL; the tests hold the pipeline against a plain version of each stage.
ORACLE_SQL = None

PIPELINE_QUERIES = {"pipeline": run}
PIPELINE_CHECKS = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
