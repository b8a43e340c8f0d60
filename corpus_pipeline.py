"""From raw documents to packed training sequences, stage by stage.

Each stage takes the documents its predecessor kept. Near duplicates are judged on five-word shingles at a similarity of 0.8.

Defined results: documents with null, empty or short text go in the first stage, by its rule of 50 words; very long texts are
judged, compared, searched and cut whole, and give as many pieces as they fill; rows that repeat a doc_id are one document to
near-dedup and stay together or go together, a repeated text under another id goes, the smallest id stays; rows with a null
doc_id are judged like others by every stage and never dropped as copies; an empty table gives empty tables. Columns beside those
of documents, whatever their names, are carried along up to the last stage, which returns pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from inkmill.llm import decontam, neardup, packing, pii, quality
from inkmill.llm.common import saved, table
from inkmill.plans.ship import ship


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    ship(spark)
    return quality.keep_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the smallest id."""
    ship(spark)
    return neardup.drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak a benchmark item, also with other numbers or names, go."""
    ship(spark)
    return decontam.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the text is masked by its kind; n_chars follows."""
    ship(spark)
    return pii.redact(docs, lengths="n_chars")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, packed."""
    ship(spark)
    return packing.pack_documents(docs, packing.default_tokenizer())


STAGES = [("quality_rules", quality_rules), ("near_dedup", near_dedup), ("decontamination", decontaminate), ("pii", redact_pii), ("packing", pack)]

#: Minwise trees, templates and tokens are not expressible in SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
