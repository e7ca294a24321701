"""A pipeline that turns documents into training tokens, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strataloom.llm import lines, mixing, pieces, simhash, toxicity
from strataloom.llm.common import forget, stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the labelled examples don't show to be toxic."""
    return toxicity.drop_toxic(docs, toxicity.fit_tables(docs, sf_dir))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that match a line before them; those left without words go."""
    return lines.drop_repeated_lines(docs)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group."""
    return simhash.keep_one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as a mix by the target weights takes them."""
    return mixing.take(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, checked by decoding them."""
    return pieces.encode_documents(docs)


STAGES = [("toxicity", drop_toxic), ("line dedup", dedup_lines), ("simhash near-dedup", dedup_documents), ("mixing", mix_sources), ("sentencepiece", encode)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents; each one's output is written and read again, and deleted once the next is written.

    Nulls in any column, empty and very long texts, repeated rows and an empty table pass through
    as each stage says; columns of any name stay up to the last stage, which returns its own. A
    document without words has nothing that the mix could take, so it ends there.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if before is not None:
            forget(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)


#: SQL can't express the stages; tests/llm/test_pipeline.py holds what each keeps against plain Python.
ORACLE_SQL = None
