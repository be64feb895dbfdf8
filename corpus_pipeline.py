"""Corpus preparation: raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``documents``.  Every stage works on all rows that
its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import bestfit_packing, exact_dedup, language_id, mixing, near_dedup
from tessera.llm.common import materialise, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents whose language cannot be told (no text, no letter)."""
    return language_id.drop_unidentified(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of texts that are equal up to white space."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every near-duplicate group."""
    return near_dedup.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights; a document may come twice."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and place in it."""
    return bestfit_packing.packed_documents(docs)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mix_sources", mix_sources),
    ("bestfit_packing", pack_sequences),
]

#: A trained language model has no SQL form; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
