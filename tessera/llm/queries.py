"""The registered query of each operator, with its production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import (
    bestfit_packing,
    decontaminate,
    exact_dedup,
    language_id,
    mixing,
    multi_index,
    near_dedup,
    packed_ids,
    prefix_trie,
    repeats,
    toxicity,
    vector_codes,
    warc,
)
from tessera.llm.common import new_folder, table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_bestfit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bestfit_packing.packed_documents(table(spark, sf_dir, "documents"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "warc")
    warc.write_pages(table(spark, sf_dir, "pages"), path)
    return warc.read_warc(spark, path, payload="check").drop("url", "payload")


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op5_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.nearest_neighbours(table(spark, sf_dir, "embeddings"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.languages(table(spark, sf_dir, "documents"))


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeats(table(spark, sf_dir, "documents"))


def op8_packed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "packed-ids")
    packed_ids.write_packed(table(spark, sf_dir, "documents"), path)
    return packed_ids.unpacked(packed_ids.read_packed(spark, path))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.copy_groups(table(spark, sf_dir, "documents"))


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.vector_codes(table(spark, sf_dir, "embeddings"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


def op13_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("spans")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_bestfit_packing": op2_bestfit_packing,
    "op3_warc": op3_warc,
    "op4_near_dedup": op4_near_dedup,
    "op5_multi_index": op5_multi_index,
    "op6_language_id": op6_language_id,
    "op7_repeats": op7_repeats,
    "op8_packed_ids": op8_packed_ids,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_mix_sources": op10_mix_sources,
    "op11_vector_codes": op11_vector_codes,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_decontaminate": op13_decontaminate,
}

ORACLE: dict[str, str] = {
    "op3_warc": warc.ORACLE,
    "op9_exact_dedup": exact_dedup.ORACLE,
    "op10_mix_sources": mixing.ORACLE,
    "op11_vector_codes": vector_codes.ORACLE,
    "op12_prefix_trie": prefix_trie.ORACLE,
    "op13_decontaminate": decontaminate.ORACLE,
}
