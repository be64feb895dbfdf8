"""Operator 9: exact de-duplication by skew-safe combining (built-ins only).

Texts are equal when identical after deleting every white-space character
(``[\\x20\\x09-\\x0D]``).  Three combining stages, each grouping on the digest
*and* the full normalised text, so a digest collision never merges two texts:

1. every input task reduces its own copies (the map-side half of the first
   aggregate, whose salt is the task's number);
2. the salted groups of all tasks are merged per (digest, salt);
3. the salt winners are merged per digest.

A group of copies that holds a third of the table reaches stage 3 as at most
``salts`` rows.  Members learn their winner through a join on the digest; only
if two different texts share a digest (never seen with SHA-256, provoked in
the tests with a weak digest) do those digests join on the full text as well.

Defined results: a null text counts as empty, and all empty texts are one
group; of rows with equal length the smallest doc_id wins (a null id only if
its whole group has null ids); repeated rows count separately in
``group_size`` and are all ``kept`` when they carry the winning id; an empty table gives an empty
result; other columns of the input are ignored here and returned by
:func:`drop_copies`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import WHITE, materialise

SALTS = 16


def sha256_hex(norm: Column) -> Column:
    return F.sha2(norm.cast("binary"), 256)


def _normalised(docs: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return (docs.select("doc_id", F.char_length(text).cast("long").alias("_n"),
                        F.regexp_replace(text, WHITE, "").alias("_norm"))
            .withColumn("_digest", digest(F.col("_norm"))))


def winners(docs: DataFrame, salts: int = SALTS,
            digest: Callable[[Column], Column] = sha256_hex) -> DataFrame:
    """One row per distinct text: _digest, _norm, keep_id, group_size."""
    salted = _normalised(docs, digest).withColumn("_salt", F.spark_partition_id() % salts)
    merged = (salted.groupBy("_digest", "_salt", "_n", "_norm")
              .agg(F.min("doc_id").alias("_id"), F.count(F.lit(1)).alias("_rows")))
    # Both aggregates below are clustered by the digest: one exchange for the two.
    by_length = (merged.repartition("_digest").groupBy("_digest", "_n", "_norm")
                 .agg(F.min("_id").alias("_id"), F.sum("_rows").alias("_rows")))
    return (by_length.groupBy("_digest", "_norm")
            .agg(F.max("_n").alias("_n"), F.max_by("_id", "_n").alias("keep_id"),
                 F.sum("_rows").alias("group_size")))


def copy_groups(docs: DataFrame, salts: int = SALTS,
                digest: Callable[[Column], Column] = sha256_hex) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    best = winners(docs, salts, digest)
    narrow = materialise(best.select("_digest", "keep_id", "group_size"), "winners")
    clashing = (narrow.groupBy("_digest").agg(F.count(F.lit(1)).alias("_texts"))
                .filter("_texts > 1").select("_digest"))
    rows = _normalised(docs, digest)
    rows = rows.withColumn("text_sha256",
                           F.col("_digest") if digest is sha256_hex else sha256_hex(F.col("_norm")))
    if clashing.isEmpty():
        out = rows.drop("_norm").join(narrow, "_digest")
    else:
        alone = rows.join(clashing, "_digest", "left_anti").drop("_norm").join(narrow, "_digest")
        mixed = (rows.join(clashing, "_digest", "left_semi")
                 .join(best.join(clashing, "_digest", "left_semi").drop("_n"),
                       ["_digest", "_norm"]))
        out = alone.select("doc_id", "keep_id", "group_size", "text_sha256").unionByName(
            mixed.select("doc_id", "keep_id", "group_size", "text_sha256"))
    return out.select("doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"),
                      F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def drop_copies(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """The documents that stay, one row per distinct text, all input columns.
    If the winning id comes several times with the winning length, one of
    these rows stays."""
    best = materialise(winners(docs, salts).select(
        F.col("_digest").alias("__digest"), _id_key(F.col("keep_id")).alias("__id"),
        F.col("_n").alias("__n")), "winners")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.withColumns({
        "__digest": sha256_hex(F.regexp_replace(text, WHITE, "")),
        "__id": _id_key(F.col("doc_id")), "__n": F.char_length(text).cast("long")})
    key = ["__digest", "__id", "__n"]
    return rows.join(best, key, "left_semi").dropDuplicates(key).select(*docs.columns)


def _id_key(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("string"), F.lit("null"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm
  FROM documents),
w AS (
  SELECT norm, max(n) AS most, count(*) AS group_size FROM d GROUP BY norm),
k AS (
  SELECT d.norm, min(d.doc_id) AS keep_id, any_value(w.group_size) AS group_size
  FROM d JOIN w ON d.norm = w.norm AND d.n = w.most GROUP BY d.norm)
SELECT d.doc_id, k.keep_id, k.group_size, d.doc_id = k.keep_id AS kept,
       sha256(d.norm) AS text_sha256
FROM d JOIN k ON d.norm = k.norm
"""
