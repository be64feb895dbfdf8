"""Small helpers shared by the operators: reading, scratch tables, row checks."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import scratch_path

#: ASCII white space of every contract: space and \x09-\x0D.
WHITE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def new_folder(spark: SparkSession, name: str) -> str:
    """Path of a folder in the cluster's shared folder that nobody else uses."""
    return scratch_path(spark, f"tessera-{name}-{uuid.uuid4().hex[:12]}")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write *df* once as Parquet into the cluster's shared folder and read it
    back: a cut of the lineage that survives the loss of executors.  Steps that
    are over by then lose their shuffle files as soon as the driver drops them."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    gc.collect()
    spark._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def is_held_out(doc_id: Column) -> Column:
    """The held-out fold: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fits(df: DataFrame, rows: int) -> bool:
    """Whether *df* has at most *rows* rows; counted on the executors."""
    return df.count() <= rows
