"""Spark session construction and cluster-safe lineage cutting.

The library never builds its own session inside an operator: every operator
takes DataFrames and returns DataFrames.  ``get_session`` is only a
convenience for scripts, tests and the benchmark.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

# Settings a 1000-executor deployment would override through spark-submit;
# here they are only defaults for local runs.
_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Runtime (measured) broadcast bound: AQE switches a join to broadcast only
    # when the materialised side is below this size.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Small-file friendly scans; a cluster sets this from the target SF.
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
}


def get_session(master: str | None = None, app: str = "tessera",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``.  Where it is unset a fresh
    folder on this machine serves, but only for a ``local`` master: the
    executors of a cluster could not read it."""
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="tessera-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(configured)
    return configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives the
    loss of executors, unlike a local checkpoint)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str, by: Sequence[str] = ()) -> DataFrame:
    """*df* written once as Parquet into the shared checkpoint folder and read
    back: a cut of the lineage whose readers still prune columns.  With *by* in
    a folder for each value of these (few) columns, so a filter on them reads
    no other rows."""
    path = scratch_path(df.sparkSession, f"tessera-{name}-{uuid.uuid4().hex[:12]}")
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for intermediate tables."""
    return os.path.join(ensure_checkpoint_dir(spark).rstrip("/"), name)
