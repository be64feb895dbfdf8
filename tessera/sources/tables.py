"""Scans and sinks (survey 2A).

* driver tables are parquet, read lazily so Catalyst pushes filters and
  column pruning into the scan;
* CSV extracts are read with an explicit schema (never ``inferSchema``);
* batch extracts and per-horizon feature tables are written once, partitioned.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


# Tables whose per-row work is heavy (whole-text tokenising, regexes), with
# the unique key used to spread a scan that yields too few partitions.
# Narrow tables (events, TPC-H) are cheap per row and are not spread: an
# extra exchange costs more than it saves there.
PRIMARY_KEYS = {
    "documents": "doc_id", "benchmark": "item_id", "pages": "page_id",
    "conversations": "conv_id", "embeddings": "vec_id",
}


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hash-spread a scan over the cluster when it arrives in fewer
    partitions than there are cores (a small file with one row group).  On a
    large input the scan already has many partitions and nothing changes.
    The key is a unique id, so the spread is deterministic and skew-free."""
    try:
        target = df.sparkSession.sparkContext.defaultParallelism
        current = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 — no RDD access (e.g. a remote session): leave as is
        return df
    if current >= target:
        return df
    return df.repartition(target, key)


class Tables:
    """Lazy accessor for the parquet tables of one data directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def get(self, name: str) -> DataFrame:
        df = self.spark.read.parquet(self.path(name))
        key = PRIMARY_KEYS.get(name)
        return spread(df, key) if key else df

    def __getattr__(self, name: str) -> DataFrame:
        if name in DRIVER_TABLES:
            return self.get(name)
        raise AttributeError(name)

    def register_views(self) -> None:
        for name in DRIVER_TABLES:
            self.get(name).createOrReplaceTempView(name)


# A01 -------------------------------------------------------------------------
def read_csv(spark: SparkSession, path: str, schema: T.StructType | str,
             header: bool = True) -> DataFrame:
    """CSV scan with a declared schema; timestamps longer than 19 chars are
    handled by :func:`tessera.functions.dates.parse_ts19` afterwards."""
    return (spark.read.schema(schema).option("header", header)
            .option("mode", "PERMISSIVE").csv(path))


# A02 -------------------------------------------------------------------------
def rename_positional(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Headerless extract → named columns, by position."""
    names = list(names)
    if len(names) != len(df.columns):
        raise ValueError(f"expected {len(df.columns)} names, got {len(names)}")
    return df.toDF(*names)


# A03 -------------------------------------------------------------------------
def run_extracts(extracts: Mapping[str, DataFrame], out_dir: str,
                 mode: str = "overwrite") -> dict[str, str]:
    """Write one parquet dataset per named extract (the batch crawl)."""
    written = {}
    for name, df in extracts.items():
        path = f"{out_dir.rstrip('/')}/{name}"
        df.write.mode(mode).parquet(path)
        written[name] = path
    return written


def run_sql_extracts(tables: Tables, statements: Mapping[str, str], out_dir: str) -> dict[str, str]:
    """The batch crawl from (name, SQL) pairs over the driver tables."""
    tables.register_views()
    return run_extracts({name: tables.spark.sql(sql) for name, sql in statements.items()}, out_dir)


# A04 -------------------------------------------------------------------------
def union_live_archive(live: DataFrame, archive: DataFrame) -> DataFrame:
    """Bag union (UNION ALL) of a live table and its archive."""
    return live.unionByName(archive)


# A05 -------------------------------------------------------------------------
def write_by_horizon(df: DataFrame, path: str, horizon_col: str = "horizon",
                     mode: str = "overwrite", spread_by: str = "UserID", files: int = 16) -> None:
    """All horizons in one dataset, partitioned so a reader of one horizon
    prunes the others.  Rows are clustered by the horizon and one of *files*
    hash ranges of ``spread_by``, so a horizon is written by many tasks in few
    files each."""
    part = F.pmod(F.xxhash64(spread_by), F.lit(files))
    (df.repartition(horizon_col, part).write.mode(mode)
       .partitionBy(horizon_col).parquet(path))


# A06 -------------------------------------------------------------------------
def load_stop_words(spark: SparkSession, path: str | None = None,
                    languages: Iterable[str] = ("english",)) -> DataFrame:
    """Union (set semantics) of a one-word-per-line file and Spark's built-in
    lists.  Compound entries keep their ``_`` joiner."""
    from pyspark.ml.feature import StopWordsRemover

    words = set()
    for lang in languages:
        words.update(StopWordsRemover.loadDefaultStopWords(lang))
    builtin = spark.createDataFrame([(w,) for w in sorted(words)], "word string")
    if path is None:
        return builtin
    listed = (spark.read.text(path)
              .select(F.lower(F.trim(F.col("value"))).alias("word"))
              .filter(F.col("word") != ""))
    return listed.unionByName(builtin).distinct()


# A07 -------------------------------------------------------------------------
def annotation_recode(feedback: DataFrame, annotation: DataFrame,
                      key: str = "FeedbackID",
                      mark: str = "lookup_in_question") -> DataFrame:
    """Left-join a manual annotation sheet and recode its mark:
    missing/``0`` → ``not in``, ``x``/``v`` → ``in``."""
    joined = feedback.join(annotation.select(key, mark), key, "left")
    m = F.lower(F.trim(F.col(mark).cast("string")))
    return joined.withColumn(
        mark, F.when(m.isin("x", "v"), F.lit("in")).otherwise(F.lit("not in")))


def annotation_counts(recoded: DataFrame,
                      mark: str = "lookup_in_question") -> DataFrame:
    return recoded.groupBy(mark).agg(F.count(F.lit(1)).alias("n"))
