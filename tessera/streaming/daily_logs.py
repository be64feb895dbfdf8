"""Incremental daily event log (the D02 extract) with Structured Streaming.

The batch extract re-aggregates the whole event history; this job keeps it
up to date as event files arrive:

* file source over the event table, ``maxFilesPerTrigger`` bounded;
* the event-log projection of :mod:`tessera.sources.views`;
* a watermark on the event time and a 1-day tumbling ``window`` as the
  grouping key, so state for closed days is evicted (bounded state);
* ``update`` output mode into ``foreachBatch``: each micro-batch's changed
  (day, user) rows are written with their batch id to a parquet table in the
  shared checkpoint folder.  A replayed batch overwrites its own partition,
  so the sink is idempotent under retries;
* the current table is the latest version of every (day, user) — an
  aggregation (``max_by`` on the batch id), not a window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import scratch_path
from tessera.sources import views as V


def event_log_projection(events: DataFrame) -> DataFrame:
    k = V.prop_k()
    brand = V._pick(V.BRANDS, (F.col("user_id") + k % 3) % len(V.BRANDS))
    return events.select(F.col("user_id").alias("UserID"), F.col("ts").alias("EventTime"),
                         V._event_code().alias("EventCode"), brand.alias("DeviceBrand"))


def daily_counts(logs: DataFrame, lateness: str | None = None) -> DataFrame:
    """Counts per day and user.  With *lateness* the state of older days is
    dropped and rows later than that are lost; without, files may arrive in
    any order and the result is that of the batch extract."""
    day = F.window(F.col("EventTime").cast("timestamp"), "1 day")
    logs = logs.withColumn("EventTime", F.col("EventTime").cast("timestamp"))
    if lateness:
        logs = logs.withWatermark("EventTime", lateness)
    return (logs.groupBy(day.alias("w"), "UserID")
                .agg(F.max("DeviceBrand").alias("DeviceBrand"),
                     F.count_if(F.col("EventCode") == "app_info_openApp").cast("long").alias("open_time"),
                     F.count_if(F.col("EventCode").isin("pop_up_show_listSub",
                                                        "parentcontrol_show_listPackage"))
                     .cast("long").alias("payment_screen_time")))


def run(spark: SparkSession, table_dir: str, table: str = "events",
        name: str = "daily_event_log", files_per_trigger: int = 64) -> str:
    """Run the stream over the ``table`` files of ``table_dir`` until the
    current input is consumed (``availableNow``); returns the sink path."""
    path = f"{table_dir.rstrip('/')}/{table}.parquet"
    schema = spark.read.parquet(path).schema
    # As a pattern, the path may be a single file as well as a folder of files.
    pattern = f"{table_dir.rstrip('/')}/{table}[.]parquet"
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
              .parquet(pattern))
    agg = daily_counts(event_log_projection(stream))
    sink = scratch_path(spark, f"{name}/table")
    ckpt = scratch_path(spark, f"{name}/checkpoint")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        (batch.select(F.to_date(F.col("w.start")).alias("EventDate"), "UserID", "DeviceBrand",
                      "open_time", "payment_screen_time")
              .withColumn("batch_id", F.lit(batch_id).cast("long"))
              .write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}"))

    q = (agg.writeStream.outputMode("update").foreachBatch(write_batch)
            .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    return sink


def current_table(spark: SparkSession, sink: str) -> DataFrame:
    """Latest version of every (day, user) row written by :func:`run`."""
    rows = spark.read.parquet(sink)
    latest = F.struct("DeviceBrand", "open_time", "payment_screen_time")
    g = rows.groupBy("EventDate", "UserID").agg(F.max_by(latest, "batch_id").alias("r"))
    return g.select("EventDate", "UserID", "r.DeviceBrand", "r.open_time", "r.payment_screen_time")
