"""Structured Streaming form of the daily loads.

The reference runs once a day over the day's drop of delivery rows. Here
the drops land as files in a folder and two streams consume them:

* ``courier_daily_stream``: courier performance per calendar day as an
  event-time window with a watermark; a day is emitted once the watermark
  passes its end (append mode), so late rows within the allowed lateness
  still count and nothing is emitted twice.
* ``previous_delivery_stream``: the courier fact with the courier's
  previous delivery. The previous delivery may sit in an earlier drop, so
  the last (time, id, duration) of each courier is kept in state
  (``applyInPandasWithState``). Within a micro-batch a courier's rows are
  ordered by (issue time, id); drops must arrive in time order per courier,
  and a drop that is older than what the courier already delivered stops the
  query with an error instead of giving a wrong previous delivery. A
  courier's state is one row, and its rows per call are bounded by the
  micro-batch size (``maxFilesPerTrigger``), not by its history.

Both sinks are file sinks with a checkpoint under the shared checkpoint
directory: a restarted query resumes from its offsets and the sink's
commit log keeps each batch exactly once. The state function runs in the
executors' Python workers, so the package must be shipped with the job
(``--py-files`` or an installed wheel) on a cluster.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from postlens.functions.semantics import np_round, pct_change
from postlens.operators import postal as O


def read_drops(spark: SparkSession, landing: str, schema: T.StructType, files_per_batch: int = 16) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(landing)


def courier_daily_stream(spark: SparkSession, landing: str, schema: T.StructType, sink: str, checkpoint: str,
                         lateness: str = "1 day", available_now: bool = True) -> StreamingQuery:
    """Per (day, city, courier): mean and count of duration, success share
    (rounded 2, pandas rounding) and the view's efficiency score."""
    # Watermarks need a session-zone timestamp; the drops carry wall-clock
    # (NTZ) times, read in the session time zone.
    s = (read_drops(spark, landing, schema).withColumn("event_ts", F.col("issue_datetime").cast("timestamp"))
         .withWatermark("event_ts", lateness))
    g = s.groupBy(F.window("event_ts", "1 day").alias("day"), "city", "courier_id").agg(
        np_round(F.avg("delivery_duration_minutes"), 2).alias("avg_delivery_time"),
        F.count("delivery_duration_minutes").alias("total_deliveries"),
        np_round(F.avg(F.col("success").cast("double")), 2).alias("success_rate"))
    eff = F.col("success_rate") * 0.6 + (F.lit(120.0) - F.greatest(F.lit(0.0), F.least(
        F.col("avg_delivery_time"), F.lit(120.0)))) / 120.0 * 0.4
    out = g.select(F.to_date(F.col("day.start")).alias("date"), "city", "courier_id", "avg_delivery_time",
                   "total_deliveries", "success_rate", np_round(eff, 3).alias("efficiency_score"))
    w = (out.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
         .partitionBy("date"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start(sink)


FACT_SCHEMA = T.StructType([
    T.StructField("delivery_id", T.StringType()), T.StructField("courier_id", T.StringType()),
    T.StructField("parcel_type", T.StringType()), T.StructField("city", T.StringType()),
    T.StructField("issue_datetime", T.TimestampNTZType()),
    T.StructField("delivery_duration_minutes", T.IntegerType()),
    T.StructField("previous_delivery_duration", T.IntegerType()),
])
STATE_SCHEMA = T.StructType([
    T.StructField("last_ts", T.TimestampNTZType()), T.StructField("last_id", T.StringType()),
    T.StructField("last_parcel", T.StringType()), T.StructField("last_minutes", T.IntegerType()),
])
ORDER = ["issue_datetime", "delivery_id", "parcel_id", "delivery_duration_minutes"]


def _with_previous(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    rows = pd.concat(list(batches), ignore_index=True).sort_values(ORDER, kind="mergesort")
    minutes = rows["delivery_duration_minutes"].astype("Int64")
    prev = minutes.shift(1)
    if state.exists:
        if rows["issue_datetime"].iloc[0] < state.get[0]:
            raise ValueError(f"delivery {rows['delivery_id'].iloc[0]} is older than the courier's last one")
        prev.iloc[0] = state.get[3]
    last = rows.iloc[-1]
    state.update((last["issue_datetime"], last["delivery_id"], last["parcel_id"],
                  None if pd.isna(last["delivery_duration_minutes"]) else int(last["delivery_duration_minutes"])))
    yield pd.DataFrame({
        "delivery_id": rows["delivery_id"], "courier_id": rows["courier_id"], "parcel_type": rows["parcel_type"],
        "city": rows["city"], "issue_datetime": rows["issue_datetime"],
        "delivery_duration_minutes": minutes, "previous_delivery_duration": prev.astype("Int64")})


def previous_delivery_stream(spark: SparkSession, landing: str, schema: T.StructType, sink: str,
                             checkpoint: str, available_now: bool = True,
                             files_per_batch: int = 16) -> StreamingQuery:
    s = read_drops(spark, landing, schema, files_per_batch).where(F.col("courier_id").isNotNull())
    facts = s.groupBy("courier_id").applyInPandasWithState(
        _with_previous, FACT_SCHEMA, STATE_SCHEMA, "append", GroupStateTimeout.NoTimeout)
    change = pct_change("delivery_duration_minutes", "previous_delivery_duration")
    out = facts.select("*", np_round(change, 1).alias("performance_change_percent"),
                       O.performance_trend(change).alias("performance_trend"),
                       F.to_date("issue_datetime").alias("delivery_date"))
    w = (out.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
         .partitionBy("delivery_date"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start(sink)
