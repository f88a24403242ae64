"""The streaming daily loads give the batch results on the same rows."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF_SMALL
from postlens.operators import windows as W
from postlens.session import scratch_dir
from postlens.sources.standins import load
from postlens.streaming import daily_load as S


def stage_drops(spark, df, landing):
    """One file per event-time year, written in time order (file mtime)."""
    years = sorted(r[0] for r in df.select(F.year("issue_datetime")).distinct().collect())
    for y in years:
        df.where(F.year("issue_datetime") == y).coalesce(1).write.mode("append").parquet(landing)
    return len(years)


def test_previous_delivery_stream_equals_batch(spark):
    d = load(spark, SF_SMALL, "deliveries")
    landing = scratch_dir(spark, "landing")
    n = stage_drops(spark, d, landing)
    assert n > 1
    sink, ckpt = scratch_dir(spark, "facts_sink"), scratch_dir(spark, "facts_ckpt")
    schema = spark.read.parquet(landing).schema
    q = S.previous_delivery_stream(spark, landing, schema, sink, ckpt, files_per_batch=1)  # one drop per batch
    q.awaitTermination(600)
    got = spark.read.parquet(sink).select("delivery_id", "courier_id", "issue_datetime",
                                          "delivery_duration_minutes", "previous_delivery_duration",
                                          "performance_trend")
    want = W.previous_delivery(d).select("delivery_id", "courier_id", "issue_datetime",
                                         "delivery_duration_minutes", "previous_delivery_duration",
                                         "performance_trend")
    assert sorted(got.collect()) == sorted(want.collect())


def test_courier_daily_stream_emits_closed_days(spark):
    d = load(spark, SF_SMALL, "deliveries")
    landing = scratch_dir(spark, "landing_daily")
    stage_drops(spark, d, landing)
    sink, ckpt = scratch_dir(spark, "daily_sink"), scratch_dir(spark, "daily_ckpt")
    q = S.courier_daily_stream(spark, landing, spark.read.parquet(landing).schema, sink, ckpt)
    q.awaitTermination(600)
    got = spark.read.parquet(sink)
    horizon = d.agg(F.max("issue_datetime")).first()[0] - dt.timedelta(days=1)
    from postlens.functions.semantics import np_round
    want = (d.groupBy(F.to_date("issue_datetime").alias("date"), "city", "courier_id")
            .agg(np_round(F.avg("delivery_duration_minutes"), 2).alias("avg_delivery_time"),
                 F.count("delivery_duration_minutes").alias("total_deliveries"))
            .where(F.col("date") < F.lit(horizon.date()) - 1))
    g = got.where(F.col("date") < F.lit(horizon.date()) - 1).select(*want.columns)
    assert g.count() > 0
    assert sorted(g.collect()) == sorted(want.collect())


def test_previous_delivery_stream_resumes_from_checkpoint(spark):
    """A restarted query picks up its state and offsets: drops that arrive
    after the restart still see the previous delivery from before it, and
    no row is written twice."""
    d = load(spark, SF_SMALL, "deliveries")
    years = sorted(r[0] for r in d.select(F.year("issue_datetime")).distinct().collect())
    landing = scratch_dir(spark, "landing_restart")
    sink, ckpt = scratch_dir(spark, "restart_sink"), scratch_dir(spark, "restart_ckpt")
    half = len(years) // 2
    for y in years[:half]:
        d.where(F.year("issue_datetime") == y).coalesce(1).write.mode("append").parquet(landing)
    schema = spark.read.parquet(landing).schema
    S.previous_delivery_stream(spark, landing, schema, sink, ckpt, files_per_batch=1).awaitTermination(600)
    for y in years[half:]:
        d.where(F.year("issue_datetime") == y).coalesce(1).write.mode("append").parquet(landing)
    S.previous_delivery_stream(spark, landing, schema, sink, ckpt, files_per_batch=1).awaitTermination(600)
    cols = ["delivery_id", "courier_id", "issue_datetime", "delivery_duration_minutes", "previous_delivery_duration"]
    got = spark.read.parquet(sink).select(*cols)
    want = W.previous_delivery(d).select(*cols)
    assert got.count() == want.count()
    assert sorted(got.collect()) == sorted(want.collect())
