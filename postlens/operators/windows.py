"""Sequence and time-series operators.

Per-entity sequences (a courier's deliveries) are windowed in two levels so
that no single task holds a hot entity's whole history: the window is
partitioned by (entity, day) and only the first row of each day borrows its
predecessor from a per-(entity, day) summary, which is tiny. Daily metric
series have one row per metric and day (bounded by the calendar), so they
are windowed per metric directly.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlens.functions.semantics import np_round, pct_change, safe_div
from postlens.operators import postal as O


# ---------------------------------------------------------------- sequences
def split_lag(df: DataFrame, entity: str, order: list[str], value: str, out: str,
              bucket: Column | None = None) -> DataFrame:
    """``lag(value)`` over ``partitionBy(entity).orderBy(order)``, computed
    without putting a whole entity into one window partition.

    ``bucket`` (default: the date of the first order column) must be
    monotone in the order. Rows are windowed per (entity, bucket); the
    first row of a bucket takes the last value of the entity's preceding
    non-empty bucket, found by a lag over the per-bucket summary.
    """
    bucket = bucket if bucket is not None else F.to_date(F.col(order[0]))
    d = df.withColumn("_bucket", bucket)
    w = Window.partitionBy(entity, "_bucket").orderBy(*order)
    d = d.withColumn(out, F.lag(value).over(w)).withColumn("_first", F.row_number().over(w) == 1)
    # Last value per (entity, bucket) as an aggregate: partial aggregation
    # before the shuffle moves one row per bucket and map task, so this
    # second pass over the (column-pruned) input is cheap.
    key = F.struct(*[F.col(c) for c in order])
    last = (d.groupBy(entity, "_bucket").agg(F.max_by(F.col(value), key).alias("_last"))
            .withColumn("_carry", F.lag("_last").over(Window.partitionBy(entity).orderBy("_bucket")))
            .select(entity, "_bucket", "_carry"))
    d = d.join(last, [entity, "_bucket"], "left")
    return (d.withColumn(out, F.when(F.col("_first"), F.col("_carry")).otherwise(F.col(out)))
            .drop("_bucket", "_first", "_carry"))


DELIVERY_ORDER = ["issue_datetime", "delivery_id", "parcel_id", "delivery_duration_minutes"]


def previous_delivery(deliveries: DataFrame) -> DataFrame:
    """Previous delivery duration of the same courier (order: issue time,
    then id, parcel and duration as tie-breaks), change % and trend."""
    d = split_lag(deliveries.where(F.col("courier_id").isNotNull()), "courier_id", DELIVERY_ORDER,
                  "delivery_duration_minutes", "previous_delivery_duration")
    change = pct_change("delivery_duration_minutes", "previous_delivery_duration")
    return d.select("delivery_id", "courier_id", "parcel_type", "city", "issue_datetime",
                    "delivery_duration_minutes", "previous_delivery_duration",
                    np_round(change, 1).alias("performance_change_percent"),
                    O.performance_trend(change).alias("performance_trend"))


def courier_facts(deliveries: DataFrame) -> DataFrame:
    """Transactional fact per delivery with the courier's previous one."""
    p = previous_delivery(deliveries)
    return p.select(F.to_date("issue_datetime").alias("delivery_date"), "courier_id", "parcel_type", "city",
                    "delivery_duration_minutes", "previous_delivery_duration",
                    "performance_change_percent", "performance_trend")


def department_facts(departments: DataFrame, ds: str) -> DataFrame:
    """Monthly snapshot per department x parcel x transport for the run
    month: volume, mean processing time (1 dp) and utilization = volume /
    the department's busiest combination that month (2 dp)."""
    g = (departments.where(F.col("month") == F.lit(ds[:7]))
         .groupBy("department_id", "department_type", "parcel_type", "transport_type")
         .agg(F.sum("monthly_volume").alias("monthly_volume"),
              F.avg("avg_processing_time_minutes").alias("avg_proc")))
    peak = F.max("monthly_volume").over(Window.partitionBy("department_id"))
    return g.select(F.lit(ds).cast("date").alias("snapshot_date"), "department_id", "department_type",
                    "parcel_type", "transport_type", "monthly_volume",
                    np_round("avg_proc", 1).alias("avg_processing_time_minutes"),
                    np_round(safe_div("monthly_volume", peak), 2).alias("capacity_utilization"))


def transport_facts(transport: DataFrame, ds: str) -> DataFrame:
    """Monthly snapshot per transport x parcel with the transport metrics."""
    m = O.transport_metrics(transport.where(F.col("month") == F.lit(ds[:7])), "avg_distance_per_delivery")
    return m.select(
        F.lit(ds).cast("date").alias("snapshot_date"), "transport_type", "parcel_type", "fleet_size",
        "monthly_deliveries", "avg_distance_per_delivery",
        F.col("computed_distance_km").alias("total_distance_km"),
        F.col("computed_fuel_liters").alias("fuel_consumption_liters"), "utilization_rate_percent")


def prediction_facts(predictions: DataFrame, ds: str) -> DataFrame:
    """The day's prediction rows (date, model, entity, predicted, actual,
    confidence, unit) as appended to the fact table."""
    return predictions.where(F.col("prediction_date") == F.lit(ds).cast("date"))


# ---------------------------------------------------------------- daily series
def calendar_complete(daily: DataFrame, fill: float = 0.0) -> DataFrame:
    """One row per metric and calendar day between the metric's first and
    last day; missing days take ``fill``. The calendar has one row per day,
    so it stays small; it is joined back on (metric, date)."""
    cal = (daily.groupBy("metric").agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
           .select("metric", F.explode(F.sequence("lo", "hi")).alias("date")))
    return (cal.join(daily, ["metric", "date"], "left")
            .select("metric", "date", F.coalesce("value", F.lit(fill)).alias("value")))


def time_series_features(daily: DataFrame) -> DataFrame:
    """Value, value 7 and 30 days before, growth over each, and the
    weekday seasonality factor, on the calendar-complete series."""
    s = calendar_complete(daily)
    w = Window.partitionBy("metric").orderBy("date")
    wd = Window.partitionBy("metric", F.dayofweek("date"))
    wm = Window.partitionBy("metric")
    s = s.select("*", F.lag("value", 7).over(w).alias("value_7d_ago"),
                 F.lag("value", 30).over(w).alias("value_30d_ago"),
                 safe_div(F.avg("value").over(wd), F.avg("value").over(wm)).alias("seasonality_factor"))
    return s.select("date", "metric", "value", "value_7d_ago", "value_30d_ago",
                    safe_div(F.col("value") - F.col("value_7d_ago"), "value_7d_ago").alias("growth_rate_7d"),
                    safe_div(F.col("value") - F.col("value_30d_ago"), "value_30d_ago").alias("growth_rate_30d"),
                    "seasonality_factor")


def seasonality_factor(daily: DataFrame) -> DataFrame:
    """Weekday mean / overall mean per metric (calendar-complete series)."""
    s = calendar_complete(daily)
    by_day = s.groupBy("metric", F.date_format("date", "EEEE").alias("weekday")).agg(
        F.sum("value").alias("_sum"), F.count(F.lit(1)).alias("_n"))
    # Overall mean from the seven weekday partials of the same metric.
    m = Window.partitionBy("metric")
    overall = F.sum("_sum").over(m) / F.sum("_n").over(m)
    return by_day.select("metric", "weekday", (F.col("_sum") / F.col("_n")).alias("weekday_mean"),
                         overall.alias("overall_mean")).withColumn(
        "seasonality_factor", safe_div("weekday_mean", "overall_mean"))


def metric_anomalies(daily: DataFrame, window_days: int = 14, high: float = 3.0, medium: float = 2.0) -> DataFrame:
    """Days whose value leaves the trailing range: mean and sample
    deviation of the ``window_days`` preceding days (all present); |z| > 3
    HIGH, > 2 MEDIUM; zero deviation gives no anomaly."""
    s = calendar_complete(daily)
    w = Window.partitionBy("metric").orderBy("date").rowsBetween(-window_days, -1)
    s = s.select("*", F.avg("value").over(w).alias("expected"), F.stddev_samp("value").over(w).alias("sd"),
                 F.count("value").over(w).alias("n"))
    z = safe_div(F.col("value") - F.col("expected"), F.when(F.col("sd") > 0, F.col("sd")))
    s = s.where(F.col("n") == window_days).withColumn("z_score", z)
    sev = F.when(F.abs("z_score") > high, "HIGH").when(F.abs("z_score") > medium, "MEDIUM")
    return (s.withColumn("severity", sev).where(F.col("severity").isNotNull())
            .select("date", "metric", "expected", F.col("value").alias("actual"), "z_score", "severity"))


def with_anomaly_priority(anomalies: DataFrame) -> DataFrame:
    return anomalies.withColumn("priority", O.anomaly_priority(F.col("metric")))


# ---------------------------------------------------------------- logistics
def _month_over_month(df: DataFrame, entity: str, month: Column, measure: Column, extra: dict) -> DataFrame:
    """Per (entity, month) aggregate beside the entity's preceding month
    with data; the window runs over the aggregate, one row per month."""
    g = df.groupBy(F.col(entity).alias("affected_entity"), month.alias("period")).agg(
        measure.alias("cur"), *[v.alias(k) for k, v in extra.items()])
    w = Window.partitionBy("affected_entity").orderBy("period")
    return g.withColumn("prev", F.lag("cur").over(w)).withColumn("chg", pct_change("cur", "prev"))


def _pct_int(c: Column) -> Column:
    return F.rint(F.abs(c)).cast("int")


def logistics_anomalies(departments: DataFrame, deliveries: DataFrame, routes: DataFrame,
                        ds: str) -> DataFrame:
    """Three kinds, month over the previous month with data:
    delivery_time_spike: department mean processing time up >= 25 %
    (>= 40 % high, else medium); volume_anomaly: courier deliveries down
    >= 30 % (>= 50 % medium, else low); route_inefficiency: a city's mean
    route distance up >= 15 % (medium)."""
    t = _month_over_month(departments.where(F.col("department_id").isNotNull()), "department_id",
                          F.col("month"), F.avg("avg_processing_time_minutes"),
                          {"vol": F.sum("monthly_volume")})
    t = t.where(F.col("chg") >= 25).select(
        F.lit("delivery_time_spike").alias("anomaly_type"), "affected_entity", "period",
        F.when(F.col("chg") >= 40, "high").otherwise("medium").alias("severity"),
        F.format_string("Average delivery time increased by %d%%", _pct_int(F.col("chg"))).alias("description"),
        F.format_string("%d delayed parcels", F.col("vol")).alias("estimated_impact"))
    v = _month_over_month(deliveries.where(F.col("courier_id").isNotNull()), "courier_id",
                          F.date_format("delivery_date", "yyyy-MM"), F.count(F.lit(1)), {})
    v = v.where(F.col("chg") <= -30).select(
        F.lit("volume_anomaly").alias("anomaly_type"), "affected_entity", "period",
        F.when(F.col("chg") <= -50, "medium").otherwise("low").alias("severity"),
        F.format_string("Delivery volume dropped by %d%%", _pct_int(F.col("chg"))).alias("description"),
        F.lit("Potential courier availability issue").alias("estimated_impact"))
    city = F.coalesce("sender_location", "receiver_location")
    r = _month_over_month(routes.withColumn("_city", city).where(F.col("_city").isNotNull()), "_city",
                          F.date_format("validation_date", "yyyy-MM"), F.avg("estimated_distance_km"),
                          {"n": F.count(F.lit(1))})
    r = r.where(F.col("chg") >= 15).select(
        F.lit("route_inefficiency").alias("anomaly_type"), "affected_entity", "period",
        F.lit("medium").alias("severity"),
        F.format_string("Average route distance increased by %d%%", _pct_int(F.col("chg"))).alias("description"),
        F.format_string("Additional %d km", F.rint((F.col("cur") - F.col("prev")) * F.col("n")).cast("long"))
        .alias("estimated_impact"))
    return reduce(lambda a, b: a.unionByName(b), [t, v, r]).withColumn("detected_at", F.lit(ds).cast("date"))


def alert_counts(*anomaly_frames: DataFrame) -> DataFrame:
    """Number of alerts by priority over the given anomaly outputs."""
    sev = reduce(lambda a, b: a.unionByName(b),
                 [f.select(F.lower("severity").alias("severity")) for f in anomaly_frames])
    return sev.agg(F.count_if(F.col("severity") == "high").alias("high_priority"),
                   F.count_if(F.col("severity") == "medium").alias("medium_priority"),
                   F.count_if(F.col("severity") == "low").alias("low_priority"))


def latest_month(deliveries: DataFrame) -> Column:
    """``YYYY-MM`` of the last delivery, from the date column alone."""
    return deliveries.where(F.col("courier_id").isNotNull()).agg(F.date_format(F.max("delivery_date"), "yyyy-MM").alias("m")).scalar()


def top_performers(courier_months: DataFrame, departments: DataFrame, month: Column, k: int = 10) -> DataFrame:
    """Best k couriers by efficiency in the given month and the most
    efficient department, ties by id. ``orderBy().limit()`` plans a
    per-partition top-k and a k-row merge."""
    couriers = (courier_months.where((F.col("month") == month) & F.col("efficiency_score").isNotNull())
                .orderBy(F.desc("efficiency_score"), F.asc("courier_id")).limit(k)
                .select(F.lit("courier").alias("kind"), F.col("courier_id").alias("id"), "month", "efficiency_score", "deliveries_completed"))
    best = (departments.where(F.col("efficiency_score").isNotNull())
            .orderBy(F.desc("efficiency_score"), F.asc("department_id")).limit(1)
            .select(F.lit("department").alias("kind"), F.col("department_id").alias("id"), F.lit(None).cast("string").alias("month"),
                    "efficiency_score", F.lit(None).cast("long").alias("deliveries_completed")))
    return couriers.unionByName(best)


def operations_kpis(deliveries: DataFrame, departments: DataFrame, transport: DataFrame, ds: str) -> DataFrame:
    """Dashboard KPIs: deliveries, mean time, success %, department
    utilization % (mean queue / max queue) and transport utilization %
    (mean of the utilization fraction)."""
    from postlens.operators.common import side_by_side
    d = deliveries.agg(F.count(F.lit(1)).alias("total_deliveries"),
                       np_round(F.avg("delivery_duration_minutes"), 1).alias("avg_delivery_time"),
                       np_round(F.avg(F.col("success").cast("double")) * 100.0, 1).alias("success_rate"))
    p = departments.agg(np_round(safe_div(F.avg("queue_length"), F.max("queue_length")) * 100.0, 1)
                        .alias("department_utilization"))
    t = transport.agg(np_round(F.avg("utilization_rate") * 100.0, 1).alias("transport_utilization"))
    return side_by_side(d, p, t).withColumn("date", F.lit(ds).cast("date"))


def courier_insights(courier_months: DataFrame, month: Column) -> DataFrame:
    """The month's improving / declining / stable couriers, mean change."""
    cur = courier_months.where(F.col("month") == month)
    return cur.groupBy("month").agg(
        F.count_if(F.col("performance_trend") == "improving").alias("improving_couriers"),
        F.count_if(F.col("performance_trend") == "declining").alias("declining_couriers"),
        F.count_if(F.col("performance_trend") == "stable").alias("stable_couriers"),
        np_round(F.avg("performance_change_percent"), 2).alias("avg_performance_change"))

