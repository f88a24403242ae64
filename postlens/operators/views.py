"""Grouped analytic views: the executed pandas views (E) and the warehouse
SQL views (S).

All of them are a single ``groupBy().agg()``: Spark plans a partial
(map-side) aggregate before the shuffle, so a hot key contributes one
partial row per input partition, never all its rows to one task.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.functions.semantics import bool_mean, clip, np_round, safe_div
from postlens.operators.common import side_by_side


def _ds(ds: str | _dt.date):
    return F.lit(str(ds)).cast("date")


# ---------------------------------------------------------------- E views
def courier_performance_view(deliveries: DataFrame, ds: str) -> DataFrame:
    """By (city, courier): mean/count of duration, mean success, rounded to 2
    first; efficiency from the rounded values, rounded to 3.

    pandas drops rows whose group key is missing, so null keys are removed.
    """
    g = (deliveries.where(F.col("city").isNotNull() & F.col("courier_id").isNotNull())
         .groupBy("city", "courier_id")
         .agg(np_round(F.avg("delivery_duration_minutes"), 2).alias("avg_delivery_time"),
              F.count("delivery_duration_minutes").alias("total_deliveries"),
              np_round(bool_mean("success"), 2).alias("success_rate")))
    eff = (F.col("success_rate") * 0.6
           + (F.lit(120.0) - clip("avg_delivery_time", 0, 120)) / 120.0 * 0.4)
    return g.withColumn("date", _ds(ds)).withColumn("efficiency_score", np_round(eff, 3))


def department_efficiency_view(departments: DataFrame, ds: str) -> DataFrame:
    """By (city, department_type): sum and mean of daily_processed, mean
    processing time and queue length, rounded to 2."""
    g = (departments.where(F.col("city").isNotNull() & F.col("department_type").isNotNull())
         .groupBy("city", "department_type")
         .agg(F.coalesce(F.sum("daily_processed"), F.lit(0)).alias("total_processed"),
              np_round(F.avg("daily_processed"), 2).alias("avg_processed_per_dept"),
              np_round(F.avg("avg_processing_time_minutes"), 2).alias("avg_processing_time"),
              np_round(F.avg("queue_length"), 2).alias("avg_queue_length")))
    return g.withColumn("date", _ds(ds))


def transport_utilization_view(transport: DataFrame, ds: str) -> DataFrame:
    """By transport type: mean utilization, summed fuel, distance and
    deliveries (rounded to 2); efficiency = util * (1 - fuel/distance/100)
    from the rounded values, rounded to 3."""
    g = (transport.where(F.col("transport_type").isNotNull())
         .groupBy("transport_type")
         .agg(np_round(F.avg("utilization_rate"), 2).alias("utilization_rate"),
              np_round(F.coalesce(F.sum("fuel_consumption_liters"), F.lit(0.0)), 2).alias("fuel_consumption_liters"),
              np_round(F.coalesce(F.sum("total_distance_km"), F.lit(0.0)), 2).alias("total_distance_km"),
              F.coalesce(F.sum("monthly_deliveries"), F.lit(0)).alias("monthly_deliveries")))
    eff = F.col("utilization_rate") * (F.lit(1.0) - safe_div("fuel_consumption_liters", "total_distance_km") / 100.0)
    return g.withColumn("date", _ds(ds)).withColumn("efficiency_score", np_round(eff, 3))


def customer_satisfaction_view(feedback: DataFrame, ds: str) -> DataFrame:
    """By city: mean and count of score, on-time share, rounded to 2."""
    g = (feedback.where(F.col("city").isNotNull()).groupBy("city")
         .agg(np_round(F.avg("satisfaction_score"), 2).alias("avg_satisfaction"),
              F.count("satisfaction_score").alias("feedback_count"),
              np_round(bool_mean("on_time_delivery"), 2).alias("on_time_rate")))
    return g.withColumn("date", _ds(ds))


def business_metrics(deliveries: DataFrame, departments: DataFrame, feedback: DataFrame, ds: str,
                     revenue_per_delivery: float = 65.0, cost_per_delivery: float = 35.0) -> DataFrame:
    """One row of daily business KPIs. The reference draws the unit rates
    at random; here they are parameters."""
    d = deliveries.agg(
        F.count(F.lit(1)).alias("total_deliveries"),
        F.count_distinct("courier_id").alias("active_couriers"),
        F.count_distinct("city").alias("cities_covered"))
    f = feedback.agg(F.avg("satisfaction_score").alias("customer_satisfaction_avg"),
                     bool_mean("on_time_delivery").alias("on_time_delivery_rate"))
    p = departments.agg(F.count_distinct("department_id").alias("active_departments"))
    row = side_by_side(d, f, p)
    return row.select(
        _ds(ds).alias("date"), "total_deliveries",
        (F.col("total_deliveries") * F.lit(revenue_per_delivery)).alias("total_revenue_estimated"),
        (F.col("total_deliveries") * F.lit(cost_per_delivery)).alias("operational_cost_estimated"),
        "customer_satisfaction_avg", "on_time_delivery_rate", "active_couriers",
        "active_departments", "cities_covered")


def profit_margin(metrics: DataFrame) -> DataFrame:
    """(revenue - cost) / revenue * 100, one decimal."""
    m = safe_div(F.col("total_revenue_estimated") - F.col("operational_cost_estimated"),
                 "total_revenue_estimated") * 100.0
    return metrics.select("date", "total_revenue_estimated", "operational_cost_estimated",
                          np_round(m, 1).alias("profit_margin_percent"))


# ---------------------------------------------------------------- S views
def department_staff_view(staff: DataFrame, ds: str) -> DataFrame:
    return (staff.where(F.col("snapshot_date") == _ds(ds))
            .groupBy("department_id", "department_type", "region", "position")
            .agg(F.sum("staff_count").alias("total_staff"),
                 F.avg("avg_salary").alias("avg_salary"),
                 F.avg("experience_months").alias("avg_experience_months"),
                 F.count(F.lit(1)).alias("position_variations"))
            .orderBy("department_id", "position"))


def transport_fleet_view(transport: DataFrame, ds: str) -> DataFrame:
    return (transport.where(F.col("month") == F.lit(str(ds)[:7]))
            .groupBy("transport_type")
            .agg(F.sum("fleet_size").alias("total_fleet_size"),
                 F.sum("monthly_deliveries").alias("total_monthly_deliveries"),
                 F.avg("avg_distance_per_delivery").alias("avg_distance_per_delivery"),
                 F.sum("total_distance_km").alias("total_distance_km"),
                 F.sum("fuel_consumption_liters").alias("total_fuel_consumption"),
                 F.avg("utilization_rate").alias("avg_utilization_rate"),
                 F.count_distinct("parcel_type").alias("parcel_types_served"))
            .orderBy(F.desc("total_monthly_deliveries")))


def geographical_coverage_view(coverage_rows: DataFrame, ds: str) -> DataFrame:
    """Reads coverage rows that already carry ``capacity_ratio`` and
    ``expansion_priority`` (see ``coverage.coverage_rows``)."""
    return (coverage_rows.where(F.col("analysis_date") == _ds(ds))
            .groupBy("region")
            .agg(F.sum("cities_covered").alias("total_cities_covered"),
                 F.sum("total_departments").alias("total_departments"),
                 F.avg("coverage_density").alias("avg_coverage_density"),
                 F.avg("service_quality_score").alias("avg_service_quality"),
                 F.sum("estimated_monthly_demand").alias("total_estimated_demand"),
                 F.sum("current_monthly_capacity").alias("total_current_capacity"),
                 F.avg("capacity_ratio").alias("avg_capacity_ratio"),
                 F.count_if(F.col("expansion_priority") == "high").alias("high_priority_areas"))
            .orderBy("avg_capacity_ratio"))


def ml_model_performance_view(predictions: DataFrame, ds: str) -> DataFrame:
    """MAE, RMSE, mean confidence, count and share within 10 % per model.

    The share divides by ``actual`` (not its absolute value), as the
    reference does; a zero actual counts as outside.
    """
    err = F.col("predicted_value") - F.col("actual_value")
    return (predictions.where((F.col("prediction_date") == _ds(ds)) & F.col("actual_value").isNotNull())
            .groupBy("model_type")
            .agg(F.avg(F.abs(err)).alias("mae"),
                 F.sqrt(F.avg(F.pow(err, 2))).alias("rmse"),
                 F.avg("confidence_score").alias("avg_confidence"),
                 F.count(F.lit(1)).alias("total_predictions"),
                 (F.count_if(safe_div(F.abs(err), "actual_value") <= 0.1) / F.count(F.lit(1)))
                 .alias("accuracy_within_10_percent"))
            .orderBy("mae"))
