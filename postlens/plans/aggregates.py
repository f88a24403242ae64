"""Registered aggregation queries: the executed views, the
warehouse views and the KPI rows over the stand-in fixtures."""

from __future__ import annotations

from postlens.operators import views
from postlens.operators.common import flat_arrays
from postlens.operators.postal import geographical_coverage
from postlens.plans import params as P
from postlens.plans.catalog import register
from postlens.sources.standins import load

S = "2.5"

# Shared SQL fragments of the oracles (DuckDB).
CLIP_120 = "CASE WHEN {c} IS NULL THEN NULL ELSE greatest(0.0E0, least({c}, 120.0E0)) END"


COURIER_VIEW_SQL = f"""
SELECT city, courier_id, avg_delivery_time, total_deliveries, success_rate, DATE '{P.RUN_DS}' AS "date",
       round_even(success_rate * 0.6E0 + (120.0E0 - {CLIP_120.format(c='avg_delivery_time')}) / 120.0E0 * 0.4E0, 3)
         AS efficiency_score
FROM (SELECT city, courier_id,
             round_even(avg(delivery_duration_minutes), 2) AS avg_delivery_time,
             count(delivery_duration_minutes) AS total_deliveries,
             round_even(avg(cast(success AS double)), 2) AS success_rate
      FROM deliveries WHERE city IS NOT NULL AND courier_id IS NOT NULL
      GROUP BY city, courier_id) g"""


@register("courier_performance_view", section=S, oracle=COURIER_VIEW_SQL)
def q_courier_performance_view(spark, sf):
    return views.courier_performance_view(load(spark, sf, "deliveries"), P.RUN_DS)


@register("department_efficiency_view", section=S, oracle=f"""
SELECT city, department_type,
       cast(coalesce(sum(daily_processed), 0) AS BIGINT) AS total_processed,
       round_even(avg(daily_processed), 2) AS avg_processed_per_dept,
       round_even(avg(avg_processing_time_minutes), 2) AS avg_processing_time,
       round_even(avg(queue_length), 2) AS avg_queue_length,
       DATE '{P.RUN_DS}' AS "date"
FROM departments WHERE city IS NOT NULL AND department_type IS NOT NULL
GROUP BY city, department_type""")
def q_department_efficiency_view(spark, sf):
    return views.department_efficiency_view(load(spark, sf, "departments"), P.RUN_DS)


@register("transport_utilization_view", section=S, oracle=f"""
SELECT transport_type, utilization_rate, fuel_consumption_liters, total_distance_km, monthly_deliveries,
       DATE '{P.RUN_DS}' AS "date",
       round_even(utilization_rate * (1.0E0 - fuel_consumption_liters / nullif(total_distance_km, 0) / 100.0E0), 3)
         AS efficiency_score
FROM (SELECT transport_type,
             round_even(avg(utilization_rate), 2) AS utilization_rate,
             round_even(coalesce(sum(fuel_consumption_liters), 0.0E0), 2) AS fuel_consumption_liters,
             round_even(coalesce(sum(total_distance_km), 0.0E0), 2) AS total_distance_km,
             cast(coalesce(sum(monthly_deliveries), 0) AS BIGINT) AS monthly_deliveries
      FROM transport WHERE transport_type IS NOT NULL GROUP BY transport_type) g""")
def q_transport_utilization_view(spark, sf):
    return views.transport_utilization_view(load(spark, sf, "transport"), P.RUN_DS)


@register("customer_satisfaction_view", section=S, oracle=f"""
SELECT city,
       round_even(avg(satisfaction_score), 2) AS avg_satisfaction,
       count(satisfaction_score) AS feedback_count,
       round_even(avg(cast(on_time_delivery AS double)), 2) AS on_time_rate,
       DATE '{P.RUN_DS}' AS "date"
FROM feedback WHERE city IS NOT NULL GROUP BY city""")
def q_customer_satisfaction_view(spark, sf):
    return views.customer_satisfaction_view(load(spark, sf, "feedback"), P.RUN_DS)


BUSINESS_METRICS_SQL = f"""
SELECT DATE '{P.RUN_DS}' AS "date", d.total_deliveries,
       d.total_deliveries * {P.REVENUE_PER_DELIVERY}E0 AS total_revenue_estimated,
       d.total_deliveries * {P.COST_PER_DELIVERY}E0 AS operational_cost_estimated,
       f.customer_satisfaction_avg, f.on_time_delivery_rate, d.active_couriers,
       p.active_departments, d.cities_covered
FROM (SELECT count(*) AS total_deliveries, count(DISTINCT courier_id) AS active_couriers,
             count(DISTINCT city) AS cities_covered FROM deliveries) d,
     (SELECT avg(satisfaction_score) AS customer_satisfaction_avg,
             avg(cast(on_time_delivery AS double)) AS on_time_delivery_rate FROM feedback) f,
     (SELECT count(DISTINCT department_id) AS active_departments FROM departments) p"""


def _business_metrics(spark, sf):
    return views.business_metrics(load(spark, sf, "deliveries"), load(spark, sf, "departments"),
                                  load(spark, sf, "feedback"), P.RUN_DS,
                                  P.REVENUE_PER_DELIVERY, P.COST_PER_DELIVERY)


@register("business_metrics", section=S, oracle=BUSINESS_METRICS_SQL)
def q_business_metrics(spark, sf):
    return _business_metrics(spark, sf)


@register("profit_margin", section=S, oracle=f"""
SELECT "date", total_revenue_estimated, operational_cost_estimated,
       round_even((total_revenue_estimated - operational_cost_estimated)
                  / nullif(total_revenue_estimated, 0) * 100.0E0, 1) AS profit_margin_percent
FROM ({BUSINESS_METRICS_SQL}) m""")
def q_profit_margin(spark, sf):
    return views.profit_margin(_business_metrics(spark, sf))


# ------------------------------------------------------------ warehouse views
STAFF_VIEW_SQL = f"""
SELECT department_id, department_type, region, "position",
       cast(sum(staff_count) AS BIGINT) AS total_staff,
       avg(avg_salary) AS avg_salary,
       avg(experience_months) AS avg_experience_months,
       count(*) AS position_variations
FROM staff WHERE snapshot_date = DATE '{P.SNAPSHOT_DS}'
GROUP BY department_id, department_type, region, "position"
ORDER BY department_id, "position\""""


@register("department_staff_view", section=S, oracle=STAFF_VIEW_SQL)
def q_department_staff_view(spark, sf):
    return views.department_staff_view(load(spark, sf, "staff"), P.SNAPSHOT_DS)


FLEET_VIEW_SQL = f"""
SELECT transport_type,
       cast(sum(fleet_size) AS BIGINT) AS total_fleet_size,
       cast(sum(monthly_deliveries) AS BIGINT) AS total_monthly_deliveries,
       avg(avg_distance_per_delivery) AS avg_distance_per_delivery,
       sum(total_distance_km) AS total_distance_km,
       sum(fuel_consumption_liters) AS total_fuel_consumption,
       avg(utilization_rate) AS avg_utilization_rate,
       count(DISTINCT parcel_type) AS parcel_types_served
FROM transport WHERE month = substr('{P.TRANSPORT_DS}', 1, 7)
GROUP BY transport_type
ORDER BY total_monthly_deliveries DESC"""


@register("transport_fleet_view", section=S, oracle=FLEET_VIEW_SQL)
def q_transport_fleet_view(spark, sf):
    return views.transport_fleet_view(load(spark, sf, "transport", month=P.TRANSPORT_DS[:7]), P.TRANSPORT_DS)


# Coverage rows with the derived columns of ``geographical_coverage``.
COVERAGE_ROWS_SQL = """
SELECT *,
       round_even(current_monthly_capacity / nullif(estimated_monthly_demand, 0), 3) AS capacity_ratio,
       CASE WHEN current_monthly_capacity / nullif(estimated_monthly_demand, 0) IS NULL THEN NULL
            WHEN current_monthly_capacity / nullif(estimated_monthly_demand, 0) < 1.1 THEN 'high'
            WHEN current_monthly_capacity / nullif(estimated_monthly_demand, 0) < 1.3 THEN 'medium'
            ELSE 'low' END AS expansion_priority,
       concat_ws('|', CASE WHEN coverage_density < 0.7 THEN 'low_department_density' END,
                      CASE WHEN service_quality_score < 8.0 THEN 'service_quality_issues' END) AS service_gaps
FROM coverage"""

COVERAGE_VIEW_SQL = f"""
SELECT region,
       cast(sum(cities_covered) AS BIGINT) AS total_cities_covered,
       cast(sum(total_departments) AS BIGINT) AS total_departments,
       avg(coverage_density) AS avg_coverage_density,
       avg(service_quality_score) AS avg_service_quality,
       cast(sum(estimated_monthly_demand) AS BIGINT) AS total_estimated_demand,
       sum(current_monthly_capacity) AS total_current_capacity,
       avg(capacity_ratio) AS avg_capacity_ratio,
       count(CASE WHEN expansion_priority = 'high' THEN 1 END) AS high_priority_areas
FROM ({COVERAGE_ROWS_SQL}) c
WHERE analysis_date = DATE '{P.SNAPSHOT_DS}'
GROUP BY region
ORDER BY avg_capacity_ratio ASC"""


def coverage_rows(spark, sf):
    from postlens.operators.postal import coverage_rows as rows
    return rows(load(spark, sf, "coverage"))


@register("geographical_coverage_view", section=S, oracle=COVERAGE_VIEW_SQL)
def q_geographical_coverage_view(spark, sf):
    return views.geographical_coverage_view(coverage_rows(spark, sf), P.SNAPSHOT_DS)


MODEL_VIEW_SQL = f"""
SELECT model_type,
       avg(abs(predicted_value - actual_value)) AS mae,
       sqrt(avg(pow(predicted_value - actual_value, 2))) AS rmse,
       avg(confidence_score) AS avg_confidence,
       count(*) AS total_predictions,
       count_if(abs(predicted_value - actual_value) / nullif(actual_value, 0) <= 0.1) / count(*)
         AS accuracy_within_10_percent
FROM predictions
WHERE prediction_date = DATE '{P.PREDICTION_DS}' AND actual_value IS NOT NULL
GROUP BY model_type
ORDER BY mae"""


@register("ml_model_performance_view", section=S, oracle=MODEL_VIEW_SQL)
def q_ml_model_performance_view(spark, sf):
    return views.ml_model_performance_view(load(spark, sf, "predictions", year=int(P.PREDICTION_DS[:4])), P.PREDICTION_DS)


@register("geographical_coverage", section=S, oracle=f"""
WITH g AS (
  SELECT region, count(DISTINCT city) AS cities_covered, cast(sum(total_departments) AS BIGINT) AS total_departments,
         avg(coverage_density) AS density, avg(service_quality_score) AS quality,
         sum(estimated_monthly_demand) AS estimated_monthly_demand, sum(current_monthly_capacity) AS current_monthly_capacity
  FROM coverage WHERE analysis_date = DATE '{P.SNAPSHOT_DS}' GROUP BY region),
r AS (SELECT *, round_even(density, 3) AS coverage_density, round_even(quality, 2) AS service_quality_score,
             current_monthly_capacity / nullif(cast(estimated_monthly_demand AS DOUBLE), 0) AS ratio FROM g)
SELECT region, cities_covered, total_departments, coverage_density, service_quality_score, estimated_monthly_demand,
       current_monthly_capacity, round_even(ratio, 3) AS capacity_ratio, DATE '{P.SNAPSHOT_DS}' AS analysis_date,
       CASE WHEN ratio IS NULL THEN NULL WHEN ratio < 1.1 THEN 'high' WHEN ratio < 1.3 THEN 'medium' ELSE 'low' END AS expansion_priority,
       concat_ws('|', CASE WHEN density < 0.7 THEN 'low_department_density' END,
                      CASE WHEN quality < 8.0 THEN 'service_quality_issues' END) AS service_gaps FROM r""")
def q_geographical_coverage(spark, sf):
    return flat_arrays(geographical_coverage(load(spark, sf, "coverage"), P.SNAPSHOT_DS))

