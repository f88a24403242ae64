"""Registered joins and the route summary built on them."""

from __future__ import annotations

from pyspark.sql import functions as F

from postlens.operators import models as ML
from postlens.operators import postal as O
from postlens.operators import reports as REP
from postlens.operators import routes as R
from postlens.operators.common import flat_arrays, side_by_side
from postlens.plans import params as P
from postlens.plans.aggregates import BUSINESS_METRICS_SQL
from postlens.plans.catalog import register
from postlens.plans.columns import COURIER_MONTHLY_SQL, TREND_SQL
from postlens.plans.model_sql import SATISFACTION_SCORES_SQL
from postlens.plans.quality import QUALITY_REPORT_SQL
from postlens.sources.standins import load

S = "2.4"

VALIDATE_SQL = """
SELECT r.route_id, r.delivery_type, r.validation_date, r.processing_time_ms,
  concat_ws('|',
    CASE WHEN r.delivery_type = 'Department to Department'
          AND NOT (s.department_id IS NOT NULL AND d.department_id IS NOT NULL
                   AND coalesce(r.sender_department <> r.receiver_department, false))
         THEN 'Department mismatch in route' END,
    CASE WHEN r.delivery_type = 'Department to Courier' AND NOT coalesce(s.city = r.receiver_location, false)
         THEN 'Sender department and receiver city mismatch' END,
    CASE WHEN r.delivery_type = 'Courier to Department' AND NOT coalesce(r.sender_location = d.city, false)
         THEN 'Sender city and receiver department mismatch' END,
    CASE WHEN r.delivery_type = 'Courier to Courier'
          AND NOT (r.sender_location IN (SELECT city FROM department_dim WHERE city IS NOT NULL)
                   AND r.receiver_location IN (SELECT city FROM department_dim WHERE city IS NOT NULL))
         THEN 'Courier city mismatch' END) AS error_messages
FROM routes r
LEFT JOIN department_dim s ON r.sender_department = s.department_id
LEFT JOIN department_dim d ON r.receiver_department = d.department_id"""


def _validated(spark, sf):
    return R.validate_routes(load(spark, sf, "routes"), load(spark, sf, "department_dim"))


@register("validate_routes", section=S, oracle=f"""
SELECT *, error_messages = '' AS is_valid FROM ({VALIDATE_SQL}) v""")
def q_validate_routes(spark, sf):
    return flat_arrays(_validated(spark, sf))


@register("route_validation_summary", section="2.5", oracle=f"""
SELECT count(*) AS total_routes, cast(count_if(error_messages = '') AS BIGINT) AS valid_routes,
       cast(count_if(error_messages <> '') AS BIGINT) AS invalid_routes,
       round_even(count_if(error_messages = '') / nullif(count(*), 0) * 100.0E0, 2) AS success_rate,
       round_even(avg(processing_time_ms), 2) AS avg_processing_time_ms
FROM ({VALIDATE_SQL}) v""")
def q_route_validation_summary(spark, sf):
    return R.route_validation_summary(_validated(spark, sf))


@register("feedback_with_delivery", section=S, oracle="""
SELECT f.feedback_id, f.delivery_id, f.customer_id, f.city, f.satisfaction_score, f.on_time_delivery,
       d.courier_id, d.parcel_type, d.city AS delivery_city, d.delivery_duration_minutes, d.success
FROM feedback f JOIN deliveries d ON f.delivery_id = d.delivery_id""")
def q_feedback_with_delivery(spark, sf):
    return R.feedback_with_delivery(load(spark, sf, "feedback"), load(spark, sf, "deliveries"))


@register("courier_current_vs_previous", section=S, oracle=f"""
WITH {COURIER_MONTHLY_SQL}
SELECT courier_id, month, cur AS current_avg_delivery_time, prev AS previous_avg_delivery_time,
       round_even(chg, 2) AS performance_change_percent, {TREND_SQL} AS performance_trend,
       n AS deliveries_completed, round_even(sr, 3) AS success_rate,
       round_even(1.0E0 / nullif(cur, 0) * sr * 100.0E0, 2) AS efficiency_score
FROM l""")
def q_courier_current_vs_previous(spark, sf):
    return O.courier_current_vs_previous(load(spark, sf, "deliveries"))


VIEW_COUNTS_SQL = """
SELECT (SELECT count(*) FROM (SELECT DISTINCT city, courier_id FROM deliveries
                              WHERE city IS NOT NULL AND courier_id IS NOT NULL) a)
     + (SELECT count(*) FROM (SELECT DISTINCT city, department_type FROM departments
                              WHERE city IS NOT NULL AND department_type IS NOT NULL) b)
     + (SELECT count(*) FROM (SELECT DISTINCT transport_type FROM transport
                              WHERE transport_type IS NOT NULL) c)
     + (SELECT count(*) FROM (SELECT DISTINCT city FROM feedback WHERE city IS NOT NULL) d)
       AS total_view_records"""


ASSEMBLE_SQL = f"""
SELECT q.execution_date, q.overall_quality_score, q.status AS quality_status,
       b.total_deliveries, b.total_revenue_estimated, b.operational_cost_estimated,
       b.customer_satisfaction_avg, b.on_time_delivery_rate, b.active_couriers, b.active_departments,
       b.cities_covered,
       round_even((b.total_revenue_estimated - b.operational_cost_estimated)
                  / nullif(b.total_revenue_estimated, 0) * 100.0E0, 1) AS profit_margin_percent,
       v.total_view_records
FROM ({QUALITY_REPORT_SQL}) q, ({BUSINESS_METRICS_SQL}) b, ({VIEW_COUNTS_SQL}) v"""


REPORT_SQL = f"""
SELECT a.*, s.accuracy AS customer_satisfaction_accuracy, s."precision" AS customer_satisfaction_precision
FROM ({ASSEMBLE_SQL}) a, ({SATISFACTION_SCORES_SQL}) s"""


def report_with_satisfaction(spark, sf):
    """The daily report and the held-out scores of the satisfaction model."""
    scores = ML.classification_scores(ML.fit_satisfaction(load(spark, sf, "feedback"))[1], "label")
    return side_by_side(REP.daily_report(spark, sf, P.RUN_DS), scores.select(
        F.col("accuracy").alias("customer_satisfaction_accuracy"), F.col("precision").alias("customer_satisfaction_precision")))


@register("assemble_report", section=S, oracle=REPORT_SQL)
def q_assemble_report(spark, sf):
    return report_with_satisfaction(spark, sf)

