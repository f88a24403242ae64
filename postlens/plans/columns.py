"""Registered projections, filters and conditional columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from postlens.functions import lookups as L
from postlens.operators import postal as O
from postlens.operators.common import flat_arrays
from postlens.plans import params as P
from postlens.plans.catalog import register
from postlens.plans.fixture_sql import sql_case
from postlens.sources.standins import load
from postlens.sources.tables import dimension

S = "2.3"

PCLASS_SQL = sql_case("split_part(parcel_type, ' ', 1)", L.PARCEL_OF_PTYPE)
TCLASS_SQL = sql_case("transport_type", L.TRANSPORT_OF_FLAG)


def band_sql(expr: str, rules: list[tuple[str, float, str]], otherwise: str) -> str:
    whens = " ".join(f"WHEN {expr} {op} {bound} THEN '{label}'" for op, bound, label in rules)
    return f"CASE WHEN {expr} IS NULL THEN NULL {whens} ELSE '{otherwise}' END"


@register("filter_run_date", section=S,
          oracle=f"SELECT * FROM staff WHERE snapshot_date = DATE '{P.SNAPSHOT_DS}'")
def q_filter_run_date(spark, sf):
    return load(spark, sf, "staff").where(F.col("snapshot_date") == F.lit(P.SNAPSHOT_DS).cast("date"))


@register("filter_run_month", section=S,
          oracle=f"SELECT * FROM transport WHERE month = substr('{P.TRANSPORT_DS}', 1, 7)")
def q_filter_run_month(spark, sf):
    return load(spark, sf, "transport", month=P.TRANSPORT_DS[:7]).where(F.col("month") == F.lit(P.TRANSPORT_DS[:7]))


@register("filter_known_actuals", section=S, oracle=f"""
SELECT * FROM predictions WHERE prediction_date = DATE '{P.PREDICTION_DS}' AND actual_value IS NOT NULL""")
def q_filter_known_actuals(spark, sf):
    return load(spark, sf, "predictions", year=int(P.PREDICTION_DS[:4])).where(
        (F.col("prediction_date") == F.lit(P.PREDICTION_DS).cast("date")) & F.col("actual_value").isNotNull())


@register("delivery_hour", section=S, oracle="""
SELECT delivery_id, courier_id, receive_datetime, cast(hour(receive_datetime) AS INTEGER) AS delivery_hour FROM deliveries""")
def q_delivery_hour(spark, sf):
    return load(spark, sf, "deliveries").select(
        "delivery_id", "courier_id", "receive_datetime", O.delivery_hour("receive_datetime").alias("delivery_hour"))


@register("delivery_delay", section=S, oracle="""
SELECT feedback_id, delivery_time_actual - delivery_time_promised AS delivery_delay FROM feedback""")
def q_delivery_delay(spark, sf):
    return load(spark, sf, "feedback").select(
        "feedback_id", O.delivery_delay("delivery_time_actual", "delivery_time_promised").alias("delivery_delay"))


@register("on_time_flag", section=S, oracle="""
SELECT feedback_id, delivery_time_actual <= delivery_time_promised AS on_time FROM feedback""")
def q_on_time_flag(spark, sf):
    return load(spark, sf, "feedback").select(
        "feedback_id", O.on_time_flag("delivery_time_actual", "delivery_time_promised").alias("on_time"))


@register("satisfied_flag", section=S, oracle="""
SELECT feedback_id, satisfaction_score >= 7 AS is_satisfied FROM feedback""")
def q_satisfied_flag(spark, sf):
    return load(spark, sf, "feedback").select(
        "feedback_id", O.satisfied_flag("satisfaction_score").alias("is_satisfied"))


@register("sentiment_band", section=S, oracle=f"""
SELECT feedback_id, satisfaction_score,
       {band_sql('satisfaction_score', [('>=', 7, 'positive'), ('<=', 4, 'negative')], 'neutral')} AS sentiment_mvp,
       {band_sql('satisfaction_score', [('>=', 8, 'positive'), ('<=', 4, 'negative')], 'neutral')} AS sentiment_ml
FROM feedback""")
def q_sentiment_band(spark, sf):
    return load(spark, sf, "feedback").select(
        "feedback_id", "satisfaction_score",
        O.sentiment_band("satisfaction_score", 7, 4).alias("sentiment_mvp"),
        O.sentiment_band("satisfaction_score", 8, 4).alias("sentiment_ml"))


@register("issue_time", section=S, oracle="""
SELECT delivery_id, receive_datetime, delivery_duration_minutes,
       receive_datetime + to_minutes(cast(delivery_duration_minutes AS BIGINT)) AS computed_issue_datetime
FROM deliveries""")
def q_issue_time(spark, sf):
    return load(spark, sf, "deliveries").select(
        "delivery_id", "receive_datetime", "delivery_duration_minutes",
        O.issue_time("receive_datetime", "delivery_duration_minutes").alias("computed_issue_datetime"))


CITY_FACTOR_SQL = ("SELECT n_name AS city, [" + ", ".join(f"{x!r}E0" for x in L.CITY_FACTORS)
                   + f"][n_nationkey % {len(L.CITY_FACTORS)} + 1] AS city_factor FROM nation")


@register("city_adjusted_duration", section=S, oracle=f"""
SELECT d.*, f.city_factor,
       cast(trunc(d.delivery_duration_minutes * f.city_factor) AS INTEGER) AS adjusted_duration_minutes
FROM deliveries d LEFT JOIN ({CITY_FACTOR_SQL}) f ON d.city = f.city""")
def q_city_adjusted_duration(spark, sf):
    nation = dimension(spark, sf, "nation", "n_nationkey", "n_name")
    return O.city_adjusted_duration(load(spark, sf, "deliveries"), nation)


@register("parcel_weighted_volume", section=S, oracle=f"""
SELECT *, cast(trunc(monthly_volume * {sql_case('parcel_class', L.PARCEL_FACTOR, True)}) AS INTEGER)
            AS weighted_volume
FROM (SELECT *, {PCLASS_SQL} AS parcel_class FROM departments) d""")
def q_parcel_weighted_volume(spark, sf):
    return O.parcel_weighted_volume(load(spark, sf, "departments"))


SUITABILITY_VALUES = ", ".join(f"('{t}', '{p}', {f!r}E0)" for t, m in L.SUITABILITY.items() for p, f in m.items())


@register("fleet_capacity", section=S, oracle=f"""
SELECT t.*, s.suitability, cast(trunc(t.fleet_size * s.suitability * 25) AS INTEGER) AS monthly_capacity
FROM (SELECT *, {TCLASS_SQL} AS transport_class, {PCLASS_SQL} AS parcel_class FROM transport) t
LEFT JOIN (VALUES {SUITABILITY_VALUES}) s(transport_class, parcel_class, suitability)
  ON t.transport_class = s.transport_class AND t.parcel_class = s.parcel_class""")
def q_fleet_capacity(spark, sf):
    return O.fleet_capacity(load(spark, sf, "transport"), L.suitability_table(spark), trips=25)


@register("transport_metrics", section=S, oracle=f"""
SELECT transport_type, parcel_type, month, fleet_size, monthly_deliveries, transport_class,
       monthly_deliveries * avg_distance_per_delivery AS computed_distance_km,
       monthly_deliveries * avg_distance_per_delivery * {sql_case('transport_class', L.FUEL_PER_KM, True)}
         AS computed_fuel_liters,
       round_even(monthly_deliveries / nullif(cast(fleet_size * 30 AS double), 0) * 100.0E0, 2)
         AS utilization_rate_percent
FROM (SELECT *, {TCLASS_SQL} AS transport_class FROM transport) t""")
def q_transport_metrics(spark, sf):
    return O.transport_metrics(load(spark, sf, "transport"))


@register("staff_floor", section=S, oracle="""
SELECT department_id, "position", snapshot_date, staff_count,
       CASE WHEN staff_count IS NULL THEN NULL ELSE greatest(1, staff_count) END AS staff_count_floored
FROM staff""")
def q_staff_floor(spark, sf):
    return load(spark, sf, "staff").select("department_id", "position", "snapshot_date", "staff_count",
                                           O.staff_floor("staff_count").alias("staff_count_floored"))


@register("route_endpoints", section=S, oracle="""
SELECT route_id, delivery_type,
  CASE WHEN delivery_type IN ('Department to Department', 'Department to Courier') THEN sender_department END
    AS sender_department,
  CASE WHEN delivery_type IN ('Department to Department', 'Courier to Department') THEN receiver_department END
    AS receiver_department,
  CASE WHEN delivery_type IN ('Courier to Department', 'Courier to Courier') THEN sender_location END
    AS sender_location,
  CASE WHEN delivery_type IN ('Department to Courier', 'Courier to Courier') THEN receiver_location END
    AS receiver_location
FROM routes""")
def q_route_endpoints(spark, sf):
    return O.route_endpoints(load(spark, sf, "routes"))


COURIER_MONTHLY_SQL = """
m AS (SELECT courier_id, strftime(delivery_date, '%Y-%m') AS month,
             avg(delivery_duration_minutes) AS cur, count(*) AS n, avg(cast(success AS double)) AS sr
      FROM deliveries WHERE courier_id IS NOT NULL GROUP BY 1, 2),
l AS (SELECT *, lag(cur) OVER (PARTITION BY courier_id ORDER BY month) AS prev,
             (cur - lag(cur) OVER (PARTITION BY courier_id ORDER BY month))
               / nullif(lag(cur) OVER (PARTITION BY courier_id ORDER BY month), 0) * 100.0E0 AS chg FROM m)"""
TREND_SQL = band_sql("chg", [("<", -10.0, "improving"), (">", 10.0, "declining")], "stable")


@register("performance_trend", section=S, oracle=f"""
WITH {COURIER_MONTHLY_SQL}
SELECT courier_id, month, round_even(chg, 2) AS performance_change_percent, {TREND_SQL} AS performance_trend
FROM l""")
def q_performance_trend(spark, sf):
    return O.courier_current_vs_previous(load(spark, sf, "deliveries")).select(
        "courier_id", "month", "performance_change_percent", "performance_trend")


@register("courier_efficiency", section=S, oracle=f"""
WITH {COURIER_MONTHLY_SQL}
SELECT courier_id, month, round_even(1.0E0 / nullif(cur, 0) * sr * 100.0E0, 2) AS efficiency_score FROM l""")
def q_courier_efficiency(spark, sf):
    return O.courier_current_vs_previous(load(spark, sf, "deliveries")).select(
        "courier_id", "month", "efficiency_score")


DEPT_EFF_SQL = f"""
SELECT department_id, department_type,
       round_even(avg_proc, 2) AS avg_processing_time_minutes,
       round_even(throughput, 2) AS daily_throughput,
       round_even(err, 4) AS error_rate,
       round_even(throughput / nullif(avg_proc, 0) * (1.0E0 - err) * 100.0E0, 2) AS efficiency_score,
       concat_ws('|', CASE WHEN avg_proc > 60 THEN 'slow_processing' END,
                      CASE WHEN err > 0.05 THEN 'high_error_rate' END,
                      CASE WHEN throughput < 300 THEN 'low_throughput' END) AS bottlenecks,
       round_even(util, 3) AS capacity_utilization,
       DATE '{P.RUN_DS}' AS analysis_date
FROM (SELECT department_id, department_type,
             avg(avg_processing_time_minutes) AS avg_proc, avg(daily_processed) AS throughput,
             avg(CASE WHEN transport_type = 'R' THEN 1.0E0 ELSE 0.0E0 END) AS err,
             avg(queue_length) / nullif(cast(max(queue_length) AS double), 0) AS util
      FROM departments GROUP BY department_id, department_type) g"""


def _dept_eff(spark, sf):
    return O.department_efficiency(load(spark, sf, "departments"), P.RUN_DS)


@register("department_efficiency_score", section=S,
          oracle=f"SELECT department_id, efficiency_score FROM ({DEPT_EFF_SQL}) e")
def q_department_efficiency_score(spark, sf):
    return _dept_eff(spark, sf).select("department_id", "efficiency_score")


@register("department_bottlenecks", section=S,
          oracle=f"SELECT department_id, bottlenecks FROM ({DEPT_EFF_SQL}) e")
def q_department_bottlenecks(spark, sf):
    return flat_arrays(_dept_eff(spark, sf).select("department_id", "bottlenecks"))


@register("department_efficiency", section="2.5", oracle=DEPT_EFF_SQL)
def q_department_efficiency(spark, sf):
    return flat_arrays(_dept_eff(spark, sf))


@register("coverage_gaps", section=S, oracle="""
SELECT region, city, concat_ws('|', CASE WHEN coverage_density < 0.7 THEN 'low_department_density' END,
                                  CASE WHEN service_quality_score < 8.0 THEN 'service_quality_issues' END)
         AS service_gaps
FROM coverage""")
def q_coverage_gaps(spark, sf):
    c = load(spark, sf, "coverage")
    return flat_arrays(c.select("region", "city",
                                O.coverage_gaps("coverage_density", "service_quality_score").alias("service_gaps")))


@register("expansion_priority", section=S, oracle=f"""
SELECT region, city, round_even(r, 3) AS capacity_ratio,
       {band_sql('r', [('<', 1.1, 'high'), ('<', 1.3, 'medium')], 'low')} AS expansion_priority
FROM (SELECT *, current_monthly_capacity / nullif(cast(estimated_monthly_demand AS double), 0) AS r
      FROM coverage) c""")
def q_expansion_priority(spark, sf):
    return O.coverage_rows(load(spark, sf, "coverage")).select(
        "region", "city", "capacity_ratio", "expansion_priority")
