"""Registered window, fact and anomaly queries."""

from __future__ import annotations

from postlens.operators import postal as O
from postlens.operators import windows as W
from postlens.plans import params as P
from postlens.plans.catalog import register
from postlens.plans.columns import COURIER_MONTHLY_SQL, DEPT_EFF_SQL, TREND_SQL
from postlens.sources.standins import load

S = "2.6"

PREV_SQL = """
p AS (SELECT delivery_id, courier_id, parcel_type, city, issue_datetime, delivery_duration_minutes,
             lag(delivery_duration_minutes) OVER (PARTITION BY courier_id
               ORDER BY issue_datetime, delivery_id, parcel_id, delivery_duration_minutes)
               AS previous_delivery_duration
      FROM deliveries WHERE courier_id IS NOT NULL),
pc AS (SELECT *, (delivery_duration_minutes - previous_delivery_duration)
                 / nullif(cast(previous_delivery_duration AS double), 0) * 100.0E0 AS chg FROM p)"""


@register("previous_delivery", section=S, oracle=f"""
WITH {PREV_SQL}
SELECT delivery_id, courier_id, parcel_type, city, issue_datetime, delivery_duration_minutes,
       previous_delivery_duration, round_even(chg, 1) AS performance_change_percent,
       {TREND_SQL} AS performance_trend
FROM pc""")
def q_previous_delivery(spark, sf):
    return W.previous_delivery(load(spark, sf, "deliveries"))


@register("courier_facts", section="2.5", oracle=f"""
WITH {PREV_SQL}
SELECT cast(issue_datetime AS date) AS delivery_date, courier_id, parcel_type, city, delivery_duration_minutes,
       previous_delivery_duration, round_even(chg, 1) AS performance_change_percent,
       {TREND_SQL} AS performance_trend
FROM pc""")
def q_courier_facts(spark, sf):
    return W.courier_facts(load(spark, sf, "deliveries"))


DEPT_FACTS_SQL = f"""
SELECT DATE '{P.TRANSPORT_DS}' AS snapshot_date, department_id, department_type, parcel_type, transport_type,
       monthly_volume, round_even(avg_proc, 1) AS avg_processing_time_minutes,
       round_even(monthly_volume / nullif(cast(max(monthly_volume) OVER (PARTITION BY department_id) AS double), 0), 2)
         AS capacity_utilization
FROM (SELECT department_id, department_type, parcel_type, transport_type,
             cast(sum(monthly_volume) AS BIGINT) AS monthly_volume, avg(avg_processing_time_minutes) AS avg_proc
      FROM departments WHERE month = substr('{P.TRANSPORT_DS}', 1, 7)
      GROUP BY department_id, department_type, parcel_type, transport_type) g"""


@register("department_facts", section="2.5", oracle=DEPT_FACTS_SQL)
def q_department_facts(spark, sf):
    return W.department_facts(load(spark, sf, "departments", month=P.TRANSPORT_DS[:7]), P.TRANSPORT_DS)


@register("transport_facts", section="2.5", oracle=f"""
SELECT DATE '{P.TRANSPORT_DS}' AS snapshot_date, transport_type, parcel_type, fleet_size, monthly_deliveries,
       avg_distance_per_delivery,
       monthly_deliveries * avg_distance_per_delivery AS total_distance_km,
       monthly_deliveries * avg_distance_per_delivery
         * CASE transport_type WHEN 'A' THEN 0.12E0 WHEN 'N' THEN 0.25E0 WHEN 'R' THEN 0.05E0 END
         AS fuel_consumption_liters,
       round_even(monthly_deliveries / nullif(cast(fleet_size * 30 AS double), 0) * 100.0E0, 2)
         AS utilization_rate_percent
FROM transport WHERE month = substr('{P.TRANSPORT_DS}', 1, 7)""")
def q_transport_facts(spark, sf):
    return W.transport_facts(load(spark, sf, "transport", month=P.TRANSPORT_DS[:7]), P.TRANSPORT_DS)


@register("prediction_facts", section="2.5", oracle=f"""
SELECT * FROM predictions WHERE prediction_date = DATE '{P.PREDICTION_DS}'""")
def q_prediction_facts(spark, sf):
    return W.prediction_facts(load(spark, sf, "predictions", year=int(P.PREDICTION_DS[:4])), P.PREDICTION_DS)


CAL_SQL = """
cal AS (SELECT metric, cast(unnest(generate_series(min("date"), max("date"), INTERVAL 1 DAY)) AS DATE) AS "date"
        FROM daily_metrics GROUP BY metric),
s AS (SELECT c.metric, c."date", coalesce(d.value, 0.0E0) AS value
      FROM cal c LEFT JOIN daily_metrics d ON c.metric = d.metric AND c."date" = d."date")"""


@register("time_series_features", section=S, oracle=f"""
WITH {CAL_SQL},
f AS (SELECT "date", metric, value,
             lag(value, 7) OVER (PARTITION BY metric ORDER BY "date") AS value_7d_ago,
             lag(value, 30) OVER (PARTITION BY metric ORDER BY "date") AS value_30d_ago,
             avg(value) OVER (PARTITION BY metric, dayofweek("date"))
               / nullif(avg(value) OVER (PARTITION BY metric), 0) AS seasonality_factor
      FROM s)
SELECT "date", metric, value, value_7d_ago, value_30d_ago,
       (value - value_7d_ago) / nullif(value_7d_ago, 0) AS growth_rate_7d,
       (value - value_30d_ago) / nullif(value_30d_ago, 0) AS growth_rate_30d,
       seasonality_factor
FROM f""")
def q_time_series_features(spark, sf):
    return W.time_series_features(load(spark, sf, "daily_metrics"))


@register("seasonality_factor", section=S, oracle=f"""
WITH {CAL_SQL},
o AS (SELECT metric, avg(value) AS overall_mean FROM s GROUP BY metric),
d AS (SELECT metric, dayname("date") AS weekday, avg(value) AS weekday_mean FROM s GROUP BY metric, dayname("date"))
SELECT d.metric, d.weekday, d.weekday_mean, o.overall_mean, d.weekday_mean / nullif(o.overall_mean, 0)
         AS seasonality_factor
FROM d JOIN o ON d.metric = o.metric""")
def q_seasonality_factor(spark, sf):
    return W.seasonality_factor(load(spark, sf, "daily_metrics"))


METRIC_ANOM_SQL = f"""
WITH {CAL_SQL},
w AS (SELECT *, avg(value) OVER t AS expected, stddev_samp(value) OVER t AS sd, count(value) OVER t AS n
      FROM s WINDOW t AS (PARTITION BY metric ORDER BY "date" ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING)),
z AS (SELECT *, (value - expected) / (CASE WHEN sd > 0 THEN sd END) AS z_score FROM w WHERE n = 14)
SELECT "date", metric, expected, value AS actual, z_score,
       CASE WHEN abs(z_score) > 3.0 THEN 'HIGH' WHEN abs(z_score) > 2.0 THEN 'MEDIUM' END AS severity
FROM z WHERE abs(z_score) > 2.0"""


@register("metric_anomalies", section=S, oracle=METRIC_ANOM_SQL)
def q_metric_anomalies(spark, sf):
    return W.metric_anomalies(load(spark, sf, "daily_metrics"))


@register("anomaly_priority", section="2.3", oracle=f"""
SELECT *, CASE metric WHEN 'revenue' THEN 'high' WHEN 'traffic' THEN 'medium' WHEN 'conversion' THEN 'high' END
            AS priority
FROM ({METRIC_ANOM_SQL}) a""")
def q_anomaly_priority(spark, sf):
    return W.with_anomaly_priority(W.metric_anomalies(load(spark, sf, "daily_metrics")))


LOGISTICS_SQL = f"""
WITH dm AS (SELECT department_id AS affected_entity, month AS period,
                   avg(avg_processing_time_minutes) AS cur, cast(sum(monthly_volume) AS BIGINT) AS vol
            FROM departments WHERE department_id IS NOT NULL GROUP BY 1, 2),
dl AS (SELECT *, (cur - lag(cur) OVER (PARTITION BY affected_entity ORDER BY period))
                 / nullif(lag(cur) OVER (PARTITION BY affected_entity ORDER BY period), 0) * 100.0E0 AS chg FROM dm),
cm AS (SELECT courier_id AS affected_entity, strftime(delivery_date, '%Y-%m') AS period, count(*) AS cur
       FROM deliveries WHERE courier_id IS NOT NULL GROUP BY 1, 2),
cl AS (SELECT *, (cur - lag(cur) OVER (PARTITION BY affected_entity ORDER BY period))
                 / nullif(cast(lag(cur) OVER (PARTITION BY affected_entity ORDER BY period) AS double), 0) * 100.0E0
                 AS chg FROM cm),
rm AS (SELECT coalesce(sender_location, receiver_location) AS affected_entity,
              strftime(validation_date, '%Y-%m') AS period, avg(estimated_distance_km) AS cur, count(*) AS n
       FROM routes WHERE coalesce(sender_location, receiver_location) IS NOT NULL GROUP BY 1, 2),
rl AS (SELECT *, lag(cur) OVER (PARTITION BY affected_entity ORDER BY period) AS prev,
              (cur - lag(cur) OVER (PARTITION BY affected_entity ORDER BY period))
                / nullif(lag(cur) OVER (PARTITION BY affected_entity ORDER BY period), 0) * 100.0E0 AS chg FROM rm)
SELECT 'delivery_time_spike' AS anomaly_type, affected_entity, period,
       CASE WHEN chg >= 40 THEN 'high' ELSE 'medium' END AS severity,
       printf('Average delivery time increased by %d%%', cast(round_even(abs(chg), 0) AS INTEGER)) AS description,
       printf('%d delayed parcels', vol) AS estimated_impact, DATE '{P.RUN_DS}' AS detected_at
FROM dl WHERE chg >= 25
UNION ALL
SELECT 'volume_anomaly', affected_entity, period, CASE WHEN chg <= -50 THEN 'medium' ELSE 'low' END,
       printf('Delivery volume dropped by %d%%', cast(round_even(abs(chg), 0) AS INTEGER)),
       'Potential courier availability issue', DATE '{P.RUN_DS}'
FROM cl WHERE chg <= -30
UNION ALL
SELECT 'route_inefficiency', affected_entity, period, 'medium',
       printf('Average route distance increased by %d%%', cast(round_even(abs(chg), 0) AS INTEGER)),
       printf('Additional %d km', cast(round_even((cur - prev) * n, 0) AS BIGINT)), DATE '{P.RUN_DS}'
FROM rl WHERE chg >= 15"""


def _logistics(spark, sf):
    return W.logistics_anomalies(load(spark, sf, "departments"), load(spark, sf, "deliveries"),
                                 load(spark, sf, "routes"), P.RUN_DS)


@register("logistics_anomalies", section=S, oracle=LOGISTICS_SQL)
def q_logistics_anomalies(spark, sf):
    return _logistics(spark, sf)


@register("alert_counts", section="2.5", oracle=f"""
WITH a AS (SELECT lower(severity) AS severity FROM ({LOGISTICS_SQL}) x
           UNION ALL SELECT lower(severity) FROM ({METRIC_ANOM_SQL}) y)
SELECT cast(count_if(severity = 'high') AS BIGINT) AS high_priority,
       cast(count_if(severity = 'medium') AS BIGINT) AS medium_priority,
       cast(count_if(severity = 'low') AS BIGINT) AS low_priority FROM a""")
def q_alert_counts(spark, sf):
    return W.alert_counts(_logistics(spark, sf), W.metric_anomalies(load(spark, sf, "daily_metrics")))


EFF_SQL = f"""
WITH {COURIER_MONTHLY_SQL},
e AS (SELECT courier_id, month, round_even(1.0E0 / nullif(cur, 0) * sr * 100.0E0, 2) AS efficiency_score,
             n AS deliveries_completed, round_even(chg, 2) AS performance_change_percent,
             {TREND_SQL} AS performance_trend FROM l)"""


@register("top_performers", section=S, oracle=f"""
{EFF_SQL}
SELECT * FROM (
  SELECT 'courier' AS kind, courier_id AS id, month, efficiency_score, deliveries_completed FROM e
  WHERE month = (SELECT max(month) FROM e) AND efficiency_score IS NOT NULL
  ORDER BY efficiency_score DESC, courier_id LIMIT 10) c
UNION ALL SELECT * FROM (
  SELECT 'department', department_id, NULL, efficiency_score, NULL FROM ({DEPT_EFF_SQL}) x
  WHERE efficiency_score IS NOT NULL ORDER BY efficiency_score DESC, department_id LIMIT 1) d""")
def q_top_performers(spark, sf):
    d = load(spark, sf, "deliveries")
    return W.top_performers(O.courier_current_vs_previous(d), O.department_efficiency(load(spark, sf, "departments"), P.RUN_DS),
                            W.latest_month(d))


@register("courier_insights", section="2.5", oracle=f"""
{EFF_SQL}
SELECT month, cast(count_if(performance_trend = 'improving') AS BIGINT) AS improving_couriers,
       cast(count_if(performance_trend = 'declining') AS BIGINT) AS declining_couriers,
       cast(count_if(performance_trend = 'stable') AS BIGINT) AS stable_couriers,
       round_even(avg(performance_change_percent), 2) AS avg_performance_change
FROM e WHERE month = (SELECT max(month) FROM e) GROUP BY month""")
def q_courier_insights(spark, sf):
    d = load(spark, sf, "deliveries")
    return W.courier_insights(O.courier_current_vs_previous(d), W.latest_month(d))


@register("operations_kpis", section="2.5", oracle=f"""
SELECT d.total_deliveries, d.avg_delivery_time, d.success_rate, p.department_utilization,
       t.transport_utilization, DATE '{P.RUN_DS}' AS "date"
FROM (SELECT count(*) AS total_deliveries, round_even(avg(delivery_duration_minutes), 1) AS avg_delivery_time,
             round_even(avg(cast(success AS double)) * 100.0E0, 1) AS success_rate FROM deliveries) d,
     (SELECT round_even(avg(queue_length) / nullif(cast(max(queue_length) AS double), 0) * 100.0E0, 1)
               AS department_utilization FROM departments) p,
     (SELECT round_even(avg(utilization_rate) * 100.0E0, 1) AS transport_utilization FROM transport) t""")
def q_operations_kpis(spark, sf):
    return W.operations_kpis(load(spark, sf, "deliveries"), load(spark, sf, "departments"),
                             load(spark, sf, "transport"), P.RUN_DS)



