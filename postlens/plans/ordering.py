"""Registered sorts and set operations.

Sorted results are range-partitioned sorts (no single-task sort); the
order is only guaranteed where a result is read, so it is applied at the
consumer, as here.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from postlens.operators import views
from postlens.operators import windows as W
from postlens.operators.common import union_all
from postlens.plans import params as P
from postlens.plans.aggregates import COURIER_VIEW_SQL, FLEET_VIEW_SQL, STAFF_VIEW_SQL
from postlens.plans.catalog import register
from postlens.plans.windows import LOGISTICS_SQL, METRIC_ANOM_SQL
from postlens.sources.standins import load


@register("order_by_keys", section="2.7", oracle=STAFF_VIEW_SQL)
def q_order_by_keys(spark, sf):
    return views.department_staff_view(load(spark, sf, "staff"), P.SNAPSHOT_DS).orderBy("department_id", "position")


@register("order_by_measure", section="2.7", oracle=FLEET_VIEW_SQL)
def q_order_by_measure(spark, sf):
    return views.transport_fleet_view(load(spark, sf, "transport", month=P.TRANSPORT_DS[:7]), P.TRANSPORT_DS).orderBy(
        F.desc("total_monthly_deliveries"))


@register("grouped_key_order", section="2.7", oracle=f"SELECT * FROM ({COURIER_VIEW_SQL}) v ORDER BY city, courier_id")
def q_grouped_key_order(spark, sf):
    return views.courier_performance_view(load(spark, sf, "deliveries"), P.RUN_DS).orderBy("city", "courier_id")


@register("union_all", section="2.8", oracle=f"""
SELECT 'logistics' AS source, anomaly_type AS kind, affected_entity AS entity, lower(severity) AS severity
FROM ({LOGISTICS_SQL}) a
UNION ALL
SELECT 'metrics', 'metric_anomaly', metric, lower(severity) FROM ({METRIC_ANOM_SQL}) b""")
def q_union_all(spark, sf):
    logistics = W.logistics_anomalies(load(spark, sf, "departments"), load(spark, sf, "deliveries"),
                                      load(spark, sf, "routes"), P.RUN_DS)
    metrics = W.metric_anomalies(load(spark, sf, "daily_metrics"))
    return union_all(
        logistics.select(F.lit("logistics").alias("source"), F.col("anomaly_type").alias("kind"),
                         F.col("affected_entity").alias("entity"), F.lower("severity").alias("severity")),
        metrics.select(F.lit("metrics").alias("source"), F.lit("metric_anomaly").alias("kind"),
                       F.col("metric").alias("entity"), F.lower("severity").alias("severity")))


@register("append_rows", section="2.8", oracle="""
SELECT transport_type AS kind, parcel_type, month, monthly_deliveries AS volume FROM transport
UNION ALL SELECT department_type, parcel_type, month, monthly_volume FROM departments""")
def q_append_rows(spark, sf):
    t, d = load(spark, sf, "transport"), load(spark, sf, "departments")
    return union_all(t.select(F.col("transport_type").alias("kind"), "parcel_type", "month", F.col("monthly_deliveries").alias("volume")),
                     d.select(F.col("department_type").alias("kind"), "parcel_type", "month", F.col("monthly_volume").alias("volume")))
