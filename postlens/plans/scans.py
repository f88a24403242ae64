"""Registered scans. Each query first materialises a
stand-in in the format the operator reads (under a fresh folder of the
shared checkpoint directory), then reads it back with the operator."""

from __future__ import annotations

from pyspark.sql import functions as F

from postlens.functions import lookups as L
from postlens.operators import quality as Q
from postlens.operators import sinks as W
from postlens.plans import params as P
from postlens.plans.aggregates import STAFF_VIEW_SQL
from postlens.plans.catalog import register
from postlens.plans.quality import QUALITY_REPORT_SQL
from postlens.session import scratch_dir
from postlens.sources import daily
from postlens.sources import files as R
from postlens.sources.standins import load
from postlens.sources.tables import table

S = "2.1"
# A shipping day with rows in every stand-in size.
DAILY_DS = "1996-06-17"


@register("scan_csv", section=S, oracle="SELECT * FROM deliveries")
def q_scan_csv(spark, sf):
    d = load(spark, sf, "deliveries")
    path = scratch_dir(spark, "couriers_csv")
    W.write_csv(d, path)
    return R.scan_csv(spark, path, d.schema)


@register("scan_json_document", section=S, oracle=QUALITY_REPORT_SQL)
def q_scan_json_document(spark, sf):
    rep = Q.quality_report(load(spark, sf, "deliveries"), load(spark, sf, "departments"), P.RUN_DS)
    path = scratch_dir(spark, "quality_report_json")
    W.write_json_report(rep, path)
    return R.scan_json_document(spark, path, rep.schema)


@register("scan_table", section=S, oracle="SELECT * FROM staff")
def q_scan_table(spark, sf):
    path = scratch_dir(spark, "staging_staff")
    W.write_truncate(load(spark, sf, "staff"), path)
    R.register_table(spark, "staging_staff_distribution", path)
    return R.scan_table(spark, "staging_staff_distribution")


@register("scan_all_columns", section=S, oracle="SELECT * FROM lineitem")
def q_scan_all_columns(spark, sf):
    table(spark, sf, "lineitem").createOrReplaceTempView("lineitem_all")
    return R.sql_query(spark, "SELECT * FROM lineitem_all")


@register("sql_query", section=S, oracle=STAFF_VIEW_SQL)
def q_sql_query(spark, sf):
    load(spark, sf, "staff").createOrReplaceTempView("staff_distribution")
    return R.sql_query(spark, """
        SELECT department_id, department_type, region, position,
               SUM(staff_count) AS total_staff, AVG(avg_salary) AS avg_salary,
               AVG(experience_months) AS avg_experience_months, COUNT(*) AS position_variations
        FROM staff_distribution WHERE snapshot_date = CAST(:ds AS DATE)
        GROUP BY department_id, department_type, region, position
        ORDER BY department_id, position""", ds=P.SNAPSHOT_DS)


SUIT_VALUES = ", ".join(f"('{t}', '{p}', {f!r}D)" for t, m in L.SUITABILITY.items() for p, f in m.items())
SUIT_VALUES_DUCK = ", ".join(f"('{t}', '{p}', {f!r}E0)" for t, m in L.SUITABILITY.items() for p, f in m.items())
TCLASS_SQL = "CASE transport_type WHEN 'A' THEN 'van' WHEN 'N' THEN 'truck' WHEN 'R' THEN 'motorcycle' END"


@register("inline_rows", section=S, oracle=f"""
SELECT s.transport_class, s.parcel_class, s.suitability, f.fleet
FROM (VALUES {SUIT_VALUES_DUCK}) s(transport_class, parcel_class, suitability)
JOIN (SELECT {TCLASS_SQL} AS transport_class, cast(sum(fleet_size) AS BIGINT) AS fleet FROM transport
      GROUP BY 1) f ON s.transport_class = f.transport_class""")
def q_inline_rows(spark, sf):
    """Literal rows (a ``VALUES`` relation of the 20 suitability factors)
    beside the fleet each transport class has in the data."""
    lits = spark.sql(f"SELECT * FROM VALUES {SUIT_VALUES} AS s(transport_class, parcel_class, suitability)")
    fleet = (load(spark, sf, "transport").groupBy(L.transport_class(F.col("transport_type")).alias("transport_class"))
             .agg(F.sum("fleet_size").alias("fleet")))
    return F.broadcast(lits).join(fleet, "transport_class")


DAILY_SQL = f"SELECT * FROM deliveries WHERE delivery_date = DATE '{DAILY_DS}'"


@register("scan_daily_partition", section=S, oracle=DAILY_SQL)
def q_scan_daily_partition(spark, sf):
    """A day delivered as JSON, CSV and Parquet files, a third of its rows in each."""
    d = load(spark, sf, "deliveries").where(F.col("delivery_date") == F.lit(DAILY_DS).cast("date"))
    base = scratch_dir(spark, "couriers_daily")
    third = F.pmod(F.xxhash64("delivery_id"), F.lit(3))
    d.where(third == 0).write.option("ignoreNullFields", False).option("timestampNTZFormat", R.TIMESTAMP_FORMAT).json(f"{base}/{DAILY_DS}/json")
    W.write_csv(d.where(third == 1), f"{base}/{DAILY_DS}/csv")
    d.where(third == 2).write.parquet(f"{base}/{DAILY_DS}/parquet")
    return daily.good_rows(daily.read_day(spark, base, d.schema, DAILY_DS))


@register("scan_month_partition", section=S, oracle=DAILY_SQL)
def q_scan_month_partition(spark, sf):
    """The same day from a layout partitioned by month, by directory pruning."""
    d = load(spark, sf, "deliveries").withColumn("delivery_month", F.date_format("delivery_date", "yyyy-MM"))
    base = scratch_dir(spark, "couriers_by_month")
    W.write_append(d, base, "delivery_month")
    return R.scan_daily_partition(spark, base, d.schema, DAILY_DS, "delivery_date", "delivery_month") \
        .drop("delivery_month")
