"""Registered sinks: each query writes with the operator to
a fresh folder of the shared checkpoint directory and returns what a
reader of the target sees."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlens.operators import quality as Q
from postlens.operators import reports as REP
from postlens.operators import ledger
from postlens.operators import sinks as W
from postlens.operators.model_store import ModelStore, digest
from postlens.operators.scoring import scorers
from postlens.operators import views
from postlens.operators import windows as WIN
from postlens.plans import params as P
from postlens.plans.aggregates import COURIER_VIEW_SQL, STAFF_VIEW_SQL
from postlens.plans.joins import REPORT_SQL, report_with_satisfaction
from postlens.plans.windows import DEPT_FACTS_SQL
from postlens.plans.catalog import register
from postlens.plans.quality import QUALITY_REPORT_SQL
from postlens.session import scratch_dir
from postlens.sources import files as R
from postlens.sources.standins import load

S = "2.2"

@register("write_csv", section=S, oracle=COURIER_VIEW_SQL)
def q_write_csv(spark, sf):
    v = views.courier_performance_view(load(spark, sf, "deliveries"), P.RUN_DS)
    path = scratch_dir(spark, "courier_performance_view_csv")
    W.write_csv(v, path)
    return R.scan_csv(spark, path, v.schema)


@register("write_json_report", section=S, oracle=QUALITY_REPORT_SQL)
def q_write_json_report(spark, sf):
    rep = Q.quality_report(load(spark, sf, "deliveries"), load(spark, sf, "departments"), P.RUN_DS)
    nested = rep.select("execution_date", F.struct(
        "courier_completeness", "department_completeness", "business_rules_score", "anomaly_score",
        "overall_quality_score").alias("scores"), "status")
    path = scratch_dir(spark, "quality_report_json")
    W.write_json_report(nested, path)
    back = R.scan_json_document(spark, path, nested.schema)
    return back.select("execution_date", "scores.*", "status")


REPORT_TEXT_SQL = """
WITH r AS ({report}),
lines AS (
  SELECT 0 AS line_no, printf('[quality] Overall quality score: %.1f%%', round_even(overall_quality_score, 1)) AS value FROM r
  UNION ALL SELECT 1, '[quality] Status: ' || quality_status FROM r
  UNION ALL SELECT 2, '[business] Total deliveries: ' || format('{{:,}}', total_deliveries) FROM r
  UNION ALL SELECT 3, '[business] Revenue: $' || format('{{:,.2f}}', total_revenue_estimated) FROM r
  UNION ALL SELECT 4, '[business] Operational cost: $' || format('{{:,.2f}}', operational_cost_estimated) FROM r
  UNION ALL SELECT 5, printf('[business] Profit margin: %.1f%%', round_even(profit_margin_percent, 1)) FROM r
  UNION ALL SELECT 6, printf('[business] On-time delivery rate: %.1f%%', round_even(on_time_delivery_rate * 100.0E0, 1)) FROM r
  UNION ALL SELECT 7, printf('[business] Average satisfaction: %.2f', round_even(customer_satisfaction_avg, 2)) FROM r
  UNION ALL SELECT 8, '[operations] Active couriers: ' || active_couriers FROM r
  UNION ALL SELECT 9, '[operations] Active departments: ' || active_departments FROM r
  UNION ALL SELECT 10, '[operations] Cities covered: ' || cities_covered FROM r
  UNION ALL SELECT 11, '[operations] View records loaded: ' || total_view_records FROM r
  UNION ALL SELECT 12, '[models] Satisfaction accuracy: ' || coalesce(printf('%.1f%%', round_even(customer_satisfaction_accuracy * 100.0E0, 1)), 'n/a') FROM r
  UNION ALL SELECT 13, '[models] Satisfaction precision: ' || coalesce(printf('%.1f%%', round_even(customer_satisfaction_precision * 100.0E0, 1)), 'n/a') FROM r)
SELECT value FROM lines"""


@register("write_text_report", section=S, oracle=REPORT_TEXT_SQL.format(report=REPORT_SQL))
def q_write_text_report(spark, sf):
    path = scratch_dir(spark, "daily_report_txt")
    REP.write_text_report(report_with_satisfaction(spark, sf), path, REP.satisfaction_lines())
    return spark.read.text(path)


@register("full_text_report", section=S)
def q_full_text_report(spark, sf):
    """The text report over all five summaries, with the scores that the model
    store holds of the current delivery-time and satisfaction models."""
    store = ModelStore(spark, scratch_dir(spark, "report_models"))
    for name, source in (("delivery_time", "deliveries"), ("customer_satisfaction", "feedback")):
        rows = load(spark, sf, source)
        store.load_or_fit(name, digest(rows), lambda n=name, r=rows: scorers(P.RUN_DS)[n].fit(r))
    path = scratch_dir(spark, "full_report_txt")
    REP.write_text_report(REP.full_report(spark, sf, P.RUN_DS, store), path, REP.model_lines())
    return spark.read.text(path)


@register("write_truncate", section=S, oracle=DEPT_FACTS_SQL)
def q_write_truncate(spark, sf):
    facts = WIN.department_facts(load(spark, sf, "departments", month=P.TRANSPORT_DS[:7]), P.TRANSPORT_DS)
    path = scratch_dir(spark, "department_workload_monthly")
    W.write_truncate(facts, path)
    W.write_truncate(facts, path)  # a second run replaces, never adds
    return spark.read.parquet(path)


@register("write_append", section=S, oracle=DEPT_FACTS_SQL)
def q_write_append(spark, sf):
    """Two jobs append to one day, and the first is retried: nothing is lost or doubled."""
    facts = WIN.department_facts(load(spark, sf, "departments", month=P.TRANSPORT_DS[:7]), P.TRANSPORT_DS)
    root = scratch_dir(spark, "department_facts")
    even = F.pmod(F.xxhash64("department_id"), F.lit(2)) == 0
    for run, rows in (("even", facts.where(even)), ("odd", facts.where(~even)), ("even", facts.where(even))):
        ledger.append_run(rows, root, f"{run}-{P.TRANSPORT_DS}", "snapshot_date")
    return ledger.read_committed(spark, root, facts.schema, "snapshot_date", P.TRANSPORT_DS)


@register("insert_values", section=S, oracle=f"""
SELECT execution_date, overall_quality_score, status, cast(NULL AS VARCHAR) AS note FROM ({QUALITY_REPORT_SQL}) q""")
def q_insert_values(spark, sf):
    """One row by column list; the insert is retried under its run id."""
    rep = Q.quality_report(load(spark, sf, "deliveries"), load(spark, sf, "departments"), P.RUN_DS)
    schema = T.StructType([T.StructField("execution_date", T.DateType()), T.StructField("overall_quality_score", T.DoubleType()),
                           T.StructField("status", T.StringType()), T.StructField("note", T.StringType())])
    root = scratch_dir(spark, "quality_log")
    for _ in range(2):
        ledger.insert_run(rep, root, schema, ["execution_date", "overall_quality_score", "status"], f"quality-{P.RUN_DS}", "execution_date")
    return ledger.read_committed(spark, root, schema)


@register("create_or_replace_view", section=S, oracle=STAFF_VIEW_SQL)
def q_create_or_replace_view(spark, sf):
    v = views.department_staff_view(load(spark, sf, "staff"), P.SNAPSHOT_DS)
    name = W.create_or_replace_view(v, "department_staff_distribution", P.SNAPSHOT_DS)
    return spark.table(name)


MANIFEST_SQL = """
WITH v AS (
  SELECT 'courier_performance_view' AS table_name, count(*) AS row_count FROM
    (SELECT DISTINCT city, courier_id FROM deliveries WHERE city IS NOT NULL AND courier_id IS NOT NULL) a
  UNION ALL SELECT 'department_efficiency_view', count(*) FROM
    (SELECT DISTINCT city, department_type FROM departments WHERE city IS NOT NULL AND department_type IS NOT NULL) b
  UNION ALL SELECT 'transport_utilization_view', count(*) FROM
    (SELECT DISTINCT transport_type FROM transport WHERE transport_type IS NOT NULL) c
  UNION ALL SELECT 'customer_satisfaction_view', count(*) FROM
    (SELECT DISTINCT city FROM feedback WHERE city IS NOT NULL) d)
SELECT table_name, row_count, 'SUCCESS' AS status FROM v
UNION ALL SELECT 'total_records', cast(sum(row_count) AS BIGINT), 'summary' FROM v"""


@register("load_manifest", section=S, oracle=MANIFEST_SQL)
def q_load_manifest(spark, sf):
    return REP.load_manifest(REP.analytics_views(spark, sf, P.RUN_DS))

