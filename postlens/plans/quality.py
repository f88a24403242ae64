"""Registered data-quality queries."""

from __future__ import annotations

from functools import reduce

from postlens.functions.semantics import np_round
from postlens.operators import postal as O
from postlens.operators import quality as Q
from postlens.operators.common import flat_arrays
from postlens.plans import params as P
from postlens.plans.catalog import register
from postlens.plans.fixture_sql import completeness_sql
from postlens.sources.standins import load

S = "2.5"
QUALITY_TABLES = ("deliveries", "departments", "transport", "feedback", "routes")


def _completeness_sql() -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, {completeness_sql(t)} AS completeness_percent FROM {t}"
        for t in QUALITY_TABLES)


def _completeness(spark, sf):
    return reduce(lambda a, b: a.unionByName(b),
                  [Q.column_completeness(load(spark, sf, t), t) for t in QUALITY_TABLES])


@register("column_completeness", section=S, oracle=_completeness_sql())
def q_column_completeness(spark, sf):
    return _completeness(spark, sf)


@register("positive_duration_share", section=S, oracle="""
SELECT count_if(delivery_duration_minutes > 0) / nullif(count(*), 0) * 100.0E0 AS business_rules_score
FROM deliveries""")
def q_positive_duration_share(spark, sf):
    return Q.positive_duration_share(load(spark, sf, "deliveries"))


@register("mean_range_score", section=S, oracle="""
SELECT avg(delivery_duration_minutes) AS mean_duration,
       CASE WHEN avg(delivery_duration_minutes) BETWEEN 30 AND 150 THEN 95.0E0 ELSE 75.0E0 END AS anomaly_score
FROM deliveries""")
def q_mean_range_score(spark, sf):
    return Q.mean_range_score(load(spark, sf, "deliveries"))


QUALITY_REPORT_SQL = f"""
SELECT DATE '{P.RUN_DS}' AS execution_date,
       round_even(cc, 2) AS courier_completeness, round_even(dc, 2) AS department_completeness,
       round_even(br, 2) AS business_rules_score, round_even(an, 2) AS anomaly_score,
       round_even((cc + dc + br + an) / 4.0E0, 2) AS overall_quality_score,
       CASE WHEN (cc + dc + br + an) / 4.0E0 >= 90 THEN 'PASS'
            WHEN (cc + dc + br + an) / 4.0E0 >= 80 THEN 'WARNING' ELSE 'FAIL' END AS status
FROM (SELECT {completeness_sql('deliveries')} AS cc,
             count_if(delivery_duration_minutes > 0) / nullif(count(*), 0) * 100.0E0 AS br,
             CASE WHEN avg(delivery_duration_minutes) BETWEEN 30 AND 150 THEN 95.0E0 ELSE 75.0E0 END AS an
      FROM deliveries) a,
     (SELECT {completeness_sql('departments')} AS dc FROM departments) b"""


@register("quality_report", section=S, oracle=QUALITY_REPORT_SQL)
def q_quality_report(spark, sf):
    return Q.quality_report(load(spark, sf, "deliveries"), load(spark, sf, "departments"), P.RUN_DS)


CHECKS_SQL = f"""
WITH c AS (
  SELECT 'delivery_data_completeness' AS check_name, s AS score,
         CASE WHEN s > 0.95 THEN 'PASS' ELSE 'WARNING' END AS status,
         printf('Delivery records completeness: %.2f%%', s * 100.0E0) AS details
  FROM (SELECT {completeness_sql('deliveries')} / 100.0E0 AS s FROM deliveries) a
  UNION ALL
  SELECT 'route_validation_accuracy', s, CASE WHEN s > 0.90 THEN 'PASS' ELSE 'FAIL' END,
         printf('Route validation accuracy: %.2f%%', s * 100.0E0)
  FROM (SELECT avg(cast(is_valid_route AS double)) AS s FROM routes) b
  UNION ALL
  SELECT 'timestamp_consistency', s, CASE WHEN s > 0.95 THEN 'PASS' ELSE 'WARNING' END,
         printf('Timestamp consistency: %.2f%%', s * 100.0E0)
  FROM (SELECT count_if(issue_datetime >= receive_datetime) / nullif(count(*), 0) AS s FROM deliveries) d)
SELECT * FROM c
UNION ALL
SELECT 'overall', round_even(m, 3),
       CASE WHEN m > 0.92 THEN 'PASS' WHEN m > 0.85 THEN 'WARNING' ELSE 'FAIL' END,
       printf('Overall score: %.2f%%', m * 100.0E0)
FROM (SELECT avg(score) AS m FROM c) o"""


@register("quality_checks", section=S, oracle=CHECKS_SQL)
def q_quality_checks(spark, sf):
    return Q.quality_checks(load(spark, sf, "deliveries"), load(spark, sf, "routes"))


@register("quality_issue_list", section="2.3", oracle=f"""
SELECT table_name, round_even(completeness_percent, 2) AS overall_score,
       concat_ws('|', CASE WHEN completeness_percent < 90.0 THEN '{O.QUALITY_ISSUE_TEXTS[0][1]}' END,
                      CASE WHEN completeness_percent < 85.0 THEN '{O.QUALITY_ISSUE_TEXTS[1][1]}' END) AS issues,
       CASE WHEN completeness_percent IS NULL THEN NULL
            WHEN completeness_percent > 80.0 THEN 'PASS' ELSE 'FAIL' END AS status
FROM ({_completeness_sql()}) c""")
def q_quality_issue_list(spark, sf):
    c = _completeness(spark, sf)
    return flat_arrays(c.select(
        "table_name", np_round("completeness_percent", 2).alias("overall_score"),
        O.quality_issue_list("completeness_percent").alias("issues"),
        O.quality_status("completeness_percent").alias("status")))
