"""DuckDB statements of the satisfaction model, shared by several queries."""

from __future__ import annotations

from postlens.operators import linear as LIN
from postlens.operators import models as ML


def _satisfaction_sql() -> str:
    """Scored rows of the satisfaction model: label codes, training means,
    the same Newton steps, then the held-out rows."""
    k = len(ML.SATISFACTION_FEATURES) + 1
    code = "CASE WHEN {0} IN (SELECT {0} FROM tr WHERE {0} IS NOT NULL) THEN (SELECT count(DISTINCT t.{0}) FROM tr t WHERE t.{0} < f.{0}) ELSE (SELECT count(DISTINCT t.{0}) FROM tr t) END"
    return f"""WITH f0 AS (SELECT feedback_id, city, delivery_type, cast(delivery_time_actual - delivery_time_promised AS DOUBLE) AS delivery_delay,
                    cast(delivery_time_actual AS DOUBLE) AS delivery_time_actual, CASE WHEN satisfaction_score >= 7 THEN 1.0E0 ELSE 0.0E0 END AS label,
                    {ML.holdout_sql('feedback_id')} AS is_test FROM feedback),
tr AS (SELECT * FROM f0 WHERE NOT is_test),
cc AS (SELECT city, {code.format('city')} AS city_encoded FROM (SELECT DISTINCT city FROM f0) f),
ct AS (SELECT delivery_type, {code.format('delivery_type')} AS delivery_type_encoded FROM (SELECT DISTINCT delivery_type FROM f0) f),
f1 AS (SELECT * FROM f0 JOIN cc USING (city) JOIN ct USING (delivery_type)),
mu AS (SELECT {', '.join(f'avg({c}) AS {c}' for c in ML.SATISFACTION_FEATURES)} FROM f1 WHERE NOT is_test),
f2 AS MATERIALIZED (SELECT feedback_id, label AS y, is_test, [1.0E0, {', '.join(f'f1.{c} - mu.{c}' for c in ML.SATISFACTION_FEATURES)}] AS x FROM f1, mu),
tx AS (SELECT x, y FROM f2 WHERE NOT is_test),
{LIN.newton_logistic_sql('tx', k, [0.0] + [1.0] * (k - 1))},
sc AS (SELECT feedback_id, y AS label, 1.0E0 / (1.0E0 + exp(-list_dot_product(x, w))) AS p FROM f2, w{LIN.STEPS} WHERE is_test)
"""


SATISFACTION_SQL = _satisfaction_sql()

SATISFACTION_SCORES_SQL = SATISFACTION_SQL + """,
s AS (SELECT count(*) AS n, avg(CASE WHEN (p > 0.5E0) = (label = 1) THEN 1.0E0 ELSE 0.0E0 END) AS accuracy,
             cast(count_if(p > 0.5E0 AND label = 1) AS DOUBLE) / nullif(count_if(p > 0.5E0), 0) AS "precision",
             cast(count_if(p > 0.5E0 AND label = 1) AS DOUBLE) / nullif(count_if(label = 1), 0) AS recall FROM sc)
SELECT n, accuracy, "precision", recall, "precision" * recall * 2.0E0 / nullif("precision" + recall, 0) AS f1 FROM s"""
