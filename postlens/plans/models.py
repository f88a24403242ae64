"""Registered model queries.

Fitted models are deterministic functions of the data (seeded
estimators, hash-based holdouts) but their numbers are not SQL, so most
keys here have no oracle; the closed-form ones (elasticity, banding,
robust z, reports, capacity) do. Every call fits on the data it is given.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from postlens.functions.semantics import np_round, safe_div
from postlens.operators import linear as LIN
from postlens.operators import models as ML
from postlens.operators import scoring
from postlens.operators import sinks as W
from postlens.operators import windows as WIN
from postlens.operators.common import side_by_side, union_all
from postlens.operators.model_store import ModelStore
from postlens.plans import params as P
from postlens.plans.aggregates import MODEL_VIEW_SQL
from postlens.plans.catalog import register
from postlens.plans.model_sql import SATISFACTION_SCORES_SQL, SATISFACTION_SQL
from postlens.session import scratch_dir, shared_path
from postlens.sources.standins import load
from postlens.sources.tables import table

S = "2.11"


def _delivery(spark, sf):
    return ML.fit_delivery_time(load(spark, sf, "deliveries"))


def _satisfaction(spark, sf):
    return ML.fit_satisfaction(load(spark, sf, "feedback"))


@register("label_encode", section=S, oracle="""
SELECT 'city' AS column_name, city AS label, cast(dense_rank() OVER (ORDER BY city) - 1 AS DOUBLE) AS code
FROM (SELECT DISTINCT city FROM deliveries WHERE city IS NOT NULL) c
UNION ALL
SELECT 'parcel_type', parcel_type, cast(dense_rank() OVER (ORDER BY parcel_type) - 1 AS DOUBLE)
FROM (SELECT DISTINCT parcel_type FROM deliveries WHERE parcel_type IS NOT NULL) p""")
def q_label_encode(spark, sf):
    d = load(spark, sf, "deliveries")
    out = []
    for c in ("city", "parcel_type"):
        enc = ML.label_encoder(c).fit(d)
        vals = d.where(F.col(c).isNotNull()).select(c).distinct()
        out.append(enc.transform(vals).select(F.lit(c).alias("column_name"), F.col(c).alias("label"),
                                              F.col(f"{c}_encoded").alias("code")))
    return union_all(*out)


@register("holdout_split", section=S, oracle=f"""
WITH f AS (SELECT {ML.holdout_sql('delivery_id', 'parcel_id', 'receive_datetime')} AS is_test FROM deliveries)
SELECT CASE WHEN is_test THEN 'test' ELSE 'train' END AS split, count(*) AS "rows",
       cast(count(*) AS DOUBLE) / (SELECT count(*) FROM f) AS share FROM f GROUP BY 1""")
def q_holdout_split(spark, sf):
    f = ML.delivery_frame(load(spark, sf, "deliveries"))
    n = f.agg(F.count(F.lit(1))).scalar()
    return f.groupBy(F.when(F.col("is_test"), "test").otherwise("train").alias("split")).agg(
        F.count(F.lit(1)).alias("rows"), safe_div(F.count(F.lit(1)), n).alias("share"))


@register("delivery_time_model", section=S)
def q_delivery_time_model(spark, sf):
    return _delivery(spark, sf)[1]


@register("regression_scores", section=S)
def q_regression_scores(spark, sf):
    return ML.regression_scores(_delivery(spark, sf)[1], "actual_minutes", "predicted_minutes")


@register("accuracy_within_minutes", section=S)
def q_accuracy_within_minutes(spark, sf):
    return ML.accuracy_within_minutes(_delivery(spark, sf)[1])


@register("feature_importance", section=S)
def q_feature_importance(spark, sf):
    return ML.feature_importance(spark, _delivery(spark, sf)[0], ML.DELIVERY_FEATURES)


@register("satisfaction_model", section=S, oracle=SATISFACTION_SQL + """
SELECT feedback_id, label, CASE WHEN p > 0.5E0 THEN 1.0E0 ELSE 0.0E0 END AS prediction, round_even(p, 6) AS p_satisfied FROM sc""")
def q_satisfaction_model(spark, sf):
    return _satisfaction(spark, sf)[1].withColumn("p_satisfied", np_round("p_satisfied", 6))


@register("classification_scores", section=S, oracle=SATISFACTION_SCORES_SQL)
def q_classification_scores(spark, sf):
    return ML.classification_scores(_satisfaction(spark, sf)[1], "label")


@register("ltv_model", section=S)
def q_ltv_model(spark, sf):
    scored = ML.fit_ltv(load(spark, sf, "purchases"))
    return ML.regression_scores(scored, "spend_after")


@register("churn_model", section=S)
def q_churn_model(spark, sf):
    s = ML.fit_churn(load(spark, sf, "purchases"))
    return s.groupBy("risk_band").agg(F.count(F.lit(1)).alias("customers"),
                                      F.avg("churn_probability").alias("avg_probability"),
                                      F.avg("churned").alias("observed_churn_rate"))


def _product_types(spark, sf):
    return table(spark, sf, "part", "p_partkey", "p_type").select(
        F.col("p_partkey").cast("int").alias("product_id"), F.col("p_type").alias("product_type"))


def _recs(spark, sf):
    return ML.fit_recommendations(load(spark, sf, "interactions"), _product_types(spark, sf))


@register("recommendations", section=S)
def q_recommendations(spark, sf):
    return ML.recommendation_rows(_recs(spark, sf)[1])


@register("ranking_scores", section=S)
def q_ranking_scores(spark, sf):
    split, recs = _recs(spark, sf)
    return ML.ranking_scores(split, recs, _product_types(spark, sf))


def _elasticity_sql() -> str:
    xs = ["ln(unit_price)", "discount", "sin(month * pi() / 6)", "cos(month * pi() / 6)"]
    named = ", ".join(f"{x} AS z{i}" for i, x in enumerate(xs))
    means = ", ".join(f"avg(z{i}) OVER (PARTITION BY product_type) AS m{i}" for i in range(len(xs)))
    centred = [f"(z{i} - m{i})" for i in range(len(xs))]
    return f"""WITH z AS (SELECT product_type, ln(quantity) AS y, {named} FROM price_points WHERE unit_price > 0 AND quantity > 0),
c AS (SELECT *, {means}, avg(y) OVER (PARTITION BY product_type) AS my FROM z),
g AS (SELECT product_type, count(*) AS observations, {LIN.normal_equations_sql(centred, '(y - my)', [1.0] * len(xs))} AS m FROM c GROUP BY product_type),
{LIN.solve_sql(len(xs), 'g', 'e')},
r AS (SELECT product_type, observations, round_even(m[1][{len(xs) + 1}], 6) AS elasticity, round_even(m[2][{len(xs) + 1}], 6) AS discount_effect FROM e{len(xs)})
SELECT product_type, observations, elasticity, discount_effect,
       CASE WHEN elasticity > -1 THEN 'raise' WHEN elasticity < -1 THEN 'lower' ELSE 'keep' END AS suggested_change,
       (pow(1.05E0, 1.0E0 + elasticity) - 1.0E0) * 100.0E0 AS revenue_lift_percent FROM r"""


@register("price_elasticity", section=S, oracle=_elasticity_sql())
def q_price_elasticity(spark, sf):
    return ML.price_elasticity(load(spark, sf, "price_points"))


def _calendar_sql(source: str = "daily_metrics") -> str:
    return f"""cal AS (SELECT metric, cast(unnest(generate_series(min("date"), max("date"), INTERVAL 1 DAY)) AS DATE) AS "date" FROM {source} GROUP BY metric),
ser AS (SELECT c.metric, c."date", coalesce(d.value, 0.0E0) AS value FROM cal c LEFT JOIN {source} d ON c.metric = d.metric AND c."date" = d."date")"""


def _additive_sql(rows: str, name: str) -> str:
    """CTE ``name``: (metric, first, w), fitted on ``rows`` (metric, date, value, first)."""
    xs = LIN.seasonal_design_sql('"date"', "first", ML.YEARLY, ML.WEEKLY)
    k = len(xs)
    cols = [f"x[{i + 1}]" for i in range(k)]
    return f"""{name}_x AS (SELECT metric, first, value, [{', '.join(xs)}] AS x FROM {rows}),
{name}_g AS (SELECT metric, first, {LIN.normal_equations_sql(cols, 'value', LIN.seasonal_penalty(ML.YEARLY, ML.WEEKLY))} AS m FROM {name}_x GROUP BY metric, first),
{LIN.solve_sql(k, f'{name}_g', f'{name}_e')},
{name} AS (SELECT metric, first, list_transform(m, lambda row: row[{k + 1}]) AS w FROM {name}_e{k})"""


_ADDITIVE = "list_dot_product(w, [" + ", ".join(LIN.seasonal_design_sql('"date"', "first", ML.YEARLY, ML.WEEKLY)) + "])"

DEMAND_SQL = f"""WITH {_calendar_sql()},
cut AS (SELECT metric, quantile_disc(datediff('day', DATE '1970-01-01', "date"), 0.8E0) AS cut, min("date") AS first FROM ser GROUP BY metric),
s0 AS (SELECT *, datediff('day', DATE '1970-01-01', "date") AS day FROM ser JOIN cut USING (metric)),
tr AS (SELECT * FROM s0 WHERE day <= cut),
{_additive_sql('tr', 'fit')},
s1 AS (SELECT s0.*, {_ADDITIVE.replace('first', 's0.first')} AS additive FROM s0 JOIN fit ON fit.metric = s0.metric),
s2 AS (SELECT *, avg(value - additive) OVER (PARTITION BY metric ORDER BY "date" ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS off FROM s1),
h AS (SELECT unnest([1, 7, 30]) AS horizon_days),
s3 AS (SELECT metric, day, cut, value, additive,
              additive + lag(off, 1) OVER w AS f1, additive + lag(off, 7) OVER w AS f7, additive + lag(off, 30) OVER w AS f30,
              lag(value, 7) OVER w AS b7, lag(value, 35) OVER w AS b35 FROM s2 WINDOW w AS (PARTITION BY metric ORDER BY "date")),
r AS (SELECT horizon_days, value, CASE horizon_days WHEN 1 THEN f1 WHEN 7 THEN f7 ELSE f30 END AS f, CASE horizon_days WHEN 30 THEN b35 ELSE b7 END AS b FROM s3, h WHERE day > cut)
SELECT horizon_days, count(*) AS test_days, round_even(avg(abs(f - value)), 3) AS model_mae,
       round_even(avg(CASE WHEN value <> 0 THEN abs(f - value) / abs(value) END) * 100.0E0, 3) AS model_mape,
       round_even(avg(abs(b - value)), 3) AS baseline_mae,
       round_even(avg(CASE WHEN value <> 0 THEN abs(b - value) / abs(value) END) * 100.0E0, 3) AS baseline_mape
FROM r WHERE f IS NOT NULL AND b IS NOT NULL GROUP BY horizon_days"""


@register("demand_forecast", section=S, oracle=DEMAND_SQL)
def q_demand_forecast(spark, sf):
    return ML.demand_forecast(load(spark, sf, "daily_metrics"))


_ALL_DAYS = f"""{_calendar_sql()},
tr AS (SELECT ser.*, f.first FROM ser JOIN (SELECT metric, min("date") AS first FROM ser GROUP BY metric) f USING (metric)),
{_additive_sql('tr', 'fit')}"""
_COMPONENTS = ["level", "trend_per_year"] + [f"{n}_{f}_{k}" for n, _, k in LIN.seasonal_terms(ML.YEARLY, ML.WEEKLY) for f in ("sin", "cos")]


@register("demand_components", section=S, oracle=f"""WITH {_ALL_DAYS}
SELECT metric, unnest({_COMPONENTS}) AS component, round_even(unnest(w), 3) AS weight FROM fit""")
def q_demand_components(spark, sf):
    """Level, trend and seasonal weights of each metric's whole series."""
    return ML.demand_components(load(spark, sf, "daily_metrics"))


_OUTLOOK = f"""
k0 AS (SELECT tr.metric, tr."date", value, {_ADDITIVE.replace('first', 'tr.first')} AS additive, max(tr."date") OVER (PARTITION BY tr.metric) AS last FROM tr JOIN fit ON fit.metric = tr.metric),
off AS (SELECT metric, avg(value - additive) AS off, max(last) AS last FROM k0 WHERE datediff('day', "date", last) < 7 GROUP BY metric),
ahead AS (SELECT metric, off, unnest(range(1, 31)) AS days_ahead, last FROM off),
a1 AS (SELECT metric, off, cast(days_ahead AS INT) AS days_ahead, cast(last + days_ahead * INTERVAL 1 DAY AS DATE) AS "date" FROM ahead),
outlook AS (SELECT a1.metric, "date", days_ahead, round_even({_ADDITIVE.replace('first', 'fit.first')} + off, 3) AS forecast FROM a1 JOIN fit ON fit.metric = a1.metric)"""


@register("demand_outlook", section=S, oracle=f"""WITH {_ALL_DAYS},{_OUTLOOK}
SELECT metric, "date", days_ahead, forecast FROM outlook""")
def q_demand_outlook(spark, sf):
    """Each metric's next 30 days."""
    return ML.demand_outlook(load(spark, sf, "daily_metrics"))


@register("sentiment_model", section=S)
def q_sentiment_model(spark, sf):
    return ML.sentiment_scores(ML.fit_sentiment(load(spark, sf, "text_labels")))


@register("satisfaction_category", section=S, oracle="""
SELECT customer_id, count(*) AS feedback_count, avg(satisfaction_score) AS avg_score,
       CASE WHEN avg(satisfaction_score) >= 8.5 THEN 'very_satisfied'
            WHEN avg(satisfaction_score) >= 7.0 THEN 'satisfied'
            WHEN avg(satisfaction_score) >= 5.5 THEN 'neutral'
            WHEN avg(satisfaction_score) >= 3.0 THEN 'dissatisfied' ELSE 'very_dissatisfied' END
         AS satisfaction_category
FROM feedback GROUP BY customer_id""")
def q_satisfaction_category(spark, sf):
    from postlens.functions.semantics import band
    g = load(spark, sf, "feedback").groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("feedback_count"), F.avg("satisfaction_score").alias("avg_score"))
    return g.withColumn("satisfaction_category", band("avg_score", [
        (">=", 8.5, "very_satisfied"), (">=", 7.0, "satisfied"), (">=", 5.5, "neutral"),
        (">=", 3.0, "dissatisfied")], "very_dissatisfied"))


@register("fraud_score", section=S)
def q_fraud_score(spark, sf):
    s = ML.fraud_score(spark, load(spark, sf, "shipments"))
    return s.where("is_flagged").select("shipment_id", "isolation_score", "reconstruction_error", "anomaly_score", "is_flagged", "components")


@register("metric_outliers", section=S, oracle="""
WITH m AS (SELECT metric, quantile_cont(value, 0.5) AS median FROM daily_metrics GROUP BY metric),
d AS (SELECT x.*, m.median FROM daily_metrics x JOIN m USING (metric)),
a AS (SELECT metric, quantile_cont(abs(value - median), 0.5) AS mad FROM d GROUP BY metric),
z AS (SELECT d.*, a.mad, abs(value - median) * 0.6745 / (CASE WHEN mad > 0 THEN mad END) AS robust_z
      FROM d JOIN a USING (metric)),
c AS (SELECT metric, quantile_cont(robust_z, 0.95) AS cut FROM z GROUP BY metric)
SELECT metric, "date", value, median, mad, robust_z, robust_z >= cut AS is_outlier FROM z JOIN c USING (metric)""")
def q_metric_outliers(spark, sf):
    return ML.metric_outliers(load(spark, sf, "daily_metrics"))


def _store(spark, sf) -> ModelStore:
    """Models of one data folder, on the shared storage."""
    return ModelStore(spark, shared_path(spark, "postlens-models", hashlib.md5(sf.rstrip("/").encode()).hexdigest()))


@register("score_all_models", section=S)
def q_score_all_models(spark, sf):
    inputs = {n: load(spark, sf, n) for n in ("deliveries", "feedback", "purchases", "interactions", "price_points", "daily_metrics", "text_labels", "shipments")}
    return scoring.score_all(spark, inputs, _store(spark, sf), P.RUN_DS)


DRIFT_SQL = """
WITH k AS (SELECT * FROM predictions WHERE actual_value IS NOT NULL),
mid AS (SELECT model_type, (datediff('day', DATE '1970-01-01', min(prediction_date)) + datediff('day', DATE '1970-01-01', max(prediction_date))) / 2.0E0 AS mid FROM k GROUP BY model_type),
p AS (SELECT k.*, datediff('day', DATE '1970-01-01', prediction_date) > mid AS later,
             coalesce(CASE WHEN actual_value <> 0 THEN abs(predicted_value - actual_value) / actual_value END <= 0.1E0, false) AS near
      FROM k JOIN mid USING (model_type)),
e AS (SELECT model_type, quantile_disc(predicted_value, [0.1E0, 0.2E0, 0.3E0, 0.4E0, 0.5E0, 0.6E0, 0.7E0, 0.8E0, 0.9E0]) AS edges FROM p WHERE NOT later GROUP BY model_type),
b AS (SELECT model_type, len(list_filter(edges, lambda x: x < predicted_value)) AS bin, count_if(NOT later) AS n_early, count_if(later) AS n_late
      FROM p JOIN e USING (model_type) GROUP BY ALL),
t AS (SELECT model_type, sum(n_early) AS t_early, sum(n_late) AS t_late FROM b GROUP BY model_type),
s AS (SELECT model_type, greatest(n_early / nullif(t_early, 0), 0.0001E0) AS e, greatest(n_late / nullif(t_late, 0), 0.0001E0) AS a FROM b JOIN t USING (model_type)),
d AS (SELECT model_type, sum((a - e) * ln(a / e)) AS psi FROM s GROUP BY model_type),
c AS (SELECT model_type, avg(CASE WHEN NOT later THEN cast(near AS DOUBLE) END) AS early, avg(CASE WHEN later THEN cast(near AS DOUBLE) END) AS late FROM p GROUP BY model_type)
SELECT model_type, round_even(psi * 10000.0E0, 0) / 10000.0E0 AS drift_score, (late - early) * 100.0E0 AS accuracy_change_points,
       CASE WHEN psi < 0.1E0 THEN 'healthy' ELSE 'needs_retraining' END AS status, psi >= 0.1E0 AS retraining_required
FROM d JOIN c USING (model_type)"""


@register("model_drift", section=S, oracle=DRIFT_SQL)
def q_model_drift(spark, sf):
    return ML.model_drift(load(spark, sf, "predictions"))


@register("ml_performance_report", section=S, oracle=f"""
SELECT v.model_type, v.mae, v.accuracy_within_10_percent, v.total_predictions,
       (SELECT count(DISTINCT model_type) FROM predictions WHERE prediction_date = DATE '{P.PREDICTION_DS}')
         AS models_deployed,
       (SELECT count(*) FROM predictions WHERE prediction_date = DATE '{P.PREDICTION_DS}') AS predictions_served
FROM ({MODEL_VIEW_SQL}) v""")
def q_ml_performance_report(spark, sf):
    from postlens.operators import views
    preds = load(spark, sf, "predictions")
    v = views.ml_model_performance_view(preds, P.PREDICTION_DS)
    day = WIN.prediction_facts(preds, P.PREDICTION_DS)
    return v.select("model_type", "mae", "accuracy_within_10_percent", "total_predictions",
                    day.agg(F.count_distinct("model_type")).scalar().alias("models_deployed"),
                    day.agg(F.count(F.lit(1))).scalar().alias("predictions_served"))


CAPACITY_SQL = f"""
WITH daily AS (SELECT 'deliveries' AS metric, delivery_date AS "date", cast(count(*) AS DOUBLE) AS value FROM deliveries GROUP BY delivery_date),
{_ALL_DAYS.replace('daily_metrics', 'daily')},{_OUTLOOK},
ld AS (SELECT max("date") AS d FROM daily),
k AS (SELECT (SELECT round_even(sum(greatest(forecast, 0.0E0)), 1) FROM outlook WHERE days_ahead <= 7) AS forecast_next_7d,
             count(DISTINCT CASE WHEN delivery_date > (SELECT d FROM ld) - 28 THEN courier_id END) AS active_couriers,
             count_if(delivery_date > (SELECT d FROM ld) - 28) AS n28
      FROM deliveries),
f AS (SELECT dayname("date") AS weekday, avg(value) / (SELECT avg(value) FROM ser) AS factor FROM ser GROUP BY dayname("date"))
SELECT forecast_next_7d, active_couriers, n28 / 4.0E0 / nullif(active_couriers, 0) AS weekly_per_courier,
       greatest(0, cast(ceil(forecast_next_7d / (n28 / 4.0E0 / nullif(active_couriers, 0))) AS BIGINT) - active_couriers) AS additional_couriers_needed,
       (SELECT array_to_string(list_slice(list(weekday ORDER BY factor DESC, weekday), 1, 2), ',') FROM f) AS peak_days
FROM k"""


@register("capacity_plan", section=S, oracle=CAPACITY_SQL)
def q_capacity_plan(spark, sf):
    """Couriers to add for next week: the 7-day forecast of the additive model
    (days below zero count as zero) over the weekly deliveries per active
    courier of the last 28 days, less the active couriers; peak days are the
    two weekdays with the largest seasonality factor."""
    d = load(spark, sf, "deliveries")
    daily = d.groupBy(F.col("delivery_date").alias("date")).agg(F.count(F.lit(1)).cast("double").alias("value")) \
        .withColumn("metric", F.lit("deliveries"))
    last = daily.agg(F.max("date")).scalar()
    month = F.col("delivery_date") > F.date_sub(last, 28)
    k = d.agg(F.count_distinct(F.when(month, F.col("courier_id"))).alias("active_couriers"), F.count_if(month).alias("n28"))
    week = ML.demand_outlook(daily, 7).agg(np_round(F.sum(F.greatest("forecast", F.lit(0.0))), 1).alias("forecast_next_7d"))
    k = side_by_side(week, k)
    weekly = safe_div(F.col("n28") / 4.0, "active_couriers")
    k = k.select("forecast_next_7d", "active_couriers", weekly.alias("weekly_per_courier"),
                 F.greatest(F.lit(0), F.ceil(safe_div("forecast_next_7d", weekly)) - F.col("active_couriers"))
                 .alias("additional_couriers_needed"))
    season = WIN.seasonality_factor(daily)
    peaks = season.agg(F.array_join(F.slice(F.transform(
        F.sort_array(F.collect_list(F.struct((-F.col("seasonality_factor")).alias("f"), F.col("weekday").alias("w")))),
        lambda x: x["w"]), 1, 2), ",").alias("peak_days"))
    return side_by_side(k, peaks)


@register("save_model", section="2.2")
def q_save_model(spark, sf):
    """Save the delivery-time package (encoders, forest, features, scores) as
    a new version, load the current one and score the holdout with it."""
    deliveries = ML.kept_delivery_frame(load(spark, sf, "deliveries"))
    store = ModelStore(spark, scratch_dir(spark, "models"))
    store.save("delivery_time_model", scoring.scorers(P.RUN_DS)["delivery_time"].fit(deliveries))
    package = store.load("delivery_time_model")
    scored = ML.score_delivery_time(ML.DeliveryModel(package.parts["encoders"], package.parts["forest"]), deliveries)
    return (ML.regression_scores(scored, "actual_minutes", "predicted_minutes")
            .withColumn("features", F.lit(len(package.features))).withColumn("saved_mae", F.lit(package.scores["mae"])))


@register("model_manifest", section="2.2")
def q_model_manifest(spark, sf):
    store = ModelStore(spark, scratch_dir(spark, "model_store"))
    fits = scoring.scorers(P.RUN_DS)
    store.save("delivery_time_model", fits["delivery_time"].fit(load(spark, sf, "deliveries")))
    store.save("satisfaction_model", fits["customer_satisfaction"].fit(load(spark, sf, "feedback")))
    return W.model_manifest(spark, store.root)
