"""Scored rows of all nine models, with models kept in a store.

Each model has a fit, which gives a package to save, and a score, which turns
a loaded package and its input into prediction facts. ``score_all`` fits a
model only where the store's current version was fitted on other data.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.operators import isolation
from postlens.operators import models as ML
from postlens.operators.common import union_all
from postlens.operators.model_store import ModelStore, Package, digest
from postlens.session import ensure_checkpoint_dir, kept

HORIZONS = (1, 7, 30)


@dataclass
class Scorer:
    source: str
    fit: Callable[[DataFrame], Package]
    score: Callable[[Package, DataFrame], DataFrame]


def facts(scored: DataFrame, ds: str, model_type: str, entity: Column, predicted: str, actual: Column | None, confidence: Column | None, unit: str,
          band: Column | None = None) -> DataFrame:
    """Rows in the prediction-fact layout."""
    number = lambda c: (c if c is not None else F.lit(None)).cast("double")
    return scored.select(F.lit(ds).cast("date").alias("prediction_date"), F.lit(model_type).alias("model_type"), entity.cast("string").alias("entity_id"),
                         F.col(predicted).cast("double").alias("predicted_value"), number(actual).alias("actual_value"),
                         number(confidence).alias("confidence_score"), F.lit(unit).alias("unit"), (band if band is not None else F.lit("none")).alias("band"))


def _first(scores: DataFrame) -> dict:
    row = scores.first()
    return {k: v for k, v in row.asDict().items() if isinstance(v, (int, float))} if row else {}


def _fit_delivery(rows: DataFrame) -> Package:
    model, held_out = ML.fit_delivery_time(rows)
    scores = _first(ML.regression_scores(held_out, "actual_minutes", "predicted_minutes")) | _first(ML.accuracy_within_minutes(held_out))
    return Package(model.parts(), ML.DELIVERY_FEATURES, scores)


def _fit_satisfaction(rows: DataFrame) -> Package:
    model, held_out = ML.fit_satisfaction(rows)
    return Package({"model": model}, ML.SATISFACTION_FEATURES, _first(ML.classification_scores(held_out, "label")))


def _fit_ltv(rows: DataFrame) -> Package:
    frame = ML.kept_customers(rows, ML.LTV_DAYS)
    model = ML.ltv_model(frame)
    return Package({"model": model}, ML.CUSTOMER_FEATURES, _first(ML.regression_scores(ML.score_ltv(model, frame), "spend_after")))


def _fit_churn(rows: DataFrame) -> Package:
    frame = ML.kept_customers(rows, ML.CHURN_DAYS)
    model = ML.churn_model(frame)
    held_out = ML.score_churn(model, frame).where("is_test")
    return Package({"model": model}, ML.CUSTOMER_FEATURES, _first(ML.classification_scores(held_out, "churned")))


def _fit_recommendations(rows: DataFrame) -> Package:
    users, items = ML.recommendation_factors(rows)
    return Package({"users": users, "items": items}, ["user_id", "product_id"])


def _fit_price(rows: DataFrame) -> Package:
    return Package({"weights": ML.elasticity_weights(rows)}, list(ML.ELASTICITY_REGRESSORS))


def _fit_demand(rows: DataFrame) -> Package:
    return Package({f"horizon_{h}": ML.demand_model(rows, h) for h in HORIZONS}, ["value", "lag_1", "lag_7", "lag_30", "mean_7", "weekday"])


def _fit_sentiment(rows: DataFrame) -> Package:
    model = ML.sentiment_model(rows)
    held_out = ML.score_sentiment(model, rows)
    accuracy = held_out.agg(F.avg((F.col("label_idx") == F.col("prediction")).cast("double")).alias("accuracy"))
    return Package({"model": model}, ["text"], _first(accuracy))


def _fit_fraud(rows: DataFrame) -> Package:
    model, views = ML.fit_fraud(rows.sparkSession, rows, stored=True)
    return Package({"axes": model.axes, "forest": isolation.as_table(rows.sparkSession, model.forest)}, ML.SHIPMENT_FEATURES,
                   parameters={"components": model.components, **model.cuts}, views=views)


def _score_fraud(p: Package, rows: DataFrame) -> DataFrame:
    cuts = {k: v for k, v in p.parameters.items() if k != "components"}
    model = ML.FraudModel(p.parts["axes"], int(p.parameters["components"]), isolation.of_table(p.parts["forest"]), cuts)
    return ML.score_fraud(model, rows) if p.views is None else ML.flagged(model, p.views)


def scorers(ds: str) -> dict[str, Scorer]:
    c, either = F.col, lambda p: F.greatest(F.col(p), F.lit(1.0) - F.col(p))
    unsatisfied = F.lit(1.0) - c("p_satisfied")
    return {
        "delivery_time": Scorer("deliveries", _fit_delivery, lambda p, d: facts(
            ML.score_delivery_time(ML.DeliveryModel(p.parts["encoders"], p.parts["forest"]), d, True), ds, "delivery_time", c("delivery_id"), "predicted_minutes", c("actual_minutes"), None, "minutes")),
        "customer_satisfaction": Scorer("feedback", _fit_satisfaction, lambda p, d: facts(
            ML.score_satisfaction(p.parts["model"], d, True), ds, "customer_satisfaction", c("feedback_id"), "prediction", c("label"), either("p_satisfied"), "class",
            F.when(unsatisfied >= 0.7, "high").when(unsatisfied >= 0.4, "medium").otherwise("low"))),
        "churn": Scorer("purchases", _fit_churn, lambda p, d: facts(
            ML.score_churn(p.parts["model"], d), ds, "churn", c("customer_id"), "churn_probability", c("churned"), either("churn_probability"), "probability", c("risk_band"))),
        "ltv": Scorer("purchases", _fit_ltv, lambda p, d: facts(
            ML.score_ltv(p.parts["model"], d, every_row=True), ds, "ltv", c("customer_id"), "prediction", c("spend_after"), None, "amount")),
        "recommendations": Scorer("interactions", _fit_recommendations, lambda p, d: facts(
            ML.recommendation_rows(ML.recommend(p.parts["users"], p.parts["items"], d)), ds, "recommendations", F.concat_ws("|", "user_id", "product_id"), "score", None, None, "preference")),
        "price": Scorer("price_points", _fit_price, lambda p, d: facts(
            ML.price_changes(p.parts["weights"]), ds, "price", c("product_type"), "revenue_lift_percent", None, None, "percent")),
        "demand": Scorer("daily_metrics", _fit_demand, lambda p, d: union_all(*[facts(
            ML.score_demand(p.parts[f"horizon_{h}"], d, h, True), ds, "demand", F.concat_ws("|", "metric", "date", F.lit(h)), "prediction", c("target"), None, "metric value") for h in HORIZONS])),
        "sentiment": Scorer("text_labels", _fit_sentiment, lambda p, d: facts(
            ML.score_sentiment(p.parts["model"], d, True), ds, "sentiment", c("doc_id"), "prediction", c("label_idx"), c("confidence"), "class")),
        "fraud": Scorer("shipments", _fit_fraud, lambda p, d: facts(
            _score_fraud(p, d), ds, "fraud", c("shipment_id"), "anomaly_score", None, None, "anomaly score", F.when(c("is_flagged"), "high").otherwise("low"))),
    }


def score_all(spark: SparkSession, inputs: dict[str, DataFrame], store: ModelStore, ds: str) -> DataFrame:
    """Every row scored by each model (training rows as well), its risk band,
    and the number of rows of its (model_type, band). Churn's bands are the
    churn model's, satisfaction's the same steps of the probability of not
    being satisfied, a flagged shipment is high; models of amounts have no
    risk and the band ``none``."""
    by_source: dict[str, dict[str, Scorer]] = {}
    for name, scorer in scorers(ds).items():
        by_source.setdefault(scorer.source, {})[name] = scorer

    def of_source(source: str) -> list[DataFrame]:
        rows = kept(inputs[source], f"scored-{source.replace('_', '-')}")  # joined and summed up once, for digest, fits and scores
        mark, out = digest(rows), []
        for name, scorer in by_source[source].items():
            package = store.load_or_fit(name, mark, lambda s=scorer: s.fit(rows))
            out.append(kept(scorer.score(package, rows), f"scores-{name.replace('_', '-')}"))  # read twice
        return out

    # models of different sources don't wait for each other: a fit's many short jobs run beside the long ones of others
    ensure_checkpoint_dir(spark)
    with ThreadPoolExecutor(len(by_source)) as pool:
        found = [pool.submit(inheritable_thread_target(spark)(of_source), source) for source in by_source]
        scored = union_all(*[frame for part in found for frame in part.result()])
    # at most a row for each of the nine models and four bands
    counts = scored.groupBy("model_type", "band").agg(F.count(F.lit(1)).alias("band_rows"))
    return scored.join(F.broadcast(counts), ["model_type", "band"]).select(*scored.columns, "band_rows")
