"""Model queries compute their inputs once, however many passes they take."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from postlens.operators import deep_forest
from postlens.operators import models as ML


def _counted(df):
    """``df`` and the number of rows computed of it so far."""
    seen = df.sparkSession.sparkContext.accumulator(0)

    def rows(frames):
        for frame in frames:
            seen.add(len(frame))
            yield frame

    return df.mapInPandas(rows, df.schema), seen


def _deliveries(spark, n=400):
    return spark.range(n).select(
        F.concat(F.lit("DEL_"), "id").alias("delivery_id"), F.lit("PCL_1").alias("parcel_id"),
        F.concat(F.lit("city"), F.col("id") % 3).alias("city"), F.concat(F.lit("type"), F.col("id") % 2).alias("parcel_type"),
        F.timestamp_seconds(F.col("id") * 3600).alias("receive_datetime"), (F.col("id") % 50 * 4).cast("int").alias("delivery_duration_minutes"))


def test_delivery_model_computes_its_rows_once(spark):
    rows, seen = _counted(_deliveries(spark))
    model, held_out = ML.fit_delivery_time(rows)
    scores = ML.regression_scores(held_out, "actual_minutes", "predicted_minutes").first()
    assert scores["n"] == ML.delivery_frame(_deliveries(spark)).where("is_test").count() > 0
    assert ML.accuracy_within_minutes(held_out).first()["within_30_minutes"] is not None
    assert seen.value == 400


def test_saved_and_loaded_model_share_one_frame(spark):
    rows, seen = _counted(_deliveries(spark, 200))
    frame = ML.kept_delivery_frame(rows)
    model, held_out = ML.fit_delivery_time(frame)
    again = ML.score_delivery_time(model, frame)
    assert sorted(again.collect()) == sorted(held_out.collect())
    assert seen.value == 200


def test_poisson_draws_do_not_walk_the_terms_one_by_one(monkeypatch):
    """Every different mean is summed once, whatever the number of rows."""
    deep_forest._sums.cache_clear()
    u, mean = np.random.default_rng(3).random(50_000), np.tile([1.0, 3.0, 20.0, 64.0, 65.0], 10_000)
    got = deep_forest.poisson(u, mean)
    assert deep_forest._sums.cache_info().misses == 4
    for m in (1.0, 3.0, 20.0, 64.0):
        own = mean == m
        p = total = np.exp(-np.float64(m))
        k, sums = 0, [total]
        while len(sums) < 200:
            k += 1
            p = p * m / k
            total = total + p
            sums.append(total)
        assert (got[own] == [next((i for i, s in enumerate(sums) if s > x), 200) for x in u[own]]).all()
    from statistics import NormalDist
    z = np.array([NormalDist().inv_cdf(x) for x in u[mean == 65.0]])
    assert (got[mean == 65.0] == np.maximum(0, np.rint(65.0 + np.sqrt(65.0) * z))).all()


def test_satisfaction_model_computes_its_rows_once(spark):
    feedback = spark.range(300).select(
        F.concat(F.lit("FB_"), "id").alias("feedback_id"), F.concat(F.lit("city"), F.col("id") % 3).alias("city"),
        F.concat(F.lit("kind"), F.col("id") % 2).alias("delivery_type"), (F.col("id") % 90).cast("int").alias("delivery_time_actual"),
        F.lit(60).alias("delivery_time_promised"), (F.col("id") % 11).cast("int").alias("satisfaction_score"))
    rows, seen = _counted(feedback)
    _, held_out = ML.fit_satisfaction(rows)
    assert ML.classification_scores(held_out, "label").first()["n"] > 0
    assert seen.value == 300


def test_fraud_scores_compute_their_rows_once(spark):
    shipments = spark.range(500).select(
        F.concat(F.lit("PCL_"), "id").alias("shipment_id"), *[(F.xxhash64(F.lit(i), "id") % 100).cast("double").alias(c) for i, c in enumerate(ML.SHIPMENT_FEATURES)])
    rows, seen = _counted(shipments)
    scored = ML.fraud_score(spark, rows, trees=10, psi=32)
    assert scored.count() == 500 and 0 < scored.where("is_flagged").count() <= 25
    assert seen.value == 500
    model = ML.fraud_model(spark, shipments, trees=10, psi=32)
    assert sorted(ML.score_fraud(model, shipments).collect()) == sorted(scored.collect())


def test_ranking_scores_compute_the_interactions_once(spark):
    interactions = spark.range(400).select((F.col("id") % 20).cast("int").alias("user_id"), (F.col("id") % 20 * 3 + F.floor(F.col("id") / 20)).cast("int").alias("product_id"), F.lit(1).cast("long").alias("purchases"))
    types = spark.range(100).select(F.col("id").cast("int").alias("product_id"), F.concat(F.lit("t"), F.col("id") % 4).alias("product_type"))
    rows, seen = _counted(interactions)
    split, recs = ML.fit_recommendations(rows, types)
    got = ML.ranking_scores(split, recs, types).first()
    assert 0 < got["coverage"] <= 1 and 0 <= got["map_at_10"] <= 1
    assert seen.value == 400


def test_all_models_share_one_computed_source(spark, monkeypatch, tmp_path):
    from postlens.operators import scoring
    from postlens.operators.model_store import ModelStore, Package

    def fit(rows):
        return Package({"table": rows.agg(F.avg("x").alias("x"))})

    def score(package, rows):
        scored = rows.crossJoin(package.parts["table"].withColumnRenamed("x", "mean"))
        return scoring.facts(scored, "2024-01-01", "m", F.col("id"), "mean", F.col("x"), None, "none")

    monkeypatch.setattr(scoring, "scorers", lambda ds: {n: scoring.Scorer("source", fit, score) for n in ("one", "two", "three")})
    rows, seen = _counted(spark.range(90).select("id", (F.col("id") % 7).cast("double").alias("x")))
    got = scoring.score_all(spark, {"source": rows}, ModelStore(spark, f"{tmp_path}/models"), "2024-01-01")
    assert got.count() == 270 and got.where("band_rows <> 270").count() == 0
    assert seen.value == 90
