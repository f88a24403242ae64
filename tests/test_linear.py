import datetime as dt
import math

import numpy as np
from pyspark.sql import functions as F

from postlens.operators import linear as L
from postlens.operators import models as ML


def test_solve_random_systems(spark):
    rng = np.random.default_rng(1)
    a = [rng.normal(size=(30, 6)) for _ in range(20)]
    mats = [np.column_stack([x.T @ x, x.T @ rng.normal(size=30)]) for x in a]
    df = spark.createDataFrame([(i, m.tolist()) for i, m in enumerate(mats)], "i int, m array<array<double>>")
    got = {r.i: r.w for r in df.select("i", L.solve(F.col("m"), 6).alias("w")).collect()}
    for i, m in enumerate(mats):
        assert np.allclose(got[i], np.linalg.solve(m[:, :6], m[:, 6]), rtol=1e-9)


def test_singular_system_gives_nulls(spark):
    df = spark.createDataFrame([([[1.0, 1.0, 1.0], [1.0, 1.0, 1.0]],)], "m array<array<double>>")
    assert None in df.select(L.solve(F.col("m"), 2).alias("w")).first().w


def test_ridge(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 2))
    y = 1.0 - 0.7 * x[:, 0] + 0.2 * x[:, 1] + rng.normal(size=400) * 0.1
    rows = [("a" if i < 250 else "b", *map(float, x[i]), float(y[i])) for i in range(400)] + [("a", None, 1.0, 1.0), ("void", None, None, 1.0)]
    df = spark.createDataFrame(rows, "g string, u double, v double, y double").repartition(5)
    slopes = {r.g: r.s for r in df.groupBy("g").agg(F.regr_slope("y", "u").alias("s")).collect()}
    for r in ML.ridge(df, "y", ("u",), ["g"], 0.0).collect():
        assert abs(r.weights[1] - slopes[r.g]) < 1e-10  # no penalty: the plain slope
    got = {r.g: r for r in ML.ridge(df, "y", ("u", "v"), ["g"], 5.0).collect()}
    assert set(got) == {"a", "b"} and got["a"].observations == 250
    for g, part in (("a", slice(0, 250)), ("b", slice(250, 400))):
        xc, yc = x[part] - x[part].mean(axis=0), y[part] - y[part].mean()
        w = np.linalg.solve(xc.T @ xc + 5.0 * np.eye(2), xc.T @ yc)
        assert np.allclose(got[g].weights[1:], w, rtol=1e-9)
        assert abs(got[g].weights[0] - (y[part].mean() - x[part].mean(axis=0) @ w)) < 1e-9


def test_newton_reaches_the_optimum(spark):
    rng = np.random.default_rng(3)
    x = np.column_stack([np.ones(600), rng.normal(size=(600, 3)) * (1, 20, 0.1)])
    y = (rng.random(600) < 1 / (1 + np.exp(-(0.3 + x[:, 1] - 0.05 * x[:, 2])))).astype(float)
    df = spark.createDataFrame([(*map(float, r), float(t)) for r, t in zip(x, y)], "a double, b double, c double, d double, y double")
    pen = [0.0, 1.0, 1.0, 1.0]
    w = L.newton_logistic(df, [F.col(c) for c in "abcd"], F.col("y"), pen)
    gradient = x.T @ (y - 1 / (1 + np.exp(-x @ w))) - np.array(pen) * w
    assert np.abs(gradient).max() < 1e-9
    assert L.newton_logistic(df.where("a < 0"), [F.col(c) for c in "abcd"], F.col("y"), pen).tolist() == [0.0] * 4


def daily(spark, n=1200, metrics=("m",), seed=4):
    rng, first = np.random.default_rng(seed), dt.date(2019, 3, 5)
    rows = []
    for j, m in enumerate(metrics):
        for i in range(n):
            day = first + dt.timedelta(days=i)
            z = (day - dt.date(1970, 1, 1)).days
            value = 500 + 40 * i / 365.25 + 30 * math.sin(2 * math.pi * z / 365.25) + (25 if day.weekday() == 0 else 0) + rng.normal() * (j + 1)
            rows.append((day, m, value))
    return spark.createDataFrame(rows, "date date, metric string, value double"), rows


def test_additive_model_finds_trend_and_seasons(spark):
    df, _ = daily(spark, metrics=("m", "n"))
    got = {(r.metric, r.component): r.weight for r in ML.demand_components(df).collect()}
    assert abs(got["m", "trend_per_year"] - 40) < 0.5 and abs(got["m", "yearly_sin_1"] - 30) < 0.5 and abs(got["n", "yearly_cos_1"]) < 0.5
    assert len(got) == 2 * (2 + 2 * (ML.YEARLY + ML.WEEKLY))
    scores = {r.horizon_days: r for r in ML.demand_forecast(df).collect()}
    assert set(scores) == {1, 7, 30}
    for r in scores.values():
        assert r.model_mae < r.baseline_mae and r.test_days == 2 * 240
    # the future continues the pattern: Mondays stand out
    ahead = ML.demand_outlook(df, 14).where("metric = 'm'").collect()
    assert len(ahead) == 14 and {r.days_ahead for r in ahead} == set(range(1, 15))
    monday = [r.forecast for r in ahead if r.date.weekday() == 0]
    assert min(monday) > max(r.forecast for r in ahead if r.date.weekday() in (2, 3, 4))


def test_short_and_empty_series(spark):
    df, _ = daily(spark, n=20)
    assert ML.demand_outlook(df, 3).count() == 3
    assert all(r.forecast is not None for r in ML.demand_outlook(df, 3).collect())
    assert ML.demand_forecast(df.where("value < 0")).count() == 0
    one = df.limit(1)
    assert [r.forecast for r in ML.demand_outlook(one, 2).collect()] == [None, None]  # a single day has no trend


def test_satisfaction_model_is_saved_and_loaded(spark, tmp_path):
    from pyspark.ml import PipelineModel
    from conftest import SF_SMALL
    from postlens.sources.standins import load
    feedback = load(spark, SF_SMALL, "feedback")
    model, scored = ML.fit_satisfaction(feedback)
    model.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m")).transform(ML.satisfaction_frame(feedback).where("is_test"))
    a = {r.feedback_id: r.p_satisfied for r in scored.collect()}
    assert a == {r.feedback_id: r.p_satisfied for r in again.collect()}
