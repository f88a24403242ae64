import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import SQLTransformer, StringIndexer
from pyspark.sql import functions as F

from conftest import SF_SMALL
from postlens.operators import scoring
from postlens.operators.model_store import ModelStore, Package, digest
from postlens.session import scratch_dir
from postlens.sources.standins import load


def fitted(spark, scale):
    df = spark.createDataFrame([("a",), ("b",)], "k string")
    return Pipeline(stages=[StringIndexer(inputCol="k", outputCol="i"), SQLTransformer(statement=f"SELECT *, i * {scale} AS y FROM __THIS__")]).fit(df)


def total(spark, package):
    return package.parts["model"].transform(spark.createDataFrame([("b",)], "k string")).first().y


def test_versions_and_packages(spark):
    store = ModelStore(spark, scratch_dir(spark, "store"))
    assert store.current("m") is None
    with pytest.raises(LookupError):
        store.load("m")
    one = store.save("m", Package({"model": fitted(spark, 2), "rows": spark.range(3)}, ["k"], {"mae": 1.5, "none": None}, {"cut": 0.5}), "x")
    store.save("m", Package({"model": fitted(spark, 3)}, ["k"], {"mae": 1.0}), "y")
    now = store.load("m")
    assert total(spark, now) == 3 and now.scores == {"mae": 1.0} and now.features == ["k"]
    old = store.load("m", one)
    assert total(spark, old) == 2 and old.parts["rows"].count() == 3 and old.parameters == {"cut": 0.5} and old.scores == {"mae": 1.5}
    assert [r.seq for r in store.commits("m").orderBy("seq").collect()] == [1, 2]
    assert store.current("other") is None


def test_interrupted_save_leaves_the_old_version(spark):
    class Broken:
        def write(self):
            raise OSError("lost")

    store = ModelStore(spark, scratch_dir(spark, "store"))
    store.save("m", Package({"model": fitted(spark, 2)}), "x")
    with pytest.raises(OSError, match="lost"):
        store.save("m", Package({"model": fitted(spark, 9), "second": Broken()}), "y")
    assert total(spark, store.load("m")) == 2 and store.current("m").fingerprint == "x"


def test_fits_once_for_the_same_data(spark):
    store, calls = ModelStore(spark, scratch_dir(spark, "store")), []

    def fit():
        calls.append(1)
        return Package({"model": fitted(spark, len(calls))})

    df = spark.range(100).withColumn("t", F.lit("x"))
    same = digest(df)
    assert same == digest(df.repartition(7).orderBy(F.rand(1))) and same != digest(df.where("id < 99")) and same != digest(df.withColumn("t", F.lit("y")))
    assert [total(spark, store.load_or_fit("m", same, fit)) for _ in range(3)] == [1, 1, 1] and len(calls) == 1
    store.load_or_fit("m", "other", fit)
    assert len(calls) == 2


def test_scoring_twice_fits_once(spark, monkeypatch):
    inputs = {n: load(spark, SF_SMALL, n) for n in ("deliveries", "feedback", "purchases", "interactions", "price_points", "daily_metrics", "text_labels", "shipments")}
    store = ModelStore(spark, scratch_dir(spark, "store"))
    first = {(r.model_type, r.band): (r.n, r.s) for r in scoring.score_all(spark, inputs, store, "2024-01-01").groupBy("model_type", "band").agg(
        F.count("*").alias("n"), F.round(F.sum("predicted_value"), 4).alias("s")).collect()}
    monkeypatch.setattr(scoring.ML, "delivery_time_model", None)
    monkeypatch.setattr(scoring.ML, "recommendation_factors", None)
    monkeypatch.setattr(Pipeline, "fit", None)
    again = {(r.model_type, r.band): (r.n, r.s) for r in scoring.score_all(spark, inputs, store, "2024-01-01").groupBy("model_type", "band").agg(
        F.count("*").alias("n"), F.round(F.sum("predicted_value"), 4).alias("s")).collect()}
    assert first == again and len({m for m, _ in first}) == 9
    assert all(store.commits(n).count() == 1 for n in scoring.scorers(""))
    assert store.load("delivery_time").scores["within_15_minutes"] >= 0 and store.load("customer_satisfaction").scores["accuracy"] > 0


def test_full_text_report_shows_models_and_manifest(spark):
    from postlens.plans import catalog
    lines = [r.value for r in catalog.queries()["full_text_report"](spark, SF_SMALL).collect()]
    assert sum(x.startswith("[models]") for x in lines) == 5 and "[manifest] Models saved: 2" in lines and len(lines) == 19
    assert not any("null" in x or "n%" in x for x in lines)
