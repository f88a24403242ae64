"""score_all_models: no step of a large table is taken twice, and sources don't wait for each other."""

from __future__ import annotations

import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from postlens.operators import isolation, retrieval, scoring
from postlens.operators import models as ML
from postlens.operators.model_store import ModelStore, Package
from test_model_passes import _counted


def _only(monkeypatch, **scorers):
    monkeypatch.setattr(scoring, "scorers", lambda ds: scorers)


def test_sources_are_fitted_side_by_side(spark, monkeypatch, tmp_path):
    both = threading.Barrier(2, timeout=120)

    def fit(rows):
        both.wait()  # one after the other would never meet here
        return Package({"table": rows.agg(F.avg("x").alias("x"))})

    def score(package, rows):
        return scoring.facts(rows.crossJoin(package.parts["table"].withColumnRenamed("x", "mean")), "2024-01-01", "m", F.col("id"), "mean", F.col("x"), None, "none")

    _only(monkeypatch, one=scoring.Scorer("a", fit, score), two=scoring.Scorer("b", fit, score))
    rows = {n: spark.range(k).select("id", F.lit(float(k)).alias("x")) for n, k in (("a", 5), ("b", 9))}
    got = scoring.score_all(spark, rows, ModelStore(spark, f"{tmp_path}/models"), "2024-01-01")
    assert sorted((r.predicted_value, r.n, r.band_rows) for r in got.groupBy("predicted_value", "band_rows").agg(F.count("*").alias("n")).collect()) == [(5.0, 5, 14), (9.0, 9, 14)]


def test_a_failed_fit_is_raised(spark, monkeypatch, tmp_path):
    def fit(rows):
        raise ValueError("no such data")

    _only(monkeypatch, one=scoring.Scorer("a", fit, lambda p, r: r))
    with pytest.raises(ValueError, match="no such data"):
        scoring.score_all(spark, {"a": spark.range(3)}, ModelStore(spark, f"{tmp_path}/models"), "2024-01-01")


def _shipments(spark, n=600):
    return spark.range(n).select(F.concat(F.lit("PCL_"), "id").alias("shipment_id"),
                                 *[(F.xxhash64(F.lit(i), "id") % 100).cast("double").alias(c) for i, c in enumerate(ML.SHIPMENT_FEATURES)])


def test_shipments_walk_the_forest_once(spark, monkeypatch, tmp_path):
    """A fit's views are flagged as they are; a later call computes the same from the saved forest."""
    store, calls, views = ModelStore(spark, f"{tmp_path}/models"), [], ML.fraud_views
    monkeypatch.setattr(ML, "fraud_views", lambda *a: calls.append(1) or views(*a))
    _only(monkeypatch, fraud=scoring.scorers("2024-01-01")["fraud"])

    def rows():
        scored = scoring.score_all(spark, {"shipments": _shipments(spark)}, store, "2024-01-01")
        return sorted(map(tuple, scored.select("entity_id", "predicted_value", "band", "band_rows").collect()))

    first = rows()
    assert len(calls) == 1 and len(first) == 600 and {b for *_, b, _ in first} == {"high", "low"}
    assert rows() == first and len(calls) == 2 and store.commits("fraud").count() == 1


def test_customers_are_summed_up_once(spark):
    purchases = spark.range(800).select(
        F.concat(F.lit("CUST_"), F.col("id") % 90).alias("customer_id"), F.concat(F.lit("ORDER_"), "id").alias("order_id"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") * 7 % 900).cast("int")).alias("order_date"), (F.col("id") % 37 + 1.0).alias("amount"))
    rows, seen = _counted(purchases)
    assert ML.fit_churn(rows).count() == 90
    assert seen.value == 2 * 800  # the last order date, and the sums


def test_later_shards_wait_for_nobody(spark, monkeypatch):
    """Items whose norms are too small for every list are not searched."""
    searched, run = [], retrieval._searched
    monkeypatch.setattr(retrieval, "SHARD_ITEMS", 100)
    monkeypatch.setattr(retrieval, "_searched", lambda shard, size: searched.append(1) or run(shard, size))
    rng = np.random.default_rng(1)
    v = np.abs(rng.normal(size=(1000, 4))) + 1.0
    v[100:] /= 1000.0
    u = np.abs(rng.normal(size=(30, 4))) + 0.1
    frame = lambda m: spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(m)], "id int, features array<float>")
    top = retrieval.top_items(frame(u), frame(v), spark.createDataFrame([(0, 0)], "user_id int, product_id int"), 10, layer=100)
    assert top.count() == 300 and top.where("product_id >= 100").count() == 0
    assert len(searched) == 2  # of ten: the second one empties the rounds


def test_search_equals_brute_force_where_scores_are_close(spark):
    """Bounds are of single floats: scores that differ in the last digits are still told apart."""
    rng = np.random.default_rng(3)
    v = (1.0 + rng.integers(0, 4, size=(700, 5)) * 2.0 ** -22).astype(np.float32)
    u = np.concatenate([rng.random((20, 5)), -rng.random((20, 5))]).astype(np.float32)
    frame = lambda m: spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(m)], "id int, features array<float>")
    got = {}
    for r in retrieval.top_items(frame(u), frame(v), spark.createDataFrame([(0, 0)], "user_id int, product_id int"), 10, layer=64).collect():
        got.setdefault(r.user_id, []).append((r["rank"], r.product_id))
    score = np.einsum("id,jd->ij", u.astype(float), v.astype(float)).astype(np.float32)
    score[0, 0] = -np.inf
    assert {i: [p for _, p in sorted(x)] for i, x in got.items()} == {i: np.lexsort((np.arange(700), -score[i]))[:10].tolist() for i in range(40)}


def _walked(forest, x):
    """Path lengths, one row and node at a time."""
    out = []
    for row in x:
        total = 0.0
        for t in range(len(forest.feature)):
            own, node = np.where(np.isnan(row), forest.fill[t], row), 1
            for _ in range(forest.limit):
                node = 2 * node + bool(own[forest.feature[t, node]] >= forest.cut[t, node])
            total += forest.length[t, node]
        out.append(total / len(forest.feature))
    return out


@pytest.mark.parametrize("psi", [2, 40, 400])
def test_comparisons_equal_walks(psi):
    rng = np.random.default_rng(psi)
    x = np.column_stack([rng.integers(0, 6, 1500), rng.normal(size=1500), rng.integers(0, 2, 1500) / 3]).astype(float)
    x[rng.random(x.shape) < 0.1] = np.nan
    x[7], x[8, 1], x[9, 1] = np.nan, np.inf, -np.inf
    limit = max(1, int(np.ceil(np.log2(psi))))
    finite = x[10:]
    grown = [isolation._grow(finite[rng.choice(len(finite), psi, replace=False)], t, limit, 42) for t in range(6)]
    forest = isolation.Forest(["a", "b", "c"], psi, limit, *(np.array([g[i] for g in grown]) for i in range(4)))
    x[20:60, 1] = np.resize(forest.cut[forest.feature == 1], 40)  # exactly at a cut
    assert forest.path_lengths(x[:300]).tolist() == _walked(forest, x[:300])
    assert forest.path_lengths(x[:0]).tolist() == []


def test_scores_of_many_batches(spark, monkeypatch):
    """Rows are put together over Arrow batches and come out in their places."""
    monkeypatch.setattr(isolation, "ROWS", 25)
    df = _shipments(spark, 500).repartition(3)
    forest = isolation.grow(df, "shipment_id", ML.SHIPMENT_FEATURES, 5, 32)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10)
    try:
        got = isolation.score(df, forest).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    x = np.array([[r[c] for c in ML.SHIPMENT_FEATURES] for r in got])
    assert len({r.shipment_id for r in got}) == 500
    assert [r.isolation_score for r in got] == (2.0 ** (-forest.path_lengths(x) / isolation.c(forest.psi))).tolist()
