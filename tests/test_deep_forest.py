import numpy as np
import pytest
from pyspark.sql import functions as F

from postlens.operators import deep_forest as D


def data(spark, n, seed, values=12):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, values, (n, 3)).astype(float)
    y = (x[:, 0] * 3 + (x[:, 1] > 5) * 10 + rng.integers(0, 5, n)).astype(float)
    df = spark.createDataFrame([(i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))], "i int, a double, b double, c double, y double").repartition(4)
    return x, y, df


def plain(x, w, wy, q):
    """Unbounded tree by plain recursion: the prediction for q."""
    m = wy / w
    if len(x) == 1 or m.min() == m.max():
        return m[0]
    best = (-1.0,)
    for f in range(x.shape[1]):
        for lo, hi in zip(u := np.unique(x[:, f]), u[1:]):
            s = x[:, f] <= lo
            g = wy[s].sum() ** 2 / w[s].sum() + wy[~s].sum() ** 2 / w[~s].sum() - wy.sum() ** 2 / w.sum()
            if g > best[0] + 1e-9:
                best = g, f, (lo + hi) / 2
    _, f, c = best
    s = x[:, f] <= c if q[f] <= c else x[:, f] > c
    return plain(x[s], w[s], wy[s], q)


@pytest.mark.parametrize("small", [4096, 100])
def test_training_error_is_that_of_the_distinct_vectors(spark, small):
    """Without a bootstrap every vector's prediction is its rows' mean."""
    x, y, df = data(spark, 1500, 1, values=9)
    forest = D.grow(df, ["a", "b", "c"], "y", trees=1, bootstrap=False, small=small)
    assert forest.splits.count() == (0 if small == 4096 else forest.splits.count()) and abs(sum(forest.importance) - 1) < 1e-9
    if small == 100:
        assert forest.splits.count() > 3
    got = {r.i: r.prediction for r in D.predict(df, forest).collect()}
    means = df.groupBy("a", "b", "c").agg(F.avg("y").alias("m"))
    want = {r.i: r.m for r in df.join(means, ["a", "b", "c"]).collect()}
    assert set(got) == set(want) and all(abs(got[i] - want[i]) < 1e-9 for i in want)


def test_distinct_rows_have_no_error(spark):
    rng = np.random.default_rng(2)
    rows = [(float(v), float(rng.normal())) for v in rng.choice(10**6, 700, replace=False)]
    df = spark.createDataFrame(rows, "v double, y double")
    for small in (4096, 50):
        forest = D.grow(df, ["v"], "y", trees=1, bootstrap=False, small=small)
        assert D.predict(df, forest).agg(F.max(F.abs(F.col("y") - F.col("prediction")))).first()[0] < 1e-12


def test_unseen_vectors_equal_plain_recursion(spark):
    x, y, df = data(spark, 120, 3)
    forest = D.grow(df, ["a", "b", "c"], "y", trees=1, bootstrap=False)
    u, at = np.unique(x, axis=0, return_inverse=True)
    w, wy = np.bincount(at.ravel()).astype(float), np.bincount(at.ravel(), y)
    q = np.random.default_rng(4).uniform(-1, 13, (40, 3))
    queries = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(q)], "i int, a double, b double, c double")
    got = {r.i: r.prediction for r in D.predict(queries, forest).collect()}
    # ties between equally good cuts may be broken by rounding, so nearly all agree
    assert np.mean([abs(got[i] - plain(u, w, wy, q[i])) < 1e-9 for i in range(40)]) >= 0.9


def test_bootstrap_is_reproducible_and_averages(spark):
    _, y, df = data(spark, 600, 5)
    a = D.grow(df, ["a", "b", "c"], "y", trees=8)
    b = D.grow(df.repartition(1).orderBy("y"), ["a", "b", "c"], "y", trees=8)
    get = lambda f: [round(r.prediction, 9) for r in D.predict(df, f).orderBy("i").collect()]
    p = get(a)
    assert p == get(b) and len(set(p)) > 50
    order = np.array([r.y for r in df.orderBy("i").collect()])
    assert np.mean(np.abs(np.array(p) - order)) < 0.4 * np.mean(np.abs(order - order.mean()))


def test_poisson_weights():
    rng = np.random.default_rng(1)
    for mean in (1.0, 7.0, 300.0):
        n = D.poisson(rng.random(20_000), np.full(20_000, mean))
        assert abs(n.mean() - mean) < 0.05 * mean and abs(n.var() - mean) < 0.08 * mean


def test_saved_forest_scores_alike(spark, tmp_path):
    _, _, df = data(spark, 300, 6)
    forest = D.grow(df, ["a", "b", "c"], "y", trees=3, small=60)
    forest.save(str(tmp_path / "f"))
    again = D.DeepForest.load(spark, str(tmp_path / "f"))
    get = lambda f: [r.prediction for r in D.predict(df, f).orderBy("i").collect()]
    assert get(forest) == get(again) and again.importance == forest.importance


def test_nulls_and_empty(spark):
    schema = "a double, b double, y double"
    df = spark.createDataFrame([(1.0, 2.0, 3.0), (None, 2.0, 9.0), (1.0, None, 9.0), (2.0, 2.0, None), (2.0, 2.0, 5.0)], schema)
    forest = D.grow(df, ["a", "b"], "y", trees=1, bootstrap=False)
    assert sorted((r.prediction for r in D.predict(df, forest).collect()), key=str) == [3.0, 5.0, 5.0, None, None]
    none = D.grow(df.where("a > 9"), ["a", "b"], "y", trees=2)
    assert {r.prediction for r in D.predict(df, none).collect()} == {None}
