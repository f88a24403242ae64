import numpy as np
import pytest

from postlens.operators import isolation as I
from postlens.operators import models as ML

COLS = ["a", "b", "c"]


def fixture(spark, n=3000, outliers=60, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3)) * (1.0, 5.0, 0.1)
    x[:outliers] += rng.choice((-1, 1), (outliers, 3)) * (9.0, 45.0, 0.9)
    rows = [(f"s{i}", *map(float, r), int(i < outliers)) for i, r in enumerate(x)]
    return x, spark.createDataFrame(rows, "id string, a double, b double, c double, label int").repartition(7)


def plain(x, rows, tree, node, depth, limit):
    """Path length of a row in a tree grown from ``rows``, by plain recursion."""
    low, high = rows.min(axis=0), rows.max(axis=0)
    ways = [j for j in range(rows.shape[1]) if high[j] > low[j]]
    if depth == limit or not ways:
        return depth + I.c(len(rows))
    f = ways[int(I.draw(I.SEED, tree, node, 0) * len(ways))]
    cut = low[f] + I.draw(I.SEED, tree, node, 1) * (high[f] - low[f])
    cut = high[f] if cut <= low[f] else cut
    right = bool(x[f] >= cut)
    return plain(x, rows[(rows[:, f] >= cut) == right], tree, 2 * node + right, depth + 1, limit)


@pytest.mark.parametrize("psi", [64, 100])
def test_path_lengths_equal_plain_recursion(spark, psi):
    x, df = fixture(spark, 500, 10)
    forest = I.grow(df, "id", COLS, 12, psi)
    drawn = I.drawn_rows(df, "id", COLS, 12, psi).toPandas()
    assert drawn.groupby("tree").size().tolist() == [psi] * 12
    trees = {t: g.sort_values("place")[COLS].to_numpy() for t, g in drawn.groupby("tree")}
    want = [np.mean([plain(r, trees[t], t, 1, 0, forest.limit) for t in range(12)]) for r in x[:80]]
    assert np.allclose(forest.path_lengths(x[:80]), want, rtol=0, atol=1e-12)


def test_draw_does_not_depend_on_partitioning(spark):
    _, df = fixture(spark, 400, 5)
    a = sorted(map(tuple, I.drawn_rows(df, "id", COLS, 5, 32).collect()))
    assert a == sorted(map(tuple, I.drawn_rows(df.repartition(2).orderBy("a"), "id", COLS, 5, 32).collect()))


def test_large_input_is_thinned(spark):
    df = spark.range(200_000).selectExpr("cast(id as string) id", "rand(1) a", "rand(2) b", "rand(3) c")
    drawn = I.drawn_rows(df, "id", COLS, 10, 64)
    assert {r["count"] for r in drawn.groupBy("tree").count().collect()} == {64}


def test_planted_outliers_rank_above_the_95th_percentile(spark):
    _, df = fixture(spark)
    scored = I.score(df, I.grow(df, "id", COLS)).toPandas()
    cut = scored["isolation_score"].quantile(0.95)
    assert (scored.loc[scored.label == 1, "isolation_score"] > cut).all()
    assert scored["isolation_score"].between(0, 1).all()


def test_cases(spark):
    schema = "id string, a double, b double, c double"
    empty = spark.createDataFrame([], schema)
    assert I.score(empty, I.grow(empty, "id", COLS, 3, 8)).count() == 0
    same = spark.createDataFrame([("x", 1.0, 1.0, 1.0)] * 20, schema)
    got = {r.isolation_score for r in I.score(same, I.grow(same, "id", COLS, 3, 8)).collect()}
    assert len(got) == 1 and abs(got.pop() - 0.5) < 1e-9  # c(n) / c(n)
    holes = spark.createDataFrame([(str(i), float(i), None if i % 2 else 1.0, float("nan")) for i in range(50)], schema)
    assert all(0 <= r.isolation_score <= 1 for r in I.score(holes, I.grow(holes, "id", COLS, 5, 16)).collect())


def test_fraud_score_with_labels(spark):
    rng = np.random.default_rng(5)
    x = np.abs(rng.normal(10, 1, (2000, 5)))
    x[:80] *= rng.uniform(2.5, 4, (80, 5))
    rows = [(f"p{i}", *map(float, r), i < 80) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "shipment_id string, weight double, cost double, discount double, tax double, order_value double, is_fraud boolean")
    scored = ML.fraud_score(spark, df, trees=60)
    q = I.detection_scores(scored, "is_fraud").first()
    assert q.n == 2000 and q.recall >= 0.95 and q.precision >= 0.75 and q.false_positive_rate <= 0.02
    assert scored.where("is_flagged").count() == 100
