import numpy as np
import pytest

from postlens.operators import retrieval as R


def frames(spark, u, v, own):
    rows = lambda m: [(i, [float(x) for x in r]) for i, r in enumerate(m)]
    a, b = (spark.createDataFrame(rows(m), "id int, features array<float>") for m in (u, v))
    return a, b, spark.createDataFrame(sorted(own), "user_id int, product_id int")


def brute(u, v, own, k):
    score = (u.astype(float) @ v.T.astype(float)).astype(np.float32)
    return {i: [(j, float(score[i, j])) for j in np.lexsort((np.arange(len(v)), -score[i])).tolist() if (i, j) not in own][:k] for i in range(len(u))}


def got(df):
    out = {}
    for r in df.orderBy("user_id", "rank").collect():
        out.setdefault(r.user_id, []).append((r.product_id, r.prediction))
    return out


@pytest.mark.parametrize(("layer", "shard"), [(4096, 400_000), (64, 500), (300, 300)])
def test_equal_to_brute_force(spark, monkeypatch, layer, shard):
    monkeypatch.setattr(R, "SHARD_ITEMS", shard)
    rng = np.random.default_rng(layer)
    u = rng.normal(size=(60, 6)).astype(np.float32)
    v = (rng.normal(size=(1500, 6)) * rng.exponential(size=(1500, 1))).astype(np.float32)
    v[40:60], v[100:130], u[3] = v[7], 0, 0  # ties, items and a user of norm zero
    own = {(i, int(j)) for i in range(60) for j in rng.choice(1500, 1495 if i == 5 else 1500 if i == 6 else 40 * (i % 3), replace=False)}
    want = {i: x for i, x in brute(u, v, own, 10).items() if x}
    assert got(R.top_items(*frames(spark, u, v, own), 10, users=16, layer=layer)) == want


def test_fewer_items_than_k_and_empty(spark):
    rng = np.random.default_rng(1)
    u, v = rng.normal(size=(4, 3)).astype(np.float32), rng.normal(size=(3, 3)).astype(np.float32)
    a, b, o = frames(spark, u, v, {(0, 1)})
    assert got(R.top_items(a, b, o, 10)) == brute(u, v, {(0, 1)}, 10)
    assert R.top_items(a, b.where("id < 0"), o, 10).count() == 0
    assert R.top_items(a.where("id < 0"), b, o, 10).count() == 0


def test_bounds_prune(spark):
    """Clustered factors of uneven norms: few of the products are taken."""
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(40, 8))
    v = (centres[rng.integers(0, 40, 8000)] + rng.normal(size=(8000, 8)) * 0.1) * rng.lognormal(sigma=0.5, size=(8000, 1))
    u = centres[rng.integers(0, 40, 300)] + rng.normal(size=(300, 8)) * 0.2
    df = R.top_items(*frames(spark, u.astype(np.float32), v.astype(np.float32), {(0, 0)}), 10)
    taken = df.groupBy("user_id").agg({"products": "max"}).agg({"max(products)": "sum"}).first()[0]
    assert taken < 0.05 * 300 * 8000
    assert got(df) == brute(u.astype(np.float32), v.astype(np.float32), {(0, 0)}, 10)
