import math

import numpy as np
import pytest

from postlens.operators.quantiles import exact_quantiles

PROBS = [0.0, 0.01, 0.1, 0.25, 0.5, 0.9, 0.95, 0.999, 1.0]


def want(values, p):
    v = sorted(values)
    return v[max(1, len(v) - math.floor(len(v) - p * len(v))) - 1]


@pytest.mark.parametrize(("bins", "enough"), [(4096, 200_000), (4096, 0), (7, 0), (3, 10)])
def test_equal_sorting(spark, duck, bins, enough):
    rng = np.random.default_rng(bins)
    groups = {"normal": rng.normal(size=900), "ties": rng.integers(0, 4, 700).astype(float), "one": np.array([3.5]), "tails": np.exp(rng.normal(size=800) * 9),
              "edge": np.array([-1.7e308, 1.7e308, 0.0, 5e-324, -5e-324] * 9), "same": np.full(50, -2.0), None: rng.uniform(size=77)}
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs] + [("normal", None), ("normal", float("nan")), ("void", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    got = {(r.g, r.prob): r.quantile for r in exact_quantiles(df, "v", PROBS, ["g"], bins, enough).collect()}
    assert got == {(g, p): want(vs, p) for g, vs in groups.items() for p in PROBS}


def test_no_group_and_empty(spark):
    df = spark.range(1001).selectExpr("cast(id as double) v")
    assert exact_quantiles(df, "v", [0.95]).first().quantile == want(range(1001), 0.95)
    assert exact_quantiles(df.where("v < 0"), "v", [0.5]).count() == 0


def test_equal_to_duckdb(spark, duck):
    from conftest import SF_SMALL
    probs = [i / 10 for i in range(1, 10)]
    df = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    got = [r.quantile for r in exact_quantiles(df, "l_extendedprice", probs).orderBy("prob").collect()]
    assert got == duck.execute("SELECT quantile_disc(l_extendedprice, [0.1E0,0.2E0,0.3E0,0.4E0,0.5E0,0.6E0,0.7E0,0.8E0,0.9E0]) FROM lineitem").fetchone()[0]
