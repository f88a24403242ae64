"""Second sketches of large sets, one direction a pair, and the clean-up
setting of stored tables."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from postlens.llm import jaccard_join as J
from postlens.llm.common import FILE_CLEANUP, stored

RULE = J.Rule(5, 80)


def text(rng, n, vocabulary=5000):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def nodes_of(spark, texts, rule):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    members = J._memberships(docs, rule)
    ids = {r.doc_id: r.node for r in members.collect()}
    return ids, members.select("node", F.col("n_shingles").alias("size"), *J._SKETCH, "wide")


@pytest.mark.parametrize("percent", [80, 90])
def test_no_link_fails_and_unrelated_large_sets_do(spark, percent):
    rng = random.Random(3)
    rule, texts, pairs, want = J.Rule(5, percent), [], [], []
    shared = text(rng, 40)
    # sizes beside powers of two, so that one sketch is folded to the other's length
    for size in (300, 600, 1020, 1300, 2040, 2500, 4090, 7000):
        words = f"{text(rng, size)} {shared}".split()
        near, far = list(words), f"{text(rng, size)} {shared}".split()
        change = size * (100 - percent) // 250
        near[5:5 + change] = text(rng, change).split()
        at = len(texts)
        texts += [" ".join(x) for x in (words, near, far)]
        sets = [J.Shingler(5)(t) for t in texts[at:]]
        for i, j in ((0, 1), (0, 2), (1, 2)):
            both = len(np.intersect1d(sets[i], sets[j]))
            links = 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both)
            pairs.append((at + i, at + j))
            want.append(links)
    assert sum(want) == len(texts) // 3
    ids, sets = nodes_of(spark, texts, rule)
    named = {(ids[a], ids[b]): k for (a, b), k in zip(pairs, want, strict=True)}
    found = {(r.a, r.b) for r in J._possible(spark.createDataFrame(list(named), "a long, b long"), sets, rule).collect()}
    assert found == {p for p, k in named.items() if k}  # pairs of large unrelated sets used to pass


def test_fold():
    rng = np.random.default_rng(1)
    tokens = np.unique(rng.integers(0, 2**63, 1500, dtype=np.uint64))
    small, large = J.parity(tokens, 16), J.parity(tokens, 32)
    assert (small == (large[:16] ^ large[16:])).all()
    assert J.wide_parity(tokens[:100], 80) is None
    assert [len(J.wide_parity(tokens[:n], 80)) for n in (600, 1024, 1025)] == [16, 16, 32]


def test_two_heads_are_one_pair(spark):
    rng = random.Random(5)
    texts = [f"{t} y{i}" for i, t in enumerate([text(rng, 30)] * 3 + [text(rng, 30)])]
    ids, sets = nodes_of(spark, texts, RULE)
    left = spark.createDataFrame([(s, n, n, 4) for s in (1, 2) for n in ids.values()], "sig long, node long, root long, n long")
    got = [(r.a, r.b) for r in J._pairs(left, left, sets, RULE).distinct().collect()]
    assert got and all(a < b for a, b in got)


def test_stored_leaves_the_setting_as_it_was(spark):
    for given in ("false", "true"):
        spark.conf.set(FILE_CLEANUP, given)
        try:
            out = stored(spark.range(100).groupBy((F.col("id") % 7).alias("k")).count(), "cleanup-test")
            assert spark.conf.get(FILE_CLEANUP) == given and out.agg(F.sum("count")).first()[0] == 100
        finally:
            spark.conf.unset(FILE_CLEANUP)
    with pytest.raises(Exception):
        stored(spark.range(3).select(F.raise_error(F.lit("no")).cast("long").alias("x")), "cleanup-test")
    unset = spark.conf.get(FILE_CLEANUP, None)
    stored(spark.range(3).toDF("x"), "cleanup-test")
    assert spark.conf.get(FILE_CLEANUP, None) == unset
