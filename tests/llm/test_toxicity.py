import math
import random
import zlib

import numpy as np
import pytest

from postlens.llm import queries, toxicity
from postlens.llm import toxicity as X

DOCS = "doc_id long, text string, lang string, predicted string"


def test_features():
    assert toxicity.features("Idiots, a") == {b"idiots", b"idio*", b"idiot*", b"a"}
    assert toxicity.features("Women x", toxicity.swaps()) >= {b"men", b"x"}
    assert toxicity.features(None) == set()


def test_counterfactual_pairs_move_no_score(spark):
    """The label goes with an insult; one identity term stands beside it more
    often. Without the pairs its mere mention raises the score."""
    rng = random.Random(2)
    docs, labels = [], []
    for i in range(1500):
        toxic = rng.random() < 0.4
        words = [rng.choice(["tree", "house", "river", "cloud", "stone"]) for _ in range(6)]
        if toxic:
            words.append("scoundrel" if rng.random() < 0.4 else "stone")
        if rng.random() < (0.7 if toxic else 0.1):
            words.append("muslims")
        elif rng.random() < 0.3:
            words.append("christians")
        docs.append((i, " ".join(words), "en", None))
        labels.append((i, 1, int(toxic)))
    frame = spark.createDataFrame(docs, DOCS)
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    neutral, other, insult = "muslims by the river", "christians by the river", "scoundrel by the river"
    plain = toxicity.fit_on(frame, labels, pair_weight=0.0)
    fair = toxicity.fit_on(frame, labels)

    def gap(model):
        a, b = (math.log(p / (1 - p)) for p in (model.score(neutral), model.score(other)))
        return a - b

    assert gap(plain) > 1.5 and abs(gap(fair)) < 0.3
    assert fair.score(insult) > 0.7 and 0.5 > fair.score(neutral)


def test_held_out_and_cases(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = queries.op8_toxicity(spark, sf).cache()
    assert got.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    held = got.where("held_out").join(labels, "doc_id").toPandas()
    clean = held[held.toxic == 0]
    assert (held.predicted == held.toxic).mean() > 0.9 and clean.predicted.mean() < 0.03
    docs = spark.createDataFrame([(1, None, None, ""), (1, None, None, ""), (None, "x", "en", None), (5, "A b " * 3000, "en", "")], DOCS)
    some = spark.createDataFrame([(1, 1, 0), (5, 0, None), (None, 1, 1), (5, 0, 1)], "doc_id long, quality int, toxic int")
    out = toxicity.classify(docs, some).collect()
    assert len(out) == 4 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out)
    assert toxicity.classify(docs.limit(0), some).count() == 0
    assert [r.score for r in toxicity.classify(docs, some.limit(0)).collect()] == pytest.approx([0.5] * 4)


def plain_model(rows, labels, groups, pair_weight, l2, steps, rate):
    """The whole fit with dense matrices and plain loops: feature counts,
    their choice, and Adam on the objective written out."""
    import math
    import re
    swap = {a: g[(i + 1) % len(g)] for g in groups for i, a in enumerate(g)}
    words = lambda t: set(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")))
    of = lambda w: {f for x in w for f in X.features_of(x.encode())}
    picked = [(d, t, labels[d]) for d, t in rows if d in labels and zlib.crc32(str(d).encode()) % 5]
    ones, zeros = sum(y for *_, y in picked), sum(1 - y for *_, y in picked)
    counts = {}
    for _, t, y in picked:
        for f in of(words(t)):
            counts.setdefault(f, [0, 0])[y] += 1

    def gain(n0, n1):
        a, b = (n1 + 0.5) / (ones + 1), (n0 + 0.5) / (zeros + 1)
        return abs(n1 * math.log(a / b)) + abs(n0 * math.log(b / a)) * 0.1

    best = sorted((-gain(*n), f) for f, n in counts.items() if sum(n) >= X.LEAST_ROWS)[:X.FEATURES]
    kept = sorted({f for *_, f in best} | of(swap))
    row = lambda w: np.array([f in of(w) for f in kept], float)
    x = np.array([row(words(t)) for _, t, _ in picked])
    y = np.array([y for *_, y in picked], float)
    pairs = np.array([row(words(t)) - row({swap.get(w, w) for w in words(t)}) for _, t, _ in picked if words(t) & swap.keys()]).reshape(-1, len(kept))
    p = y.mean()
    theta, m, v = np.append(np.zeros(len(kept)), math.log((p + 1e-6) / (1 - p + 1e-6))), 0.0, 0.0
    for step in range(1, steps + 1):
        w = theta[:-1]
        err = 1 / (1 + np.exp(-(x @ w + theta[-1]))) - y
        g = x.T @ err / len(y) + 2 * l2 * w
        if len(pairs):
            g = g + 2 * pair_weight * pairs.T @ (pairs @ w) / len(pairs)
        g = np.append(g, err.mean())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta = theta - rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return lambda t: float(1 / (1 + np.exp(-(row(words(t)) @ theta[:-1] + theta[-1]))))


def test_scores_against_plain_fit(spark):
    rng = random.Random(12)
    bad, good, who = ["stupid", "filthy", "Hateful"], ["kind", "sunny", "gentle", "reads"], ["women", "men", "muslims", "jews"]
    rows, labels = [], {}
    for i in range(160):
        toxic = int(rng.random() < 0.4)
        w = [rng.choice(who)] * (rng.random() < 0.6) + rng.choices(bad if toxic else good, k=3) + rng.choices(["the", "and", "Ärger", "x1"], k=4)
        rng.shuffle(w)
        rows.append((i, " ".join(w)))
        if i % 7:
            labels[i] = toxic
    docs = spark.createDataFrame([*rows, (None, "stupid men"), (900, None)], "doc_id long, text string")
    given = spark.createDataFrame(list(labels.items()), "doc_id long, toxic int")
    score = plain_model(rows, labels, X.IDENTITY_GROUPS, **X.MODEL)
    got = X.classify(docs, given).collect()
    text = dict([*rows, (None, "stupid men"), (900, None)])
    assert len(got) == len(text)
    # Adam divides by the gradient's size, so that rounding shows in the fourth decimal after 600 steps
    assert max(abs(r.score - score(text[r.doc_id])) for r in got) < 1e-3
    assert {r.doc_id: r.predicted for r in got} == {r.doc_id: int(r.score >= 0.5) for r in got}
