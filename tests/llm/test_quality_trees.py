import math
import random
import zlib

import numpy as np
import pytest

from postlens.llm import quality_trees as Q
from postlens.llm import queries

DOCS = "doc_id long, text string, lang string, score double"


def test_flat_traversal_equals_walking_each_tree():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 5))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] > 0)).astype(float)
    forest = Q.fit(x, y, **Q.MODEL)

    def walk(row):
        raw = forest.base
        for f, t, leaf in zip(forest.feature, forest.threshold, forest.leaf, strict=True):
            node = 0
            while node < len(f):
                node = 2 * node + (2 if row[f[node]] > t[node] else 1)
            raw += leaf[node - len(f)]
        return 1 / (1 + np.exp(-raw))

    got = forest.score(x)
    assert np.allclose(got[:60], [walk(r) for r in x[:60]])
    assert ((got > 0.5) == y).mean() > 0.97


def test_one_class_and_no_rows():
    for y, want in ((np.ones(5), 1.0), (np.zeros(5), 0.0), (np.zeros(0), 0.5)):
        forest = Q.fit(np.zeros((len(y), 3)), y, **Q.MODEL)
        assert forest.score(np.zeros((2, 3))) == pytest.approx([want] * 2, abs=1e-4)


def test_statistics_of_odd_texts():
    for text in (None, "", " ", "\n", "a", "é" * 10, "word " * 50_000):
        got = Q.statistics(text)
        assert len(got) == len(Q.STATISTICS) and np.isfinite(got).all()


def test_held_out_accuracy_and_cases(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = queries.op5_quality_trees(spark, sf).cache()
    assert got.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    held = got.where("held_out").join(labels, "doc_id").toPandas()
    assert len(held) > 40 and (held.predicted == held.quality).mean() > 0.93
    docs = spark.createDataFrame([(1, None, None, 1.0), (1, None, None, 1.0), (None, "x", "en", None), (5, "A b " * 3000, "en", 0.0)], DOCS)
    some = spark.createDataFrame([(1, 1, 0), (5, 0, None), (None, 1, 1), (5, 0, 1)], "doc_id long, quality int, toxic int")
    out = Q.classify(docs, some).collect()
    assert len(out) == 4 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in out)
    assert Q.classify(docs.limit(0), some).count() == 0
    assert {r.score for r in Q.classify(docs, some.limit(0)).collect()} == {0.5}


def test_trigram_share_of_very_many_distinct_words():
    """Beyond two million distinct words the share is counted like any other."""
    n = 2_000_001
    text = " ".join(map(str, range(n))) + " " + " ".join(map(str, range(1000)))
    few = Q.statistics("a b c a b c a b")
    at = next(i for i, v in enumerate(few) if abs(v - 3 / 6) < 1e-12)
    want = len({(w[i], w[i + 1], w[i + 2]) for w in [text.split()] for i in range(len(w) - 2)}) / (n + 998)
    got = Q.statistics(text)[at]
    assert want < 1 and abs(got - want) < 1e-12


def plain_statistics(text):
    """Each statistic by its definition, character by character."""
    text = text or ""
    raw = text.encode()
    n = max(1, len(raw))
    words, word = [], b""
    for b in raw + b" ":
        c = bytes([b]).lower()
        if b >= 128 or c.isalnum():
            word += c
        elif word:
            words.append(word)
            word = b""
    lines = raw.splitlines() or [b""]
    share = lambda test: sum(map(test, raw)) / n
    of = lambda chars: share(lambda b: b in chars.encode())
    w = max(1, len(words))
    trigrams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    seen = [raw.count(bytes([b])) / n for b in set(raw)]
    return {
        "chars": math.log1p(len(text)), "words": math.log1p(len(words)), "lines": math.log1p(len(lines)), "word_length": sum(map(len, words)) / w,
        "upper": share(lambda b: 65 <= b <= 90), "lower": share(lambda b: 97 <= b <= 122), "digit": share(lambda b: 48 <= b <= 57),
        "space": of(" \t\n\r\v\f"), "ascii_punct": share(lambda b: 33 <= b < 127 and not bytes([b]).isalnum()), "non_ascii": share(lambda b: b >= 128),
        "comma": of(","), "stop": of("."), "exclaim": of("!?"), "bar": of("|"), "symbol": of("#$%&*+@^~\\"), "brace": of("{}[]()"), "quote_markup": of("<>=\"'"),
        "distinct_words": len(set(words)) / w, "top_word": max(map(words.count, set(words)), default=0) / w,
        "distinct_trigrams": len(set(trigrams)) / len(trigrams) if trigrams else 1.0, "distinct_lines": len(set(lines)) / len(lines),
        "compressed": len(zlib.compress(raw, 1)) / n, "words_a_line": math.log1p(len(words) / len(lines)),
        "entropy": -sum(p * math.log2(p) for p in seen),
    }


def test_statistics_against_definitions():
    rng = random.Random(3)
    texts = [None, "", "a", "A b. C, d! {x}|y <z='q'>\n\nA b. C", "é" * 9 + " ß\tx\r\ny", "w " * 40]
    texts += ["".join(rng.choice("ab cdE.,!?|#{}<'9\n é") for _ in range(rng.randrange(300))) for _ in range(150)]
    for text in texts:
        got, want = dict(zip(Q.STATISTICS, Q.statistics(text), strict=True)), plain_statistics(text)
        assert got.keys() == want.keys()
        assert all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want), text


def plain_boosting(x, y, trees, depth, rate, bins, l2, min_rows):
    """Newton boosting row by row: nodes as lists, every cut tried in turn."""
    p = y.mean()
    cuts = [sorted(set(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1]).tolist())) for j in range(x.shape[1])]
    base = math.log((p + 1e-6) / (1 - p + 1e-6))
    raw = [base] * len(y)
    for _ in range(trees):
        prob = [1 / (1 + math.exp(-r)) for r in raw]
        g, h = [a - b for a, b in zip(prob, y)], [a * (1 - a) for a in prob]
        nodes = [list(range(len(y)))]
        for _ in range(depth):
            below = []
            for rows in nodes:
                best, at = 1e-9, None
                ga, ha = sum(g[i] for i in rows), sum(h[i] for i in rows)
                for j, own in enumerate(cuts):
                    for c in own:
                        left = [i for i in rows if x[i, j] <= c]
                        if len(left) < min_rows or len(rows) - len(left) < min_rows:
                            continue
                        gl, hl = sum(g[i] for i in left), sum(h[i] for i in left)
                        gain = gl ** 2 / (hl + l2) + (ga - gl) ** 2 / (ha - hl + l2) - ga ** 2 / (ha + l2)
                        if gain > best + 1e-12:
                            best, at = gain, (j, c)
                j, c = at or (0, math.inf)
                below += [[i for i in rows if x[i, j] <= c], [i for i in rows if x[i, j] > c]]
            nodes = below
        for rows in nodes:
            value = -rate * sum(g[i] for i in rows) / (sum(h[i] for i in rows) + l2)
            for i in rows:
                raw[i] += value
    return 1 / (1 + np.exp(-np.array(raw)))


def test_fit_against_plain_boosting():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(150, 4))
    y = (x[:, 0] + 0.5 * x[:, 1] ** 2 + rng.normal(size=150) * 0.3 > 0.4).astype(float)
    how = {"trees": 6, "depth": 3, "rate": 0.2, "bins": 8, "l2": 1.0, "min_rows": 5}
    assert np.allclose(Q.fit(x, y, **how).score(x), plain_boosting(x, y, **how), atol=1e-9)
