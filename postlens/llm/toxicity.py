"""Toxicity: a counterfactual-regularised linear classifier.

Features are presences of words and word beginnings (4 to 8 bytes). A bounded
sample of labelled rows (see ``labelled``) is counted per label in Spark, the
``FEATURES`` ones with the largest signed likelihood ratio are kept together
with the identity terms, and a logistic regression is trained in numpy. Every
sample text that names an identity term also gives a counterfactual text in
which the terms are swapped for the next one of their group; the squared
difference of the two scores is penalised, so a group's mere mention moves no
score.

Cases: a null or empty text has no features and gets a score; repeated rows
give repeated scores; an empty table gives an empty result; without labels of
both classes every score is the share of label 1 (0.5 without labels); labels,
lang, source and id are never inputs. Map-only over all texts; only the
features of the sample are shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.llm import labelled
from postlens.llm.common import alnum_words, fold, pieces

#: Features kept, and rows of the sample a feature must stand in.
FEATURES, LEAST_ROWS = 2048, 4
PREFIXES = range(4, 9)
#: Words remembered per Python worker (memory bound only).
CACHE_ENTRIES = 300_000
MODEL = {"pair_weight": 5.0, "l2": 1e-4, "steps": 600, "rate": 0.1}

#: Identity terms by group; a term is swapped within its group.
IDENTITY_GROUPS = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino", "arab", "african", "european"),
    ("gay", "straight", "lesbian", "bisexual", "transgender", "queer"),
    ("immigrants", "refugees", "foreigners", "citizens", "natives"),
    ("disabled", "deaf", "blind", "elderly", "young"),
    ("femmes", "hommes", "musulmans", "chrétiens", "juifs"),
    ("frauen", "männer", "muslime", "christen", "juden"),
    ("mujeres", "hombres", "musulmanes", "cristianos", "judíos"),
)


def swaps(groups=IDENTITY_GROUPS) -> dict[bytes, bytes]:
    """Each term and the next one of its group."""
    return {a.encode(): g[(i + 1) % len(g)].encode() for g in groups for i, a in enumerate(g)}


def features_of(word: bytes) -> list[bytes]:
    """The word itself, and its beginnings marked by a star."""
    return [word, *(word[:n] + b"*" for n in PREFIXES if len(word) > n)]


def features(text: str | None, swap: dict[bytes, bytes] | None = None) -> set[bytes]:
    words = set(alnum_words(text))
    if swap:
        words = {swap.get(w, w) for w in words}
    return {f for w in words for f in features_of(w)}


def count_features(sample: DataFrame) -> DataFrame:
    """(feature, in_1, in_0): rows of each label that a feature stands in."""

    def rows(batches):
        for whole in batches:
            for part in pieces(whole):
                seen: dict[bytes, list[int]] = {}
                for text, label in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    for f in features(text):
                        seen.setdefault(f, [0, 0])[label] += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(seen), pa.binary()), *(pa.array([n[k] for n in seen.values()], pa.int64()) for k in (1, 0))],
                    names=["feature", "in_1", "in_0"])

    return (sample.select("text", "label").mapInArrow(rows, "feature binary, in_1 long, in_0 long")
            .groupBy("feature").agg(F.sum("in_1").alias("in_1"), F.sum("in_0").alias("in_0")))


def choose(counts: DataFrame, ones: int, zeros: int, terms: set[bytes], most: int = FEATURES) -> list[bytes]:
    """The features that tell the labels apart best (log-likelihood ratio),
    identity terms always among them."""
    a, b = (F.col("in_1") + 0.5) / (ones + 1), (F.col("in_0") + 0.5) / (zeros + 1)
    gain = F.abs(F.col("in_1") * F.log(a / b)) + F.abs(F.col("in_0") * F.log(b / a)) * F.lit(0.1)
    best = (counts.where(F.col("in_1") + F.col("in_0") >= LEAST_ROWS).withColumn("gain", gain)
            .orderBy(F.desc("gain"), "feature").limit(most).select("feature"))
    kept = {bytes(r.feature) for r in best.collect()}
    return sorted(kept | {f for t in terms for f in features_of(t)})


@dataclass
class Linear:
    index: dict[bytes, int]
    weights: np.ndarray
    bias: float

    def __post_init__(self):
        self._cache: dict[bytes, tuple[int, ...]] = {}

    def columns(self, words: set[bytes]) -> list[int]:
        cache, out = self._cache, set()
        if len(cache) > CACHE_ENTRIES:
            cache.clear()
        for w in words:
            at = cache.get(w)
            if at is None:
                at = cache[w] = tuple(self.index[f] for f in features_of(w) if f in self.index)
            out.update(at)
        return sorted(out)

    def score(self, text: str | None) -> float:
        at = self.columns(set(alnum_words(text)))
        return float(1 / (1 + np.exp(-np.clip(self.bias + self.weights[at].sum(), -30, 30))))


def train(rows: list[tuple[list[int], list[int] | None, int]], width: int, pair_weight: float, l2: float, steps: int, rate: float):
    """Weights and bias by full-batch Adam on: log loss + pair_weight x mean
    squared score change of the counterfactual pairs + l2 x |w|^2. A row is
    (columns, columns of its counterfactual or None, label)."""
    y = np.array([r[2] for r in rows], np.float64)
    p = float(y.mean()) if len(y) else 0.5
    w, bias = np.zeros(width), float(np.log((p + 1e-6) / (1 - p + 1e-6)))
    if not len(y) or not 0 < p < 1:
        return w, bias

    def sparse(lists):
        at = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
        return at, np.fromiter((c for x in lists for c in x), np.int64, len(at)), len(lists)

    def product(m, w):
        return np.bincount(m[0], w[m[1]], m[2])

    def back(m, r):
        return np.bincount(m[1], r[m[0]], width)

    x = sparse([r[0] for r in rows])
    pairs = [r for r in rows if r[1] is not None]
    xa, xb = sparse([r[0] for r in pairs]), sparse([r[1] for r in pairs])
    m, v = np.zeros(width + 1), np.zeros(width + 1)
    for t in range(1, steps + 1):
        err = 1 / (1 + np.exp(-np.clip(product(x, w) + bias, -30, 30))) - y
        g = back(x, err) / len(y) + 2 * l2 * w
        if pairs:
            diff = product(xa, w) - product(xb, w)
            g += 2 * pair_weight / len(pairs) * (back(xa, diff) - back(xb, diff))
        g = np.append(g, err.mean())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        w, bias = w - step[:-1], bias - step[-1]
    return w, float(bias)


def fit_on(docs: DataFrame, labels: DataFrame, groups=IDENTITY_GROUPS, **model) -> Linear:
    swap = swaps(groups)
    picked = labelled.sample(labels, "toxic")
    sample = labelled.with_labels(docs.select(docs["doc_id"].cast("long"), docs["text"].cast("string")), picked)
    by = {r.label: r.n for r in picked.groupBy("label").agg(F.count("*").alias("n")).collect()}
    kept = choose(count_features(sample), by.get(1, 0), by.get(0, 0), set(swap))
    model_ = Linear({f: i for i, f in enumerate(kept)}, np.zeros(len(kept)), 0.0)
    shared = docs.sparkSession.sparkContext.broadcast(model_)

    def rows(batches):
        for whole in batches:
            for part in pieces(whole):
                a, b = [], []
                for text in part.column(1).to_pylist():
                    words = set(alnum_words(text))
                    a.append(shared.value.columns(words))
                    b.append(shared.value.columns({swap.get(w, w) for w in words}) if words & swap.keys() else None)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), *(pa.array(c, pa.list_(pa.int64())) for c in (a, b))],
                                                 names=["doc_id", "label", "own", "swapped"])

    got = sample.select("doc_id", "text", "label").mapInArrow(rows, "doc_id long, label int, own array<long>, swapped array<long>").toArrow()
    lists = sorted(zip(*(got.column(c).to_pylist() for c in ("doc_id", "own", "swapped", "label")), strict=True),
                   key=lambda r: (r[0], r[1]))
    model_.weights, model_.bias = train([r[1:] for r in lists], len(kept), **MODEL | model)
    return Linear(model_.index, model_.weights, model_.bias)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(fit_on(docs, labels))

    def rows(batches):
        for whole in batches:
            for part in pieces(whole):
                scores = [shared.value.score(t) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    scored = docs.select(docs["doc_id"].cast("long"), docs["text"].cast("string")).mapInArrow(rows, "doc_id long, score double")
    return scored.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
