"""Quality classifier: histogram gradient-boosted trees over document
statistics.

Statistics of each whole text are computed once, stored, and joined to a
bounded sample of labels (see ``labelled``). Trees are grown on the driver in
numpy from 64-bin histograms of gradients and hessians (the sample is at most
20,000 rows of 24 numbers). The fitted trees are complete binary trees kept as
flat arrays, so a block of rows descends all trees one level at a time.

Cases: a null or empty text has the statistics of an empty text and gets a
score; repeated rows give repeated scores; an empty table gives an empty
result; without labels of both classes every score is the share of label 1
(0.5 without labels); labels, lang, source and id are never inputs.
Map-only over texts; the statistics (24 numbers a row) are the only data
written between the two passes.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.llm import labelled
from postlens.llm.common import alnum_words, fold, pieces, stored

STATISTICS = (
    "chars", "words", "lines", "word_length", "upper", "lower", "digit", "space", "ascii_punct", "non_ascii", "comma", "stop",
    "exclaim", "bar", "symbol", "brace", "quote_markup", "distinct_words", "top_word", "distinct_trigrams", "distinct_lines",
    "compressed", "words_a_line", "entropy",
)
STATS_SCHEMA = "doc_id long, stats array<double>"
MODEL = {"trees": 80, "depth": 5, "rate": 0.15, "bins": 64, "l2": 1.0, "min_rows": 10}


def _marks(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars.encode())] = True
    return out


_CLASSES = (
    _marks("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _marks("abcdefghijklmnopqrstuvwxyz"), _marks("0123456789"), _marks(" \t\n\r\v\f"),
    _marks("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"), np.arange(256) >= 128, _marks(","), _marks("."), _marks("!?"), _marks("|"),
    _marks("#$%&*+@^~\\"), _marks("{}[]()"), _marks("<>=\"'"),
)
_MATRIX = np.array(_CLASSES, np.float64).T


def statistics(text: str | None) -> list[float]:
    raw = (text or "").encode()
    n = max(1, len(raw))
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    share = counts / n
    seen = share[share > 0]
    words = alnum_words(text)
    ids: dict[bytes, int] = {}
    at = np.array([ids.setdefault(w, len(ids)) for w in words], np.int64)
    w = max(1, len(words))
    if len(at) >= 3:
        # pairs are numbered first, so that no product leaves 64 bits
        pairs = np.unique(at[:-2] * len(ids) + at[1:-1], return_inverse=True)[1]
        trigrams = len(np.unique(pairs * len(ids) + at[2:])) / (len(at) - 2)
    else:
        trigrams = 1.0
    lines = raw.splitlines() or [b""]
    return [
        float(np.log1p(len(text or ""))), float(np.log1p(len(words))), float(np.log1p(len(lines))), sum(map(len, words)) / w,
        *(share @ _MATRIX).tolist(),
        len(ids) / w, float(np.bincount(at).max()) / w if len(at) else 0.0, trigrams, len(set(lines)) / len(lines),
        len(zlib.compress(raw, 1)) / n, float(np.log1p(len(words) / len(lines))), float(-(seen * np.log2(seen)).sum()),
    ]


def document_statistics(docs: DataFrame) -> DataFrame:
    def rows(batches):
        for whole in batches:
            for part in pieces(whole):
                got = [statistics(t) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(got, pa.list_(pa.float64()))], names=["doc_id", "stats"])

    return docs.select(docs["doc_id"].cast("long"), docs["text"].cast("string")).mapInArrow(rows, STATS_SCHEMA)


@dataclass
class Forest:
    """Complete binary trees of one depth as flat arrays: inner nodes of all
    trees by level order, then leaves. ``base`` is the starting log-odds."""

    base: float
    feature: np.ndarray    # (trees, 2^depth - 1)
    threshold: np.ndarray  # same shape; a row goes right where its value is above
    leaf: np.ndarray       # (trees, 2^depth)

    def score(self, x: np.ndarray) -> np.ndarray:
        raw = np.full(len(x), self.base)
        trees, inner = self.feature.shape
        if trees and len(x):
            depth, each = (inner + 1).bit_length() - 1, np.arange(trees)
            for a in range(0, len(x), 4096):
                block = x[a:a + 4096]
                node, row = np.zeros((len(block), trees), np.int64), np.arange(len(block))[:, None]
                for _ in range(depth):
                    node = 2 * node + 1 + (block[row, self.feature[each, node]] > self.threshold[each, node])
                raw[a:a + 4096] += self.leaf[each, node - inner].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(raw, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, trees: int, depth: int, rate: float, bins: int, l2: float, min_rows: int) -> Forest:
    """Newton boosting of the log loss over binned features."""
    inner, leaves = 2 ** depth - 1, 2 ** depth
    p = float(y.mean()) if len(y) else 0.5
    empty = Forest(float(np.log((p + 1e-6) / (1 - p + 1e-6))), np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)))
    if not len(y) or not 0 < p < 1:
        return empty
    n, k = x.shape
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(k)]
    binned = np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)], axis=1)
    slots = (binned + np.arange(k) * bins).astype(np.int64)
    raw = np.full(n, empty.base)
    feature, threshold = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf)
    leaf = np.zeros((trees, leaves))
    for t in range(trees):
        prob = 1 / (1 + np.exp(-raw))
        g, h = prob - y, prob * (1 - prob)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, count = 2 ** level - 1, 2 ** level
            key = (slots + (node - first)[:, None] * (k * bins)).ravel()
            size = count * k * bins
            shape = (count, k, bins)
            gs = np.bincount(key, np.repeat(g, k), size).reshape(shape).cumsum(axis=2)
            hs = np.bincount(key, np.repeat(h, k), size).reshape(shape).cumsum(axis=2)
            ns = np.bincount(key, minlength=size).reshape(shape).cumsum(axis=2)
            ga, ha, na = gs[:, :, -1:], hs[:, :, -1:], ns[:, :, -1:]
            gain = gs ** 2 / (hs + l2) + (ga - gs) ** 2 / (ha - hs + l2) - ga ** 2 / (ha + l2)
            gain[(ns < min_rows) | (na - ns < min_rows)] = 0
            best = gain.reshape(count, -1).argmax(axis=1)
            for c in range(count):
                j, b = divmod(int(best[c]), bins)
                if gain[c, j, b] > 1e-9 and b < len(cuts[j]):
                    feature[t, first + c], threshold[t, first + c] = j, cuts[j][b]
            node = 2 * node + 1 + (x[np.arange(n), feature[t, node]] > threshold[t, node])
        at = node - inner
        leaf[t] = -rate * np.bincount(at, g, leaves) / (np.bincount(at, h, leaves) + l2)
        raw += leaf[t][at]
    return Forest(empty.base, feature, threshold, leaf)


def fit_on(stats: DataFrame, labels: DataFrame, label: str = "quality") -> Forest:
    picked = labelled.sample(labels, label)
    rows = labelled.with_labels(stats.where("doc_id is not null"), picked).select("doc_id", "stats", "label").toArrow()
    order = np.lexsort((np.arange(rows.num_rows), rows.column("doc_id").to_numpy()))
    x = np.array(rows.column("stats").to_pylist(), np.float64).reshape(-1, len(STATISTICS))[order]
    return fit(x, rows.column("label").to_numpy().astype(np.float64)[order], **MODEL)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    stats = stored(document_statistics(docs), "quality-statistics")
    shared = docs.sparkSession.sparkContext.broadcast(fit_on(stats, labels))

    def rows(batches):
        for b in batches:
            x = np.array(b.column(1).to_pylist(), np.float64).reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(shared.value.score(x), pa.float64())], names=["doc_id", "score"])

    scored = stats.mapInArrow(rows, "doc_id long, score double")
    return scored.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The documents that score at least ``threshold``, as they are: the
    statistics of the sample only are gathered, every row is then scored and
    filtered where it is read (no shuffle of the texts)."""
    picked = stored(labelled.sample(labels, "quality").select("doc_id"), "quality-sample")
    shared = docs.sparkSession.sparkContext.broadcast(
        fit_on(document_statistics(labelled.with_labels(docs.select(docs["doc_id"].cast("long"), "text"), picked)), labels))
    at = docs.columns.index("text")

    def rows(batches):
        for whole in batches:
            for part in pieces(whole):
                x = np.array([statistics(t) for t in part.column(at).to_pylist()], np.float64).reshape(-1, len(STATISTICS))
                yield part.filter(pa.array(shared.value.score(x) >= threshold))

    return docs.mapInArrow(rows, docs.schema)
