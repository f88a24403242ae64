"""Isolation forest, grown and applied in Spark.

``grow`` draws ``psi`` rows for each of ``trees`` trees: a row's place in a
tree's draw is a hash of the tree and the row's key, so the draw is the same
under any partitioning. Rows are thinned by a hash first, so that the draw
costs one hash a row and a bounded number of (tree, row) pairs. One task
grows a tree from its ``psi`` rows (a bounded group); nodes are numbered as in a
heap (children of i: 2i and 2i + 1), and feature and cut of node i come from
a hash of (tree, i), not from a stream of random numbers.

``score`` walks the trees for many rows at once
and returns ``2 ** -(mean path length / c(psi))``: near 1 for rows that few
cuts isolate, below 0.5 for ordinary ones. A leaf of n rows counts as its
depth plus ``c(n)``, the mean depth of a search tree of n keys.

The forest (``trees`` times ``2 ** (limit + 1)`` numbers) is bounded by its
parameters, whatever the data, and travels with the task. Null and NaN
features count as the feature's mean over the drawn rows of a tree.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TREES, PSI, SEED = 200, 256, 42
#: Drawn rows a tree is thinned to before its rows are ranked, in multiples of ``psi``.
SLACK = 4
#: Rows walked at once: a comparison's fixed cost counts little beside theirs.
ROWS = 80_000


def c(n: float) -> float:
    """Mean depth of an unsuccessful search in a search tree of n keys."""
    return 0.0 if n <= 1 else 1.0 if n == 2 else 2.0 * (math.log(n - 1) + 0.5772156649015329) - 2.0 * (n - 1) / n


def draw(seed: int, tree: int, node: int, use: int) -> float:
    """A number in [0, 1) for a use (0: feature, 1: cut) at a node."""
    mask = (1 << 64) - 1
    x = (seed * 0x9E3779B97F4A7C15 + tree * 0xBF58476D1CE4E5B9 + node * 0x94D049BB133111EB + use * 0xD6E8FEB86659FD93 + 1) & mask
    for _ in range(2):
        x = ((x ^ (x >> 31)) * 0xFF51AFD7ED558CCD) & mask
    return (x >> 11) / (1 << 53)


@dataclass
class Forest:
    """Flat arrays over (tree, node). A leaf's subtree repeats the leaf's path
    length and sends every row left, so all walks have ``limit`` steps."""

    columns: list[str]
    psi: int
    limit: int
    feature: np.ndarray
    cut: np.ndarray
    length: np.ndarray
    fill: np.ndarray

    @cached_property
    def cuts(self) -> list[np.ndarray]:
        """The different cuts of each column over all trees, ascending."""
        return [np.unique(self.cut[(self.feature == j) & ~np.isnan(self.cut)]) for j in range(len(self.columns))]

    @cached_property
    def walks(self) -> list[tuple]:
        """Per tree: its different path lengths, and its nodes as (column, place
        of the cut, left, right) or the number of a path length. Nodes whose
        paths all have one length are that length."""
        out = []
        for feature, cut, length in zip(self.feature, self.cut, self.length):
            half = len(length) // 2
            lengths, code = np.unique(length[half:], return_inverse=True)
            below = list(code.astype(np.min_scalar_type(len(lengths) - 1)))
            while half > 1:
                half //= 2
                pairs = zip(range(half, 2 * half), below[::2], below[1::2])
                below = [a if not isinstance(a, tuple) and not isinstance(b, tuple) and a == b else (int(feature[i]), self._place(int(feature[i]), cut[i]), a, b) for i, a, b in pairs]
            out.append((lengths, below[0]))
        return out

    def _place(self, column: int, cut: float) -> int:
        """The rank from which a value is at or above the cut."""
        cuts = self.cuts[column]
        return np.min_scalar_type(len(cuts) + 1).type(len(cuts) + 1 if np.isnan(cut) else np.searchsorted(cuts, cut) + 1)

    def _ranks(self, column: int, values: np.ndarray) -> np.ndarray:
        """How many cuts of the column each value reaches (none for NaN)."""
        cuts = self.cuts[column]
        found = np.where(np.isnan(values), 0, np.searchsorted(cuts, values, side="right"))
        return found.astype(np.min_scalar_type(len(cuts) + 1))

    def path_lengths(self, x: np.ndarray) -> np.ndarray:
        """Mean path length of each row of a matrix. Values are turned into
        their ranks among the column's cuts once; then each node of a tree is
        one comparison of all rows, which picks the right or the left side's
        number by its bits."""
        n, wide = x.shape
        total, holes = np.zeros(n), np.isnan(x)
        at, length = np.empty(n, np.intp), np.empty(n)  # for all trees: new arrays of this size cost more than the look-ups
        ranks, some = [self._ranks(j, x[:, j]) for j in range(wide)], [holes[:, j].any() for j in range(wide)]
        for t, (lengths, top) in enumerate(self.walks):
            own = [np.where(holes[:, j], self._ranks(j, self.fill[t, j:j + 1]), ranks[j]) if some[j] else ranks[j] for j in range(wide)]

            def number(node):
                column, place, left, right = node
                left = number(left) if isinstance(left, tuple) else left
                right = number(right) if isinstance(right, tuple) else right
                mask = (own[column] >= place).view(np.uint8).astype(code, copy=False)
                np.negative(mask, out=mask)  # all bits or none
                np.bitwise_and(mask, np.bitwise_xor(left, right), out=mask)
                return np.bitwise_xor(mask, left, out=mask)

            code = np.min_scalar_type(len(lengths) - 1)
            at[:] = number(top) if isinstance(top, tuple) else top
            total += lengths.take(at, out=length, mode="clip")
        return total / len(self.walks)


def as_table(spark: SparkSession, forest: Forest) -> DataFrame:
    """One row a tree (bounded by the forest's parameters)."""
    rows = [(t, forest.columns, forest.psi, forest.limit, *(getattr(forest, n)[t].tolist() for n in ("feature", "cut", "length", "fill"))) for t in range(len(forest.feature))]
    return spark.createDataFrame(rows, "tree int, columns array<string>, psi int, `limit` int, feature array<int>, cut array<double>, length array<double>, fill array<double>").coalesce(1)


def of_table(table: DataFrame) -> Forest:
    rows = table.orderBy("tree").collect()
    return Forest(list(rows[0]["columns"]), rows[0]["psi"], rows[0]["limit"], *(np.array([r[k] for r in rows]) for k in ("feature", "cut", "length", "fill")))


def _grow(x: np.ndarray, tree: int, limit: int, seed: int) -> tuple[np.ndarray, ...]:
    size = 2 << limit
    feature, cut, length = np.zeros(size, np.int32), np.full(size, np.inf), np.zeros(size)
    known = ~np.isnan(x)
    fill = np.array([x[known[:, j], j].mean() if known[:, j].any() else 0.0 for j in range(x.shape[1])])
    x = np.where(known, x, fill)
    open_nodes = {1: np.arange(len(x))}
    for depth in range(limit + 1):
        below = {}
        for node, rows in open_nodes.items():
            low, high = x[rows].min(axis=0), x[rows].max(axis=0)
            ways = np.flatnonzero(high > low)
            if depth == limit or len(ways) == 0:  # a leaf, and all nodes under it
                a, b = node, node
                while a < size:
                    length[a:b + 1] = depth + c(len(rows))
                    a, b = 2 * a, 2 * b + 1
                continue
            f = ways[int(draw(seed, tree, node, 0) * len(ways))]
            feature[node] = f
            cut[node] = low[f] + draw(seed, tree, node, 1) * (high[f] - low[f])
            if cut[node] <= low[f]:  # both sides get a row
                cut[node] = high[f]
            right = x[rows, f] >= cut[node]
            below[2 * node], below[2 * node + 1] = rows[~right], rows[right]
        open_nodes = below
    return feature, cut, length, fill


def drawn_rows(rows: DataFrame, key: str, columns: list[str], trees: int = TREES, psi: int = PSI, seed: int = SEED) -> DataFrame:
    """(tree, columns...) with ``psi`` rows a tree, or all if there are fewer."""
    from pyspark.sql import Window
    n = rows.count()
    top = float(1 << 63)
    chance = min(1.0, SLACK * trees * psi / max(n, 1))
    at = lambda h: (F.shiftrightunsigned(h, 1).cast("double") / top)
    pool = rows.select(F.col(key).alias("key"), *columns).where(at(F.xxhash64(F.lit(seed), key)) < chance)
    own = min(1.0, SLACK * psi / max(n * chance, 1.0))
    tree = F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree")
    pairs = pool.select("*", tree).withColumn("h", F.xxhash64(F.lit(seed), "tree", "key")).where(at(F.col("h")) < own)
    place = F.row_number().over(Window.partitionBy("tree").orderBy("h", "key", *columns))
    return pairs.withColumn("place", place).where(F.col("place") <= psi).select("tree", "place", *columns)


def grow(rows: DataFrame, key: str, columns: list[str], trees: int = TREES, psi: int = PSI, seed: int = SEED) -> Forest:
    drawn = drawn_rows(rows, key, columns, trees, psi, seed)
    most = psi
    limit = max(1, math.ceil(math.log2(psi)))

    def one(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("place")
        tree = int(frame["tree"].iloc[0])
        feature, cut, length, fill = _grow(frame[columns].to_numpy(np.float64, na_value=np.nan), tree, limit, seed)
        return pd.DataFrame({"tree": [tree], "rows": [len(frame)], "feature": [feature], "cut": [cut], "length": [length], "fill": [fill]})

    schema = "tree int, rows long, feature array<int>, cut array<double>, length array<double>, fill array<double>"
    grown = sorted(drawn.groupBy("tree").applyInPandas(one, schema).collect(), key=lambda r: r["tree"])  # bounded by trees and psi
    if not grown:  # no rows at all: every path has no length
        empty = np.zeros((1, 4))
        return Forest(columns, 2, 1, empty.astype(np.int32), empty, empty, np.zeros((1, len(columns))))
    most = max(r["rows"] for r in grown)
    return Forest(columns, most, limit, *(np.array([r[k] for r in grown]) for k in ("feature", "cut", "length", "fill")))


def score(rows: DataFrame, forest: Forest, out: str = "isolation_score") -> DataFrame:
    """``rows`` with the score of each row."""
    usual = c(forest.psi) or 1.0

    @F.pandas_udf("double")
    def scored(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        some, rows = [], 0
        for columns in batches:
            some.append(np.column_stack([s.to_numpy(np.float64, na_value=np.nan) for s in columns]))
            rows += len(some[-1])
            if rows >= ROWS:
                yield pd.Series(2.0 ** (-forest.path_lengths(np.concatenate(some)) / usual))
                some, rows = [], 0
        if rows:
            yield pd.Series(2.0 ** (-forest.path_lengths(np.concatenate(some)) / usual))

    return rows.withColumn(out, scored(*[F.col(x).cast("double") for x in forest.columns]))


def detection_scores(flagged: DataFrame, label: str, flag: str = "is_flagged") -> DataFrame:
    """Precision, recall, F1 and false-positive rate of a flag against a label (1 or true: an outlier)."""
    from postlens.functions.semantics import safe_div
    y, p = F.col(label).cast("boolean"), F.col(flag).cast("boolean")
    s = flagged.agg(F.count("*").alias("n"), F.count_if(p & y).alias("tp"), F.count_if(p & ~y).alias("fp"),
                    F.count_if(~p & y).alias("fn"), F.count_if(~p & ~y).alias("tn"))
    precision, recall = safe_div(F.col("tp"), F.col("tp") + F.col("fp")), safe_div(F.col("tp"), F.col("tp") + F.col("fn"))
    return s.select("n", precision.alias("precision"), recall.alias("recall"), safe_div(precision * recall * 2.0, precision + recall).alias("f1"),
                    safe_div(F.col("fp"), F.col("fp") + F.col("tn")).alias("false_positive_rate"))
