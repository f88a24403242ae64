"""Regression forest grown to purity, in Spark.

Rows are first collapsed to distinct (features, label) with a count, and
each tree draws a Poisson weight of that mean for each of them, which is what
drawing every row with weight Poisson(1) adds up to. A tree then works on
its distinct feature vectors with the sums of weight and weighted label.

- Nodes of more than ``small`` vectors are split level by level over all of
  them: per feature the range is cut into ``BINS`` cells, whose sums (a
  partial aggregate) give the best cut. Each level reads its vectors once.
- A node of at most ``small`` vectors goes whole to one task, which grows the
  rest of its subtree with exact cuts until every leaf holds one vector or
  equal means. No depth bound applies.

The model is a table: cuts of the large nodes, and one row of flat arrays
for each finished subtree, so it may be as large as the data. Scoring works on
the distinct vectors, which meet their subtrees by (tree, node).

Features are numbers; a row with a null feature or label is not used, and its
prediction is null. Cuts lie half-way between neighbouring values and equal
values go left; of equally good cuts the first feature's smallest counts.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postlens.session import scratch_dir
from postlens.sources.tables import broadcast_if_rows_at_most

SMALL, BINS, TREES, SEED = 4096, 1024, 50, 42
#: After so many levels cuts of large nodes halve the vectors, so that node numbers stay in 63 bits.
BALANCED_FROM = 24
#: Vectors a scoring task holds of one subtree.
MOST = 100_000
_PART = "tree int, node long, feature array<int>, cut array<double>, left array<int>, value array<double>, gains array<double>"


def _kept(df: DataFrame, name: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Entries of a table of Poisson(mean), mean <= 64: its further terms are below 1e-16.
_TERMS = 64 + 12 * 8 + 64


def poisson(u: np.ndarray, mean: np.ndarray) -> np.ndarray:
    """Inverse distribution function of Poisson(mean) at u, a normal
    approximation above a mean of 64. Each different mean has its sums once;
    u is looked up in them."""
    out = np.zeros(len(u))
    small = np.flatnonzero(mean <= 64)
    small = small[np.argsort(mean[small], kind="stable")]
    for same in np.split(small, np.flatnonzero(np.diff(mean[small])) + 1):
        if len(same):
            out[same] = np.searchsorted(_sums(float(mean[same[0]])), u[same], side="right")
    large = mean > 64
    if large.any():
        m = mean[large]
        out[large] = np.maximum(0, np.rint(m + np.sqrt(m) * _normal(np.clip(u[large], 1e-15, 1 - 1e-15))))
    return out


@lru_cache(maxsize=1024)
def _sums(mean: float) -> np.ndarray:
    """P(X <= 0), P(X <= 1), ... of Poisson(mean)."""
    p = np.exp(-np.float64(mean))
    out = [p]
    for k in range(1, _TERMS):
        p = p * mean / k
        out.append(out[-1] + p)
    return np.array(out)


def _normal(u: np.ndarray) -> np.ndarray:
    """Inverse distribution function of the standard normal (Wichura's AS241,
    which ``statistics.NormalDist`` has for one number)."""
    q = u - 0.5
    mid = np.abs(q) <= 0.425
    r = 0.180625 - q * q
    middle = q * np.polyval(_MID[0], r) / np.polyval(_MID[1], r)
    r = np.sqrt(-np.log(np.where(q <= 0, u, 1.0 - u)))
    near, far = (np.polyval(a, r - s) / np.polyval(b, r - s) for (a, b), s in ((_NEAR, 1.6), (_FAR, 5.0)))
    return np.where(mid, middle, np.copysign(np.where(r <= 5.0, near, far), q))


_MID = ([2.5090809287301226727e+3, 3.3430575583588128105e+4, 6.7265770927008700853e+4, 4.5921953931549871457e+4,
         1.3731693765509461125e+4, 1.9715909503065514427e+3, 1.3314166789178437745e+2, 3.3871328727963666080e+0],
        [5.2264952788528545610e+3, 2.8729085735721942674e+4, 3.9307895800092710610e+4, 2.1213794301586595867e+4,
         5.3941960214247511077e+3, 6.8718700749205790830e+2, 4.2313330701600911252e+1, 1.0])
_NEAR = ([7.74545014278341407640e-4, 2.27238449892691845833e-2, 2.41780725177450611770e-1, 1.27045825245236838258e+0,
          3.64784832476320460504e+0, 5.76949722146069140550e+0, 4.63033784615654529590e+0, 1.42343711074968357734e+0],
         [1.05075007164441684324e-9, 5.47593808499534494600e-4, 1.51986665636164571966e-2, 1.48103976427480074590e-1,
          6.89767334985100004550e-1, 1.67638483018380384940e+0, 2.05319162663775882187e+0, 1.0])
_FAR = ([2.01033439929228813265e-7, 2.71155556874348757815e-5, 1.24266094738807843860e-3, 2.65321895265761230930e-2,
         2.96560571828504891230e-1, 1.78482653991729133580e+0, 5.46378491116411436990e+0, 6.65790464350110377720e+0],
        [2.04426310338993978564e-15, 1.42151175831644588870e-7, 1.84631831751005468180e-5, 7.86869131145613259100e-4,
         1.48753612908506148525e-2, 1.36929880922735805310e-1, 5.99832206555887937690e-1, 1.0])


@dataclass
class DeepForest:
    columns: list[str]
    trees: int
    splits: DataFrame  # tree, node, feature, cut: the large nodes
    parts: DataFrame  # _PART: finished subtrees
    importance: list[float]

    def save(self, path: str) -> None:
        spark = self.parts.sparkSession
        self.splits.write.mode("overwrite").parquet(f"{path}/splits")
        self.parts.write.mode("overwrite").parquet(f"{path}/parts")
        meta = spark.createDataFrame([(self.columns, self.trees, self.importance)], "columns array<string>, trees int, importance array<double>")
        meta.coalesce(1).write.mode("overwrite").parquet(f"{path}/meta")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> DeepForest:
        meta = spark.read.parquet(f"{path}/meta").first()
        return cls(list(meta["columns"]), meta["trees"], spark.read.parquet(f"{path}/splits"), spark.read.parquet(f"{path}/parts"), list(meta["importance"]))


def _weighted(rows: DataFrame, columns: list[str], label: str, trees: int, seed: int, bootstrap: bool) -> DataFrame:
    """(tree, node, columns..., w, wy): each tree's distinct vectors."""
    known = rows.select(*[F.col(c).cast("double").alias(c) for c in columns], F.col(label).cast("double").alias("y")).dropna()
    counted = known.groupBy(*columns, "y").agg(F.count("*").cast("double").alias("n"))
    each = counted.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
    if bootstrap:
        @F.pandas_udf("double")
        def draw(u: pd.Series, n: pd.Series) -> pd.Series:
            return pd.Series(poisson(u.to_numpy(), n.to_numpy()))

        u = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "tree", *columns, "y"), 11).cast("double") / float(1 << 53)
        each = each.withColumn("w", draw(u, F.col("n"))).where("w > 0")
    else:
        each = each.withColumn("w", F.col("n"))
    return each.groupBy("tree", *columns).agg(F.sum("w").alias("w"), F.sum(F.col("w") * F.col("y")).alias("wy")).withColumn("node", F.lit(1).cast("long"))


def grow(rows: DataFrame, columns: list[str], label: str, trees: int = TREES, seed: int = SEED, bootstrap: bool = True, small: int = SMALL) -> DeepForest:
    cells = _kept(_weighted(rows, columns, label, trees, seed, bootstrap), "forest-vectors")
    splits, parts, level = [], [], 0
    while True:
        mean = F.col("wy") / F.col("w")
        nodes = _kept(cells.groupBy("tree", "node").agg(F.count("*").alias("n"), F.min(mean).alias("least"), F.max(mean).alias("most"), F.sum("w").alias("tw"), F.sum("wy").alias("twy"),
                                                        *[F.min(c).alias(f"lo_{c}") for c in columns], *[F.max(c).alias(f"hi_{c}") for c in columns]), "forest-nodes")
        big = nodes.where((F.col("n") > small) & (F.col("least") < F.col("most")))
        own = cells.join(broadcast_if_rows_at_most(nodes.where((F.col("n") <= small) | (F.col("least") == F.col("most"))).select("tree", "node"), 200_000), ["tree", "node"])
        even = nodes.where((F.col("n") > small) & (F.col("least") == F.col("most"))).select(
            "tree", "node", F.array(F.lit(-1)).alias("feature"), F.array(F.lit(0.0)).alias("cut"), F.array(F.lit(0)).alias("left"), F.array(F.col("least")).alias("value"),
            F.array_repeat(F.lit(0.0), len(columns)).alias("gains"))
        few = own.join(broadcast_if_rows_at_most(even.select("tree", "node"), 200_000), ["tree", "node"], "left_anti")
        parts += [_kept(few.groupBy("tree", "node").applyInPandas(_finisher(columns), _PART), "forest-parts"), _kept(even, "forest-parts")]
        if big.isEmpty():
            break
        chosen = _kept(_best_cuts(cells, big, columns, level >= BALANCED_FROM), "forest-splits")
        splits.append(chosen)
        at = F.element_at(F.array(*columns), F.col("feature") + 1)
        moved = cells.join(broadcast_if_rows_at_most(chosen.select("tree", "node", "feature", "cut"), 200_000), ["tree", "node"])
        cells = _kept(moved.select("tree", (2 * F.col("node") + (at > F.col("cut")).cast("long")).alias("node"), *columns, "w", "wy"), "forest-vectors")
        level += 1
    spark = rows.sparkSession
    all_parts = parts[0]
    for p in parts[1:]:
        all_parts = all_parts.unionByName(p)
    all_splits = spark.createDataFrame([], "tree int, node long, feature int, cut double, gain double")
    for s in splits:
        all_splits = all_splits.unionByName(s)
    gain = all_parts.select("tree", F.posexplode("gains").alias("feature", "gain")).unionByName(all_splits.select("tree", "feature", "gain")) \
        .groupBy("tree", "feature").agg(F.sum("gain").alias("gain"))
    share = gain.withColumn("share", F.try_divide("gain", F.sum("gain").over(Window.partitionBy("tree"))))
    got = {r["feature"]: r["s"] for r in share.groupBy("feature").agg(F.sum("share").alias("s")).collect()}  # a number a feature
    total = sum(v or 0.0 for v in got.values())
    importance = [float(got.get(i) or 0.0) / total if total else 0.0 for i in range(len(columns))]
    return DeepForest(columns, trees, all_splits.drop("gain"), all_parts.drop("gains"), importance)


def _best_cuts(cells: DataFrame, big: DataFrame, columns: list[str], balanced: bool) -> DataFrame:
    """(tree, node, feature, cut, gain) of the large nodes."""
    inside = cells.join(broadcast_if_rows_at_most(big, 200_000), ["tree", "node"])
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("feature"), F.col(c).alias("x"), F.col(f"lo_{c}").alias("lo"), F.col(f"hi_{c}").alias("hi")) for i, c in enumerate(columns)])).alias("f")
    part = F.try_divide(F.col("x") - F.col("lo"), F.col("hi") - F.col("lo"))
    binned = (inside.select("tree", "node", "w", "wy", "n", each).select("tree", "node", "w", "wy", "n", "f.*").where("lo < hi")
              .withColumn("bin", F.least(F.lit(BINS - 1), F.floor(part * BINS).cast("int")))
              .groupBy("tree", "node", "feature", "bin").agg(F.sum("w").alias("w"), F.sum("wy").alias("wy"), F.count("*").alias("c"), F.min("x").alias("low"), F.max("x").alias("high")))
    w = Window.partitionBy("tree", "node", "feature")  # at most BINS rows
    upto = w.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    s = binned.select("*", F.sum("w").over(upto).alias("lw"), F.sum("wy").over(upto).alias("ly"), F.sum("c").over(upto).alias("lc"),
                      F.sum("w").over(w).alias("aw"), F.sum("wy").over(w).alias("ay"), F.sum("c").over(w).alias("ac"), F.lead("low").over(w.orderBy("bin")).alias("next"))
    s = s.where("next is not null")
    gain = F.col("ly") * F.col("ly") / F.col("lw") + (F.col("ay") - F.col("ly")) * (F.col("ay") - F.col("ly")) / (F.col("aw") - F.col("lw")) - F.col("ay") * F.col("ay") / F.col("aw")
    middle = F.col("high") + (F.col("next") - F.col("high")) / 2
    cut = F.when(middle < F.col("next"), middle).otherwise(F.col("high"))
    rank = F.least(F.col("lc"), F.col("ac") - F.col("lc")).cast("double") if balanced else gain
    best = s.groupBy("tree", "node").agg(F.max(F.struct(rank.alias("rank"), (-F.col("feature")).alias("f"), (-cut).alias("c"), gain.alias("gain"))).alias("b"))
    return best.select("tree", "node", (-F.col("b.f")).cast("int").alias("feature"), (-F.col("b.c")).alias("cut"), F.greatest(F.col("b.gain"), F.lit(0.0)).alias("gain"))


def grow_exact(x: np.ndarray, w: np.ndarray, wy: np.ndarray):
    """Arrays (feature or -1, cut, left child; the right one follows, value)
    of a tree grown to purity, and the gain of each feature."""
    feature, cut, left, value, gains = [-1], [0.0], [0], [0.0], np.zeros(x.shape[1])
    mean = wy / w
    todo = [(0, np.arange(len(x)))]
    while todo:
        node, rows = todo.pop()
        tw, ty = w[rows].sum(), wy[rows].sum()
        value[node] = ty / tw
        if len(rows) == 1 or mean[rows].min() == mean[rows].max():
            value[node] = mean[rows[0]]
            continue
        best = None
        for f in range(x.shape[1]):
            order = rows[np.argsort(x[rows, f], kind="stable")]
            v = x[order, f]
            at = np.flatnonzero(v[1:] > v[:-1])
            if not len(at):
                continue
            lw, ly = np.cumsum(w[order])[at], np.cumsum(wy[order])[at]
            gain = ly * ly / lw + (ty - ly) ** 2 / (tw - lw) - ty * ty / tw
            i = int(np.argmax(gain))
            if best is None or gain[i] > best[0]:
                middle = v[at[i]] + (v[at[i] + 1] - v[at[i]]) / 2
                best = float(gain[i]), f, float(middle if middle < v[at[i] + 1] else v[at[i]])
        gain, f, c = best
        gains[f] += max(gain, 0.0)
        feature[node], cut[node], left[node] = f, c, len(feature)
        right = x[rows, f] > c
        for part in (rows[~right], rows[right]):
            todo.append((len(feature), part))
            feature.append(-1)
            cut.append(0.0)
            left.append(0)
            value.append(0.0)
    return feature, cut, left, value, gains


def _finisher(columns: list[str]):
    def finish(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(columns)
        grown = grow_exact(frame[columns].to_numpy(np.float64), frame["w"].to_numpy(), frame["wy"].to_numpy())
        return pd.DataFrame({"tree": [frame["tree"].iloc[0]], "node": [frame["node"].iloc[0]], **{n: [np.array(a)] for n, a in zip(("feature", "cut", "left", "value", "gains"), grown)}})

    return finish


def predict(rows: DataFrame, forest: DeepForest, out: str = "prediction") -> DataFrame:
    """``rows`` with the mean over all trees."""
    names = [f"__x{i}" for i in range(len(forest.columns))]
    keyed = rows.withColumns({n: F.col(c).cast("double") for n, c in zip(names, forest.columns)})
    cells = _kept(keyed.select(*names).dropna().distinct(), "forest-queries")
    at = cells.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(forest.trees - 1)))).withColumn("node", F.lit(1).cast("long"))
    deepest = forest.splits.agg(F.max(F.floor(F.log2(F.col("node").cast("double"))))).first()[0]
    splits = broadcast_if_rows_at_most(forest.splits, 200_000)
    for _ in range(0 if deepest is None else int(deepest) + 1):  # levels of large nodes
        x = F.element_at(F.array(*names), F.col("feature") + 1)
        at = (at.join(splits, ["tree", "node"], "left")
              .withColumn("node", F.when(F.col("feature").isNull(), F.col("node")).otherwise(2 * F.col("node") + (x > F.col("cut")).cast("long"))).select("tree", "node", *names))
    # a subtree that very many vectors meet goes to several tasks
    at = _kept(at, "forest-queries")
    busy = _kept(at.groupBy("tree", "node").agg(F.ceil(F.count("*") / MOST).cast("int").alias("salts")), "forest-busy")
    at = at.join(broadcast_if_rows_at_most(busy, 200_000), ["tree", "node"]).select("tree", "node", F.pmod(F.xxhash64(*names), F.col("salts")).cast("int").alias("salt"), *names)
    copies = busy.select(F.col("tree").alias("t"), F.col("node").alias("k"), F.sequence(F.lit(0), F.col("salts") - 1).alias("salts"))
    parts = (forest.parts.join(broadcast_if_rows_at_most(copies, 200_000), F.expr("tree = t and node = k"))
             .select("tree", "node", F.explode("salts").alias("salt"), "feature", "cut", "left", "value"))
    keys = ["tree", "node", "salt"]

    def walk(queries: pd.DataFrame, part: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(part):
            return pd.DataFrame({n: pd.Series(dtype="float64") for n in [*names, "p"]})
        feature, cut, left, value = (np.asarray(part[c].iloc[0]) for c in ("feature", "cut", "left", "value"))
        x, node = queries[names].to_numpy(np.float64), np.zeros(len(queries), np.int64)
        live = np.flatnonzero(feature[node] >= 0)
        while len(live):
            here = node[live]
            node[live] = left[here] + (x[live, feature[here]] > cut[here])
            live = live[feature[node[live]] >= 0]
        return queries[names].assign(p=value[node])

    scored = at.groupBy(*keys).cogroup(parts.groupBy(*keys)).applyInPandas(walk, ", ".join(f"{n} double" for n in [*names, "p"]))
    mean = _kept(scored.groupBy(*names).agg(F.avg("p").alias(out)), "forest-scores")
    return keyed.join(mean, names, "left").select(*[keyed[c] for c in rows.columns], out)
