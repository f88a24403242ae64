"""Exact retrieval of the items with the largest inner products.

``build_index`` turns item factors into a tree. Items are ranked by norm
(``global_row_number``, no single-task sort) and cut into layers of falling
norm, small at first; inside a layer, one task splits the items along their
main axis into balls of at most ``leaf`` items, ``GROUP`` neighbours of which
share a larger ball. A node knows its largest norm, and a ball its centre and
radius, so no item of it can score above
``min(|u| * norm, u . centre + |u| * radius)`` for a user u.

``top_items`` walks the tree for a block of users at a time. Every user
carries one running list of the k best items; a layer, then a ball, is opened
only for the users whose k-th score it may still beat, ties included. Layers
travel to the tasks in shards of bounded size: a shard is one map over the
users, and users whose k-th score beats all later layers leave the rounds, so
neither the catalogue's size nor the number of users is bounded by a task's
memory, and no user meets an item by a join.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.operators.ranking import global_row_number
from postlens.session import scratch_dir

FIRST_LAYER, LAYER, LEAF, GROUP = 256, 1024, 2, 4
USERS = 1024
#: Items of a shard: its factors are collected once and broadcast.
SHARD_ITEMS = 400_000
#: Float32 scores may differ from the bounds' arithmetic by this share of |u| |v|.
SLACK = 1e-6
#: And bounds taken in single floats by this share of |u| (|v| + radius).
ROUNDING = 1e-5


def _kept(df: DataFrame, name: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _balls(x: np.ndarray, leaf: int) -> np.ndarray:
    """The leaf of each row: halves along the main axis until they are small,
    neighbours by number. Parts of equal size are split together."""
    parts = [np.arange(len(x))] if len(x) else []
    while any(len(p) > leaf for p in parts):
        sizes = np.array([len(p) for p in parts])
        halves: list[tuple] = [(p,) for p in parts]
        for size in np.unique(sizes[sizes > leaf]):
            which = np.flatnonzero(sizes == size)
            rows = np.stack([parts[i] for i in which])
            about = x[rows] - x[rows].mean(axis=1, keepdims=True)
            axis = np.linalg.eigh(np.matmul(about.transpose(0, 2, 1), about))[1][:, :, -1:]
            rows = np.take_along_axis(rows, np.argsort(np.matmul(about, axis)[:, :, 0], axis=1, kind="stable"), axis=1)
            for i, own in zip(which, rows):
                halves[i] = (own[:size // 2], own[size // 2:])
        parts = [h for both in halves for h in both]
    out = np.zeros(len(x), np.int32)
    for name, rows in enumerate(parts):
        out[rows] = name
    return out


def build_index(item_factors: DataFrame, layer: int = LAYER, leaf: int = LEAF) -> DataFrame:
    """(shard, layer, leaf, product_id, item) of (id, features)."""
    norm = F.sqrt(F.aggregate("features", F.lit(0.0), lambda t, x: t + x.cast("double") * x.cast("double")))
    items = item_factors.select(F.col("id").alias("product_id"), F.col("features").cast("array<double>").alias("item"), norm.alias("norm"))
    ranked = global_row_number(items, [F.desc("norm"), F.asc("product_id")], "place")
    first = min(FIRST_LAYER, layer)
    # layer 0 ends at ``first`` items, each next one doubles up to ``layer``
    doubling = max(0, (layer // first).bit_length() - 1)
    grown = first * ((1 << doubling) - 1) if doubling else 0
    at = F.col("place") - 1
    number = F.when(at < grown, F.floor(F.log2(F.floor(at / first) + 1))).otherwise(F.lit(doubling) + F.floor((at - grown) / layer)).cast("int")
    shard = F.floor(at / max(SHARD_ITEMS, layer)).cast("int")

    def split(frame: pd.DataFrame) -> pd.DataFrame:
        return frame.assign(leaf=_balls(np.stack(frame["item"].to_numpy()), leaf))

    layered = ranked.select(shard.alias("shard"), number.alias("layer"), F.lit(0).alias("leaf"), "product_id", "item")
    return layered.groupBy("shard", "layer").applyInPandas(split, layered.schema)


def _runs(*keys: np.ndarray) -> np.ndarray:
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


class Balls:
    """Runs of items: their number, largest norm, and a row (centre, radius)
    whose product with a user's row (factors, length) is an upper bound of the
    scores. Products are of single floats, so the radius is a little wider."""

    def __init__(self, items: np.ndarray, norm: np.ndarray, start: np.ndarray):
        self.start, self.size = start, np.diff(np.append(start, len(items)))
        centre = np.add.reduceat(items, start) / self.size[:, None]
        away = items - np.repeat(centre, self.size, axis=0)
        radius = np.sqrt(np.maximum.reduceat((away * away).sum(axis=1), start))
        self.norm = np.maximum.reduceat(norm, start)
        self.row = _single(np.column_stack([centre, radius + ROUNDING * (self.norm + radius)]))


def _single(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x, dtype=np.float32)


class Shard:
    """A shard's tree in arrays, layers in order of falling norm."""

    def __init__(self, layer: np.ndarray, leaf: np.ndarray, ids: np.ndarray, items: np.ndarray):
        order = np.lexsort((ids, leaf, layer))
        layer, leaf, self.ids, self.items = layer[order], leaf[order], ids[order].astype(np.int64), items[order].astype(np.float64)
        norm = np.sqrt((self.items * self.items).sum(axis=1))
        self.groups = Balls(self.items, norm, _runs(layer, leaf // GROUP))
        self.leaves = Balls(self.items, norm, _runs(layer, leaf))
        # leaves of a group: from its first one on
        self.first = np.searchsorted(self.leaves.start, self.groups.start)
        self.many = np.diff(np.append(self.first, len(self.leaves.start)))
        # first group of each layer; the largest norm from a layer on
        self.layers = _runs(layer[self.groups.start])
        self.rest = np.maximum.accumulate(np.maximum.reduceat(self.groups.norm, self.layers)[::-1])[::-1]
        self.order = np.argsort(self.ids, kind="stable")
        self.sorted = self.ids[self.order]

    @classmethod
    def of_table(cls, table: pa.Table) -> Shard:
        table = table.combine_chunks()
        number = lambda c: table.column(c).to_numpy()
        return cls(number("layer"), number("leaf"), number("product_id"), _matrix(table.column("item").combine_chunks()))

    def held(self, owned: np.ndarray, many: np.ndarray) -> np.ndarray:
        """Sorted codes (user * items + row) of the owned products that are in
        the shard; ``owned`` holds ``many[u]`` products of each user in turn."""
        user = np.repeat(np.arange(len(many)), many)
        at = np.minimum(np.searchsorted(self.sorted, owned), len(self.ids) - 1)
        here = self.sorted[at] == owned
        return np.sort(user[here] * len(self.ids) + self.order[at[here]])

    def search(self, users: np.ndarray, held: np.ndarray, ids: np.ndarray, scores: np.ndarray, floor: np.ndarray) -> np.ndarray:
        """Update the k best (``ids``, ``scores``, filled with -1 and -inf) of
        each user in place; returns the inner products taken for each."""
        length = np.sqrt((users * users).sum(axis=1))
        rows = _single(np.column_stack([users, length]))
        products = np.zeros(len(users), np.int64)
        ends = np.append(self.layers[1:], len(self.groups.start))
        for a, b, rest in zip(self.layers, ends, self.rest):
            live = np.flatnonzero(length * rest * (1 + SLACK) >= np.maximum(scores[:, -1], floor))
            if not len(live):
                break
            bound = rows[live] @ self.groups.row[a:b].T
            products[live] += b - a
            shut = None
            if (scores[live, -1] == -np.inf).any():  # the most promising balls first: they close most of the others
                shut = _best(bound, 2 + ids.shape[1] // (LEAF * GROUP))
                row, group = np.nonzero(shut)
                self._open_groups(live[row], a + group, users, rows, held, ids, scores, floor, products)
            wanted = bound >= _below(np.maximum(scores[live, -1], floor[live]))[:, None]
            open_ = np.flatnonzero(wanted if shut is None else wanted & ~shut)
            for c in range(0, len(open_), 1 << 14):
                row, group = np.divmod(open_[c:c + (1 << 14)], b - a)
                self._open_groups(live[row], a + group, users, rows, held, ids, scores, floor, products)
        return products

    def _open_groups(self, user, group, users, rows, held, ids, scores, floor, products) -> None:
        size = self.many[group]
        pair, leaf = np.repeat(user, size), _spread(self.first[group], size)
        np.add.at(products, user, size)
        limit = _below(np.maximum(scores[:, -1], floor)).take(pair)
        hit = np.einsum("ij,ij->i", rows.take(pair, axis=0), self.leaves.row.take(leaf, axis=0)) >= limit
        if hit.any():
            self._open(pair[hit], leaf[hit], users, held, ids, scores, products)

    def _open(self, user, leaf, users, held, ids, scores, products) -> None:
        size = self.leaves.size[leaf]
        pair, item = np.repeat(user, size), _spread(self.leaves.start[leaf], size)
        np.add.at(products, user, size)
        got = np.einsum("ij,ij->i", users.take(pair, axis=0), self.items.take(item, axis=0)).astype(np.float32).astype(np.float64)
        # items below the k-th score change nothing
        some = np.flatnonzero(got >= scores[pair, -1])
        pair, item, got = pair[some], item[some], got[some]
        if len(held) and len(pair):
            code = pair * len(self.ids) + item
            free = held[np.minimum(np.searchsorted(held, code), len(held) - 1)] != code
            pair, item, got = pair[free], item[free], got[free]
        if not len(pair):
            return
        k = ids.shape[1]
        touched = np.unique(pair)
        who = np.concatenate([np.repeat(touched, k), pair])
        what = np.concatenate([ids[touched].ravel(), self.ids[item]])
        score = np.concatenate([scores[touched].ravel(), got])
        order = np.lexsort((what, -score, who))
        who = who[order]
        begin = np.searchsorted(who, touched)
        best = order[begin[:, None] + np.arange(k)]  # every touched user has k rows at least
        ids[touched], scores[touched] = what[best], score[best]


def _below(threshold: np.ndarray) -> np.ndarray:
    """As single floats, none above the threshold."""
    return (threshold - ROUNDING * np.abs(np.where(np.isfinite(threshold), threshold, 0.0)) - 1e-30).astype(np.float32)


def _matrix(lists: pa.ListArray) -> np.ndarray:
    """Lists of one length as the rows of a matrix."""
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def _lists(matrix: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1], pa.array(matrix.ravel()))


def _spread(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first, first + 1, ... for each run of a size."""
    return np.repeat(first - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


def _best(bound: np.ndarray, few: int) -> np.ndarray:
    few = min(bound.shape[1], few)
    out = np.zeros(bound.shape, bool)
    np.put_along_axis(out, np.argpartition(-bound, few - 1, axis=1)[:, :few], True, axis=1)
    return out


def top_items(user_factors: DataFrame, item_factors: DataFrame, owned: DataFrame, k: int, floors: DataFrame | None = None,
              users: int = USERS, layer: int = LAYER) -> DataFrame:
    """(user_id, product_id, prediction, rank, products): each user's exact k
    best items over all item factors, without the ``owned`` ones; ties by
    product_id. ``floors`` may give a score that a user's k-th best is known to
    reach. ``products`` counts the inner products taken for the user, bounds
    included. A user without factors has no row; one who owns all items,
    neither."""
    spark = user_factors.sparkSession
    index = _kept(build_index(item_factors, layer), "item-index")
    shards = [r["shard"] for r in index.select("shard").distinct().orderBy("shard").collect()]  # one for each SHARD_ITEMS items
    have = owned.groupBy("user_id").agg(F.collect_set(F.col("product_id").cast("long")).alias("owned"))
    state = (user_factors.select(F.col("id").alias("user_id"), F.col("features").cast("array<double>").alias("user"))
             .join(have, "user_id", "left"))
    state = state.join(floors.select("user_id", F.col("floor").cast("double").alias("floor")), "user_id", "left") if floors is not None \
        else state.withColumn("floor", F.lit(None).cast("double"))
    state = state.select("user_id", "user", F.coalesce("owned", F.array().cast("array<long>")).alias("owned"), F.coalesce("floor", F.lit(float("-inf"))).alias("floor"),
                         F.array_repeat(F.lit(-1).cast("long"), k).alias("ids"), F.array_repeat(F.lit(float("-inf")), k).alias("scores"), F.lit(0).cast("long").alias("products"))
    done = None
    for shard in shards:
        # SHARD_ITEMS rows at most
        own = spark.sparkContext.broadcast(Shard.of_table(index.where(F.col("shard") == shard).select("layer", "leaf", "product_id", "item").toArrow()))
        state = _kept(state.mapInArrow(_searched(own, users), state.schema), "running-best")
        if shard == shards[-1]:
            break
        # the next layers' norms are at most the least of this shard
        last = float(own.value.groups.norm[own.value.layers[-1]:].max())
        length = F.sqrt(F.aggregate("user", F.lit(0.0), lambda t, x: t + x * x))
        more = length * last * (1 + SLACK) >= F.greatest(F.element_at("scores", -1), "floor")
        over = state.where(~more)
        done = over if done is None else done.unionByName(over)
        state = state.where(more)
        if state.isEmpty():  # nobody's list can change any more
            break
    done = state if done is None else done.unionByName(state)
    ranked = done.select("user_id", "products", F.posexplode(F.arrays_zip("ids", "scores")).alias("place", "b"))
    return ranked.where("b.ids >= 0").select("user_id", F.col("b.ids").cast("int").alias("product_id"), F.col("b.scores").cast("float").alias("prediction"),
                                             (F.col("place") + 1).alias("rank"), "products")


def _searched(shard, size: int):
    def rows(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, size):
                part = batch.slice(a, size)
                columns = {n: part.column(n) for n in part.schema.names}
                ids, scores = _matrix(columns["ids"]).astype(np.int64), _matrix(columns["scores"]).astype(np.float64)
                owned = columns["owned"]
                held = shard.value.held(owned.flatten().to_numpy(zero_copy_only=False), pc.list_value_length(owned).to_numpy(zero_copy_only=False))
                taken = shard.value.search(_matrix(columns["user"]).astype(np.float64), held, ids, scores, columns["floor"].to_numpy(zero_copy_only=False))
                columns["ids"], columns["scores"] = _lists(ids), _lists(scores)
                columns["products"] = pa.array(columns["products"].to_numpy() + taken)
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return rows
