"""Merkle manifest of a dataset by lag and lead windows.

A leaf is the hash of a document's columns (each ``-`` if null, else its byte
count, ``:`` and its value). Per source the leaves ascend by ``doc_id``; every
``FANOUT`` consecutive nodes become their hash, level by level, until one is
left, the subroot. The subroots, by source, become the root in the same way.

- ``numbered``: a leaf's place in its source without a window over the
  source. Rows are range-partitioned by (source, id) and sorted; a row's place
  is its number inside its partition plus the source's rows in the partitions
  before, of which there is one count a partition and source.
- ``family``: per level, one window over blocks of ``BLOCK`` places (a
  multiple of the fan-out, so a run never crosses blocks) holds ``FANOUT - 1``
  lag and as many lead columns. The slot masks the lags, the length of the run
  the leads; what is left are the siblings to the left and right. A run's first
  child hashes itself and its right siblings into the parent.
- Top down, a node's path is its own siblings and its parent's path; the last
  join brings a run's path to its (at most ``FANOUT``) leaves. Only hashes
  move, never texts, and a level has a sixteenth of the rows of the one below.

Cases: a null source is a source of its own, before all others; null ids come
first in their source; equal ids are ordered by their leaf; repeated rows
are leaves of their own; a lone leaf is its subroot, a lone subroot the root,
and with no siblings at all the proof is the hash of the empty text; a null
text is never changed by tampering and a null id is never tampered with; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlens.llm.columns import ascii_lower
from postlens.llm.common import stored
from postlens.sources.tables import broadcast_if_rows_at_most

FANOUT = 16
#: Places a window group holds.
BLOCK = FANOUT * FANOUT
#: Every fifth document, by the checksum of its id, is tampered with.
TAMPERED = 5


def sha(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def leaf_hash(text: Column) -> Column:
    def part(value: Column) -> Column:
        value = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return sha(F.concat(*[part(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")], part(text)))


def leaves(docs: DataFrame) -> DataFrame:
    """(tree, doc_id, hash, other): a document's leaf and, where its text is
    tampered with, the leaf of the changed text. ``tree`` names the source:
    empty for null, else ``s`` and the source, which sorts as the source does."""
    text = F.col("text").cast("string")
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED == 0
    return docs.select(F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("")).alias("tree"), F.col("doc_id").cast("long").alias("doc_id"),
                       leaf_hash(text).alias("hash"), F.when(hit, leaf_hash(F.when(text.isNotNull(), ascii_lower(text)))).alias("other"))


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``pos``, the place in the tree in ascending ``order``
    (ties as they come), and ``n``, the tree's rows."""
    keys = ["tree", *order]
    placed = stored(rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
                    .withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()), "merkle-order")
    # one row for each partition and each tree that begins in it
    spans = placed.groupBy("tree", "part").agg(F.min("at").alias("low"), F.count("*").alias("size"))
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    spans = stored(spans.select("tree", "part", (F.coalesce(F.sum("size").over(before), F.lit(0)) - F.col("low")).alias("shift"),
                                F.sum("size").over(Window.partitionBy("tree")).alias("n")), "merkle-spans")
    return (placed.join(broadcast_if_rows_at_most(spans, 10_000), ["tree", "part"])
            .withColumn("pos", F.col("at") + F.col("shift")).drop("part", "at", "shift"))


def family(nodes: DataFrame) -> DataFrame:
    """``nodes`` with ``left`` and ``right``, the hashes of the siblings on
    either side, for the trees that have more than one node."""
    w = Window.partitionBy("tree", F.floor(F.col("pos") / BLOCK)).orderBy("pos")
    slot = F.col("pos") % FANOUT
    length = F.least(F.lit(FANOUT), F.col("n") - (F.col("pos") - slot))
    empty = F.lit("")
    left = [F.when(slot >= k, F.lag("hash", k).over(w)).otherwise(empty) for k in range(FANOUT - 1, 0, -1)]
    right = [F.when(slot + k < length, F.lead("hash", k).over(w)).otherwise(empty) for k in range(1, FANOUT)]
    return nodes.where("n > 1").withColumns({"left": F.concat(*left), "right": F.concat(*right)})


def parents(nodes: DataFrame) -> DataFrame:
    """The next level: one node a run, hashed by its first child."""
    up = F.floor(F.col("pos") / FANOUT)
    return (family(nodes).where(F.col("pos") % FANOUT == 0)
            .select("tree", up.alias("pos"), F.ceil(F.col("n") / FANOUT).alias("n"), sha(F.concat("hash", "right")).alias("hash")))


def levels(nodes: DataFrame) -> list[DataFrame]:
    """``nodes`` and the levels above it. A tree ends with its one node."""
    most = nodes.agg(F.max("n")).first()[0] or 0
    out = [nodes]
    while most > 1:
        out.append(stored(parents(out[-1]), "merkle-level"))
        most = -(-most // FANOUT)
    return out


def tops(tree_levels: list[DataFrame]) -> DataFrame:
    """(tree, hash) of every tree's last node."""
    return reduce(DataFrame.unionByName, [x.where("n = 1").select("tree", "hash") for x in tree_levels])


def with_paths(tree_levels: list[DataFrame], above: DataFrame) -> DataFrame:
    """The lowest level with ``path``, the siblings (left, right) of each
    level up to the root, and the columns of ``above``: (tree, path, ...)."""
    extra = [c for c in above.columns if c not in ("tree", "path")]
    over = None
    for nodes in reversed(tree_levels):
        kept = nodes.join(above, "tree").where("n = 1")
        if over is not None:
            up = over.select("tree", F.col("pos").alias("run"), F.col("path").alias("higher"), *extra)
            own = F.array(F.struct("left", "right"))
            many = (family(nodes).withColumn("run", F.floor(F.col("pos") / FANOUT)).join(up, ["tree", "run"])
                    .withColumn("path", F.concat(own, "higher")).select(*nodes.columns, "path", *extra))
            kept = kept.select(*many.columns).unionByName(many)
        over = kept if nodes is tree_levels[0] else stored(kept, "merkle-paths")
    return over


def manifest(docs: DataFrame) -> DataFrame:
    """Per document its leaf, subroot and root, the digest of its proof, and
    the root that its tampered or original leaf folds to along the proof."""
    own = levels(stored(numbered(leaves(docs), ["doc_id", "hash"]), "merkle-leaves"))
    subroots = stored(tops(own), "merkle-subroots")
    names = numbered(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "hash"), ["name"])
    upper = levels(stored(names, "merkle-names"))
    root = tops(upper).select("tree", F.col("hash").alias("root"), F.array().cast("array<struct<left:string,right:string>>").alias("path"))
    above = stored(with_paths(upper, root).select(F.col("name").alias("tree"), F.col("hash").alias("subroot"), "root", "path"), "merkle-sources")
    fold = F.aggregate("path", F.coalesce("other", "hash"), lambda node, s: sha(F.concat(s["left"], node, s["right"])))
    proof = sha(F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), ""))
    out = with_paths(own, above).select("doc_id", F.col("hash").alias("leaf"), "subroot", "root", proof.alias("proof_sha256"), fold.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
