"""Connected components of a link table, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node with a link: ``root`` is the least node of
    its component. ``links`` has columns a and b.

    Rounds of large-star and small-star: every node hands its larger, then
    its smaller neighbours to the least one it knows, until nothing changes
    (a logarithmic number of rounds). Grouping by a node only takes minima,
    so a node with very many links is pre-aggregated; the joins may be split
    by the adaptive skew join."""
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), "links")
    before = None
    while True:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = large.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(low, "u").select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")) \
            .select("e.*").where("u != v").distinct()
        edges = stored(small, "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if before == now:
            break
        before = now
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
