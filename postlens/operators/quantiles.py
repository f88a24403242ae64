"""Exact quantiles of many probabilities, without a sort of the data.

``exact_quantiles`` gives the value at rank ``max(1, n - floor(n - p * n))``
of each group (SQL's ``quantile_disc``) for any number of probabilities at
once. The range of a group's values is cut into ``bins`` cells, rows are
counted per cell (a partial aggregate, so only counts are shuffled), and
each rank goes on in its cell with the cell's own least and largest value.
A cell of equal values is an answer. When all open cells together hold at
most ``enough`` rows, these rows alone are numbered. A pass keeps the rows
of the open cells only; data of ordinary spread takes two passes.

Null and NaN values are left out; a group without values has no row. The
number of groups times probabilities must stay small (it is joined as a
checked broadcast); the number of rows is free, and so is their spread, since
every pass splits each open cell.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postlens.session import scratch_dir
from postlens.sources.tables import broadcast_if_rows_at_most

BINS, ENOUGH = 4096, 200_000


def _kept(df: DataFrame, name: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def exact_quantiles(df: DataFrame, value: str, probs: list[float], by: list[str] | None = None,
                    bins: int = BINS, enough: int = ENOUGH) -> DataFrame:
    """(by..., prob, quantile) for every group and probability."""
    by = by or []
    group = F.struct(*by) if by else F.struct(F.lit(0).alias("all"))
    rows = df.select(group.alias("g"), F.col(value).cast("double").alias("v")).where("v is not null and not isnan(v)")
    per_group = rows.groupBy("g").agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    each = F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("prob")
    rank = F.greatest(F.lit(1), F.col("n") - F.floor(F.col("n") - F.col("prob") * F.col("n")).cast("long"))
    ranks = _kept(per_group.select("g", "lo", "hi", "n", each).select("g", "prob", rank.alias("rank"), "lo", "hi", "n"), "quantile-ranks")
    while True:
        open_cells = broadcast_if_rows_at_most(ranks.where("lo < hi").select("g", "lo", "hi", "n").distinct(), 100_000)
        left = ranks.where("lo < hi").select("g", "lo", "hi", "n").distinct().agg(F.sum("n")).first()[0]
        if left is None:
            break
        inside = rows.join(open_cells.drop("n"), "g").where("v >= lo and v <= hi")
        if left <= enough:
            w = Window.partitionBy("g", "lo", "hi").orderBy("v")
            placed = inside.withColumn("rank", F.row_number().over(w))
            found = ranks.where("lo < hi").join(placed, ["g", "lo", "hi", "rank"]).select("g", "prob", F.col("v").alias("lo"))
            ranks = ranks.where("lo = hi").select("g", "prob", "lo").unionByName(found)
            break
        width = F.col("hi") - F.col("lo")  # above zero for unequal doubles; infinite for the widest ranges, then in halves
        part = F.when(width < float("inf"), F.try_divide(F.col("v") - F.col("lo"), width)).otherwise(
            F.try_divide(F.col("v") / 2 - F.col("lo") / 2, F.col("hi") / 2 - F.col("lo") / 2))
        cell = F.least(F.lit(bins - 1), F.floor(part * bins).cast("int"))
        counted = inside.groupBy("g", "lo", "hi", cell.alias("cell")).agg(F.count("*").alias("c"), F.min("v").alias("low"), F.max("v").alias("high"))
        upto = Window.partitionBy("g", "lo", "hi").orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)  # at most ``bins`` rows
        summed = counted.withColumn("upto", F.sum("c").over(upto))
        hit = (ranks.where("lo < hi").drop("n").join(summed, ["g", "lo", "hi"]).where("upto >= rank and upto - c < rank")
               .select("g", "prob", (F.col("rank") - F.col("upto") + F.col("c")).alias("rank"), F.col("low").alias("lo"), F.col("high").alias("hi"), F.col("c").alias("n")))
        ranks = _kept(ranks.where("lo = hi").unionByName(hit), "quantile-ranks")
    return ranks.select(*[F.col("g")[c].alias(c) for c in by], "prob", F.col("lo").alias("quantile"))
