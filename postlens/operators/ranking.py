"""Exact global ranks without a single-partition window.

``row_number()``/``ntile()`` over a window with no partition key pull every
row into one task. Here the frame is range-partitioned on the order
(Spark samples the bounds), sorted within partitions, and each row takes
the number of rows in the partitions before its own plus its position in
its partition. The per-partition counts form a table with one row per
partition, so its broadcast is bounded by the partition count, not by the
data. The numbered frame is checkpointed to the shared checkpoint
directory first, so the counts and the rows come from one materialisation
(range bounds are sampled anew by every evaluation) and executor loss
recomputes from the checkpoint.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlens.session import ensure_checkpoint_dir

_PART_SHIFT = 33  # monotonically_increasing_id: partition index in the upper bits


def global_row_number(df: DataFrame, order: list[Column], out: str = "row_number",
                      total: str | None = None) -> DataFrame:
    """1-based position of each row in ``order`` (which must be total);
    with ``total`` set, also the row count in that column."""
    ensure_checkpoint_dir(df.sparkSession)
    ordered = (df.repartitionByRange(*order).sortWithinPartitions(*order)
               .withColumn("_pid", F.spark_partition_id())
               .withColumn("_mid", F.monotonically_increasing_id()))
    ordered = ordered.checkpoint(eager=True)
    counts = ordered.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"),
                            F.sum("_n").over(everything).alias("_total"))
    pos = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), _PART_SHIFT)
    out_df = (ordered.join(F.broadcast(offsets), "_pid")
              .withColumn(out, F.col("_off") + pos + F.lit(1)))
    out_df = out_df.drop("_pid", "_mid", "_off")
    return out_df.withColumnRenamed("_total", total) if total else out_df.drop("_total")


def ntile_of(row_number: Column, total: Column, n: int) -> Column:
    """``ntile(n)`` from a 1-based row number and the row count: the first
    ``total % n`` tiles hold one row more, as SQL's NTILE does."""
    rn = row_number.cast("long") - 1
    size = F.floor(total / n).cast("long")
    extra = (total % n).cast("long")
    big = extra * (size + 1)
    return F.when(rn < big, F.floor(rn / (size + 1)) + 1).otherwise(
        extra + F.floor((rn - big) / F.greatest(size, F.lit(1))) + 1).cast("int")


def global_ntile(df: DataFrame, order: list[Column], n: int, out: str) -> DataFrame:
    """``ntile(n) OVER (ORDER BY order)`` computed in parallel."""
    ranked = global_row_number(df, order, "_rn", total="_total")
    return ranked.withColumn(out, ntile_of(F.col("_rn"), F.col("_total"), n)).drop("_rn", "_total")
