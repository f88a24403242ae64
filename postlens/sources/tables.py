"""Readers for the driver's Parquet tables.

Every reader names its columns, so the scan's ``ReadSchema`` holds only
what the operator needs; filters written downstream are pushed into the
Parquet scan by Catalyst.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

# Dimension tables whose row count is fixed by the data definition
# (25 nations, 5 regions), so a broadcast of them never grows with scale.
FIXED_SIZE_DIMENSIONS = {"nation": 25, "region": 5}


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*cols) if cols else df


def dimension(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """A fixed-size dimension, marked for broadcast.

    Only tables listed in ``FIXED_SIZE_DIMENSIONS`` qualify: their size is
    bounded by definition, not by the data volume. Everything else is left
    to the optimizer's size-checked ``autoBroadcastJoinThreshold`` and to
    AQE's runtime join selection.
    """
    if name not in FIXED_SIZE_DIMENSIONS:
        raise ValueError(f"{name} is not a fixed-size dimension")
    return F.broadcast(table(spark, sf_dir, name, *cols))


def broadcast_threshold(spark: SparkSession) -> int:
    raw = str(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")).strip().lower()
    units = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30}
    for suffix in sorted(units, key=len, reverse=True):
        if raw.endswith(suffix):
            return int(float(raw[: -len(suffix)]) * units[suffix])
    return int(raw)


def estimated_bytes(df: DataFrame) -> int | None:
    """The optimizer's size estimate of ``df`` (None when unavailable)."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # noqa: BLE001 - estimate not available: no hint
        return None


def broadcast_if_small(df: DataFrame, basis: DataFrame | None = None) -> DataFrame:
    """Hint a broadcast of ``df`` only when its estimated size (or that of
    ``basis``, the table whose rows ``df`` keeps one-to-one, e.g. a table
    joined to a fixed dimension) is within the session's
    ``autoBroadcastJoinThreshold``. Beyond it no hint is given and the
    planner shuffles (sort-merge), with AQE free to switch at runtime.
    Without the hint a small fact sample can look smaller than a dimension
    and be broadcast itself, collapsing the join into one task."""
    limit = broadcast_threshold(df.sparkSession)
    size = estimated_bytes(basis if basis is not None else df)
    if limit <= 0 or size is None or size > limit:
        return df
    return F.broadcast(df)


def broadcast_if_rows_at_most(df: DataFrame, max_rows: int = 1_000_000) -> DataFrame:
    """Broadcast a derived table (e.g. the distinct values of a column)
    after checking its row count with one aggregate job; beyond
    ``max_rows`` it is left to the planner (shuffle join, AQE at runtime).
    Use for lookups joined on low-cardinality keys, where a shuffle join
    would send each key's rows to one task."""
    n = df.agg(F.count(F.lit(1))).first()[0]
    return F.broadcast(df) if n <= max_rows else df
