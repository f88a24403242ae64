"""Bounded, reproducible samples of labelled rows for classifier fits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.llm.common import fold

#: Labelled rows a fit takes at most (documented bound; its ids are broadcast).
SAMPLE_ROWS = 20_000


def sample(labels: DataFrame, label: str, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``(doc_id, label)`` of at most ``rows`` training ids (fold not 0): the
    ones with the smallest hash, whatever the partitioning. Rows without an
    id or label are left out; of repeated ids the larger label counts."""
    one = (labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & (fold(F.col("doc_id")) != 0))
           .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col(label).cast("int")).alias("label")))
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def with_labels(rows: DataFrame, picked: DataFrame) -> DataFrame:
    """The rows whose id is in a sample (at most ``SAMPLE_ROWS`` small rows,
    so the broadcast is bounded) with their label; the rows aren't shuffled."""
    return rows.join(F.broadcast(picked), "doc_id")
