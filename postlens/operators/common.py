"""Small DataFrame combinators shared by the operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def side_by_side(*one_row: DataFrame) -> DataFrame:
    """Put several one-row summaries into one row.

    Each input is a global aggregate (exactly one row). Instead of a
    cross join, the rows are stacked with ``unionByName`` (missing columns
    as null) and folded by a global ``first(ignorenulls)``: a single tiny
    aggregation over as many rows as there are inputs.
    """
    cols = [c for df in one_row for c in df.columns]
    clashes = sorted({c for c in cols if cols.count(c) > 1})
    if clashes:
        raise ValueError(f"columns in more than one input: {', '.join(clashes)}")
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), one_row)
    return stacked.agg(*[F.first(c, ignorenulls=True).alias(c) for c in cols])


def union_all(*frames: DataFrame) -> DataFrame:
    """Bag union by column name (``UNION ALL``)."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def flat_arrays(df: DataFrame, sep: str = "|") -> DataFrame:
    """Render array<string> columns as ``sep``-joined text (display form)."""
    out = []
    for f in df.schema.fields:
        if f.dataType.typeName() == "array":
            out.append(F.array_join(F.col(f.name), sep).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)
