"""File and table readers with declared schemas.

Nothing is inferred: CSV and JSON are read with the caller's ``StructType``
(an empty CSV field reads as null), tables by name, daily inputs from a
date-partitioned layout so that the run-date filter prunes partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"


def scan_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Headered UTF-8 CSV with an explicit schema; empty fields are null."""
    return (spark.read.schema(schema).option("header", True).option("encoding", "UTF-8")
            .option("timestampNTZFormat", TIMESTAMP_FORMAT).option("mode", "FAILFAST").csv(path))


def scan_json_document(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One JSON document per file (multi-line), explicit schema."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    """A table or view of the session catalog by name."""
    return spark.table(name)


def register_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Expose Parquet files at ``path`` as the view ``name``."""
    df = spark.read.parquet(path)
    df.createOrReplaceTempView(name)
    return spark.table(name)


def sql_query(spark: SparkSession, query: str, **params) -> DataFrame:
    """Run SQL text with named parameter markers (``:ds``), never by
    pasting values into the text."""
    return spark.sql(query, args=params or None)


def scan_daily_partition(spark: SparkSession, base: str, schema: T.StructType, ds: str,
                         date_col: str, month_col: str | None = None) -> DataFrame:
    """The run date's rows of a date-partitioned layout. With ``month_col``
    the layout is by month (fewer, larger files): the month literal prunes
    directories and the date filter is pushed into the Parquet scan."""
    df = spark.read.schema(schema).option("basePath", base).parquet(base)
    if month_col:
        df = df.where(F.col(month_col) == F.lit(ds[:7]))
    return df.where(F.col(date_col) == F.lit(ds).cast("date"))
