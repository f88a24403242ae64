"""Writers. Every write is a Spark job on the executors; the
driver only names the paths.

``write_append`` replaces exactly the partitions (days) present in the
frame (``partitionOverwriteMode=dynamic``), so a retried day does not
duplicate rows, unlike the reference's plain append; a plain append stays
available with ``idempotent=False``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlens.functions.semantics import np_round
from postlens.sources.files import TIMESTAMP_FORMAT


def write_csv(df: DataFrame, path: str) -> None:
    (df.write.mode("overwrite").option("header", True).option("timestampNTZFormat", TIMESTAMP_FORMAT)
     .csv(path))


def write_json_report(df: DataFrame, path: str) -> None:
    """Nested one-row documents as JSON lines (UTF-8, non-ASCII kept)."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_truncate(df: DataFrame, path: str) -> None:
    """Replace the target's rows (``WRITE_TRUNCATE``)."""
    df.write.mode("overwrite").parquet(path)


def write_append(df: DataFrame, path: str, partition_col: str, idempotent: bool = True) -> None:
    """Append the day's rows; with ``idempotent`` a rerun of a day replaces
    that day's partition instead of adding a second copy.

    Rows are rebalanced by the partition value: the adaptive plan merges
    small values into one task and splits a large one into as many tasks as
    the advisory partition size asks for, so files follow the data's size.
    """
    w = df.hint("rebalance", F.col(partition_col)).write.partitionBy(partition_col)
    if idempotent:
        w = w.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        w = w.mode("append")
    w.parquet(path)


def create_table(spark: SparkSession, name: str, schema: T.StructType, path: str) -> None:
    """A Parquet table at an explicit (shared) location."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet LOCATION '{path}'")


def insert_values(spark: SparkSession, table: str, source: DataFrame, columns: list[str]) -> None:
    """``INSERT INTO table (c1, c2, ...)`` from the rows of ``source``. The
    source's temporary view is dropped again."""
    view = f"_insert_src_{table}"
    source.select(*columns).createOrReplaceTempView(view)
    cols = ", ".join(f"`{c}`" for c in columns)
    try:
        spark.sql(f"INSERT INTO {table} ({cols}) SELECT {cols} FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


def create_or_replace_view(df: DataFrame, prefix: str, ds: str) -> str:
    """Temp view named ``{prefix}_{yyyyMMdd}`` (``{{ds_nodash}}``)."""
    name = f"{prefix}_{ds.replace('-', '')}"
    df.createOrReplaceTempView(name)
    return name


def save_model(model, path: str) -> None:
    """Persist a fitted ``PipelineModel`` (stages, encoders, features)."""
    model.write().overwrite().save(path)


def model_manifest(spark: SparkSession, models_root: str) -> DataFrame:
    """Saved models, the first folder below ``models_root``, with their size
    in MB (2 dp), file count and status, and a total row; from the file
    listing read by Spark (``binaryFile`` metadata only)."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(models_root)
             .select("path", "length"))
    below = F.substring_index("path", f"{models_root.rstrip('/').split(':', 1)[-1]}/", -1)
    g = files.groupBy(F.substring_index(below, "/", 1).alias("model_name")).agg(
        F.sum("length").alias("bytes"), F.count(F.lit(1)).alias("files"))
    total = g.agg(F.sum("bytes").alias("bytes"), F.sum("files").alias("files")).select(
        F.lit("total").alias("model_name"), "bytes", "files", F.lit("summary").alias("status"))
    return (g.withColumn("status", F.lit("SUCCESS")).unionByName(total)
            .select("model_name", np_round(F.col("bytes") / 1048576.0, 2).alias("size_mb"), "files", "status"))
