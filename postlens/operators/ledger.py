"""Append-only tables with a commit log by run id.

``root/data/run=<id>/attempt=<uuid>/`` holds the files of one attempt of a
run, partitioned by a day column; ``root/commits`` is a log of published
attempts, one small row each. ``append_run`` writes the files first and
appends the row last, by Spark's own committer, so that an attempt is seen
whole or not at all. Of a run only the attempt published last counts:
repeating a run replaces its own rows and nobody else's, on whatever days
they are, while two runs that write to the same day keep out of each other's
files. Two attempts of one run at the same time leave one of them.

``read_committed`` takes the files from the log, never from a listing, so
files of an attempt that was lost are not read. With ``day`` only the runs
that wrote to the day are opened, and only that day's folder. The log has one
row a published attempt and is small; the files are read in parallel.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

COMMITS = "run_id string, attempt string, seq long, days array<string>, row_count long, published_at timestamp"


def commits(spark: SparkSession, root: str) -> DataFrame:
    """Every published attempt."""
    try:
        return spark.read.schema(COMMITS).parquet(f"{root}/commits")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], COMMITS)


def current_attempts(spark: SparkSession, root: str) -> DataFrame:
    """The attempt that counts of each run."""
    last = F.max(F.struct("seq", "attempt", "days", "row_count", "published_at")).alias("c")
    return commits(spark, root).groupBy("run_id").agg(last).select("run_id", "c.*")


def write_attempt(df: DataFrame, root: str, run_id: str, day_col: str) -> str:
    """Write the files of a new attempt; nobody reads them yet."""
    attempt = uuid.uuid4().hex
    df.hint("rebalance", F.col(day_col)).write.partitionBy(day_col).parquet(_folder(root, run_id, attempt))
    return attempt


def publish(spark: SparkSession, root: str, run_id: str, attempt: str, schema: T.StructType, day_col: str) -> None:
    """Make an attempt the one that counts of its run."""
    own = _rows(spark, root, [(run_id, attempt)], schema)
    days = own.groupBy(F.coalesce(F.col(day_col).cast("string"), F.lit("null")).alias("day")).agg(F.count("*").alias("n")).collect()  # a row a day
    before = commits(spark, root).where(F.col("run_id") == run_id).agg(F.max("seq")).first()[0] or 0
    row = [(run_id, attempt, before + 1, sorted(r["day"] for r in days), sum(r["n"] for r in days))]
    (spark.createDataFrame(row, COMMITS.rsplit(",", 1)[0]).withColumn("published_at", F.current_timestamp())
     .coalesce(1).write.mode("append").parquet(f"{root}/commits"))


def append_run(df: DataFrame, root: str, run_id: str, day_col: str) -> None:
    """Append the rows of a run; a repeated run id replaces its own rows."""
    attempt = write_attempt(df, root, run_id, day_col)
    publish(df.sparkSession, root, run_id, attempt, df.schema, day_col)


def insert_run(source: DataFrame, root: str, schema: T.StructType, columns: list[str], run_id: str, day_col: str) -> None:
    """Append ``source``'s ``columns``; the table's other columns are null."""
    rows = source.select(*[(F.col(f.name) if f.name in columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])
    append_run(rows, root, run_id, day_col)


def read_committed(spark: SparkSession, root: str, schema: T.StructType, day_col: str | None = None, day: str | None = None) -> DataFrame:
    """The rows of all runs, or of one day."""
    attempts = current_attempts(spark, root)
    if day is not None:
        attempts = attempts.where(F.array_contains("days", day))
    names = [(r["run_id"], r["attempt"]) for r in attempts.where("row_count > 0").select("run_id", "attempt").collect()]  # one a run
    rows = _rows(spark, root, names, schema)
    return rows if day is None else rows.where(F.col(day_col).cast("string") == F.lit(day))


def _folder(root: str, run_id: str, attempt: str) -> str:
    safe = "".join(c if c.isalnum() or c in "-_." else f"%{ord(c):x}" for c in run_id)
    return f"{root}/data/run={safe}/attempt={attempt}"


def _rows(spark: SparkSession, root: str, names: list[tuple[str, str]], schema: T.StructType) -> DataFrame:
    # each attempt has its own base path, from which its day folders give the day column
    frames = [spark.read.schema(schema).option("basePath", folder).parquet(folder).select(*schema.names)
              for folder in (_folder(root, *n) for n in names)]
    return reduce(DataFrame.unionByName, frames) if frames else spark.createDataFrame([], schema)
