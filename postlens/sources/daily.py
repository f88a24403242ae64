"""One day's input in any mix of JSON, CSV and Parquet files.

A day is the folder ``base/<ds>``. ``list_day`` names its files and their
format by ending; ``read_day`` reads each format with the one declared schema
and stacks them. Lines of JSON and CSV that don't fit the schema keep their
text in ``bad_record`` (their other columns hold what could be read, else
null), so a bad line is neither lost nor fatal; a CSV whose header names
other columns, or a Parquet file of other types, is an error. Files with
another ending are not read, but ``list_day`` shows them.

An absent day (no folder, or none of the three formats in it) is an error by
default, so that a late delivery isn't taken for a day without rows; with
``absent="empty"`` it is an empty frame. Files of size zero hold no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FORMATS = ("json", "csv", "parquet")
#: A blank or a T between day and time; whole seconds, thousandths or millionths.
TIMESTAMPS = "yyyy-MM-dd[ ]['T']HH:mm:ss[.SSSSSS][.SSS]"
BAD = "bad_record"


class AbsentDay(LookupError):
    """The day has no readable file."""


def list_day(spark: SparkSession, base: str, ds: str) -> DataFrame:
    """(path, format, bytes) of the day's files, from the listing alone;
    empty for a day without a folder."""
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{base.rstrip('/')}/{ds}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "path string, format string, bytes long")
    ending = F.lower(F.regexp_extract("path", r"\.([A-Za-z0-9]+)(?:\.gz|\.snappy)?$", 1))
    return files.select("path", F.when(ending.isin(*FORMATS), ending).otherwise("other").alias("format"), F.col("length").alias("bytes"))


def read_day(spark: SparkSession, base: str, schema: T.StructType, ds: str, absent: str = "error") -> DataFrame:
    """The day's rows: the columns of ``schema`` and ``bad_record``."""
    if absent not in ("error", "empty"):
        raise ValueError(f"absent is 'error' or 'empty', not {absent!r}")
    found = [r["format"] for r in list_day(spark, base, ds).where("bytes > 0").select("format").distinct().collect()]
    wide = T.StructType([*schema.fields, T.StructField(BAD, T.StringType())])
    frames = [_read(spark, f"{base.rstrip('/')}/{ds}", kind, schema, wide) for kind in FORMATS if kind in found]
    if frames:
        return reduce(DataFrame.unionByName, frames)
    if absent == "error":
        raise AbsentDay(f"no {', '.join(FORMATS)} file for {ds} under {base}")
    return spark.createDataFrame([], wide)


def _read(spark: SparkSession, folder: str, kind: str, schema: T.StructType, wide: T.StructType) -> DataFrame:
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", f"*.{kind}*")
    if kind == "parquet":
        return reader.schema(schema).parquet(folder).withColumn(BAD, F.lit(None).cast("string"))
    reader = (reader.schema(wide).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD)
              .option("timestampNTZFormat", TIMESTAMPS).option("encoding", "UTF-8"))
    return reader.json(folder) if kind == "json" else reader.option("header", True).option("enforceSchema", False).csv(folder)


def good_rows(day: DataFrame) -> DataFrame:
    """Rows that fit the schema, without ``bad_record``."""
    return day.where(F.col(BAD).isNull()).drop(BAD)


def bad_rows(day: DataFrame) -> DataFrame:
    """The texts that did not fit."""
    return day.where(F.col(BAD).isNotNull()).select(BAD)
