"""Sources and sinks: declared schemas, empty fields, non-ASCII text,
idempotent day partitions and table inserts."""

import datetime as dt

from pyspark.sql import types as T

from postlens.operators import sinks as W
from postlens.session import scratch_dir
from postlens.sources import files as R

SCHEMA = T.StructType([T.StructField("city", T.StringType()), T.StructField("n", T.IntegerType()),
                       T.StructField("at", T.TimestampNTZType())])


def test_csv_empty_field_is_null_and_text_kept(spark):
    path = scratch_dir(spark, "csv_in")
    lines = ["city,n,at", "Київ,3,2024-01-01 10:00:00", "Львів,,2024-01-02 11:30:00", ",7,"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    rows = sorted(R.scan_csv(spark, path, SCHEMA).collect(), key=lambda r: (r["city"] or "", r["n"] or 0))
    assert rows[0]["city"] is None and rows[0]["at"] is None and rows[0]["n"] == 7
    assert rows[1]["city"] == "Київ" and rows[1]["at"] == dt.datetime(2024, 1, 1, 10, 0)
    assert rows[2]["city"] == "Львів" and rows[2]["n"] is None


def test_csv_and_json_round_trip(spark):
    df = spark.createDataFrame([("Одеса", 1, dt.datetime(2024, 5, 1, 8, 15, 0, 123000)), (None, None, None)], SCHEMA)
    p1, p2 = scratch_dir(spark, "csv_rt"), scratch_dir(spark, "json_rt")
    W.write_csv(df, p1)
    W.write_json_report(df, p2)
    assert sorted(R.scan_csv(spark, p1, SCHEMA).collect(), key=str) == sorted(df.collect(), key=str)
    assert sorted(R.scan_json_document(spark, p2, SCHEMA).collect(), key=str) == sorted(df.collect(), key=str)


def test_sql_query_uses_parameter_markers(spark):
    spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int").createOrReplaceTempView("params_t")
    out = R.sql_query(spark, "SELECT k FROM params_t WHERE v = :v", v=2).collect()
    assert [r["k"] for r in out] == ["b"]


def test_insert_by_column_list_and_named_view(spark):
    import uuid
    name = f"t_{uuid.uuid4().hex[:8]}"
    W.create_table(spark, name, SCHEMA, scratch_dir(spark, name))
    src = spark.createDataFrame([("X", 5)], "city string, n int")
    W.insert_values(spark, name, src, ["city", "n"])
    r = spark.table(name).first()
    assert r["city"] == "X" and r["n"] == 5 and r["at"] is None
    v = W.create_or_replace_view(src, "report", "2024-01-31")
    assert v == "report_20240131" and spark.table(v).count() == 1
