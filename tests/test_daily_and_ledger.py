import datetime as dt

import pytest
from pyspark.sql import types as T

from postlens.operators import ledger as L
from postlens.operators import sinks as W
from postlens.session import scratch_dir
from postlens.sources import daily as D

SCHEMA = T.StructType([T.StructField("city", T.StringType()), T.StructField("n", T.IntegerType()), T.StructField("day", T.DateType()),
                       T.StructField("at", T.TimestampNTZType())])
DAY = dt.date(2024, 5, 1)


def rows(spark, n, start=0):
    data = [(f"Київ {i}" if i % 3 else None, i, DAY, dt.datetime(2024, 5, 1, i % 24, 5, 0, 1000 * i)) for i in range(start, start + n)]
    return spark.createDataFrame(data, SCHEMA)


def values(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_mixed_day_gives_the_rows_of_one_format(spark):
    base, df = scratch_dir(spark, "day"), rows(spark, 30)
    df.where("n < 10").write.json(f"{base}/2024-05-01/a")
    W.write_csv(df.where("n >= 10 and n < 20"), f"{base}/2024-05-01/b")
    df.where("n >= 20").write.parquet(f"{base}/2024-05-01/c")
    df.write.parquet(f"{base}/2024-05-02")
    assert values(D.good_rows(D.read_day(spark, base, SCHEMA, "2024-05-01"))) == values(D.good_rows(D.read_day(spark, base, SCHEMA, "2024-05-02"))) == values(df)
    assert {r.format for r in D.list_day(spark, base, "2024-05-01").collect()} == {"json", "csv", "parquet"}


def test_bad_lines_are_kept(spark):
    base = scratch_dir(spark, "day")
    put = lambda lines, name: spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{base}/2024-05-01/{name}")
    from pathlib import Path
    put(['{"city": "A", "n": 1}', '{"city": "B", "n": "many"}', "{broken"], "j")
    put(["city,n,day,at", "C,2,2024-05-01,", "D,few,2024-05-01,", "E,3"], "c")
    for name, ending in (("j", "json"), ("c", "csv")):
        folder = Path(f"{base}/2024-05-01/{name}".removeprefix("file:"))
        for f in folder.glob("part-*.txt"):
            f.rename(f.with_suffix(f".{ending}"))
    day = D.read_day(spark, base, SCHEMA, "2024-05-01").cache()
    assert {(r.city, r.n) for r in D.good_rows(day).collect()} == {("A", 1), ("C", 2)}
    assert {r.bad_record for r in D.bad_rows(day).collect()} == {'{"city": "B", "n": "many"}', "{broken", "D,few,2024-05-01,", "E,3"}


def test_absent_day(spark):
    base = scratch_dir(spark, "day")
    rows(spark, 2).select("city").na.fill("x").write.text(f"{base}/2024-05-03")
    for ds in ("2024-05-01", "2024-05-03"):  # no folder; no file of a known format
        with pytest.raises(D.AbsentDay):
            D.read_day(spark, base, SCHEMA, ds)
        empty = D.read_day(spark, base, SCHEMA, ds, absent="empty")
        assert empty.count() == 0 and empty.columns == [*SCHEMA.names, "bad_record"]
    with pytest.raises(ValueError):
        D.read_day(spark, base, SCHEMA, "2024-05-01", absent="skip")
    assert "other" in {r.format for r in D.list_day(spark, base, "2024-05-03").collect()}


def test_two_writers_and_a_retry(spark):
    root = scratch_dir(spark, "ledger")
    assert L.read_committed(spark, root, SCHEMA).count() == 0
    a, b = rows(spark, 10), rows(spark, 7, 100)
    L.append_run(a, root, "a/2024-05-01", "day")
    L.append_run(b, root, "b", "day")
    assert values(L.read_committed(spark, root, SCHEMA)) == values(a.union(b))
    L.append_run(a, root, "a/2024-05-01", "day")  # a retry
    assert values(L.read_committed(spark, root, SCHEMA)) == values(a.union(b))
    L.append_run(a.where("n < 3"), root, "a/2024-05-01", "day")  # a corrected run
    assert values(L.read_committed(spark, root, SCHEMA, "day", "2024-05-01")) == values(a.where("n < 3").union(b))
    assert L.commits(spark, root).count() == 4 and L.current_attempts(spark, root).count() == 2


def test_attempt_without_commit_is_not_read(spark):
    root = scratch_dir(spark, "ledger")
    a = rows(spark, 5)
    L.append_run(a, root, "a", "day")
    lost = L.write_attempt(rows(spark, 50), root, "a", "day")  # the job dies here
    assert values(L.read_committed(spark, root, SCHEMA)) == values(a)
    L.publish(spark, root, "a", lost, SCHEMA, "day")
    assert L.read_committed(spark, root, SCHEMA).count() == 50


def test_days_nulls_and_empty_runs(spark):
    root = scratch_dir(spark, "ledger")
    df = spark.createDataFrame([("x", 1, DAY, None), ("y", 2, dt.date(2024, 5, 2), None), ("z", 3, None, None)], SCHEMA)
    L.append_run(df, root, "r", "day")
    L.append_run(df.where("n > 9"), root, "none", "day")
    assert values(L.read_committed(spark, root, SCHEMA)) == values(df)
    assert [r.city for r in L.read_committed(spark, root, SCHEMA, "day", "2024-05-02").collect()] == ["y"]
    assert L.read_committed(spark, root, SCHEMA, "day", "2020-01-01").count() == 0
    L.append_run(df.where("n > 9"), root, "r", "day")  # a corrected run without rows takes its rows away
    assert L.read_committed(spark, root, SCHEMA).count() == 0


def test_insert_by_column_list(spark):
    root = scratch_dir(spark, "ledger")
    src = spark.createDataFrame([("X", 5)], "city string, n int")
    for _ in range(2):
        L.insert_run(src, root, SCHEMA, ["city"], "i", "day")
    assert values(L.read_committed(spark, root, SCHEMA)) == [("X", None, None, None)]
