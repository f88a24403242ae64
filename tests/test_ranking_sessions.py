"""Parallel global ranks and split sessions against plain SQL windows."""

import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from postlens.operators.ranking import global_ntile, global_row_number
from postlens.operators.sessions import sessionize


def test_global_ntile_equals_sql_ntile(spark):
    rnd = random.Random(7)
    for n_rows, parts in ((1, 1), (4, 3), (97, 5), (1000, 16)):
        rows = [(i, rnd.randint(0, 20)) for i in range(n_rows)]
        df = spark.createDataFrame(rows, "id int, v int").repartition(parts)
        got = global_ntile(df, [F.col("v").asc(), F.col("id").asc()], 5, "q")
        want = df.withColumn("q", F.ntile(5).over(Window.orderBy("v", "id")))
        assert sorted(got.collect()) == sorted(want.collect())


def test_global_row_number_is_dense_and_ordered(spark):
    df = spark.range(0, 500).select((F.col("id") * 7 % 500).alias("k")).repartition(7)
    got = global_row_number(df, [F.col("k").asc()], "rn", total="n").collect()
    assert sorted(r["rn"] for r in got) == list(range(1, 501))
    assert all(r["rn"] == r["k"] + 1 and r["n"] == 500 for r in got)


def brute_sessions(events, gap):
    out, last = {}, {}
    start = {}
    for uid, ts, eid in sorted(events, key=lambda e: (e[0], e[1], e[2])):
        if uid not in last or ts - last[uid] >= gap:
            start[uid] = ts
        last[uid] = ts
        out[eid] = start[uid]
    return out


def test_sessionize_matches_brute_force_across_days(spark):
    rnd = random.Random(3)
    base = dt.datetime(2024, 1, 1)
    events, eid = [], 0
    for uid in range(5):
        t = base
        for _ in range(400 if uid == 0 else 30):  # user 0 is hot and spans many midnights
            t = t + dt.timedelta(minutes=rnd.choice([1, 5, 29, 30, 31, 200, 900]))
            events.append((uid, t, eid))
            eid += 1
    df = spark.createDataFrame(events, "user_id long, ts timestamp_ntz, event_id long")
    got = {r["event_id"]: r["session_start"] for r in sessionize(df).collect()}
    assert got == brute_sessions(events, dt.timedelta(minutes=30))


def test_sessions_across_midnight_and_multi_day(spark):
    b = dt.datetime(2024, 3, 1)
    events = [
        (1, b.replace(hour=23, minute=50), 1), (1, b + dt.timedelta(days=1, minutes=10), 2),  # 20 min: same
        (2, b.replace(hour=23, minute=29, second=59), 3), (2, b + dt.timedelta(days=1), 4),  # 30 min 1 s: new
        (3, b.replace(hour=23, minute=30), 5), (3, b + dt.timedelta(days=1), 6),  # exactly 30 min: new
    ]
    eid = 100
    for i in range(180):  # user 4: one session lasting 60 hours (an event every 20 minutes)
        events.append((4, b + dt.timedelta(minutes=20 * i), eid))
        eid += 1
    df = spark.createDataFrame(events, "user_id long, ts timestamp_ntz, event_id long")
    got = {r["event_id"]: r["session_start"] for r in sessionize(df).collect()}
    assert got == brute_sessions(events, dt.timedelta(minutes=30))
    assert got[2] == events[0][1] and got[4] == events[3][1] and got[6] == events[5][1]
    assert len({got[e] for e in range(100, 280)}) == 1
