"""Invariants: reruns, totals, shares, partition independence."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from postlens.operators import sinks as W
from postlens.operators import windows as WIN
from postlens.plans import catalog
from postlens.plans import params as P
from postlens.session import scratch_dir
from postlens.sources.standins import load


def test_rerun_of_a_day_leaves_counts_unchanged(spark):
    facts = WIN.department_facts(load(spark, SF_SMALL, "departments"), P.TRANSPORT_DS)
    path = scratch_dir(spark, "rerun")
    W.write_append(facts, path, "snapshot_date")
    first = spark.read.parquet(path).count()
    W.write_append(facts, path, "snapshot_date")
    assert spark.read.parquet(path).count() == first == facts.count()
    W.write_append(facts, path, "snapshot_date", idempotent=False)
    assert spark.read.parquet(path).count() == 2 * first


def test_shares_and_ranges(spark):
    q = catalog.queries()
    s = q["sentiment_shares"](spark, SF_SMALL).first()
    assert abs(s["positive_share"] + s["neutral_share"] + s["negative_share"] - 1.0) < 1e-9
    for r in q["column_completeness"](spark, SF_SMALL).collect():
        assert 0.0 <= r["completeness_percent"] <= 100.0
    a = q["marketing_attribution"](spark, SF_SMALL)
    tot = a.agg(F.sum("first_touch_share").alias("f"), F.sum("last_touch_share").alias("l")).first()
    assert abs(tot["f"] - 100.0) < 1e-6 and abs(tot["l"] - 100.0) < 1e-6
    r = q["route_validation_summary"](spark, SF_SMALL).first()
    assert r["valid_routes"] + r["invalid_routes"] == r["total_routes"]
    seg = q["rfm_segments"](spark, SF_SMALL).agg(F.sum("customers")).first()[0]
    assert seg == q["customer_ltv"](spark, SF_SMALL).first()["customers"]


def test_results_do_not_depend_on_shuffle_partitions(spark):
    q = catalog.queries()
    keys = ["courier_performance_view", "previous_delivery", "rfm_segments", "web_kpis", "cohort_retention"]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        a = {k: sorted(q[k](spark, SF_SMALL).collect()) for k in keys}
        spark.conf.set("spark.sql.shuffle.partitions", "11")
        b = {k: sorted(q[k](spark, SF_SMALL).collect()) for k in keys}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert a == b


def test_manifest_total_and_report_lines(spark):
    from postlens.operators import reports as REP
    frames = REP.analytics_views(spark, SF_SMALL, P.RUN_DS)
    m = {r["table_name"]: r["row_count"] for r in REP.load_manifest(frames).collect()}
    assert m["total_records"] == sum(v for k, v in m.items() if k != "total_records")
    assert m["courier_performance_view"] == frames["courier_performance_view"].count()
    rep = REP.daily_report(spark, SF_SMALL, P.RUN_DS)
    lines = [r["value"] for r in REP.report_lines(rep).orderBy("line_no").select(
        F.format_string("[%s] %s: %s", "section", "metric", "value").alias("value")).collect()]
    assert lines[0].startswith("[quality] Overall quality score: ") and lines[0].endswith("%")
    assert lines[3].startswith("[business] Revenue: $") and "," in lines[3]
    assert len(lines) == 12


def test_results_do_not_depend_on_session_time_zone(spark):
    q = catalog.queries()
    keys = ["web_kpis", "previous_delivery", "delivery_hour", "scan_daily_partition"]
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        a = {k: sorted(q[k](spark, SF_SMALL).collect()) for k in keys}
        spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
        b = {k: sorted(q[k](spark, SF_SMALL).collect()) for k in keys}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert a == b
