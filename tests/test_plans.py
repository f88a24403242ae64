"""Plan checks: no Python evaluation in any non-model plan,
pruned scans, partition pruning, broadcast only of size-checked sides."""

from conftest import SF_SMALL
from postlens.plans import catalog


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


NON_MODEL = [k for k, e in catalog.load_all().items() if e.section != "2.11" and e.oracle]


def test_no_python_udf_in_sql_expressible_plans(spark):
    q = catalog.queries()
    for k in NON_MODEL:
        p = plan_of(q[k](spark, SF_SMALL))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, k


def test_scan_reads_only_needed_columns(spark):
    p = plan_of(catalog.queries()["courier_performance_view"](spark, SF_SMALL))
    assert "l_comment" not in p and "l_extendedprice" not in p


def test_dimensions_that_no_column_needs_are_not_joined(spark):
    p = plan_of(catalog.queries()["courier_performance_view"](spark, SF_SMALL))
    assert "part.parquet" not in p and "p_partkey" not in p and "l_partkey" not in p
    assert "c_custkey" not in plan_of(catalog.queries()["cohort_retention"](spark, SF_SMALL))


def test_periods_reach_the_scan(spark):
    for k in ("department_facts", "transport_facts", "transport_fleet_view", "filter_run_month", "order_by_measure"):
        p = plan_of(catalog.queries()[k](spark, SF_SMALL))
        assert "GreaterThanOrEqual(l_shipdate" in p and "LessThan(l_shipdate" in p, k
    for k in ("prediction_facts", "ml_model_performance_view", "filter_known_actuals"):
        p = plan_of(catalog.queries()[k](spark, SF_SMALL))
        assert "GreaterThanOrEqual(o_orderdate" in p and "LessThan(o_orderdate" in p, k


def test_daily_partition_is_pruned(spark):
    df = catalog.queries()["scan_month_partition"](spark, SF_SMALL)
    p = plan_of(df)
    assert "PartitionFilters: [isnotnull(delivery_month" in p and "delivery_month" in p
    assert "PushedFilters: [IsNotNull(delivery_date), EqualTo(delivery_date" in p


def test_dimensions_broadcast_fact_streamed(spark):
    df = catalog.queries()["department_efficiency_view"](spark, SF_SMALL)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in p
    assert "BuildLeft" not in p  # the fact side (lineitem) is never the build side


def test_broadcast_only_behind_size_checks(spark):
    from postlens.sources.tables import broadcast_if_rows_at_most, broadcast_if_small, table
    part = table(spark, SF_SMALL, "part", "p_partkey", "p_type")
    li = table(spark, SF_SMALL, "lineitem", "l_partkey", "l_quantity")
    hinted = li.join(broadcast_if_small(part), li.l_partkey == part.p_partkey)
    assert "BroadcastHashJoin" in plan_of(hinted)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plain = li.join(broadcast_if_small(part), li.l_partkey == part.p_partkey)
        p = plain._jdf.queryExecution().sparkPlan().toString()
        assert "BroadcastHashJoin" not in p  # no hint beyond the threshold
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    few = part.select("p_type").distinct()
    assert "ResolvedHint" in few.hint("broadcast")._jdf.queryExecution().analyzed().toString()
    n = few.count()
    assert broadcast_if_rows_at_most(few, n - 1) is few  # beyond the bound: left to the planner
    assert broadcast_if_rows_at_most(few, n) is not few  # within it: hinted
