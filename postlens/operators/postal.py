"""Row formulas and per-entity analyses of the postal pipelines (SURVEY
§2.3, §2.5): trends, efficiency scores, bottleneck and gap labels,
capacity and transport metrics, endpoint rules.

Every function is a projection or a single ``groupBy().agg()`` over its
input; lookups go through literal maps (``create_map``) or a join with a
table whose size is fixed by definition (20 suitability rows, 25 nations).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.functions import lookups as L
from postlens.functions.semantics import at_least, band, col_, labels, np_round, pct_change, safe_div


# ------------------------------------------------------------ row formulas
def delivery_hour(c: Column | str) -> Column:
    """Hour of the receive timestamp."""
    return F.hour(col_(c))


def delivery_delay(actual: Column | str, promised: Column | str) -> Column:
    """Signed minutes late (negative = early)."""
    return col_(actual) - col_(promised)


def on_time_flag(actual: Column | str, promised: Column | str) -> Column:
    """On time when actual <= promised (equal is on time)."""
    return col_(actual) <= col_(promised)


def satisfied_flag(score: Column | str, threshold: int = 7) -> Column:
    return col_(score) >= threshold


def sentiment_band(score: Column | str, hi: int = 7, lo: int = 4) -> Column:
    """positive when score >= hi, negative when score <= lo, else neutral.
    MVP bounds are (7, 4), the ML pipeline's (8, 4). Null score -> null."""
    return band(score, [(">=", hi, "positive"), ("<=", lo, "negative")], "neutral")


def issue_time(receive: Column | str, minutes: Column | str) -> Column:
    """Receive time plus a duration in whole minutes."""
    return col_(receive) + F.make_dt_interval(mins=col_(minutes).cast("int"))


def truncate_int(c: Column) -> Column:
    """Python ``int(x)``: truncation toward zero."""
    return c.cast("int")


def performance_change(cur: Column | str, prev: Column | str) -> Column:
    return pct_change(cur, prev)


def performance_trend(change: Column | str, bound: float = 10.0) -> Column:
    """improving below -bound, declining above +bound (strict), else stable;
    evaluated on the unrounded change. Null change -> null."""
    return band(change, [("<", -bound, "improving"), (">", bound, "declining")], "stable")


def courier_efficiency(avg_time: Column | str, success_rate: Column | str) -> Column:
    """round((1 / avg_time) * success_rate * 100, 2)."""
    return np_round(safe_div(F.lit(1.0), avg_time) * col_(success_rate) * 100.0, 2)


def department_efficiency_score(throughput: Column | str, avg_proc: Column | str,
                                error_rate: Column | str) -> Column:
    """round((throughput / avg_proc) * (1 - error_rate) * 100, 2)."""
    return np_round(safe_div(throughput, avg_proc) * (F.lit(1.0) - col_(error_rate)) * 100.0, 2)


def department_bottlenecks(avg_proc: Column | str, error_rate: Column | str,
                           throughput: Column | str) -> Column:
    return labels((col_(avg_proc) > 60, "slow_processing"),
                  (col_(error_rate) > 0.05, "high_error_rate"),
                  (col_(throughput) < 300, "low_throughput"))


def coverage_gaps(density: Column | str, quality: Column | str) -> Column:
    return labels((col_(density) < 0.7, "low_department_density"),
                  (col_(quality) < 8.0, "service_quality_issues"))


def expansion_priority(ratio: Column | str) -> Column:
    """high below 1.1, medium below 1.3, else low; on the unrounded ratio."""
    return band(ratio, [("<", 1.1, "high"), ("<", 1.3, "medium")], "low")


def staff_floor(c: Column | str) -> Column:
    """``max(1, n)``; a missing count stays missing."""
    return at_least(c, 1)


# Fixed texts of the data-quality issue list.
QUALITY_ISSUE_TEXTS = (
    (90.0, "Minor data completeness issues in social media data"),
    (85.0, "Data freshness warning in CRM system"),
)


def quality_issue_list(score: Column | str) -> Column:
    s = col_(score)
    return labels(*[(s < bound, text) for bound, text in QUALITY_ISSUE_TEXTS])


def quality_status(score: Column | str, pass_above: float = 80.0) -> Column:
    s = col_(score)
    return F.when(s.isNotNull(), F.when(s > pass_above, "PASS").otherwise("FAIL"))


def anomaly_priority(category: Column | str) -> Column:
    return L.map_lookup(L.ANOMALY_PRIORITY, col_(category))


# ------------------------------------------------------------ lookups
def city_adjusted_duration(deliveries: DataFrame, nation: DataFrame) -> DataFrame:
    """``int(duration * city_factor[city])``. The factor table has one row
    per nation (25, fixed), so the broadcast never grows with the data."""
    factors = F.broadcast(L.city_factor_table(nation))
    return (deliveries.join(factors, "city", "left")
            .withColumn("adjusted_duration_minutes",
                        truncate_int(F.col("delivery_duration_minutes") * F.col("city_factor"))))


def parcel_weighted_volume(departments: DataFrame) -> DataFrame:
    """``int(monthly_volume * parcel_factor[parcel_class])``."""
    pclass = L.parcel_class(F.split("parcel_type", " ").getItem(0))
    factor = L.map_lookup(L.PARCEL_FACTOR, pclass)
    return (departments.withColumn("parcel_class", pclass)
            .withColumn("weighted_volume", truncate_int(F.col("monthly_volume") * factor)))


def fleet_capacity(transport: DataFrame, suitability: DataFrame, trips: int = 25) -> DataFrame:
    """``int(fleet_size * suitability[transport][parcel] * trips)`` via a
    two-key join to the 20-row suitability table (broadcast, fixed size)."""
    t = (transport.withColumn("transport_class", L.transport_class(F.col("transport_type")))
         .withColumn("parcel_class", L.parcel_class(F.split("parcel_type", " ").getItem(0))))
    return (t.join(F.broadcast(suitability), ["transport_class", "parcel_class"], "left")
            .withColumn("monthly_capacity",
                        truncate_int(F.col("fleet_size") * F.col("suitability") * F.lit(trips))))


def transport_metrics(transport: DataFrame, *kept: str) -> DataFrame:
    """total distance = deliveries * mean distance; fuel = distance * litres
    per km of the transport class; utilization % = round(deliveries /
    (fleet * 30) * 100, 2). ``kept`` columns go along unchanged."""
    tclass = L.transport_class(F.col("transport_type"))
    dist = F.col("monthly_deliveries") * F.col("avg_distance_per_delivery")
    return transport.select(
        "transport_type", "parcel_type", "month", "fleet_size", "monthly_deliveries",
        tclass.alias("transport_class"),
        dist.alias("computed_distance_km"),
        (dist * L.map_lookup(L.FUEL_PER_KM, tclass)).alias("computed_fuel_liters"),
        np_round(safe_div("monthly_deliveries", F.col("fleet_size") * 30) * 100.0, 2)
        .alias("utilization_rate_percent"), *kept)


def route_endpoints(routes: DataFrame) -> DataFrame:
    """Keep only the endpoints the delivery type defines; others null.

    Department to Department: sender and receiver department.
    Department to Courier: sender department, receiver location.
    Courier to Department: sender location, receiver department.
    Courier to Courier: sender and receiver location.
    """
    t = F.col("delivery_type")
    sender_dept = t.isin("Department to Department", "Department to Courier")
    receiver_dept = t.isin("Department to Department", "Courier to Department")
    sender_loc = t.isin("Courier to Department", "Courier to Courier")
    receiver_loc = t.isin("Department to Courier", "Courier to Courier")
    return routes.select(
        "route_id", "delivery_type",
        F.when(sender_dept, F.col("sender_department")).alias("sender_department"),
        F.when(receiver_dept, F.col("receiver_department")).alias("receiver_department"),
        F.when(sender_loc, F.col("sender_location")).alias("sender_location"),
        F.when(receiver_loc, F.col("receiver_location")).alias("receiver_location"))


# ------------------------------------------------------------ per-entity analyses
def coverage_rows(coverage: DataFrame) -> DataFrame:
    """Row-level coverage columns: ratio (rounded 3), priority on the
    unrounded ratio, gap labels."""
    ratio = safe_div("current_monthly_capacity", "estimated_monthly_demand")
    return coverage.select(
        "*",
        np_round(ratio, 3).alias("capacity_ratio"),
        expansion_priority(ratio).alias("expansion_priority"),
        coverage_gaps("coverage_density", "service_quality_score").alias("service_gaps"))


def geographical_coverage(coverage: DataFrame, ds: str) -> DataFrame:
    """By region: distinct cities, departments, demand and capacity, mean
    density and quality; then gaps and expansion priority."""
    g = (coverage.where(F.col("analysis_date") == F.lit(ds).cast("date"))
         .groupBy("region")
         .agg(F.count_distinct("city").alias("cities_covered"),
              F.sum("total_departments").alias("total_departments"),
              F.avg("coverage_density").alias("coverage_density"),
              F.avg("service_quality_score").alias("service_quality_score"),
              F.sum("estimated_monthly_demand").alias("estimated_monthly_demand"),
              F.sum("current_monthly_capacity").alias("current_monthly_capacity")))
    ratio = safe_div("current_monthly_capacity", "estimated_monthly_demand")
    return g.select(
        "region", "cities_covered", "total_departments",
        np_round("coverage_density", 3).alias("coverage_density"),
        np_round("service_quality_score", 2).alias("service_quality_score"),
        "estimated_monthly_demand", "current_monthly_capacity",
        np_round(ratio, 3).alias("capacity_ratio"),
        coverage_gaps("coverage_density", "service_quality_score").alias("service_gaps"),
        expansion_priority(ratio).alias("expansion_priority"),
        F.lit(ds).cast("date").alias("analysis_date"))


def department_efficiency(departments: DataFrame, ds: str) -> DataFrame:
    """By department: mean processing time, daily throughput (mean of
    ``daily_processed``), error rate (share of rows of the returned flag
    ``R``), capacity utilization (mean queue / max queue); then score and
    bottlenecks from the unrounded inputs."""
    g = (departments.groupBy("department_id", "department_type")
         .agg(F.avg("avg_processing_time_minutes").alias("avg_proc"),
              F.avg("daily_processed").alias("throughput"),
              F.avg(F.when(F.col("transport_type") == "R", 1.0).otherwise(0.0)).alias("err"),
              safe_div(F.avg("queue_length"), F.max("queue_length")).alias("util")))
    return g.select(
        "department_id", "department_type",
        np_round("avg_proc", 2).alias("avg_processing_time_minutes"),
        np_round("throughput", 2).alias("daily_throughput"),
        np_round("err", 4).alias("error_rate"),
        department_efficiency_score("throughput", "avg_proc", "err").alias("efficiency_score"),
        department_bottlenecks("avg_proc", "err", "throughput").alias("bottlenecks"),
        np_round("util", 3).alias("capacity_utilization"),
        F.lit(ds).cast("date").alias("analysis_date"))


def courier_monthly(deliveries: DataFrame) -> DataFrame:
    """Per (courier, month): mean duration, deliveries, success share.
    Partial aggregation before the shuffle keeps a hot courier cheap."""
    return (deliveries.where(F.col("courier_id").isNotNull())
            .groupBy("courier_id", F.date_format("delivery_date", "yyyy-MM").alias("month"))
            .agg(F.avg("delivery_duration_minutes").alias("avg_delivery_time"),
                 F.count(F.lit(1)).alias("deliveries_completed"),
                 F.avg(F.col("success").cast("double")).alias("success_rate")))


def courier_current_vs_previous(deliveries: DataFrame) -> DataFrame:
    """Each courier-month beside the courier's preceding month with
    deliveries: change %, trend and efficiency.

    The ``lag`` runs over the per-month aggregate (one row per courier and
    month), so even a courier holding a third of all deliveries gives a
    window partition of at most a few hundred rows.
    """
    from pyspark.sql import Window
    m = courier_monthly(deliveries)
    w = Window.partitionBy("courier_id").orderBy("month")
    m = m.withColumn("previous_avg_delivery_time", F.lag("avg_delivery_time").over(w))
    change = performance_change("avg_delivery_time", "previous_avg_delivery_time")
    return m.select(
        "courier_id", "month",
        F.col("avg_delivery_time").alias("current_avg_delivery_time"),
        "previous_avg_delivery_time",
        np_round(change, 2).alias("performance_change_percent"),
        performance_trend(change).alias("performance_trend"),
        "deliveries_completed",
        np_round("success_rate", 3).alias("success_rate"),
        courier_efficiency("avg_delivery_time", "success_rate").alias("efficiency_score"))
