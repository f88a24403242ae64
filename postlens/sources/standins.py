"""Stand-in fixtures: the reference's row shapes derived from the driver's
tables (definitions in FIXTURES.md).

Join shape for scale: the fixed-size dimensions (nation, region) are
broadcast; supplier, part, customer and orders grow with the data and are
joined by the optimizer (broadcast only under the size-checked
``autoBroadcastJoinThreshold``, otherwise shuffle joins that AQE may still
convert or de-skew at runtime). Where a big table is only needed as an
aggregate (predictions), it is aggregated before the join so the shuffle
carries one row per key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.functions.semantics import month_key, padded_id
from postlens.sources.tables import broadcast_if_small, dimension, table


def _dept_type(key) -> F.Column:
    k = key % 4
    return (F.when(k == 0, "sorting").when(k == 1, "distribution")
            .when(k == 2, "local").otherwise("hub"))


def _supplier_city(spark: SparkSession, sf: str) -> DataFrame:
    nation = dimension(spark, sf, "nation", "n_nationkey", "n_name")
    sup = table(spark, sf, "supplier", "s_suppkey", "s_nationkey")
    joined = sup.join(nation, sup.s_nationkey == nation.n_nationkey).select("s_suppkey", "n_name", "n_nationkey")
    return broadcast_if_small(joined, basis=sup)


def _one_each(df: DataFrame, key: str) -> DataFrame:
    """One row per key. A left join to it that no later column needs is
    removed by the optimizer, which sees that the keys are distinct; so a
    query pays for the dimensions it uses only. Every fact row has its
    dimension row, so the left join keeps the rows of the inner one."""
    return df.groupBy(key).agg(*[F.first(c).alias(c) for c in df.columns if c != key])


def _months(df: DataFrame, column: str, month: str | None) -> DataFrame:
    """Rows of a ``YYYY-MM`` month as a half-open range on the raw column,
    which reaches the scan (a filter on the derived month would not)."""
    if month is None:
        return df
    year, number = map(int, month.split("-"))
    after = f"{year + number // 12:04d}-{number % 12 + 1:02d}-01"
    return df.where((F.col(column) >= F.lit(f"{month}-01").cast("timestamp_ntz")) & (F.col(column) < F.lit(after).cast("timestamp_ntz")))


def deliveries(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
               "l_quantity", "l_returnflag", "l_shipdate")
    part = table(spark, sf, "part", "p_partkey", "p_type")
    part = broadcast_if_small(_one_each(part, "p_partkey"), basis=part)
    city = _one_each(_supplier_city(spark, sf), "s_suppkey")
    city = broadcast_if_small(city, basis=table(spark, sf, "supplier", "s_suppkey", "s_nationkey"))
    df = (li.join(city, li.l_suppkey == F.col("s_suppkey"), "left")
            .join(part, li.l_partkey == part.p_partkey, "left"))
    receive = F.col("l_shipdate") + F.make_dt_interval(hours=(F.col("l_orderkey") % 24).cast("int"))
    minutes = (F.col("l_quantity") * 4).cast("int")
    return df.select(
        F.concat(padded_id("DEL_", "l_orderkey", 9), F.lit("_"), F.col("l_linenumber").cast("string")).alias("delivery_id"),
        padded_id("CUR_", "l_suppkey", 5).alias("courier_id"),
        padded_id("PCL_", "l_partkey", 6).alias("parcel_id"),
        F.col("p_type").alias("parcel_type"),
        F.col("n_name").alias("city"),
        receive.alias("receive_datetime"),
        (receive + F.make_dt_interval(mins=minutes)).alias("issue_datetime"),
        minutes.alias("delivery_duration_minutes"),
        F.col("l_shipdate").cast("date").alias("delivery_date"),
        (F.col("l_returnflag") != "R").alias("success"),
    )


def departments(spark: SparkSession, sf: str, month: str | None = None) -> DataFrame:
    li = _months(table(spark, sf, "lineitem", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                       "l_returnflag", "l_shipdate"), "l_shipdate", month)
    part = broadcast_if_small(table(spark, sf, "part", "p_partkey", "p_type"))
    df = (li.join(_supplier_city(spark, sf), li.l_suppkey == F.col("s_suppkey"))
            .join(part, li.l_partkey == part.p_partkey)
            .withColumn("month", month_key("l_shipdate")))
    g = df.groupBy("s_suppkey", "n_name", "p_type", "l_returnflag", "month").agg(
        F.count(F.lit(1)).alias("monthly_volume"),
        F.avg("l_quantity").alias("avg_processing_time_minutes"),
        F.sum("l_quantity").cast("int").alias("daily_processed"),
        F.max("l_linenumber").alias("queue_length"),
    )
    return g.select(
        padded_id("DEPT_", "s_suppkey", 5).alias("department_id"),
        _dept_type(F.col("s_suppkey")).alias("department_type"),
        F.col("n_name").alias("city"),
        F.col("p_type").alias("parcel_type"),
        F.col("l_returnflag").alias("transport_type"),
        "monthly_volume", "avg_processing_time_minutes", "month", "daily_processed", "queue_length",
    )


def transport(spark: SparkSession, sf: str, month: str | None = None) -> DataFrame:
    li = _months(table(spark, sf, "lineitem", "l_partkey", "l_suppkey", "l_quantity", "l_tax",
                       "l_returnflag", "l_shipdate"), "l_shipdate", month)
    part = broadcast_if_small(table(spark, sf, "part", "p_partkey", "p_type"))
    df = li.join(part, li.l_partkey == part.p_partkey).withColumn("month", month_key("l_shipdate"))
    g = df.groupBy("l_returnflag", "p_type", "month").agg(
        F.count_distinct("l_suppkey").alias("fleet_size"),
        F.count(F.lit(1)).alias("monthly_deliveries"),
        F.avg("l_quantity").alias("avg_distance_per_delivery"),
        F.sum("l_quantity").alias("total_distance_km"),
        F.sum(F.col("l_quantity") * F.col("l_tax")).alias("fuel_consumption_liters"),
    )
    return g.select(
        F.col("l_returnflag").alias("transport_type"),
        F.col("p_type").alias("parcel_type"),
        "fleet_size", "monthly_deliveries", "avg_distance_per_delivery", "total_distance_km",
        "fuel_consumption_liters",
        (F.col("monthly_deliveries").cast("double") / (F.col("fleet_size") * 30)).alias("utilization_rate"),
        "month",
    )


def feedback(spark: SparkSession, sf: str) -> DataFrame:
    ev = table(spark, sf, "events", "event_id", "ts", "user_id", "event_type", "value", "props")
    nation = dimension(spark, sf, "nation", "n_nationkey", "n_name")
    df = ev.join(nation, nation.n_nationkey == ev.user_id % 25)
    actual = F.floor("value").cast("int")
    score = F.lit(1) + actual % 10
    return df.select(
        padded_id("FB_", "event_id", 9).alias("feedback_id"),
        F.concat(padded_id("DEL_", "event_id", 9), F.lit("_1")).alias("delivery_id"),
        padded_id("CUST_", "user_id", 6).alias("customer_id"),
        F.col("n_name").alias("city"),
        F.col("event_type").alias("delivery_type"),
        score.alias("satisfaction_score"),
        F.col("props").alias("feedback_text"),
        F.when(score >= 7, "positive").when(score <= 4, "negative").otherwise("neutral").alias("sentiment"),
        actual.alias("delivery_time_actual"),
        F.lit(60).alias("delivery_time_promised"),
        (actual <= 60).alias("on_time_delivery"),
        F.col("ts").cast("date").alias("feedback_date"),
        F.lit("uk").alias("language"),
    )


def department_dim(spark: SparkSession, sf: str) -> DataFrame:
    sup = table(spark, sf, "supplier", "s_suppkey", "s_nationkey")
    nation = dimension(spark, sf, "nation", "n_nationkey", "n_name", "n_regionkey")
    region = dimension(spark, sf, "region", "r_regionkey", "r_name")
    df = sup.join(nation, sup.s_nationkey == nation.n_nationkey).join(region, F.col("n_regionkey") == region.r_regionkey)
    # One row per supplier: its size is the supplier table's.
    return broadcast_if_small(df.select(padded_id("DEPT_", "s_suppkey", 5).alias("department_id"),
                                        F.col("n_name").alias("city"), F.col("r_name").alias("region")), basis=sup)


def routes(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem", "l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag")
    orders = table(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    cust = table(spark, sf, "customer", "c_custkey", "c_nationkey")
    sn = dimension(spark, sf, "nation", "n_nationkey", "n_name").select(
        F.col("n_nationkey").alias("sn_key"), F.col("n_name").alias("sn_name"))
    cn = dimension(spark, sf, "nation", "n_nationkey", "n_name").select(
        F.col("n_nationkey").alias("cn_key"), F.col("n_name").alias("cn_name"))
    sup_t = table(spark, sf, "supplier", "s_suppkey", "s_nationkey")
    sup = broadcast_if_small(sup_t.join(sn, F.col("s_nationkey") == F.col("sn_key")), basis=sup_t)
    cust_geo = broadcast_if_small(cust.join(cn, F.col("c_nationkey") == F.col("cn_key")), basis=cust)
    oc = broadcast_if_small(orders.join(cust_geo, orders.o_custkey == cust_geo.c_custkey), basis=orders)
    df = li.join(oc, li.l_orderkey == oc.o_orderkey).join(sup, li.l_suppkey == sup.s_suppkey)
    k = F.col("o_orderkey") % 4
    return df.select(
        F.concat(F.lit("ROUTE_"), F.col("l_orderkey").cast("string"), F.lit("_"),
                 F.col("l_linenumber").cast("string")).alias("route_id"),
        padded_id("ORDER_", "o_orderkey", 9).alias("order_id"),
        F.when(k == 0, "Department to Department").when(k == 1, "Department to Courier")
         .when(k == 2, "Courier to Department").otherwise("Courier to Courier").alias("delivery_type"),
        F.when(k.isin(0, 1), padded_id("DEPT_", "l_suppkey", 5)).alias("sender_department"),
        F.when(k.isin(0, 2), padded_id("DEPT_", F.col("o_custkey") % 110, 5)).alias("receiver_department"),
        F.when(k.isin(2, 3), F.col("sn_name")).alias("sender_location"),
        F.when(k.isin(1, 3), F.col("cn_name")).alias("receiver_location"),
        (F.col("l_returnflag") != "R").alias("is_valid_route"),
        F.col("l_quantity").cast("int").alias("estimated_distance_km"),
        (F.col("l_quantity") * 2).cast("int").alias("estimated_time_minutes"),
        F.col("o_orderdate").cast("date").alias("validation_date"),
        F.col("l_linenumber").alias("processing_time_ms"),
    )


def staff(spark: SparkSession, sf: str) -> DataFrame:
    cust = table(spark, sf, "customer", "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    nation = dimension(spark, sf, "nation", "n_nationkey", "n_regionkey")
    region = dimension(spark, sf, "region", "r_regionkey", "r_name")
    df = cust.join(nation, cust.c_nationkey == nation.n_nationkey).join(region, F.col("n_regionkey") == region.r_regionkey)
    return df.select(
        padded_id("DEPT_", "c_nationkey", 5).alias("department_id"),
        _dept_type(F.col("c_nationkey")).alias("department_type"),
        F.col("r_name").alias("region"),
        F.col("c_mktsegment").alias("position"),
        (F.lit(1) + F.col("c_custkey") % 5).cast("int").alias("staff_count"),
        F.col("c_acctbal").alias("avg_salary"),
        (F.col("c_custkey") % 60).cast("int").alias("experience_months"),
        F.when(F.col("c_custkey") % 2 == 0, F.lit("2024-01-01").cast("date"))
         .otherwise(F.lit("2024-01-02").cast("date")).alias("snapshot_date"),
    )


def coverage(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem", "l_suppkey", "l_quantity", "l_returnflag")
    sup = table(spark, sf, "supplier", "s_suppkey", "s_nationkey")
    nation = dimension(spark, sf, "nation", "n_nationkey", "n_name", "n_regionkey")
    region = dimension(spark, sf, "region", "r_regionkey", "r_name")
    sup_geo = broadcast_if_small(sup.join(nation, sup.s_nationkey == nation.n_nationkey)
                                 .join(region, F.col("n_regionkey") == region.r_regionkey), basis=sup)
    g = li.join(sup_geo, li.l_suppkey == sup_geo.s_suppkey).groupBy("r_name", "n_name", "n_nationkey").agg(
        F.count_distinct("s_suppkey").alias("total_departments"),
        F.avg(F.when(F.col("l_returnflag") != "R", 12.0).otherwise(0.0)).alias("service_quality_score"),
        F.count(F.lit(1)).alias("estimated_monthly_demand"),
        F.sum("l_quantity").alias("sum_qty"),
    )
    return g.select(
        F.col("r_name").alias("region"), F.col("n_name").alias("city"),
        F.lit(1).alias("cities_covered"), "total_departments",
        (F.col("total_departments").cast("double") / 6).alias("coverage_density"),
        "service_quality_score", "estimated_monthly_demand",
        (F.col("sum_qty") / (F.lit(18) + F.col("n_nationkey") % 8)).alias("current_monthly_capacity"),
        F.lit("2024-01-01").cast("date").alias("analysis_date"),
    )


def predictions(spark: SparkSession, sf: str, year: int | None = None) -> DataFrame:
    orders = table(spark, sf, "orders", "o_orderkey", "o_orderdate", "o_orderpriority", "o_totalprice")
    li = table(spark, sf, "lineitem", "l_orderkey", "l_extendedprice", "l_discount")
    if year is not None:  # the year's orders first, then only their line items
        orders = orders.where((F.col("o_orderdate") >= F.lit(f"{year}-01-01").cast("timestamp_ntz"))
                              & (F.col("o_orderdate") < F.lit(f"{year + 1}-01-01").cast("timestamp_ntz")))
        li = li.join(orders.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_semi")
    # One row per order before the join: the shuffle carries per-key partials.
    per_order = li.groupBy("l_orderkey").agg(
        F.sum("l_extendedprice").alias("actual_value"),
        F.avg(F.lit(1.0) - F.col("l_discount")).alias("conf"),
    )
    df = orders.join(per_order, orders.o_orderkey == per_order.l_orderkey, "left")
    return df.select(
        F.date_trunc("year", "o_orderdate").cast("date").alias("prediction_date"),
        F.col("o_orderpriority").alias("model_type"),
        padded_id("ORDER_", "o_orderkey", 9).alias("entity_id"),
        F.col("o_totalprice").alias("predicted_value"),
        "actual_value",
        F.coalesce("conf", F.lit(0.5)).alias("confidence_score"),
        F.lit("currency").alias("unit"),
    )


def purchases(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    cust = table(spark, sf, "customer", "c_custkey", "c_mktsegment")
    cust = broadcast_if_small(_one_each(cust, "c_custkey"), basis=cust)
    df = orders.join(cust, orders.o_custkey == cust.c_custkey, "left")
    return df.select(
        padded_id("CUST_", "o_custkey", 6).alias("customer_id"),
        padded_id("ORDER_", "o_orderkey", 9).alias("order_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("o_totalprice").alias("amount"),
        F.col("c_mktsegment").alias("segment"),
    )


def touches(spark: SparkSession, sf: str) -> DataFrame:
    ev = table(spark, sf, "events", "event_id", "user_id", "ts", "event_type", "value")
    return ev.select("event_id", "user_id", "ts", F.col("event_type").alias("channel"),
                     (F.col("event_type") == "purchase").alias("is_conversion"), "value")


def daily_metrics(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders", "o_orderdate", "o_totalprice")
    return (orders.groupBy(F.col("o_orderdate").cast("date").alias("date"))
                  .agg(F.sum("o_totalprice").alias("value"))
                  .select("date", F.lit("revenue").alias("metric"), "value"))


def text_labels(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents", "doc_id", "text", "lang")
    labels = broadcast_if_small(table(spark, sf, "labels", "doc_id", "quality", "toxic"))
    df = docs.join(labels, "doc_id")
    return df.select(
        "doc_id", "text", F.col("lang").alias("language"),
        F.when(F.col("toxic") == 1, "negative").when(F.col("quality") == 1, "positive")
         .otherwise("neutral").alias("label"),
    )


def interactions(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem", "l_orderkey", "l_partkey")
    orders = broadcast_if_small(table(spark, sf, "orders", "o_orderkey", "o_custkey"))
    df = li.join(orders, li.l_orderkey == orders.o_orderkey)
    return (df.groupBy("o_custkey", "l_partkey").agg(F.count(F.lit(1)).alias("purchases"))
              .select(F.col("o_custkey").cast("int").alias("user_id"),
                      F.col("l_partkey").cast("int").alias("product_id"), "purchases"))


def price_points(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem", "l_partkey", "l_extendedprice", "l_quantity", "l_discount", "l_shipdate")
    part = broadcast_if_small(table(spark, sf, "part", "p_partkey", "p_type"))
    df = li.join(part, li.l_partkey == part.p_partkey)
    return df.select(F.col("p_type").alias("product_type"),
                     (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
                     F.col("l_quantity").alias("quantity"), F.col("l_discount").alias("discount"),
                     F.month("l_shipdate").alias("month"))


def shipments(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice",
               "l_discount", "l_tax")
    orders = broadcast_if_small(table(spark, sf, "orders", "o_orderkey", "o_totalprice"))
    df = li.join(orders, li.l_orderkey == orders.o_orderkey)
    return df.select(
        F.concat(F.lit("PCL_"), F.col("l_orderkey").cast("string"), F.lit("_"),
                 F.col("l_linenumber").cast("string")).alias("shipment_id"),
        F.col("l_quantity").alias("weight"), F.col("l_extendedprice").alias("cost"),
        F.col("l_discount").alias("discount"), F.col("l_tax").alias("tax"),
        F.col("o_totalprice").alias("order_value"),
    )


FIXTURES = {
    "deliveries": deliveries, "departments": departments, "transport": transport,
    "feedback": feedback, "department_dim": department_dim, "routes": routes, "staff": staff,
    "coverage": coverage, "predictions": predictions, "purchases": purchases, "touches": touches,
    "daily_metrics": daily_metrics, "text_labels": text_labels, "interactions": interactions,
    "price_points": price_points, "shipments": shipments,
}


def load(spark: SparkSession, sf: str, name: str, **period) -> DataFrame:
    """A stand-in by name; ``month="YYYY-MM"`` (departments, transport) or
    ``year`` (predictions) restricts the scan to the period."""
    return FIXTURES[name](spark, sf, **period)
