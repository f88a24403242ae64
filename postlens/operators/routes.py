"""Route validation and delivery lookups.

The department dimension grows with the data (one row per department), so
it is joined without a broadcast hint: Spark broadcasts it only when its
measured size is under ``autoBroadcastJoinThreshold`` (AQE re-checks at
runtime), otherwise it runs a sort-merge join, whose hot keys AQE's skew
handling splits. The served-city list is the distinct cities of the
dimension, aggregated before the join and broadcast behind a row-count
check (its keys, cities, have few values).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.functions.lookups import ROUTE_MESSAGES
from postlens.functions.semantics import labels, np_round, safe_div
from postlens.sources.tables import broadcast_if_rows_at_most

#: Keys over which rows without a key are dealt in a join.
NULL_KEYS = 100_000

DD, DC, CD, CC = ("Department to Department", "Department to Courier",
                  "Courier to Department", "Courier to Courier")


def validate_routes(routes: DataFrame, department_dim: DataFrame) -> DataFrame:
    """Per route: ``is_valid`` and the array of error messages.

    Department to Department: both departments known and different.
    Department to Courier: sender department's city = receiver location.
    Courier to Department: sender location = receiver department's city.
    Courier to Courier: both locations set and served by some department.
    An unknown department counts as a mismatch.
    """
    s = department_dim.select(F.col("department_id").alias("_s_id"), F.col("city").alias("_s_city"))
    r = department_dim.select(F.col("department_id").alias("_r_id"), F.col("city").alias("_r_city"))
    # Locations have few distinct values: joining the routes on them through
    # a shuffle would put each city's routes in one task, so the served-city
    # list is broadcast once its size is checked.
    served = broadcast_if_rows_at_most(
        department_dim.where(F.col("city").isNotNull()).select(F.col("city").alias("_city")).distinct())
    served_s = served.select(F.col("_city").alias("_served_s"))
    served_r = served.select(F.col("_city").alias("_served_r"))
    # A route without a department has no partner. Under a shuffle join all of
    # them would meet in one task, so each gets one of many keys that no
    # department has.
    none = F.concat(F.lit("\0"), F.pmod(F.xxhash64("route_id"), F.lit(NULL_KEYS)).cast("string"))
    df = (routes.withColumn("_s_key", F.coalesce("sender_department", none)).withColumn("_r_key", F.coalesce("receiver_department", none))
          .join(s, F.col("_s_key") == s._s_id, "left")
          .join(r, F.col("_r_key") == r._r_id, "left")
          .join(served_s, F.col("sender_location") == served_s._served_s, "left")
          .join(served_r, F.col("receiver_location") == served_r._served_r, "left"))
    t = F.col("delivery_type")
    dd_ok = (F.col("_s_id").isNotNull() & F.col("_r_id").isNotNull()
             & (F.col("sender_department") != F.col("receiver_department")))
    dc_ok = F.coalesce(F.col("_s_city") == F.col("receiver_location"), F.lit(False))
    cd_ok = F.coalesce(F.col("sender_location") == F.col("_r_city"), F.lit(False))
    cc_ok = F.col("_served_s").isNotNull() & F.col("_served_r").isNotNull()
    errors = labels(((t == DD) & ~dd_ok, ROUTE_MESSAGES[DD]),
                    ((t == DC) & ~dc_ok, ROUTE_MESSAGES[DC]),
                    ((t == CD) & ~cd_ok, ROUTE_MESSAGES[CD]),
                    ((t == CC) & ~cc_ok, ROUTE_MESSAGES[CC]))
    return df.select("route_id", "delivery_type", "validation_date", "processing_time_ms",
                     errors.alias("error_messages")).withColumn(
        "is_valid", F.size("error_messages") == 0)


def route_validation_summary(validated: DataFrame) -> DataFrame:
    """total, valid, invalid, success % (2 dp), mean processing ms (2 dp)."""
    return validated.agg(
        F.count(F.lit(1)).alias("total_routes"),
        F.count_if("is_valid").alias("valid_routes"),
        F.count_if(~F.col("is_valid")).alias("invalid_routes"),
        np_round(safe_div(F.count_if("is_valid"), F.count(F.lit(1))) * 100.0, 2).alias("success_rate"),
        np_round(F.avg("processing_time_ms"), 2).alias("avg_processing_time_ms"))


def feedback_with_delivery(feedback: DataFrame, deliveries: DataFrame) -> DataFrame:
    """Feedback rows with the delivery they name (inner join on delivery_id)."""
    d = deliveries.select("delivery_id", "courier_id", "parcel_type",
                          F.col("city").alias("delivery_city"), "delivery_duration_minutes", "success")
    return feedback.select("feedback_id", "delivery_id", "customer_id", "city", "satisfaction_score",
                           "on_time_delivery").join(d, "delivery_id", "inner")
