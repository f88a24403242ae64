"""Fixed values that must equal the reference's for the same results.

FIXED VALUES (from the reference's generator formulas):
- city factor, in this city order: Kyiv 0.8, Kharkiv 0.9, Odesa 0.95,
  Dnipro 1.0, Lviv 1.1, Zaporizhzhia 1.2, Kryvyi Rih 1.3, Mykolaiv 1.4
- parcel type factor: small 1.5, medium 1.0, large 0.7, fragile 0.4, express 0.8
- transport suitability (transport -> parcel -> factor):
  van:        small 0.8, medium 1.0, large 0.9, fragile 0.7, express 0.6
  truck:      small 0.3, medium 0.7, large 1.0, fragile 0.8, express 0.4
  motorcycle: small 1.0, medium 0.5, large 0.1, fragile 0.3, express 1.0
  car:        small 0.9, medium 0.8, large 0.4, fragile 0.6, express 0.8
- fuel litres per km: van 0.12, truck 0.25, motorcycle 0.05, car 0.08
- anomaly category priority: revenue high, traffic medium, conversion high
- route validation messages (see ``ROUTE_MESSAGES``)

Stand-in mapping (ours, documented in README): the driver's tables carry
TPC-H categories, not the reference's. A nation plays a city and takes
the city factor at position ``n_nationkey % 8``; ``p_type`` maps to a
parcel type (SMALL small, MEDIUM medium, LARGE large, PROMO express,
ECONOMY fragile, STANDARD medium); ``l_returnflag`` maps to a transport
(A van, N truck, R motorcycle).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CITY_FACTORS = [0.8, 0.9, 0.95, 1.0, 1.1, 1.2, 1.3, 1.4]

PARCEL_FACTOR = {"small": 1.5, "medium": 1.0, "large": 0.7, "fragile": 0.4, "express": 0.8}

SUITABILITY = {
    "van": {"small": 0.8, "medium": 1.0, "large": 0.9, "fragile": 0.7, "express": 0.6},
    "truck": {"small": 0.3, "medium": 0.7, "large": 1.0, "fragile": 0.8, "express": 0.4},
    "motorcycle": {"small": 1.0, "medium": 0.5, "large": 0.1, "fragile": 0.3, "express": 1.0},
    "car": {"small": 0.9, "medium": 0.8, "large": 0.4, "fragile": 0.6, "express": 0.8},
}

FUEL_PER_KM = {"van": 0.12, "truck": 0.25, "motorcycle": 0.05, "car": 0.08}

ANOMALY_PRIORITY = {"revenue": "high", "traffic": "medium", "conversion": "high"}

ROUTE_MESSAGES = {
    "Department to Department": "Department mismatch in route",
    "Department to Courier": "Sender department and receiver city mismatch",
    "Courier to Department": "Sender city and receiver department mismatch",
    "Courier to Courier": "Courier city mismatch",
}

# Stand-in category mappings (ours).
PARCEL_OF_PTYPE = {"SMALL": "small", "MEDIUM": "medium", "LARGE": "large",
                   "PROMO": "express", "ECONOMY": "fragile", "STANDARD": "medium"}
TRANSPORT_OF_FLAG = {"A": "van", "N": "truck", "R": "motorcycle"}


def map_lookup(mapping: dict, key: Column) -> Column:
    """``mapping[key]`` as a literal map (null when the key is absent)."""
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.element_at(F.create_map(*pairs), key)


def parcel_class(p_type: Column) -> Column:
    return map_lookup(PARCEL_OF_PTYPE, p_type)


def transport_class(flag: Column) -> Column:
    return map_lookup(TRANSPORT_OF_FLAG, flag)


def city_factor_table(nation: DataFrame) -> DataFrame:
    """(city, city_factor) for the nations standing in for cities."""
    factors = F.array(*[F.lit(x) for x in CITY_FACTORS])
    return nation.select(
        F.col("n_name").alias("city"),
        F.element_at(factors, (F.col("n_nationkey") % len(CITY_FACTORS) + 1).cast("int")).alias("city_factor"),
    )


def suitability_table(spark: SparkSession) -> DataFrame:
    """(transport_class, parcel_class, suitability): 20 literal rows."""
    rows = [(t, p, f) for t, m in SUITABILITY.items() for p, f in m.items()]
    schema = T.StructType([
        T.StructField("transport_class", T.StringType(), False),
        T.StructField("parcel_class", T.StringType(), False),
        T.StructField("suitability", T.DoubleType(), False),
    ])
    return spark.createDataFrame(rows, schema)
