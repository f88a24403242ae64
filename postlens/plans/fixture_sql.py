"""The stand-in fixtures as SQL for the DuckDB oracle (FIXTURES.md).

``with_fixtures(sql)`` prefixes a query with the CTEs of every fixture it
names, so each oracle statement is self-contained over the driver's views.
"""

from __future__ import annotations

import re

_LI_SUP_NAT_PART = ("lineitem JOIN supplier ON l_suppkey = s_suppkey "
                    "JOIN nation ON s_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey")
_MONTH = "substring(cast(cast(l_shipdate AS date) AS string), 1, 7)"
_DTYPE = ("CASE {k} % 4 WHEN 0 THEN 'sorting' WHEN 1 THEN 'distribution' "
          "WHEN 2 THEN 'local' ELSE 'hub' END")

FIXTURE_SQL = {
    "deliveries": f"""
SELECT concat('DEL_', lpad(cast(l_orderkey AS string), cast(greatest(9, length(cast(l_orderkey AS string))) AS int), '0'), '_', cast(l_linenumber AS string)) AS delivery_id,
       concat('CUR_', lpad(cast(l_suppkey AS string), cast(greatest(5, length(cast(l_suppkey AS string))) AS int), '0')) AS courier_id,
       concat('PCL_', lpad(cast(l_partkey AS string), cast(greatest(6, length(cast(l_partkey AS string))) AS int), '0')) AS parcel_id,
       p_type AS parcel_type,
       n_name AS city,
       l_shipdate + INTERVAL '1' HOUR * cast(l_orderkey % 24 AS int) AS receive_datetime,
       l_shipdate + INTERVAL '1' HOUR * cast(l_orderkey % 24 AS int) + INTERVAL '1' MINUTE * cast(l_quantity * 4 AS int) AS issue_datetime,
       cast(l_quantity * 4 AS int) AS delivery_duration_minutes,
       cast(l_shipdate AS date) AS delivery_date,
       l_returnflag <> 'R' AS success
FROM {_LI_SUP_NAT_PART}""",
    "departments": f"""
SELECT concat('DEPT_', lpad(cast(s_suppkey AS string), cast(greatest(5, length(cast(s_suppkey AS string))) AS int), '0')) AS department_id,
       {_DTYPE.format(k='s_suppkey')} AS department_type,
       n_name AS city, p_type AS parcel_type, l_returnflag AS transport_type,
       count(*) AS monthly_volume,
       avg(l_quantity) AS avg_processing_time_minutes,
       {_MONTH} AS month,
       cast(sum(l_quantity) AS int) AS daily_processed,
       max(l_linenumber) AS queue_length
FROM {_LI_SUP_NAT_PART}
GROUP BY s_suppkey, n_name, p_type, l_returnflag, {_MONTH}""",
    "transport": f"""
SELECT l_returnflag AS transport_type, p_type AS parcel_type,
       count(DISTINCT l_suppkey) AS fleet_size,
       count(*) AS monthly_deliveries,
       avg(l_quantity) AS avg_distance_per_delivery,
       sum(l_quantity) AS total_distance_km,
       sum(l_quantity * l_tax) AS fuel_consumption_liters,
       cast(count(*) AS double) / (count(DISTINCT l_suppkey) * 30) AS utilization_rate,
       {_MONTH} AS month
FROM lineitem JOIN part ON l_partkey = p_partkey
GROUP BY l_returnflag, p_type, {_MONTH}""",
    "feedback": """
SELECT concat('FB_', lpad(cast(event_id AS string), cast(greatest(9, length(cast(event_id AS string))) AS int), '0')) AS feedback_id,
       concat('DEL_', lpad(cast(event_id AS string), cast(greatest(9, length(cast(event_id AS string))) AS int), '0'), '_1') AS delivery_id,
       concat('CUST_', lpad(cast(user_id AS string), cast(greatest(6, length(cast(user_id AS string))) AS int), '0')) AS customer_id,
       n_name AS city,
       event_type AS delivery_type,
       1 + cast(floor(value) AS int) % 10 AS satisfaction_score,
       props AS feedback_text,
       CASE WHEN 1 + cast(floor(value) AS int) % 10 >= 7 THEN 'positive'
            WHEN 1 + cast(floor(value) AS int) % 10 <= 4 THEN 'negative' ELSE 'neutral' END AS sentiment,
       cast(floor(value) AS int) AS delivery_time_actual,
       60 AS delivery_time_promised,
       cast(floor(value) AS int) <= 60 AS on_time_delivery,
       cast(ts AS date) AS feedback_date,
       'uk' AS language
FROM events JOIN nation ON n_nationkey = user_id % 25""",
    "department_dim": """
SELECT concat('DEPT_', lpad(cast(s_suppkey AS string), cast(greatest(5, length(cast(s_suppkey AS string))) AS int), '0')) AS department_id,
       n_name AS city, r_name AS region
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "routes": """
SELECT concat('ROUTE_', cast(l_orderkey AS string), '_', cast(l_linenumber AS string)) AS route_id,
       concat('ORDER_', lpad(cast(o_orderkey AS string), cast(greatest(9, length(cast(o_orderkey AS string))) AS int), '0')) AS order_id,
       CASE o_orderkey % 4 WHEN 0 THEN 'Department to Department' WHEN 1 THEN 'Department to Courier'
            WHEN 2 THEN 'Courier to Department' ELSE 'Courier to Courier' END AS delivery_type,
       CASE WHEN o_orderkey % 4 IN (0, 1) THEN concat('DEPT_', lpad(cast(l_suppkey AS string), cast(greatest(5, length(cast(l_suppkey AS string))) AS int), '0')) END AS sender_department,
       CASE WHEN o_orderkey % 4 IN (0, 2) THEN concat('DEPT_', lpad(cast(o_custkey % 110 AS string), cast(greatest(5, length(cast(o_custkey % 110 AS string))) AS int), '0')) END AS receiver_department,
       CASE WHEN o_orderkey % 4 IN (2, 3) THEN sn.n_name END AS sender_location,
       CASE WHEN o_orderkey % 4 IN (1, 3) THEN cn.n_name END AS receiver_location,
       l_returnflag <> 'R' AS is_valid_route,
       cast(l_quantity AS int) AS estimated_distance_km,
       cast(l_quantity * 2 AS int) AS estimated_time_minutes,
       cast(o_orderdate AS date) AS validation_date,
       l_linenumber AS processing_time_ms
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
     JOIN supplier ON l_suppkey = s_suppkey JOIN nation sn ON s_nationkey = sn.n_nationkey
     JOIN nation cn ON c_nationkey = cn.n_nationkey""",
    "staff": f"""
SELECT concat('DEPT_', lpad(cast(c_nationkey AS string), cast(greatest(5, length(cast(c_nationkey AS string))) AS int), '0')) AS department_id,
       {_DTYPE.format(k='c_nationkey')} AS department_type,
       r_name AS region, c_mktsegment AS position,
       cast(1 + c_custkey % 5 AS int) AS staff_count,
       c_acctbal AS avg_salary,
       cast(c_custkey % 60 AS int) AS experience_months,
       CASE WHEN c_custkey % 2 = 0 THEN DATE '2024-01-01' ELSE DATE '2024-01-02' END AS snapshot_date
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "coverage": """
SELECT r_name AS region, n_name AS city, 1 AS cities_covered,
       count(DISTINCT s_suppkey) AS total_departments,
       cast(count(DISTINCT s_suppkey) AS double) / 6 AS coverage_density,
       avg(CASE WHEN l_returnflag <> 'R' THEN 12.0E0 ELSE 0.0E0 END) AS service_quality_score,
       count(*) AS estimated_monthly_demand,
       sum(l_quantity) / (18 + n_nationkey % 8) AS current_monthly_capacity,
       DATE '2024-01-01' AS analysis_date
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
     JOIN region ON n_regionkey = r_regionkey
GROUP BY r_name, n_name, n_nationkey""",
    "predictions": """
SELECT cast(date_trunc('year', o_orderdate) AS date) AS prediction_date,
       o_orderpriority AS model_type,
       concat('ORDER_', lpad(cast(o_orderkey AS string), cast(greatest(9, length(cast(o_orderkey AS string))) AS int), '0')) AS entity_id,
       o_totalprice AS predicted_value,
       sum(l_extendedprice) AS actual_value,
       coalesce(avg(1 - l_discount), 0.5E0) AS confidence_score,
       'currency' AS unit
FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey
GROUP BY o_orderkey, o_orderdate, o_orderpriority, o_totalprice""",
    "purchases": """
SELECT concat('CUST_', lpad(cast(c_custkey AS string), cast(greatest(6, length(cast(c_custkey AS string))) AS int), '0')) AS customer_id,
       concat('ORDER_', lpad(cast(o_orderkey AS string), cast(greatest(9, length(cast(o_orderkey AS string))) AS int), '0')) AS order_id,
       cast(o_orderdate AS date) AS order_date,
       o_totalprice AS amount,
       c_mktsegment AS segment
FROM orders JOIN customer ON o_custkey = c_custkey""",
    "touches": """
SELECT event_id, user_id, ts, event_type AS channel, event_type = 'purchase' AS is_conversion, value
FROM events""",
    "daily_metrics": """
SELECT cast(o_orderdate AS date) AS date, 'revenue' AS metric, sum(o_totalprice) AS value
FROM orders GROUP BY cast(o_orderdate AS date)""",
    "text_labels": """
SELECT doc_id, text, lang AS language,
       CASE WHEN toxic = 1 THEN 'negative' WHEN quality = 1 THEN 'positive' ELSE 'neutral' END AS label
FROM documents JOIN labels USING (doc_id)""",
    "interactions": """
SELECT cast(o_custkey AS int) AS user_id, cast(l_partkey AS int) AS product_id, count(*) AS purchases
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
GROUP BY o_custkey, l_partkey""",
    "price_points": """
SELECT p_type AS product_type, l_extendedprice / l_quantity AS unit_price, l_quantity AS quantity, l_discount AS discount, month(l_shipdate) AS month
FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "shipments": """
SELECT concat('PCL_', cast(l_orderkey AS string), '_', cast(l_linenumber AS string)) AS shipment_id,
       l_quantity AS weight, l_extendedprice AS cost, l_discount AS discount, l_tax AS tax,
       o_totalprice AS order_value
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
}


def with_fixtures(sql: str) -> str:
    """Prefix ``sql`` with the CTEs of the fixtures it references.

    A statement that already starts with ``WITH`` gets the fixture CTEs
    merged in front of its own.
    """
    used = [n for n in FIXTURE_SQL if re.search(rf"\b{n}\b", sql)]
    if not used:
        return sql
    ctes = ",\n".join(f"{n} AS ({FIXTURE_SQL[n].strip()})" for n in used)
    body = sql.strip()
    if re.match(r"(?is)^with\s", body):
        return f"WITH {ctes},\n{body[4:].lstrip()}"
    return f"WITH {ctes}\n{body}"


# Columns of the fixtures that the completeness scores read, with the
# floating-point ones (NaN counts as missing) marked.
FIXTURE_COLUMNS = {
    "deliveries": ("delivery_id courier_id parcel_id parcel_type city receive_datetime issue_datetime "
                   "delivery_duration_minutes delivery_date success").split(),
    "departments": ("department_id department_type city parcel_type transport_type monthly_volume "
                    "avg_processing_time_minutes month daily_processed queue_length").split(),
    "transport": ("transport_type parcel_type fleet_size monthly_deliveries avg_distance_per_delivery "
                  "total_distance_km fuel_consumption_liters utilization_rate month").split(),
    "feedback": ("feedback_id delivery_id customer_id city delivery_type satisfaction_score feedback_text "
                 "sentiment delivery_time_actual delivery_time_promised on_time_delivery feedback_date "
                 "language").split(),
    "routes": ("route_id order_id delivery_type sender_department receiver_department sender_location "
               "receiver_location is_valid_route estimated_distance_km estimated_time_minutes validation_date "
               "processing_time_ms").split(),
}
FIXTURE_DOUBLES = {
    "departments": {"avg_processing_time_minutes"},
    "transport": {"avg_distance_per_delivery", "total_distance_km", "fuel_consumption_liters", "utilization_rate"},
}


def completeness_sql(fixture: str) -> str:
    """Present cells / all cells * 100 over a fixture, as a DuckDB expression."""
    cols = FIXTURE_COLUMNS[fixture]
    doubles = FIXTURE_DOUBLES.get(fixture, set())
    terms = []
    for c in cols:
        cond = f'"{c}" IS NOT NULL' + (f' AND NOT isnan("{c}")' if c in doubles else "")
        terms.append(f"sum(CASE WHEN {cond} THEN 1 ELSE 0 END)")
    return f"({' + '.join(terms)}) / nullif(count(*) * {len(cols)}, 0) * 100.0E0"


def sql_case(expr: str, mapping: dict, numeric: bool = False) -> str:
    """``CASE expr WHEN k THEN v ... END`` from a fixed lookup dict."""
    def lit(v):
        return f"{float(v)!r}E0".replace("e", "E") if numeric and "e" not in repr(float(v)) else (
            repr(float(v)) if numeric else "'" + str(v).replace("'", "''") + "'")
    whens = " ".join(f"WHEN '{k}' THEN {lit(v)}" for k, v in mapping.items())
    return f"CASE {expr} {whens} END"
