"""The fixture views as SQL, put before each oracle that names them."""

from __future__ import annotations

import re

VIEWS = {
    "bookings": """
SELECT 'BK' || CAST(o.o_orderkey AS VARCHAR) AS Booking_ID,
 CAST(1 + o.o_orderkey % 3 AS INT) AS no_of_adults,
 CAST(o.o_custkey % 3 AS INT) AS no_of_children,
 CAST(o.o_orderkey % 3 AS INT) AS no_of_weekend_nights,
 CAST((o.o_orderkey + o.o_custkey) % 6 AS INT) AS no_of_week_nights,
 'Meal Plan ' || CAST(1 + o.o_custkey % 3 AS VARCHAR) AS type_of_meal_plan,
 CAST(CASE WHEN o.o_orderkey % 31 = 0 THEN 1 ELSE 0 END AS INT) AS required_car_parking_space,
 'Room_Type ' || substr(o.o_orderpriority, 1, 1) AS room_type_reserved,
 CAST((o.o_custkey * 7 + o.o_orderkey * 13) % 444 AS INT) AS lead_time,
 CAST(year(o.o_orderdate) AS INT) AS arrival_year,
 CAST(month(o.o_orderdate) AS INT) AS arrival_month,
 CAST(day(o.o_orderdate) AS INT) AS arrival_date,
 c.c_mktsegment AS market_segment_type,
 CAST(CASE WHEN o.o_custkey % 37 = 0 THEN 1 ELSE 0 END AS INT) AS repeated_guest,
 CAST(o.o_custkey % 4 AS INT) AS no_of_previous_cancellations,
 CAST(o.o_custkey % 5 AS INT) AS no_of_previous_bookings_not_canceled,
 o.o_totalprice / CAST(1000 AS DOUBLE) AS avg_price_per_room,
 CAST(o.o_orderkey % 6 AS INT) AS no_of_special_requests,
 CASE WHEN o.o_orderstatus = 'F' THEN 'Canceled' ELSE 'Not_Canceled' END AS booking_status,
 o.o_orderdate AS update_timestamp_utc
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""",
    "predictions": """
SELECT *,
 CASE WHEN p_old >= 0.5 THEN 'Not_Canceled' ELSE 'Canceled' END AS booking_status_pred_basic,
 CASE WHEN p_new >= 0.5 THEN 'Not_Canceled' ELSE 'Canceled' END AS booking_status_pred_custom,
 p_new AS booking_status_proba_custom,
 1 - p_new AS proba_other
FROM (SELECT *,
  1 / (1 + exp(-(CAST(0.5 AS DOUBLE) + CAST(-0.01 AS DOUBLE) * lead_time
    + CAST(0.3 AS DOUBLE) * no_of_special_requests + CAST(0.01 AS DOUBLE) * avg_price_per_room))) AS p_new,
  1 / (1 + exp(-(CAST(0.8 AS DOUBLE) + CAST(-0.004 AS DOUBLE) * lead_time
    + CAST(0.2 AS DOUBLE) * no_of_children))) AS p_old
 FROM bookings)""",
    "inference_log": """
SELECT ts AS timestamp, event_id AS request_id,
 CAST(floor(value * 10) AS BIGINT) AS execution_duration_ms,
 value AS avg_price_per_room,
 CASE WHEN user_id % 20 = 0 THEN NULL ELSE CAST(user_id AS INT) END AS lead_time,
 CAST(user_id % 4 AS INT) AS no_of_children,
 event_type AS market_segment_type,
 'Room_Type ' || CAST(1 + user_id % 5 AS VARCHAR) AS room_type_reserved,
 CASE WHEN event_type = 'error' THEN NULL
      WHEN user_id % 3 = 0 THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END AS prediction,
 'model-' || CAST(user_id % 2 AS VARCHAR) AS model_name
FROM events""",
    "requests": """
SELECT ts AS timestamp, CAST(epoch_ms(date_trunc('second', ts)) AS BIGINT) AS timestamp_ms,
 event_id AS request_id, CAST(pos AS INT) AS pos,
 CAST(floor(value * 10) AS BIGINT) AS execution_duration_ms,
 CAST(CAST(props->>'$.k' AS INT) + pos AS INT) AS lead_time, value AS avg_price_per_room,
 event_type AS market_segment_type, CAST(user_id % 4 AS INT) AS no_of_children,
 CAST(CASE WHEN event_type = 'error' THEN NULL WHEN (user_id % 3 = 0) = (pos = 0) THEN 1 ELSE 0 END AS DOUBLE)
   AS prediction
FROM events, (VALUES (0), (1)) p(pos)
WHERE pos = 0 OR event_id % 5 = 0""",
    "registry": """
SELECT 'model-' || CAST(p_partkey % 50 AS VARCHAR) AS model_name, p_partkey AS version,
 CASE WHEN p_size % 3 = 0 THEN 'PENDING' ELSE 'READY' END AS status,
 CASE WHEN p_partkey % 50 < 25 AND p_partkey % 7 = 0 THEN 'latest-model' END AS alias
FROM part""",
}
NEEDS = {"predictions": ("bookings",)}


def hash_of(column: str = "Booking_ID") -> str:
    return f"substr(md5({column}), 1, 8)"


def with_views(sql: str) -> str:
    """SQL with the views it names as its first common table expressions."""
    named = [v for v in VIEWS if re.search(rf"\b{v}\b", sql)]
    wanted = [v for v in VIEWS if v in named or any(v in NEEDS.get(n, ()) for n in named)]
    if not wanted:
        return sql
    views = ",\n".join(f"{v} AS ({VIEWS[v].strip()})" for v in wanted)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {views},\n{body[5:]}"
    return f"WITH {views}\n{body}"
