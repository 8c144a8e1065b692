"""Booking-shaped views over the order, customer and event tables."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgeline.functions.columns import ntz
from lodgeline.schemas import CANCELED, NOT_CANCELED

# Intercept and coefficients of the linear scorers.
LINEAR = {"lead_time": -0.01, "no_of_special_requests": 0.3, "avg_price_per_room": 0.01}
INTERCEPT = 0.5
LINEAR_OLD = {"lead_time": -0.004, "no_of_children": 0.2}
INTERCEPT_OLD = 0.8


def bookings(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """One booking per order. Both sides are plain scans, so AQE may broadcast or split either."""
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey)
    return joined.selectExpr(
        "'BK' || CAST(o_orderkey AS STRING) AS Booking_ID",
        "CAST(1 + o_orderkey % 3 AS INT) AS no_of_adults",
        "CAST(o_custkey % 3 AS INT) AS no_of_children",
        "CAST(o_orderkey % 3 AS INT) AS no_of_weekend_nights",
        "CAST((o_orderkey + o_custkey) % 6 AS INT) AS no_of_week_nights",
        "'Meal Plan ' || CAST(1 + o_custkey % 3 AS STRING) AS type_of_meal_plan",
        "CAST(CASE WHEN o_orderkey % 31 = 0 THEN 1 ELSE 0 END AS INT) AS required_car_parking_space",
        "'Room_Type ' || substr(o_orderpriority, 1, 1) AS room_type_reserved",
        "CAST((o_custkey * 7 + o_orderkey * 13) % 444 AS INT) AS lead_time",
        "CAST(year(o_orderdate) AS INT) AS arrival_year",
        "CAST(month(o_orderdate) AS INT) AS arrival_month",
        "CAST(day(o_orderdate) AS INT) AS arrival_date",
        "c_mktsegment AS market_segment_type",
        "CAST(CASE WHEN o_custkey % 37 = 0 THEN 1 ELSE 0 END AS INT) AS repeated_guest",
        "CAST(o_custkey % 4 AS INT) AS no_of_previous_cancellations",
        "CAST(o_custkey % 5 AS INT) AS no_of_previous_bookings_not_canceled",
        "o_totalprice / 1000D AS avg_price_per_room",
        "CAST(o_orderkey % 6 AS INT) AS no_of_special_requests",
        f"CASE WHEN o_orderstatus = 'F' THEN '{CANCELED}' ELSE '{NOT_CANCELED}' END AS booking_status",
        "o_orderdate AS update_timestamp_utc",
    )


def inference_log(events: DataFrame) -> DataFrame:
    """One monitoring row per event."""
    return events.selectExpr(
        "ts AS timestamp",
        "event_id AS request_id",
        "CAST(floor(value * 10) AS BIGINT) AS execution_duration_ms",
        "value AS avg_price_per_room",
        "CASE WHEN user_id % 20 = 0 THEN NULL ELSE CAST(user_id AS INT) END AS lead_time",
        "CAST(user_id % 4 AS INT) AS no_of_children",
        "event_type AS market_segment_type",
        "'Room_Type ' || CAST(1 + user_id % 5 AS STRING) AS room_type_reserved",
        "CASE WHEN event_type = 'error' THEN NULL WHEN user_id % 3 = 0 THEN 1D ELSE 0D END AS prediction",
        "'model-' || CAST(user_id % 2 AS STRING) AS model_name",
    )


def _event_record(shift: int) -> Column:
    """Request record of an event; features the event does not carry are left out."""
    return F.struct(
        (F.col("k") + shift).alias("lead_time"),
        F.col("value").alias("avg_price_per_room"),
        F.col("event_type").alias("market_segment_type"),
        (F.col("user_id") % 4).cast("int").alias("no_of_children"),
    )


def payload(events: DataFrame, form: str = "records", predictions: str = "labels") -> DataFrame:
    """Request log with JSON text: every fifth event sends two records, errors have no response."""
    first, second = _event_record(0), _event_record(1)
    two = F.col("event_id") % 5 == 0
    if form == "records":
        body = F.struct(F.when(two, F.array(first, second)).otherwise(F.array(first)).alias("dataframe_records"))
    else:
        columns = F.array(*[F.lit(c) for c in ("lead_time", "avg_price_per_room", "market_segment_type")])
        rows = [
            F.array(
                (F.col("k") + shift).cast("string"),
                F.col("value").cast("string"),
                F.col("event_type"),
            )
            for shift in (0, 1)
        ]
        data = F.when(two, F.array(*rows)).otherwise(F.array(rows[0]))
        body = F.struct(F.struct(columns.alias("columns"), data.alias("data")).alias("dataframe_split"))

    canceled = F.col("user_id") % 3 == 0
    label = F.when(canceled, CANCELED).otherwise(NOT_CANCELED)
    other = F.when(canceled, NOT_CANCELED).otherwise(CANCELED)
    if predictions == "objects":
        def answer(lab: Column, positive: Column) -> Column:
            return F.struct(
                F.when(positive, 0).otherwise(1).alias("prediction"),
                lab.alias("label"),
                F.when(positive, 0.25).otherwise(0.75).alias("probability"),
            )

        one, two_answers = answer(label, canceled), answer(other, ~canceled)
    else:
        one, two_answers = label, other
    answers = F.when(two, F.array(one, two_answers)).otherwise(F.array(one))
    response = F.when(F.col("event_type") != "error", F.to_json(F.struct(answers.alias("predictions"))))
    keyed = events.withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    return keyed.select(
        F.col("ts").alias("request_time"),
        F.col("event_id").alias("request_id"),
        F.floor(F.col("value") * 10).cast("bigint").alias("execution_duration_ms"),
        F.to_json(body).alias("request"),
        response.alias("response"),
    )


def registry(part: DataFrame) -> DataFrame:
    """Model versions, one per part; every fiftieth part starts a model family."""
    return part.selectExpr(
        "'model-' || CAST(p_partkey % 50 AS STRING) AS model_name",
        "p_partkey AS version",
        "CASE WHEN p_size % 3 = 0 THEN 'PENDING' ELSE 'READY' END AS status",
        "CASE WHEN p_partkey % 50 < 25 AND p_partkey % 7 = 0 THEN 'latest-model' END AS alias",
    )


class Tables:
    """The given parquet tables of one folder, and the views over them."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    @cached_property
    def events(self) -> DataFrame:
        return self.raw("events")

    @cached_property
    def bookings(self) -> DataFrame:
        return bookings(self.raw("orders"), self.raw("customer"))

    @cached_property
    def log(self) -> DataFrame:
        return inference_log(self.events)

    @cached_property
    def predictions(self) -> DataFrame:
        """Bookings scored by the two fixed linear models; the probability is text, as it is stored."""
        from lodgeline.operators.models import score_linear

        scored = score_linear(self.bookings, LINEAR, INTERCEPT)
        old = score_linear(scored.select("*"), LINEAR_OLD, INTERCEPT_OLD, prefix="old_")
        return old.select(
            *self.bookings.columns,
            F.col("old_label").alias("booking_status_pred_basic"),
            F.col("label").alias("booking_status_pred_custom"),
            F.col("probability").alias("booking_status_proba_custom"),
        )

    def change(self, low: float = 0.0, high: float = 1.0, df: DataFrame | None = None) -> DataFrame:
        """Bookings whose key hash lies in this share of the hash space."""
        from lodgeline.functions.columns import hash_share, key_hash

        df = self.bookings if df is None else df
        h = key_hash("Booking_ID")
        return df.filter((h >= hash_share(low)) & (h < hash_share(high)))


def latest(df: DataFrame, ts: str) -> Column:
    """Greatest timestamp of a column as a literal, so that filters on it reach the scan."""
    value = df.agg(F.max(ts).alias("v")).first()["v"]
    return ntz(value.isoformat(sep=" ") if value else "1970-01-01 00:00:00")
