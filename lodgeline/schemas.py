"""Table schemas, column roles and table names."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import types as T

# Column names, roles and labels of a booking.
KEY = "Booking_ID"
TARGET = "booking_status"
INGESTED_AT = "update_timestamp_utc"
CANCELED = "Canceled"
NOT_CANCELED = "Not_Canceled"

NUM_FEATURES = (
    "arrival_month",
    "arrival_year",
    "avg_price_per_room",
    "lead_time",
    "no_of_adults",
    "no_of_children",
    "no_of_previous_bookings_not_canceled",
    "no_of_previous_cancellations",
    "no_of_special_requests",
    "no_of_week_nights",
    "no_of_weekend_nights",
    "repeated_guest",
    "required_car_parking_space",
)
CAT_FEATURES = ("market_segment_type", "room_type_reserved", "type_of_meal_plan")
FEATURES = NUM_FEATURES + CAT_FEATURES
LOOKUP_FEATURES = ("no_of_previous_cancellations", "no_of_previous_bookings_not_canceled")

INT_COLUMNS = tuple(c for c in NUM_FEATURES if c != "avg_price_per_room") + ("arrival_date",)
DOUBLE_COLUMNS = ("avg_price_per_room",)
STRING_COLUMNS = (KEY, "type_of_meal_plan", "room_type_reserved", "market_segment_type", TARGET)


def type_of(column: str) -> T.DataType:
    """Type a booking column is stored with."""
    if column in INT_COLUMNS:
        return T.IntegerType()
    if column in DOUBLE_COLUMNS:
        return T.DoubleType()
    if column == INGESTED_AT:
        return T.TimestampType()
    return T.StringType()


def struct_of(*columns: str) -> T.StructType:
    return T.StructType([T.StructField(c, type_of(c)) for c in columns])


BOOKING_COLUMNS = (
    KEY,
    "no_of_adults",
    "no_of_children",
    "no_of_weekend_nights",
    "no_of_week_nights",
    "type_of_meal_plan",
    "required_car_parking_space",
    "room_type_reserved",
    "lead_time",
    "arrival_year",
    "arrival_month",
    "arrival_date",
    "market_segment_type",
    "repeated_guest",
    "no_of_previous_cancellations",
    "no_of_previous_bookings_not_canceled",
    "avg_price_per_room",
    "no_of_special_requests",
    TARGET,
)
BOOKING = struct_of(*BOOKING_COLUMNS)
RECORD = struct_of(*FEATURES)


@dataclass(frozen=True)
class Roles:
    """Which columns play which part in training and scoring."""

    num_features: tuple[str, ...] = NUM_FEATURES
    cat_features: tuple[str, ...] = CAT_FEATURES
    target: str = TARGET
    key: str = KEY
    lookup_features: tuple[str, ...] = LOOKUP_FEATURES

    @property
    def features(self) -> tuple[str, ...]:
        return self.num_features + self.cat_features


ENVIRONMENTS = ("dev", "acc", "prd")


@dataclass(frozen=True)
class TableNames:
    """Qualified table names of one environment."""

    catalog_name: str
    schema_name: str
    train_table: str
    test_table: str
    feature_table_name: str
    batch_inference_table: str
    extra: Mapping[str, str] = field(default_factory=dict)

    @classmethod
    def for_env(cls, config: Mapping[str, Mapping[str, str]], env: str) -> TableNames:
        if env not in ENVIRONMENTS:
            raise ValueError(f"unknown environment {env!r}, expected one of {ENVIRONMENTS}")
        block = dict(config[env])
        known = {f: block.pop(f) for f in cls.__dataclass_fields__ if f != "extra"}
        return cls(**known, extra=block)

    def qualified(self, table: str) -> str:
        return ".".join(p for p in (self.catalog_name, self.schema_name, table) if p)
