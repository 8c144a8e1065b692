"""Cleaning, projection, derived columns and filters over bookings."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgeline.functions.columns import col
from lodgeline.operators.shares import with_share
from lodgeline.schemas import DOUBLE_COLUMNS, INT_COLUMNS, STRING_COLUMNS, Roles

UNUSED = ("arrival_date",)


def drop_unused(df: DataFrame) -> DataFrame:
    return df.drop(*UNUSED)


def clean(df: DataFrame) -> DataFrame:
    """Drop unused columns, then exact duplicate rows. Copies collapse before the shuffle."""
    return drop_unused(df).dropDuplicates()


def require(df: DataFrame, columns: Iterable[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def project(df: DataFrame, roles: Roles = Roles(), with_target: bool = True) -> DataFrame:
    """Model features in role order, and the target for training and evaluation."""
    columns = [*roles.features, *([roles.target] if with_target else [])]
    require(df, columns)
    return df.select(*columns)


def total_nights(df: DataFrame) -> DataFrame:
    return df.withColumn("total_nights", F.col("no_of_weekend_nights") + F.col("no_of_week_nights"))


def has_children(df: DataFrame) -> DataFrame:
    return df.withColumn("has_children", F.when(F.col("no_of_children") > 0, 1).otherwise(0))


def log1p_cols(df: DataFrame, columns: Sequence[str] = ("lead_time", "avg_price_per_room")) -> DataFrame:
    return df.withColumns({c: F.log1p(c) for c in columns if c in df.columns})


def standard_scale(
    df: DataFrame,
    columns: Sequence[str] = ("lead_time", "avg_price_per_room", "total_nights", "no_of_special_requests"),
) -> DataFrame:
    """Mean 0 and population standard deviation 1; a constant column is only centred.

    The statistics are one row, which is what gets broadcast.
    """
    columns = [c for c in columns if c in df.columns]
    if not columns:
        return df
    stats = df.agg(
        *[F.avg(c).alias(f"_mean_{c}") for c in columns],
        *[F.stddev_pop(c).alias(f"_std_{c}") for c in columns],
    )
    scaled = {
        c: (F.col(c) - F.col(f"_mean_{c}")) / F.when(F.col(f"_std_{c}") == 0, 1.0).otherwise(F.col(f"_std_{c}"))
        for c in columns
    }
    return df.crossJoin(F.broadcast(stats)).withColumns(scaled).select(*df.columns)


def cast_align(df: DataFrame) -> DataFrame:
    """Bring known columns to their stored types; whole numbers are rounded half to even first."""
    types: dict[str, Column] = {}
    for c in df.columns:
        if c in INT_COLUMNS:
            types[c] = F.rint(F.col(c).cast("double")).cast("int")
        elif c in DOUBLE_COLUMNS:
            types[c] = F.col(c).try_cast("double")
        elif c in STRING_COLUMNS:
            types[c] = F.col(c).cast("string")
    return df.withColumns(types)


def arrival_dates(df: DataFrame) -> DataFrame:
    """First day of the arrival month, and the reservation day `lead_time` days before it.

    An impossible month gives null in both.
    """
    first = F.concat_ws("-", F.col("arrival_year"), F.col("arrival_month"), F.lit("1"))
    known = F.col("arrival_year").isNotNull() & F.col("arrival_month").isNotNull()
    arrival = F.when(known, F.try_to_date(first, "yyyy-M-d"))
    return df.withColumn("arrival_day", arrival).withColumn(
        "reservation_day", F.date_sub("arrival_day", F.col("lead_time"))
    )


def prediction_flags(
    df: DataFrame,
    label: str = "booking_status",
    prediction: str = "booking_status_pred_custom",
    proba: str = "booking_status_proba_custom",
) -> DataFrame:
    """1 where label and prediction agree (two nulls agree), and the other class's probability."""
    return df.withColumns(
        {
            "good_prediction": F.when(F.col(label).eqNullSafe(F.col(prediction)), 1).otherwise(0),
            "proba_other": 1 - F.col(proba),
        }
    )


def unscored(df: DataFrame, prediction: str) -> DataFrame:
    return df.filter(F.col(prediction).isNull())


def trailing(df: DataFrame, ts: str, as_of: Column | None = None, days: int = 7) -> DataFrame:
    """Rows from midnight `days` days before `as_of` up to `as_of`.

    The bounds, not the column, are cast, so the filter prunes row groups.
    """
    as_of = F.current_timestamp() if as_of is None else as_of
    kind = df.schema[ts].dataType
    low = F.date_sub(as_of.cast("date"), days).cast(kind)
    return df.filter(F.col(ts).between(low, as_of.cast(kind)))


def slice_by(df: DataFrame, filters: Mapping[str, Sequence]) -> DataFrame:
    """Keep rows whose columns hold chosen values; an empty choice keeps all."""
    for column, values in filters.items():
        if values:
            df = df.filter(F.col(column).isin(list(values)))
    return df


def drop_null_or_keep(df: DataFrame, column: str) -> DataFrame:
    """Drop rows with a null in this column, unless no row would be left.

    Whether a value exists is asked beforehand. That job reads one partition, and more only as
    long as it finds none; the result then is a plain filter, or the frame as it was.
    """
    known = df.filter(F.col(column).isNotNull())
    return df if known.select(column).isEmpty() else known


def first_n(df: DataFrame, n: int, order_by: Sequence[str]) -> DataFrame:
    """The first rows in a given order, so that the same rows come every time."""
    return df.orderBy(*order_by).limit(n)


def value_frequencies(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count and share of every non-null value of each column, from one scan."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot(
        [], list(columns), "feature", "category"
    )
    counts = long.filter(col("category").isNotNull()).groupBy("feature", "category").agg(F.count("*").alias("n"))
    return with_share(counts, "n", ["feature"], "share")
