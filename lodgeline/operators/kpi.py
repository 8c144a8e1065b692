"""KPI measures evaluated under a filter context.

A context is the slicer filters plus the columns a report groups by. A measure that fixes the
booking status replaces the context's choice of status, from slicers and from grouping alike,
and keeps every other filter.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgeline.operators.cleaning import slice_by
from lodgeline.operators.shares import null_safe_join
from lodgeline.schemas import CANCELED, KEY, NOT_CANCELED, TARGET

# Measures of the visible rows, and measures that fix the status.
VISIBLE = ("nb_bookings", "revenue_estimated", "avg_lead_time")
FIXED = ("nb_bookings_canceled", "revenue_not_canceled", "revenue_canceled", "avg_lead_time_canceled")
MEASURES = (*VISIBLE, *FIXED, "pct_canceled")


def _per_booking(rows: DataFrame, by: Sequence[str], visible: Column) -> DataFrame:
    """Partial sums per group and booking.

    Counting distinct bookings becomes summing flags over this frame: one shuffle however many
    distinct counts are asked for, and copies of a booking collapse before it. Rows without a
    booking id count as one booking.
    """
    canceled, kept = F.col(TARGET) == CANCELED, F.col(TARGET) == NOT_CANCELED
    price, lead = F.col("avg_price_per_room"), F.col("lead_time").cast("bigint")

    def flag(c: Column) -> Column:
        return F.max(F.when(c, 1).otherwise(0))

    return rows.groupBy(*by, KEY).agg(
        flag(visible).alias("b_visible"),
        flag(canceled).alias("b_canceled"),
        F.sum(F.when(visible, price)).alias("price"),
        F.sum(F.when(canceled, price)).alias("price_canceled"),
        F.sum(F.when(kept, price)).alias("price_kept"),
        F.sum(F.when(visible, lead)).alias("lead"),
        F.count(F.when(visible, lead)).alias("lead_n"),
        F.sum(F.when(canceled, lead)).alias("lead_canceled"),
        F.count(F.when(canceled, lead)).alias("lead_canceled_n"),
        flag(visible & canceled).alias("sees_canceled"),
        flag(visible & kept).alias("sees_kept"),
        flag(visible & ~F.coalesce(canceled | kept, F.lit(False))).alias("sees_other"),
    )


def _visible_measures() -> list[Column]:
    return [
        F.coalesce(F.sum("b_visible"), F.lit(0)).alias("nb_bookings"),
        F.sum("price").alias("revenue_estimated"),
        F.try_divide(F.sum("lead"), F.sum("lead_n")).alias("avg_lead_time"),
        F.max("sees_canceled").alias("_sees_canceled"),
        F.max("sees_kept").alias("_sees_kept"),
        F.max("sees_other").alias("_sees_other"),
    ]


def _fixed_measures() -> list[Column]:
    return [
        F.coalesce(F.sum("b_canceled"), F.lit(0)).alias("nb_bookings_canceled"),
        F.sum("price_kept").alias("revenue_not_canceled"),
        F.sum("price_canceled").alias("revenue_canceled"),
        F.try_divide(F.sum("lead_canceled"), F.sum("lead_canceled_n")).alias("avg_lead_time_canceled"),
        F.try_divide(F.sum("b_canceled"), F.count("*")).alias("_ratio"),
    ]


def _pct_canceled() -> Column:
    """1 or 0 when exactly one status is visible, else the share whatever the status choice."""
    canceled, kept, other = F.col("_sees_canceled"), F.col("_sees_kept"), F.col("_sees_other")
    return (
        F.when((canceled == 1) & (kept == 0) & (other == 0), 1.0)
        .when((kept == 1) & (canceled == 0) & (other == 0), 0.0)
        .otherwise(F.col("_ratio"))
    )


def measures(
    df: DataFrame,
    names: Sequence[str] = MEASURES,
    by: Sequence[str] = (),
    filters: Mapping[str, Sequence] | None = None,
) -> DataFrame:
    """Measures per group under slicer filters; without `by`, one row."""
    unknown = [n for n in names if n not in MEASURES]
    if unknown:
        raise ValueError(f"unknown measures: {', '.join(unknown)}")
    filters = dict(filters or {})
    chosen = list(filters.pop(TARGET, ()))
    rows = slice_by(df, filters)
    visible = F.col(TARGET).isin(chosen) if chosen else F.lit(True)

    others = [c for c in by if c != TARGET]
    if len(others) == len(by):
        grouped = _per_booking(rows, others, visible).groupBy(*others)
        out = grouped.agg(*_visible_measures(), *_fixed_measures())
    else:
        seen = _per_booking(rows.filter(visible), by, F.lit(True)).groupBy(*by).agg(*_visible_measures())
        fixed = _per_booking(rows, others, visible).groupBy(*others).agg(*_fixed_measures())
        # The group's own status is replaced too, so every status row gets the same fixed measures.
        out = null_safe_join(seen, fixed, others) if others else seen.crossJoin(F.broadcast(fixed))
    return out.withColumn("pct_canceled", _pct_canceled()).select(*by, *names)


def good_predictions(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Good predictions and accuracy over all rows that have a booking id."""
    good, rows = F.sum("good_prediction"), F.count(KEY)
    return df.groupBy(*by).agg(good.alias("nb_good_prediction"), (good / F.nullif(rows, F.lit(0))).alias("accuracy"))


