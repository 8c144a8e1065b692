"""Calendar of whole years around a date column, and series filled with zeros on it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def calendar(df: DataFrame, date: str) -> DataFrame:
    """Every day of every year the dates span, with its drill levels."""
    span = df.agg(F.year(F.min(date)).alias("lo"), F.year(F.max(date)).alias("hi"))
    days = F.sequence(F.make_date("lo", F.lit(1), F.lit(1)), F.make_date("hi", F.lit(12), F.lit(31)))
    quarter = F.floor((F.month("date") + 2) / 3).cast("int")
    return span.filter("lo IS NOT NULL").select(F.explode(days).alias("date")).select(
        "date",
        F.year("date").alias("year"),
        quarter.alias("quarter_no"),
        F.concat(F.lit("Qtr "), quarter.cast("string")).alias("quarter"),
        F.month("date").alias("month_no"),
        F.date_format("date", "MMMM").alias("month"),
        F.dayofmonth("date").alias("day"),
    )


def join_calendar(daily: DataFrame, date: str, days: DataFrame, value: str, fill: int = 0) -> DataFrame:
    """The daily values on all days of the calendar; days without one get `fill`.

    `daily` holds one row per day, so both sides are no longer than the calendar.
    """
    values = daily.select(F.to_date(date).alias("date"), value)
    return days.join(values, "date", "left").na.fill(fill, [value])
