"""Synthetic bookings with the column distributions of a source table.

Every draw is a hash of the row number, the seed and the column, so a lost task that is run again
yields the same rows whatever the partitioning.
"""

from __future__ import annotations

import math
import time
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodgeline.functions.columns import epoch_ms, utc_wall
from lodgeline.operators.cleaning import cast_align
from lodgeline.schemas import KEY

# Columns kept at zero or above (the price is not among them), columns that drift.
CLIPPED = (
    "arrival_month",
    "arrival_date",
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
YEAR = "arrival_year"
DRIFTING = ("avg_price_per_room", "lead_time")

GROUPS = 4096  # hashed value groups of the two-level running sum
MIN_SLOTS = 1024  # least number of equal slots of the row range that draws and values are joined on


def uniform(seed: int, name: str) -> Column:
    """Number in [0, 1) from the row number, the seed and a name."""
    return F.pmod(F.xxhash64("_row", F.lit(seed), F.lit(name)), F.lit(1 << 53)) / F.lit(float(1 << 53))


def normal(seed: int, name: str) -> Column:
    """Standard normal number from two uniform ones (Box-Muller)."""
    radius = F.sqrt(-2 * F.log(1 - uniform(seed, f"{name}/r")))
    return radius * F.cos(2 * math.pi * uniform(seed, f"{name}/a"))


def _slot(position: Column) -> Column:
    return F.floor(position * F.col("_slots") / F.col("_total"))


def value_intervals(df: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """Each value's part of the range 0..rows as a half-open interval, and one row of sizes.

    The running sum has two levels, within a hashed group of values and over the groups, so no
    task orders all the values. An interval is repeated for every slot it meets: a frequent value
    spans many slots and so spreads by itself. There are at least as many slots as values, so a
    slot meets about two intervals, and draws are compared with about two of them.
    """
    counts = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    grouped = counts.withColumn("g", F.pmod(F.xxhash64("value"), F.lit(GROUPS)))
    totals = grouped.groupBy("g").agg(F.sum("n").alias("g_n"), F.count("*").alias("g_values"))
    sizes = totals.agg(
        F.sum("g_n").alias("_total"), F.greatest(F.sum("g_values"), F.lit(MIN_SLOTS)).alias("_slots")
    )
    starts = totals.select("g", (F.sum("g_n").over(Window.orderBy("g")) - F.col("g_n")).alias("g_lo"))
    before = F.sum("n").over(Window.partitionBy("g").orderBy("value")) - F.col("n")
    placed = grouped.withColumn("before", before).join(F.broadcast(starts), "g")  # at most GROUPS rows
    placed = placed.withColumn("lo", F.col("g_lo") + F.col("before")).withColumn("hi", F.col("lo") + F.col("n"))
    slots = F.sequence(_slot(F.col("lo")), _slot(F.col("hi") - 1))
    spread = placed.crossJoin(F.broadcast(sizes)).select(F.explode(slots).alias("slot"), "lo", "hi", "value")
    return spread, sizes


def _draw_value(rows: DataFrame, df: DataFrame, column: str, seed: int) -> DataFrame:
    """Draw a source value by its frequency, which is to draw the value of a uniform source row."""
    intervals, sizes = value_intervals(df, column)
    position = F.floor(uniform(seed, column) * F.col("_total"))
    drawn = rows.crossJoin(F.broadcast(sizes)).withColumn("_pos", position)
    drawn = drawn.withColumn("_slot", _slot(F.col("_pos"))).drop("_total", "_slots")
    hit = (F.col("_slot") == F.col("slot")) & (F.col("_pos") >= F.col("lo")) & (F.col("_pos") < F.col("hi"))
    joined = drawn.join(intervals, hit, "left")
    return joined.withColumn(column, F.col("value")).drop("slot", "lo", "hi", "value", "_pos", "_slot")


def _source_stats(df: DataFrame, numeric: list[str], times: list[str]) -> DataFrame:
    """One row with what the draws need to know about the source."""
    parts = [F.count("*").alias("_rows")]
    for c in numeric:
        parts += [F.avg(c).alias(f"_mean_{c}"), F.coalesce(F.stddev_samp(c), F.lit(0.0)).alias(f"_std_{c}")]
    if YEAR in numeric:
        parts += [F.min(YEAR).alias("_year_lo"), F.max(YEAR).alias("_year_hi")]
    for c in times:
        ms = epoch_ms(df, c)
        parts += [F.min(ms).alias(f"_lo_{c}"), F.max(ms).alias(f"_hi_{c}")]
    return df.agg(*parts)


def generate(
    df: DataFrame,
    n: int,
    drift: bool = False,
    seed: int = 42,
    base_ms: int | None = None,
    year: int | None = None,
) -> DataFrame:
    """`n` bookings whose columns are drawn independently from the source's distributions.

    Numbers are normal, years and times uniform, other values drawn by frequency. With `drift`,
    price and lead time double and years fall in the last three up to `year`.
    """
    spark = df.sparkSession
    base_ms = int(time.time() * 1000) if base_ms is None else base_ms
    year = datetime.now(timezone.utc).year if year is None else year
    fields = [f for f in df.schema if f.name != KEY]
    numeric = [f.name for f in fields if isinstance(f.dataType, T.NumericType)]
    times = [f.name for f in fields if isinstance(f.dataType, T.TimestampType | T.TimestampNTZType)]
    drawn = [f.name for f in fields if f.name not in numeric and f.name not in times]

    rows = spark.range(n).withColumnRenamed("id", "_row")
    rows = rows.crossJoin(F.broadcast(_source_stats(df, numeric, times)))
    for c in drawn:
        rows = _draw_value(rows, df, c, seed)

    columns: dict[str, Column] = {KEY: F.concat(F.lit("BK"), (F.lit(base_ms) + F.col("_row")).cast("string"))}
    for c in numeric:
        if c == YEAR:
            lo, hi = (F.lit(year - 2), F.lit(year)) if drift else (F.col("_year_lo"), F.col("_year_hi"))
            columns[c] = lo + F.floor(uniform(seed, c) * (hi - lo + 1))
            continue
        value = F.col(f"_mean_{c}") + F.col(f"_std_{c}") * normal(seed, c)
        columns[c] = F.greatest(F.lit(0.0), value) if c in CLIPPED else value
    for c in times:
        span = F.col(f"_hi_{c}") - F.col(f"_lo_{c}")
        instant = F.timestamp_millis(F.col(f"_lo_{c}") + F.floor(uniform(seed, c) * span))
        if isinstance(df.schema[c].dataType, T.TimestampNTZType):
            instant = utc_wall(instant)
        columns[c] = instant
    made = rows.withColumns(columns).select(KEY, *[f.name for f in fields])
    made = cast_align(made)
    if drift:
        # Doubled after rounding, like the year range applied to the finished rows.
        made = made.withColumns({c: (F.col(c) * 2).cast(made.schema[c].dataType) for c in DRIFTING if c in numeric})
    return made


def check_generated(made: DataFrame, source: DataFrame, categories: list[str]) -> DataFrame:
    """One row of properties: row count, distinct ids, clipped columns at zero or above, known categories."""
    clipped = [c for c in CLIPPED if c in made.columns]
    negative = F.greatest(*[F.max(F.when(F.col(c) < 0, 1).otherwise(0)) for c in clipped], F.lit(0))
    summary = made.agg(
        F.count("*").alias("n_rows"),
        F.count_distinct(KEY).alias("n_ids"),
        (negative == 0).alias("non_negative"),
    )

    def values(df: DataFrame) -> DataFrame:
        text = df.select(*[F.col(c).cast("string").alias(c) for c in categories])
        return text.unpivot([], categories, "feature", "value").filter("value IS NOT NULL").distinct()

    strange = values(made).join(values(source), ["feature", "value"], "left_anti").agg(F.count("*").alias("_strange"))
    return summary.crossJoin(F.broadcast(strange)).select(
        "n_rows",
        "n_ids",
        "non_negative",
        (F.col("_strange") == 0).alias("known_categories"),
    )
