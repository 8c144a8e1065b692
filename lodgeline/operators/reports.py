"""Report queries: axes, shares, hierarchies, pivots, drivers, decomposition, prediction reports."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodgeline.functions.columns import bin_width
from lodgeline.operators.quantiles import exact_quantiles
from lodgeline.operators.shares import with_share, with_totals
from lodgeline.schemas import CANCELED, CAT_FEATURES, KEY, NOT_CANCELED, NUM_FEATURES, TARGET
from lodgeline.scratch import scratch_path

# The axes a report user can choose from, in their order.
AXES = (
    "type_of_meal_plan",
    "room_type_reserved",
    "market_segment_type",
    "lead_time_bin",
    "arrival_month",
    "arrival_year",
)
#: Dimensions from which on a path is added up depth by depth.
LONG_PATH = 6
DATE_LEVELS = ("year", "quarter", "month", "day")


# Bookings by axis, status, date and lead time


def with_bins(df: DataFrame) -> DataFrame:
    return df.withColumn("lead_time_bin", bin_width("lead_time", 20))


def by_axis(df: DataFrame, axis: str) -> DataFrame:
    """Bookings per value of the chosen axis, most first."""
    if axis not in AXES:
        raise ValueError(f"unknown axis {axis!r}, expected one of {AXES}")
    groups = with_bins(df).groupBy(F.col(axis).cast("string").alias("axis_value"))
    return groups.agg(F.count(KEY).alias("bookings")).orderBy(F.col("bookings").desc(), "axis_value")


def all_axes(df: DataFrame) -> DataFrame:
    """Bookings per value of every axis, from one scan."""
    known = F.when(F.col(KEY).isNotNull(), 1).otherwise(0).alias("known")
    text = with_bins(df).select(known, *[F.col(a).cast("string").alias(a) for a in AXES])
    long = text.unpivot(["known"], list(AXES), "axis", "axis_value")
    return long.groupBy("axis", "axis_value").agg(F.sum("known").alias("bookings"))


def status_share(df: DataFrame) -> DataFrame:
    groups = df.groupBy(TARGET).agg(F.count(KEY).alias("bookings"))
    return with_share(groups, "bookings", [], "share")


def date_hierarchy(df: DataFrame, date: str = "reservation_day", series: str = TARGET) -> DataFrame:
    """Bookings by year, quarter, month and day of a date, each level by series.

    Days are counted first; the levels are rolled up from the days, not from the bookings.
    """
    daily = df.filter(F.col(date).isNotNull()).groupBy(date, series).agg(F.count(KEY).alias("n"))
    dated = daily.select(
        series,
        "n",
        F.year(date).alias("year"),
        F.quarter(date).alias("quarter"),
        F.month(date).alias("month"),
        F.dayofmonth(date).alias("day"),
    )
    sets = [[*[F.col(c) for c in DATE_LEVELS[: i + 1]], F.col(series)] for i in range(len(DATE_LEVELS))]
    columns = [*[F.col(c) for c in DATE_LEVELS], F.col(series)]
    hidden = sum((F.grouping(c).cast("int") for c in DATE_LEVELS), F.lit(0))
    rolled = dated.groupingSets(sets, *columns).agg(
        F.sum("n").alias("bookings"), (F.lit(len(DATE_LEVELS)) - hidden).cast("int").alias("level")
    )
    return rolled.select("level", *DATE_LEVELS, series, "bookings")


def date_hierarchy_share(df: DataFrame, date: str = "reservation_day", series: str = TARGET) -> DataFrame:
    """The same, with each series' share of its date."""
    return with_share(date_hierarchy(df, date, series), "bookings", ["level", *DATE_LEVELS], "share")


def lead_time_bins(df: DataFrame) -> DataFrame:
    return with_bins(df).groupBy("lead_time_bin", TARGET).agg(F.count(KEY).alias("bookings"))


def lead_time_share(df: DataFrame) -> DataFrame:
    return with_share(lead_time_bins(df), "bookings", ["lead_time_bin"], "share")


# Pivots and matrices


def distinct_bookings() -> Column:
    """Distinct bookings; rows without an id count as one. Copies collapse before the shuffle."""
    return F.count_distinct(KEY) + F.coalesce(F.max(F.col(KEY).isNull().cast("int")), F.lit(0))


def pivot_counts(df: DataFrame, row: str, column: str, values: Sequence[str]) -> DataFrame:
    """Distinct bookings per row value, one column per given value."""
    counts = df.groupBy(row, column).agg(distinct_bookings().alias("bookings"))
    return counts.groupBy(row).pivot(column, list(values)).agg(F.first("bookings")).na.fill(0, list(values))


def confusion_matrix(df: DataFrame, label: str = TARGET, prediction: str = "booking_status_pred_custom") -> DataFrame:
    return pivot_counts(df, label, prediction, [CANCELED, NOT_CANCELED])


def _per_path(df: DataFrame, path: Sequence[str], **sums: Column) -> DataFrame:
    """A row for each combination of path values with `_firsts`, and with the given columns summed.

    `_firsts[d]` is how many bookings have their first row of a path prefix of length d there, so its sum over a prefix
    is the prefix's number of distinct bookings. Rows are collapsed to one per booking and path before the shuffles;
    within a booking, sorted by path, a prefix begins where it differs from that of the row before. So the table is
    never copied once per level. Rows without id are one booking.
    """
    totals = [F.sum(c).alias(name) for name, c in sums.items()]
    rows = df.groupBy(KEY, *path).agg(*totals) if totals else df.select(KEY, *path).distinct()
    before = F.lag(F.struct(*path)).over(Window.partitionBy(KEY).orderBy(*path))
    rows = rows.withColumn("_before", before)
    begins, same = [F.col("_before").isNull()], F.lit(True)
    for c in path:
        same = same & F.col("_before")[c].eqNullSafe(F.col(c))
        begins.append(F.col("_before").isNull() | ~same)
    firsts = [F.sum(F.when(x, 1).otherwise(0)).alias(f"_f{d}") for d, x in enumerate(begins)]
    grouped = rows.groupBy(*path).agg(*firsts, *[F.sum(name).alias(name) for name in sums])
    return grouped.select(*path, F.array(*[f"_f{d}" for d in range(len(begins))]).alias("_firsts"), *sums)


def _rolled_up(grouped: DataFrame, path: Sequence[str], *totals: Column) -> DataFrame:
    """The groups rolled up along the path: level, the path, bookings and the totals."""
    hidden = sum((F.grouping(c).cast("int") for c in path), F.lit(0))
    firsts = F.array(*[F.sum(F.col("_firsts")[d]) for d in range(len(path) + 1)])
    rolled = grouped.rollup(*path).agg((F.lit(len(path)) - hidden).cast("int").alias("level"), firsts.alias("_all"), *totals)
    return rolled.withColumn("bookings", F.coalesce(F.get("_all", F.col("level")), F.lit(0))).drop("_all")


def _sorted_up(grouped: DataFrame, path: Sequence[str]) -> DataFrame:
    """Level, path and bookings of every depth, the deep ones from one shuffle and one sort.

    A rollup would copy each group once for every depth before the shuffle. Here the groups are dealt by the first
    columns of the path and sorted by the rest, so that all groups of a deeper prefix lie on end, and a row is made only
    where a prefix begins. The depths above are added up from the few groups that they have.
    """
    split, depth, spark = max(1, 3 * len(path) // 7), len(path), grouped.sparkSession
    place = scratch_path(spark, "groups")
    grouped.write.parquet(place)
    grouped = spark.read.schema(grouped.schema).parquet(place)

    before = F.lag(F.struct(*path[split:])).over(Window.partitionBy(*path[:split]).orderBy(*path[split:]))
    rows = grouped.withColumn("_before", before)
    begin = F.when(F.col("_before").isNull(), split)
    for d, c in enumerate(path[split:], split + 1):
        begin = begin.when(~F.col("_before")[c].eqNullSafe(F.col(c)), d)
    rows = rows.select(*path, "_firsts", begin.alias("_begin"))
    # These windows find the groups dealt and sorted as they need them.
    for d in range(depth - 1, split - 1, -1):
        rows = rows.withColumn(f"_n{d}", F.sum(F.col("_firsts")[d]).over(Window.partitionBy(*path[:d])))
    counts = F.array(*[F.col(f"_n{d}") for d in range(split, depth)], F.col("_firsts")[depth])
    level = F.explode(F.sequence(F.col("_begin"), F.lit(depth))).alias("level")
    rows = rows.select(*path, counts.alias("_counts"), level)
    shown = [*path[:split], *[F.when(F.col("level") >= d, F.col(c)).alias(c) for d, c in enumerate(path[split:], split + 1)]]
    deep = rows.select("level", *shown, F.get("_counts", F.col("level") - split).alias("bookings"))

    above = path[: split - 1]
    few = grouped.groupBy(*above).agg(F.array(*[F.sum(F.col("_firsts")[d]) for d in range(split)]).alias("_firsts"))
    place = scratch_path(spark, "groups")
    few.write.parquet(place)
    few = spark.read.schema(few.schema).parquet(place)
    levels = [deep]
    for d in range(split - 1, -1, -1):
        hidden = [F.lit(None).cast(grouped.schema[c].dataType).alias(c) for c in path[d:]]
        bookings = F.coalesce(F.sum(F.col("_firsts")[d]), F.lit(0)).alias("bookings")
        levels.append(few.groupBy(*path[:d]).agg(bookings).select(F.lit(d).alias("level"), *path[:d], *hidden, "bookings"))
    return reduce(DataFrame.unionAll, levels)


def matrix(df: DataFrame, outer: str, inner: str, proba: str) -> DataFrame:
    """Distinct bookings and mean probability per outer and inner value, with subtotals and total.

    `level` is 2 for a cell, 1 for an outer subtotal, 0 for the grand total.
    """
    grouped = _per_path(df, [outer, inner], _sum=F.col(proba), _n=F.when(F.col(proba).isNotNull(), 1))
    mean = F.sum("_sum") / F.nullif(F.sum("_n"), F.lit(0))
    return _rolled_up(grouped, [outer, inner], mean.alias("avg_proba")).select("level", outer, inner, "bookings", "avg_proba")


# Drivers and decomposition


def key_drivers(
    df: DataFrame,
    target: str = TARGET,
    value: str = CANCELED,
    numeric: Sequence[str] = NUM_FEATURES,
    categorical: Sequence[str] = CAT_FEATURES,
    bins: int = 4,
) -> DataFrame:
    """How much likelier the target value is where a factor has a value than elsewhere.

    Numeric factors are cut into quantile bins `Q1`, `Q2`, ... at exact edges, which are found
    first and then stand in the plan as literals. All factors are counted in one scan.
    """
    edges = exact_quantiles(df, numeric, [i / bins for i in range(1, bins)])
    hit = F.when(F.col(target) == value, 1).otherwise(0).alias("hit")

    def bin_of(c: str) -> Column:
        above = [F.when(F.col(c) > F.lit(e), 1).otherwise(0) for e in edges[c]]
        return F.when(F.col(c).isNotNull(), F.concat(F.lit("Q"), (sum(above, F.lit(1))).cast("string")))

    wide = df.select(
        hit, *[bin_of(c).alias(c) for c in numeric], *[F.col(c).cast("string").alias(c) for c in categorical]
    )
    long = wide.unpivot(["hit"], [*numeric, *categorical], "factor", "factor_value")
    groups = long.groupBy("factor", "factor_value").agg(F.count("*").alias("n"), F.sum("hit").alias("hits"))
    rated = with_totals(groups, ["factor"], F.sum("n").alias("_n"), F.sum("hits").alias("_hits"))
    rest = F.col("_n") - F.col("n")
    rate = F.col("hits") / F.col("n")
    rest_rate = F.when(rest > 0, (F.col("_hits") - F.col("hits")) / rest)
    return rated.select(
        "factor",
        "factor_value",
        "n",
        rate.alias("rate"),
        rest_rate.alias("rest_rate"),
        (rate / F.nullif(rest_rate, F.lit(0.0))).alias("lift"),
    )


def decompose(df: DataFrame, path: Sequence[str]) -> DataFrame:
    """Distinct bookings along an ordered path of dimensions, at every depth of the path.

    Long paths have nearly as many groups as bookings; they are sorted and added up in place instead of rolled up.
    """
    grouped = _per_path(df, path)
    if len(path) > LONG_PATH:
        return _sorted_up(grouped, path)
    return _rolled_up(grouped, path).select("level", *path, "bookings")


def decompose_topk(df: DataFrame, path: Sequence[str], k: int = 4) -> DataFrame:
    """The `k` largest children of every node of the decomposition.

    The rank filter is pushed below the shuffle, so a node sends on at most `k` rows per task.
    """
    tree = decompose(df, path).filter("level > 0")
    parents = [F.when(F.col("level") > depth + 1, F.col(c)) for depth, c in enumerate(path[:-1])]
    siblings = Window.partitionBy("level", *parents).orderBy(F.col("bookings").desc(), *path)
    return tree.withColumn("rank", F.row_number().over(siblings)).filter(F.col("rank") <= k)


# Prediction reports


def prediction_cards(
    df: DataFrame,
    basic: str = "booking_status_pred_basic",
    custom: str = "booking_status_pred_custom",
    price: str = "avg_price_per_room",
) -> DataFrame:
    """Scored bookings, bookings the basic model calls canceled, revenue by the custom model's label."""
    per_booking = df.groupBy(KEY).agg(
        F.max(F.when(F.col(basic) == CANCELED, 1).otherwise(0)).alias("canceled"),
        F.sum(F.when(F.col(custom) == NOT_CANCELED, F.col(price))).alias("kept"),
        F.sum(F.when(F.col(custom) == CANCELED, F.col(price))).alias("lost"),
    )
    return per_booking.agg(
        F.count("*").alias("scored_bookings"),
        F.coalesce(F.sum("canceled"), F.lit(0)).alias("predicted_canceled"),
        F.sum("kept").alias("revenue_kept"),
        F.sum("lost").alias("revenue_lost"),
    )


def prediction_mix(df: DataFrame, custom: str = "booking_status_pred_custom") -> DataFrame:
    groups = df.groupBy(custom).agg(F.count(KEY).alias("bookings"))
    return with_share(groups, "bookings", [], "share")


def price_proba_scatter(
    df: DataFrame,
    custom: str = "booking_status_pred_custom",
    price: str = "avg_price_per_room",
    proba: str = "proba_other",
) -> DataFrame:
    return df.groupBy(KEY, custom).agg(F.avg(proba).alias("proba"), F.sum(price).alias("price"))


def booking_details(
    df: DataFrame, custom: str = "booking_status_pred_custom", proba: str = "proba_other"
) -> DataFrame:
    """One line per booking and its categories with summed counts, likeliest cancellation first.

    The booking settles ties, so that rows of one probability need not be sorted by one task.
    """
    sums = [c for c in NUM_FEATURES if c not in ("arrival_month", "arrival_year", "avg_price_per_room")]
    return (
        df.groupBy(KEY, custom, "market_segment_type", "room_type_reserved", "type_of_meal_plan")
        .agg(F.avg(proba).alias("proba"), *[F.sum(c).alias(c) for c in sums])
        .orderBy(F.col("proba").desc_nulls_last(), KEY)
    )


def accuracy_by(df: DataFrame, by: Sequence[str | Column]) -> DataFrame:
    """Good predictions, rows and accuracy per group; rows without a prediction count as wrong."""
    return df.groupBy(*by).agg(
        F.sum("good_prediction").alias("good_predictions"),
        F.count(KEY).alias("predictions"),
        (F.sum("good_prediction") / F.nullif(F.count(KEY), F.lit(0))).alias("accuracy"),
    )


def last_update(df: DataFrame, ts: str = "update_timestamp_utc") -> DataFrame:
    return df.agg(F.max(ts).alias("last_update"))

