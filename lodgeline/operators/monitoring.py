"""Health, drift, quality, value and fairness over the inference log.

Every operator groups the log to a frame of the size of its result before anything else is done with it. Most scan it
once; data quality needs two scans, since outliers need the statistics first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodgeline.functions.columns import bucket
from lodgeline.operators.shares import with_totals

# Defaults of the business parameters and the alert thresholds.
COST_PER_CALL = 0.02
VALUE_PER_BOOKING = 120.0
LOSS_PER_CANCELLATION = 30.0
DRIFT_LIMIT = 1.0
MISSING_LIMIT = 5.0
OUTLIER_LIMIT = 1.0
BIAS_LIMIT = 0.1

DEFAULT_NUMERIC = ("avg_price_per_room", "lead_time", "no_of_children")


def _flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def system_health(log: DataFrame, ts: str = "timestamp", unit: str = "hour") -> DataFrame:
    """Calls, failed calls, mean latency and error rate in percent per hour."""
    latency = F.avg("execution_duration_ms") if "execution_duration_ms" in log.columns else F.lit(None).cast("double")
    hourly = log.groupBy(bucket(ts, unit).alias("hour_start")).agg(
        F.count("*").alias("total_calls"),
        F.sum(_flag(F.col("prediction").isNull())).alias("errors"),
        latency.alias("avg_latency_ms"),
    )
    return hourly.withColumn("error_rate", F.col("errors") / F.col("total_calls") * 100)


def health_latest(log: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Health of the last hour that has calls."""
    return (
        system_health(log, ts)
        .orderBy(F.col("hour_start").desc())
        .limit(1)
        .select("hour_start", (100 - F.col("error_rate")).alias("success_rate"), "errors", "avg_latency_ms")
    )


def call_volume(log: DataFrame, ts: str = "timestamp") -> DataFrame:
    return log.groupBy(bucket(ts).alias("hour_start")).agg(F.count("*").alias("calls"))


def call_totals(log: DataFrame, ts: str = "timestamp") -> DataFrame:
    """All calls, and those of the last hour that has any."""
    return call_volume(log, ts).agg(
        F.coalesce(F.sum("calls"), F.lit(0)).alias("total_calls"),
        F.max_by("calls", "hour_start").alias("last_hour_calls"),
    )


def drift_numeric(log: DataFrame, features: Sequence[str] = DEFAULT_NUMERIC, ts: str = "timestamp") -> DataFrame:
    """Distance of each hour's mean from the overall mean, in overall sample standard deviations.

    One scan for any number of features: the hourly count, mean and population variance of each
    are merged into the overall mean and deviation over the hourly frame.
    """
    moments = []
    for f in features:
        x = F.col(f).cast("double")
        moments += [F.struct(F.count(f).alias("n"), F.avg(x).alias("mean"), F.var_pop(x).alias("var")).alias(f)]
    hourly = log.groupBy(bucket(ts).alias("hour_start")).agg(*moments)
    # A map of feature to moments turns the wide hourly row into one row per feature.
    pairs = F.create_map(*[part for f in features for part in (F.lit(f), F.col(f))])
    long = hourly.select("hour_start", F.explode(pairs).alias("feature", "m")).filter("m.n > 0")
    by_feature = Window.partitionBy("feature")
    n, mean = F.col("m.n"), F.col("m.mean")
    merged = long.select(
        "*",
        F.sum(n).over(by_feature).alias("all_n"),
        (F.sum(n * mean).over(by_feature) / F.sum(n).over(by_feature)).alias("all_mean"),
    )
    squares = F.sum(n * F.col("m.var") + n * (mean - F.col("all_mean")) * (mean - F.col("all_mean"))).over(by_feature)
    spread = F.when(F.col("all_n") > 1, F.sqrt(squares / (F.col("all_n") - 1)))
    return merged.withColumn("all_std", spread).select(
        "hour_start",
        "feature",
        (F.abs(mean - F.col("all_mean")) / F.nullif(F.col("all_std"), F.lit(0.0))).alias("drift_score"),
    )


def drift_categorical(
    log: DataFrame,
    features: Sequence[str] = ("market_segment_type",),
    ts: str = "timestamp",
    full: bool = False,
) -> DataFrame:
    """Distance of each hour's category shares from the overall shares, summed over categories.

    Only categories seen in the hour count; with `full` those absent from it count too. They add
    the overall share the seen ones leave over, so no grid of hours and categories is built.
    """
    long = log.select(bucket(ts).alias("hour_start"), *[F.col(f).cast("string").alias(f) for f in features]).unpivot(
        ["hour_start"], list(features), "feature", "category"
    )
    counts = long.filter(F.col("category").isNotNull()).groupBy("hour_start", "feature", "category").agg(
        F.count("*").alias("n")
    )
    # Totals by windows over the grouped frame, so the log is read once.
    total = lambda *by: F.sum("n").over(Window.partitionBy(*by))
    shares = counts.select(
        "hour_start",
        "feature",
        (F.col("n") / total("hour_start", "feature")).alias("share"),
        (total("feature", "category") / total("feature")).alias("global_share"),
    )
    gap = F.sum(F.abs(F.col("share") - F.col("global_share")))
    if full:
        gap = gap + F.greatest(1 - F.sum("global_share"), F.lit(0.0))
    return shares.groupBy("hour_start", "feature").agg(gap.alias("drift_score"))


def drift_summary(drift: DataFrame) -> DataFrame:
    return drift.agg(F.avg("drift_score").alias("mean_drift"), F.max("drift_score").alias("max_drift"))


def data_quality(log: DataFrame, features: Sequence[str] = DEFAULT_NUMERIC, k: float = 3.0) -> DataFrame:
    """Rows, missing values and values beyond `k` deviations of the mean per feature, in percent.

    Missing values count as no outliers and stay in the denominator.
    """
    stats = log.agg(
        *[F.avg(f).alias(f"_mean_{f}") for f in features], *[F.stddev_samp(f).alias(f"_std_{f}") for f in features]
    )
    with_stats = log.select(*features).crossJoin(F.broadcast(stats))
    rows = [F.count("*").alias("total_rows")]
    for f in features:
        far = F.abs(F.col(f) - F.col(f"_mean_{f}")) > k * F.col(f"_std_{f}")
        rows.append(
            F.struct(
                F.sum(_flag(F.col(f).isNull())).alias("missing"),
                F.sum(_flag(F.col(f).isNotNull() & far)).alias("outliers"),
            ).alias(f)
        )
    wide = with_stats.agg(*rows).filter("total_rows > 0")
    pairs = F.create_map(*[part for f in features for part in (F.lit(f), F.col(f))])
    return wide.select("total_rows", F.explode(pairs).alias("feature", "c")).select(
        "feature",
        "total_rows",
        F.col("c.missing").alias("missing_count"),
        (F.col("c.missing") / F.col("total_rows") * 100).alias("missing_rate"),
        (F.col("c.outliers") / F.col("total_rows") * 100).alias("outlier_rate"),
    )


def business_value(
    log: DataFrame,
    cost: float = COST_PER_CALL,
    value: float = VALUE_PER_BOOKING,
    loss: float = LOSS_PER_CANCELLATION,
    ts: str = "timestamp",
) -> DataFrame:
    """Calls, predicted outcomes, cost and estimated value per day."""
    daily = log.groupBy(bucket(ts, "day").alias("day_start")).agg(
        F.count("*").alias("total_calls"),
        F.sum(_flag(F.col("prediction") == 1)).alias("canceled_pred"),
        F.sum(_flag(F.col("prediction") == 0)).alias("kept_pred"),
    )
    infra = F.col("total_calls") * F.lit(float(cost))
    gain = F.col("kept_pred") * F.lit(float(value)) - F.col("canceled_pred") * F.lit(float(loss))
    return daily.withColumn("infra_cost", infra).withColumn("estimated_value", gain - F.col("infra_cost"))


def business_totals(daily: DataFrame) -> DataFrame:
    calls = F.coalesce(F.sum("total_calls"), F.lit(0))
    value = F.coalesce(F.sum("estimated_value"), F.lit(0.0))
    return daily.agg(
        F.coalesce(F.sum("infra_cost"), F.lit(0.0)).alias("total_cost"),
        value.alias("total_value"),
        calls.alias("total_calls"),
        F.when(calls > 0, value / calls).otherwise(0.0).alias("avg_value_per_call"),
    )


def fairness(log: DataFrame, feature: str = "market_segment_type") -> DataFrame:
    """Rate of positive predictions per category and its gap to the plain mean of all rates."""
    groups = (
        log.filter(F.col(feature).isNotNull())
        .groupBy(F.col(feature).alias("category"))
        .agg(F.count("*").alias("total"), F.sum(_flag(F.col("prediction") == 1)).alias("positive_preds"))
    )
    rate = F.col("positive_preds") / F.col("total")
    rated = with_totals(groups, [], F.avg(rate).alias("_mean_rate"))
    return rated.select(
        "category",
        "total",
        "positive_preds",
        F.round(rate, 4).alias("positive_rate"),
        F.round(rate - F.col("_mean_rate"), 4).alias("bias_gap"),
    ).orderBy(F.col("positive_rate").desc())


def alerts(
    log: DataFrame,
    features: Sequence[str] = DEFAULT_NUMERIC,
    sensitive: str = "market_segment_type",
    ts: str = "timestamp",
) -> DataFrame:
    """Drift, missing values, outliers and bias set against their limits, one row per subject."""
    drift = drift_numeric(log, features, ts).groupBy("feature").agg(F.max("drift_score").alias("drift"))
    quality = data_quality(log, features)
    bias = fairness(log, sensitive)

    def check(df: DataFrame, name: str, subject: str, value: Column, limit: float) -> DataFrame:
        return df.select(
            F.lit(name).alias("check"),
            F.col(subject).alias("subject"),
            value.cast("double").alias("value"),
            F.lit(limit).alias("threshold"),
            F.coalesce(value > limit, F.lit(False)).alias("alert"),
        )

    return (
        check(drift, "drift", "feature", F.col("drift"), DRIFT_LIMIT)
        .unionAll(check(quality, "missing", "feature", F.col("missing_rate"), MISSING_LIMIT))
        .unionAll(check(quality, "outlier", "feature", F.col("outlier_rate"), OUTLIER_LIMIT))
        .unionAll(check(bias, "bias", "category", F.abs("bias_gap"), BIAS_LIMIT))
    )


def profile_flags() -> list[Column]:
    """What a call adds to the counts of its window."""
    return [
        F.lit(1).cast("bigint").alias("n"),
        _flag(F.col("prediction") == 1).cast("bigint").alias("positives"),
        _flag(F.col("prediction").isNull()).cast("bigint").alias("nulls"),
    ]


def profile_columns() -> list[Column]:
    return [
        F.count("*").alias("n"),
        F.sum(_flag(F.col("prediction") == 1)).alias("positives"),
        F.sum(_flag(F.col("prediction").isNull())).alias("nulls"),
    ]


def profile_rates(grouped: DataFrame) -> DataFrame:
    """Positive rate among scored calls and share of calls without a prediction."""
    scored = F.col("n") - F.col("nulls")
    return grouped.withColumn("positive_rate", F.when(scored > 0, F.col("positives") / scored)).withColumn(
        "null_rate", F.col("nulls") / F.col("n")
    )


def profile(log: DataFrame, ts: str = "timestamp", width: str = "30 minutes", by: str = "model_name") -> DataFrame:
    """Volume and prediction mix of each model in tumbling windows."""
    grouped = log.groupBy(F.window(ts, width).alias("w"), by).agg(*profile_columns())
    return profile_rates(
        grouped.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), by, "n", "positives", "nulls")
    )
