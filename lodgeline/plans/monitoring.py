"""Monitoring of the inference log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeline.operators import monitoring as ops
from lodgeline.operators.cleaning import trailing

from lodgeline.plans.registry import query
from lodgeline.sources.fixtures import Tables, latest

NUMERIC = ops.DEFAULT_NUMERIC
CATEGORICAL = ("market_segment_type", "room_type_reserved")


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


HOUR = "time_bucket(INTERVAL 1 HOUR, timestamp) AS hour_start"

HEALTH = f"""SELECT {HOUR}, count(*) AS total_calls, count(*) - count(prediction) AS errors,
 round(avg(execution_duration_ms), 6) AS avg_latency_ms,
 round(100.0::DOUBLE * (count(*) - count(prediction)) / count(*), 6) AS error_rate
FROM inference_log GROUP BY hour_start"""


@query("system_health", HEALTH)
def system_health(t: Tables) -> DataFrame:
    return rounded(ops.system_health(t.log), "avg_latency_ms", "error_rate")


@query(
    "health_latest",
    f"""WITH h AS ({HEALTH}) SELECT hour_start, round(100 - error_rate, 6) AS success_rate, errors, avg_latency_ms
FROM h WHERE hour_start = (SELECT max(hour_start) FROM h)""",
)
def health_latest(t: Tables) -> DataFrame:
    return rounded(ops.health_latest(t.log), "success_rate", "avg_latency_ms")


CALLS = f"SELECT {HOUR}, count(*) AS calls FROM inference_log GROUP BY hour_start"


@query("call_volume", CALLS)
def call_volume(t: Tables) -> DataFrame:
    return ops.call_volume(t.log)


@query(
    "call_totals",
    f"""WITH c AS ({CALLS}) SELECT CAST(sum(calls) AS BIGINT) AS total_calls, max_by(calls, hour_start) AS last_hour_calls FROM c""",
)
def call_totals(t: Tables) -> DataFrame:
    return ops.call_totals(t.log)


def unpivoted(features, value: str, kind: str, nulls: str = "") -> str:
    """The log with a row for each call and feature."""
    columns = ", ".join(f"CAST({f} AS {kind}) AS {f}" for f in features)
    named = f"{value} FOR feature IN ({', '.join(features)})"
    return f"SELECT hour_start, feature, {value} FROM (SELECT {HOUR}, {columns} FROM inference_log) UNPIVOT {nulls} ({named})"


# The deviation of all values follows from counts, sums and sums of squares per hour.
DRIFT_NUMERIC = f"""WITH value_rows AS ({unpivoted(NUMERIC, "x", "DOUBLE")}),
per_hour AS (SELECT hour_start, feature, count(*) AS n, sum(x) AS total, sum(x * x) AS squares
 FROM value_rows GROUP BY ALL),
whole AS (SELECT feature, sum(n) AS n, sum(total) / sum(n) AS mean,
  sqrt(greatest(sum(squares) - sum(total) * sum(total) / sum(n), 0) / nullif(sum(n) - 1, 0)) AS spread
 FROM per_hour GROUP BY feature)
SELECT hour_start, feature, abs(total / per_hour.n - mean) / nullif(spread, 0) AS drift_score
FROM per_hour JOIN whole USING (feature)"""


@query("drift_numeric", f"SELECT hour_start, feature, round(drift_score, 6) AS drift_score FROM ({DRIFT_NUMERIC}) d")
def drift_numeric(t: Tables) -> DataFrame:
    return rounded(ops.drift_numeric(t.log), "drift_score")


def drift_categorical_sql(full: bool) -> str:
    """Shares from joined totals. In full, the categories of the whole log are laid against every hour."""
    cells = "category_total JOIN hour_total USING (feature) LEFT JOIN cell USING (hour_start, feature, category)"
    seen = "" if full else "WHERE cell.n IS NOT NULL"
    return f"""WITH value_rows AS ({unpivoted(CATEGORICAL, "category", "VARCHAR")}),
cell AS (SELECT hour_start, feature, category, count(*) AS n FROM value_rows GROUP BY ALL),
hour_total AS (SELECT hour_start, feature, sum(n) AS n FROM cell GROUP BY ALL),
category_total AS (SELECT feature, category, sum(n) AS n FROM cell GROUP BY ALL),
feature_total AS (SELECT feature, sum(n) AS n FROM cell GROUP BY ALL)
SELECT hour_start, feature,
 round(sum(abs(coalesce(cell.n, 0) / hour_total.n - category_total.n / feature_total.n)), 6) AS drift_score
FROM {cells} JOIN feature_total USING (feature) {seen} GROUP BY hour_start, feature"""


@query("drift_categorical", drift_categorical_sql(False))
def drift_categorical(t: Tables) -> DataFrame:
    return rounded(ops.drift_categorical(t.log, CATEGORICAL), "drift_score")


@query("drift_categorical_full", drift_categorical_sql(True))
def drift_categorical_full(t: Tables) -> DataFrame:
    return rounded(ops.drift_categorical(t.log, CATEGORICAL, full=True), "drift_score")


@query(
    "drift_summary",
    f"""SELECT round(avg(drift_score), 6) AS mean_drift, round(max(drift_score), 6) AS max_drift
FROM ({DRIFT_NUMERIC}) d""",
)
def drift_summary(t: Tables) -> DataFrame:
    return rounded(ops.drift_summary(ops.drift_numeric(t.log)), "mean_drift", "max_drift")


QUALITY = f"""WITH value_rows AS ({unpivoted(NUMERIC, "x", "DOUBLE", "INCLUDE NULLS")}),
spread AS (SELECT feature, avg(x) AS m, stddev_samp(x) AS s FROM value_rows GROUP BY feature)
SELECT feature, count(*) AS total_rows, count(*) - count(x) AS missing_count,
 100.0::DOUBLE * (count(*) - count(x)) / count(*) AS missing_rate,
 100.0::DOUBLE * count(*) FILTER (abs(x - m) > 3 * s) / count(*) AS outlier_rate
FROM value_rows JOIN spread USING (feature) GROUP BY feature"""


@query(
    "data_quality",
    f"""SELECT feature, total_rows, missing_count, round(missing_rate, 6) AS missing_rate,
 round(outlier_rate, 6) AS outlier_rate FROM ({QUALITY}) q""",
)
def data_quality(t: Tables) -> DataFrame:
    return rounded(ops.data_quality(t.log), "missing_rate", "outlier_rate")


BUSINESS = """SELECT *, total_calls * 0.02::DOUBLE AS infra_cost,
 120.0::DOUBLE * kept_pred - 30.0::DOUBLE * canceled_pred - 0.02::DOUBLE * total_calls AS estimated_value
FROM (SELECT time_bucket(INTERVAL 1 DAY, timestamp) AS day_start, count(*) AS total_calls,
  count(*) FILTER (prediction = 1) AS canceled_pred, count(*) FILTER (prediction = 0) AS kept_pred
 FROM inference_log GROUP BY day_start) d"""


@query(
    "business_value",
    f"""SELECT CAST(day_start AS TIMESTAMP) AS day_start, total_calls, canceled_pred, kept_pred,
 round(infra_cost, 6) AS infra_cost, round(estimated_value, 6) AS estimated_value FROM ({BUSINESS}) b""",
)
def business_value(t: Tables) -> DataFrame:
    return rounded(ops.business_value(t.log), "infra_cost", "estimated_value")


@query(
    "business_totals",
    f"""SELECT round(sum(infra_cost), 6) AS total_cost, round(sum(estimated_value), 6) AS total_value,
 CAST(sum(total_calls) AS BIGINT) AS total_calls,
 round(sum(estimated_value) / sum(total_calls), 6) AS avg_value_per_call FROM ({BUSINESS}) b""",
)
def business_totals(t: Tables) -> DataFrame:
    totals = ops.business_totals(ops.business_value(t.log))
    return rounded(totals, "total_cost", "total_value", "avg_value_per_call")


FAIRNESS = """WITH g AS (SELECT market_segment_type AS category, count(*) AS total,
  count(*) FILTER (prediction = 1) AS positive_preds
 FROM inference_log GROUP BY category HAVING category IS NOT NULL),
typical AS (SELECT avg(positive_preds / total) AS rate FROM g)
SELECT category, total, positive_preds, round(positive_preds / total, 4) AS positive_rate,
 round(positive_preds / total - rate, 4) AS bias_gap FROM g JOIN typical ON TRUE"""


@query("fairness", FAIRNESS)
def fairness(t: Tables) -> DataFrame:
    return ops.fairness(t.log, "market_segment_type")


@query(
    "alerts",
    f"""WITH d AS (SELECT feature, max(drift_score) AS v FROM ({DRIFT_NUMERIC}) x GROUP BY 1),
q AS ({QUALITY}), b AS ({FAIRNESS}), a AS (
 SELECT 'drift' AS "check", feature AS subject, v AS value, CAST(1 AS DOUBLE) AS threshold FROM d
 UNION ALL SELECT 'missing', feature, missing_rate, CAST(5 AS DOUBLE) FROM q
 UNION ALL SELECT 'outlier', feature, outlier_rate, CAST(1 AS DOUBLE) FROM q
 UNION ALL SELECT 'bias', category, abs(bias_gap), CAST(0.1 AS DOUBLE) FROM b)
SELECT "check", subject, round(value, 6) AS value, threshold, coalesce(value > threshold, FALSE) AS alert FROM a""",
)
def alerts(t: Tables) -> DataFrame:
    return rounded(ops.alerts(t.log), "value")


PROFILE = """SELECT time_bucket(INTERVAL 30 MINUTE, timestamp) AS window_start, model_name, count(*) AS n,
 count(*) FILTER (prediction = 1) AS positives, count(*) - count(prediction) AS nulls,
 round(count(*) FILTER (prediction = 1) / nullif(count(prediction), 0), 6) AS positive_rate,
 round((count(*) - count(prediction)) / count(*), 6) AS null_rate
FROM inference_log GROUP BY window_start, model_name"""


@query("profile_30min", PROFILE)
def profile_30min(t: Tables) -> DataFrame:
    return rounded(ops.profile(t.log), "positive_rate", "null_rate")


# The default view: the last seven days


def last_week(t: Tables) -> DataFrame:
    return trailing(t.log, "timestamp", latest(t.events, "ts"))


WEEK = "(SELECT * FROM inference_log WHERE timestamp >= CAST(CAST((SELECT max(timestamp) FROM inference_log) AS DATE) - 7 AS TIMESTAMP))"


@query("health_last_week", HEALTH.replace("FROM inference_log", f"FROM {WEEK} w"))
def health_last_week(t: Tables) -> DataFrame:
    return rounded(ops.system_health(last_week(t)), "avg_latency_ms", "error_rate")


@query("calls_last_week", CALLS.replace("FROM inference_log", f"FROM {WEEK} w"))
def calls_last_week(t: Tables) -> DataFrame:
    return ops.call_volume(last_week(t))


@query(
    "value_last_week",
    f"""SELECT CAST(day_start AS TIMESTAMP) AS day_start, total_calls, canceled_pred, kept_pred,
 round(infra_cost, 6) AS infra_cost, round(estimated_value, 6) AS estimated_value
FROM ({BUSINESS.replace("FROM inference_log", f"FROM {WEEK} w")}) b""",
)
def value_last_week(t: Tables) -> DataFrame:
    return rounded(ops.business_value(last_week(t)), "infra_cost", "estimated_value")
