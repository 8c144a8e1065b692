from __future__ import annotations

import math
import statistics

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lodgeline.operators import monitoring as ops

SCHEMA = (
    "timestamp string, prediction double, execution_duration_ms long, lead_time int, "
    "market_segment_type string, model_name string"
)
DATA = [
    ("2024-01-01 00:10:00", 1.0, 100, 10, "Online", "a"),
    ("2024-01-01 00:40:00", 0.0, 200, 20, "Online", "a"),
    ("2024-01-01 00:50:00", None, 300, None, "Offline", "b"),
    ("2024-01-01 01:05:00", 0.0, 400, 90, "Corporate", "a"),
    ("2024-01-02 03:00:00", 1.0, None, 30, None, "a"),
]


@pytest.fixture
def log(spark):
    df = spark.createDataFrame(DATA, SCHEMA)
    return df.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


def test_health_per_hour(log):
    got = {str(r["hour_start"]): r for r in ops.system_health(log).collect()}
    first = got["2024-01-01 00:00:00"]
    assert (first["total_calls"], first["errors"], first["avg_latency_ms"]) == (3, 1, 200.0)
    assert math.isclose(first["error_rate"], 100 / 3)
    latest = ops.health_latest(log).first()
    assert (str(latest["hour_start"]), latest["success_rate"], latest["errors"]) == ("2024-01-02 03:00:00", 100.0, 0)


def test_health_without_latency_and_without_calls(log):
    assert ops.system_health(log.drop("execution_duration_ms")).first()["avg_latency_ms"] is None
    assert ops.health_latest(log.limit(0)).collect() == []
    assert rows(ops.call_totals(log.limit(0))) == [(0, None)]
    assert rows(ops.call_totals(log)) == [(5, 1)]


def test_numeric_drift_equals_its_definition(log):
    values = [10, 20, 90, 30]
    mean, std = statistics.mean(values), statistics.stdev(values)
    got = {str(r["hour_start"])[:13]: r["drift_score"] for r in ops.drift_numeric(log, ["lead_time"]).collect()}
    want = {"2024-01-01 00": [10, 20], "2024-01-01 01": [90], "2024-01-02 03": [30]}
    assert got.keys() == want.keys()
    for hour, hourly in want.items():
        assert math.isclose(got[hour], abs(statistics.mean(hourly) - mean) / std)


def test_numeric_drift_of_large_close_values_is_stable(spark):
    df = spark.createDataFrame([(h, 1e9 + (h * 7 + i) % 3) for h in range(20) for i in range(50)], "h int, x double")
    df = df.select(F.make_timestamp_ntz(F.lit(2024), F.lit(1), F.lit(1), "h", F.lit(0), F.lit(0)).alias("timestamp"), "x")
    values = [1e9 + (h * 7 + i) % 3 for h in range(20) for i in range(50)]
    std = statistics.stdev(values)
    got = ops.drift_numeric(df, ["x"]).orderBy("hour_start").first()["drift_score"]
    hour = statistics.mean(values[:50])
    assert math.isclose(got, abs(hour - statistics.mean(values)) / std, rel_tol=1e-6)


def test_drift_of_constants_and_single_rows_is_null(log):
    same = log.withColumn("lead_time", F.lit(5))
    assert {r["drift_score"] for r in ops.drift_numeric(same, ["lead_time"]).collect()} == {None}
    assert ops.drift_numeric(log.limit(1), ["lead_time"]).first()["drift_score"] is None
    assert ops.drift_numeric(log.limit(0), ["lead_time"]).collect() == []


def brute_categorical(full: bool) -> dict[str, float]:
    seen = [(d[0][:13], d[4]) for d in DATA if d[4] is not None]
    overall = {c: sum(x == c for _, x in seen) / len(seen) for _, c in seen}
    out = {}
    for hour in {h for h, _ in seen}:
        mine = [c for h, c in seen if h == hour]
        cats = overall if full else set(mine)
        out[hour] = sum(abs(mine.count(c) / len(mine) - overall[c]) for c in cats)
    return out


@pytest.mark.parametrize("full", [False, True])
def test_categorical_drift_equals_its_definition(log, full):
    got = ops.drift_categorical(log, ["market_segment_type"], full=full).collect()
    want = brute_categorical(full)
    assert {str(r["hour_start"])[:13] for r in got} == want.keys()
    for r in got:
        assert math.isclose(r["drift_score"], want[str(r["hour_start"])[:13]], abs_tol=1e-12)


def test_quality_counts_nulls_in_the_denominator(spark):
    df = spark.createDataFrame([(1.0,)] * 30 + [(100.0,), (None,)], "x double")
    got = ops.data_quality(df, ["x"]).first()
    assert (got["total_rows"], got["missing_count"]) == (32, 1)
    assert math.isclose(got["missing_rate"], 100 / 32) and math.isclose(got["outlier_rate"], 100 / 32)
    one = ops.data_quality(df.limit(1), ["x"]).first()
    assert one["outlier_rate"] == 0.0
    assert ops.data_quality(df.limit(0), ["x"]).collect() == []


def test_business_value_and_totals(log):
    daily = ops.business_value(log)
    first = daily.orderBy("day_start").first()
    assert (first["canceled_pred"], first["kept_pred"]) == (1, 2)
    assert math.isclose(first["estimated_value"], 2 * 120 - 30 - 4 * 0.02)
    totals = ops.business_totals(daily).first()
    assert totals["total_calls"] == 5 and math.isclose(totals["total_cost"], 0.1)
    nothing = ops.business_totals(ops.business_value(log.limit(0))).first()
    assert (nothing["total_calls"], nothing["avg_value_per_call"]) == (0, 0.0)


def test_fairness_gap_is_to_the_plain_mean_of_rates(log):
    got = {r["category"]: (r["total"], r["positive_rate"], r["bias_gap"]) for r in ops.fairness(log).collect()}
    assert got == {"Online": (2, 0.5, 0.3333), "Offline": (1, 0.0, -0.1667), "Corporate": (1, 0.0, -0.1667)}


def test_alerts_flag_what_passes_its_limit(log):
    got = {(r["check"], r["subject"]): r["alert"] for r in ops.alerts(log, ["lead_time"]).collect()}
    assert got[("missing", "lead_time")] and got[("bias", "Online")] and not got[("outlier", "lead_time")]


def test_profile_in_half_hours(log):
    got = rows(ops.profile(log), "model_name", "window_start", "n", "positive_rate", "null_rate")
    picked = [(m, str(w)[11:16], n, p, q) for m, w, n, p, q in got]
    assert ("a", "00:00", 1, 1.0, 0.0) in picked and ("b", "00:30", 1, None, 1.0) in picked


def test_log_is_scanned_once_for_all_drift_features(log, path):
    log.write.parquet(path)
    df = log.sparkSession.read.parquet(path)
    plan = ops.drift_numeric(df, ["lead_time", "execution_duration_ms"])._jdf.queryExecution().executedPlan()
    assert plan.toString().count("FileScan") == 1


def test_categorical_drift_reads_the_log_once(spark, path):
    df = spark.range(100).selectExpr("timestamp_ntz'2024-01-01' + make_dt_interval(0, id % 5) AS timestamp", "string(id % 3) AS a", "string(id % 7) AS b")
    df.write.parquet(path)
    drift = ops.drift_categorical(spark.read.parquet(path), ["a", "b"], full=True)
    drift.collect()
    plan = drift._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("FileScan") == 1
