from __future__ import annotations

import math
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lodgeline.operators import cleaning, kpi
from lodgeline.operators import reports as ops
from lodgeline.operators.quantiles import exact_quantiles
from lodgeline.operators.shares import with_share

SCHEMA = "Booking_ID string, booking_status string, market_segment_type string, avg_price_per_room double, lead_time int"
DATA = [
    ("a", "Canceled", "Online", 100.0, 10),
    ("b", "Not_Canceled", "Online", 50.0, 30),
    ("c", "Not_Canceled", "Offline", 70.0, None),
    ("c", "Not_Canceled", "Offline", 10.0, 50),
    (None, "Canceled", "Offline", 1.0, 5),
]


@pytest.fixture
def facts(spark):
    return spark.createDataFrame(DATA, SCHEMA)


def one(df) -> dict:
    return df.first().asDict()


def test_measures_count_a_missing_id_as_one_booking(facts):
    got = one(kpi.measures(facts))
    assert got["nb_bookings"] == 4 and got["nb_bookings_canceled"] == 2
    assert got["revenue_estimated"] == 231.0 and got["revenue_canceled"] == 101.0
    assert got["avg_lead_time"] == 23.75 and got["pct_canceled"] == 0.5


def test_fixed_status_replaces_the_slicer(facts):
    got = one(kpi.measures(facts, filters={"booking_status": ["Not_Canceled"]}))
    assert got["nb_bookings"] == 2 and got["nb_bookings_canceled"] == 2
    assert got["revenue_estimated"] == 130.0 and got["revenue_canceled"] == 101.0
    assert got["pct_canceled"] == 0.0


def test_fixed_status_replaces_the_group_too(facts):
    df = kpi.measures(facts, by=["booking_status"])
    got = {r["booking_status"]: r for r in df.collect()}
    assert [got[s]["pct_canceled"] for s in ("Canceled", "Not_Canceled")] == [1.0, 0.0]
    assert {r["nb_bookings_canceled"] for r in got.values()} == {2}
    assert {r["revenue_not_canceled"] for r in got.values()} == {130.0}


def test_other_filters_stay(facts):
    got = one(kpi.measures(facts, filters={"market_segment_type": ["Online"], "booking_status": ["Canceled"]}))
    assert (got["nb_bookings"], got["nb_bookings_canceled"], got["pct_canceled"]) == (1, 1, 1.0)
    assert got["revenue_not_canceled"] == 50.0


def test_measures_of_nothing(facts):
    got = one(kpi.measures(facts, filters={"market_segment_type": ["none"]}))
    assert got["nb_bookings"] == 0 and got["pct_canceled"] is None and got["revenue_estimated"] is None
    with pytest.raises(ValueError, match="unknown measures"):
        kpi.measures(facts, ["profit"])


def test_accuracy_counts_unscored_rows_as_wrong(spark):
    df = spark.createDataFrame([("a", 1), ("b", 0), (None, 1)], "Booking_ID string, good_prediction int")
    assert one(kpi.good_predictions(df)) == {"nb_good_prediction": 2, "accuracy": 1.0}
    assert rows(ops.accuracy_by(df.filter("Booking_ID IS NOT NULL"), []), "accuracy") == [(0.5,)]


def test_shares_sum_to_one_and_nulls_match(facts):
    bins = ops.lead_time_share(facts)
    sums = bins.groupBy("lead_time_bin").agg(F.sum("share").alias("s"), F.sum("bookings").alias("n")).collect()
    assert len(sums) == 4
    assert all(math.isclose(r["s"], 1) for r in sums if r["n"])
    assert math.isclose(ops.status_share(facts).agg(F.sum("share")).first()[0], 1)
    grouped = facts.groupBy("lead_time").agg(F.count("*").alias("n"))
    assert with_share(grouped, "n", ["lead_time"], "s").filter("lead_time IS NULL").first()["s"] == 1.0


def test_axis_is_checked(facts):
    got = rows(ops.by_axis(facts, "market_segment_type"))
    assert got == [("Offline", 2), ("Online", 2)]
    with pytest.raises(ValueError, match="axis"):
        ops.by_axis(facts, "Booking_ID; DROP")


def test_date_hierarchy_levels_add_up(spark):
    df = spark.createDataFrame(
        [("a", "x", "2024-01-31"), ("b", "y", "2024-01-31"), ("c", "x", "2024-05-01"), ("d", "x", None)],
        "Booking_ID string, booking_status string, d string",
    ).withColumn("reservation_day", F.col("d").cast("date"))
    out = ops.date_hierarchy(df)
    per_level = {r["level"]: r["n"] for r in out.groupBy("level").agg(F.sum("bookings").alias("n")).collect()}
    assert per_level == {1: 3, 2: 3, 3: 3, 4: 3}
    shares = ops.date_hierarchy_share(df).filter("level = 1 AND booking_status = 'x'").first()["share"]
    assert math.isclose(shares, 2 / 3)


def test_pivot_shows_zero_for_absent_cells(spark):
    df = spark.createDataFrame(
        [("a", "Canceled", "Canceled"), ("a", "Canceled", "Canceled"), ("b", "Not_Canceled", "Canceled")],
        "Booking_ID string, booking_status string, booking_status_pred_custom string",
    )
    got = rows(ops.confusion_matrix(df))
    assert got == [("Canceled", 1, 0), ("Not_Canceled", 1, 0)]
    unscored = spark.createDataFrame([(None, "Canceled", "Canceled"), ("a", "Not_Canceled", None)], df.schema)
    assert rows(ops.confusion_matrix(unscored)) == [("Canceled", 1, 0), ("Not_Canceled", 0, 0)]


def test_matrix_has_subtotals_of_distinct_bookings(spark):
    df = spark.createDataFrame(
        [("a", "x", "p", 0.2), ("a", "x", "q", 0.4), ("b", "y", "p", 0.6)],
        "Booking_ID string, o string, i string, w double",
    )
    got = {(r["level"], r["o"], r["i"]): (r["bookings"], round(r["avg_proba"], 6)) for r in ops.matrix(df, "o", "i", "w").collect()}
    assert got[(0, None, None)] == (2, 0.4) and got[(1, "x", None)] == (1, 0.3) and len(got) == 6


def test_decomposition_keeps_null_values_apart_from_totals(spark):
    df = spark.createDataFrame([("a", None, "u"), ("b", "s", "u"), ("b", "s", "v")], "Booking_ID string, p string, q string")
    got = rows(ops.decompose(df, ["p", "q"]), "level", "p", "q", "bookings")
    assert (1, None, None, 1) in got and (0, None, None, 2) in got and (1, "s", None, 1) in got
    top = ops.decompose_topk(df, ["p", "q"], k=1)
    assert rows(top, "level", "p", "q", "bookings") == [(1, None, None, 1), (2, "s", "u", 1), (2, None, "u", 1)]


def test_drivers_compare_with_the_rest(spark):
    df = spark.createDataFrame(
        [("Canceled", 1, "x")] * 3 + [("Canceled", 9, "y")] + [("Not_Canceled", 9, "y")] * 4,
        "booking_status string, n int, c string",
    )
    out = ops.key_drivers(df, numeric=["n"], categorical=["c"], bins=2)
    got = {(r["factor"], r["factor_value"]): (r["n"], r["rate"], r["rest_rate"], r["lift"]) for r in out.collect()}
    assert got[("c", "x")] == (3, 1.0, 0.2, 5.0)
    assert sum(v[0] for k, v in got.items() if k[0] == "n") == 8


@pytest.mark.parametrize("accuracy,small", [(10, 20), (50, 5), (10_000, 100_000)])
def test_quantiles_are_exact(spark, accuracy, small):
    rng = random.Random(3)
    hot = [7.0 if rng.random() < 0.34 else rng.random() * 1e6 for _ in range(2000)]
    few = [float(rng.randint(0, 3)) for _ in range(2000)]
    df = spark.createDataFrame(list(zip(hot, few)) + [(None, None)] * 5, "hot double, few double")
    shares = [0.1, 0.25, 0.5, 0.9]
    got = exact_quantiles(df, ["hot", "few"], shares, accuracy, small)
    for name, values in (("hot", hot), ("few", few)):
        assert got[name] == [sorted(values)[math.ceil(round(p * 2000, 6)) - 1] for p in shares]
    assert exact_quantiles(df.limit(0), ["hot"], [0.5])["hot"] == [None]


def test_prediction_reports_over_repeated_bookings(spark):
    df = spark.createDataFrame(
        [("a", "Canceled", "Canceled", 10.0, 0.5), ("a", "Canceled", "Not_Canceled", 20.0, 0.25), ("b", None, None, 5.0, None)],
        "Booking_ID string, booking_status_pred_basic string, booking_status_pred_custom string, "
        "avg_price_per_room double, booking_status_proba_custom double",
    )
    assert rows(ops.prediction_cards(df)) == [(2, 1, 20.0, 10.0)]
    mix = {r[0]: r["bookings"] for r in ops.prediction_mix(df).collect()}
    assert mix == {"Canceled": 1, "Not_Canceled": 1, None: 1}
    scatter = ops.price_proba_scatter(df.withColumn("proba_other", 1 - F.col("booking_status_proba_custom")))
    assert rows(scatter, "Booking_ID", "proba", "price")[0] == ("a", 0.5, 10.0)


def test_reservation_day_feeds_the_hierarchy(facts):
    dated = cleaning.arrival_dates(facts.withColumns({"arrival_year": F.lit(2024), "arrival_month": F.lit(1)}))
    assert ops.date_hierarchy(dated).filter("level = 4").agg(F.sum("bookings")).first()[0] == 3


def test_long_paths_are_added_up_without_copies(spark, monkeypatch):
    rng = random.Random(3)
    path = [f"d{k}" for k in range(7)]
    data = [(f"b{rng.randrange(60)}" if rng.random() < 0.9 else None, *[rng.choice([None, 1, 2]) for _ in path]) for _ in range(150)]
    df = spark.createDataFrame(data, "Booking_ID string, " + ", ".join(f"{c} int" for c in path))
    out = ops.decompose(df, path)
    assert "Expand" not in out._jdf.queryExecution().optimizedPlan().toString()
    monkeypatch.setattr(ops, "LONG_PATH", 99)
    assert rows(out) == rows(ops.decompose(df, path))
    want = {}
    for key, *values in data:
        for depth in range(len(path) + 1):
            want.setdefault((depth, *values[:depth], *[None] * (len(path) - depth)), set()).add(key)
    assert rows(out) == sorted(((*k, len(v)) for k, v in want.items()), key=lambda r: tuple((v is None, str(v)) for v in r))
    assert rows(ops.decompose(df.limit(0), path)) in ([], [(0, *[None] * 7, 0)])


def test_deep_levels_of_long_paths_take_one_sort(spark, monkeypatch):
    path = [f"d{k}" for k in range(7)]
    data = [(f"b{k}", *[(k * (d + 3)) % 5 or None for d in range(7)]) for k in range(40)]
    out = ops.decompose(spark.createDataFrame(data, "Booking_ID string, " + ", ".join(f"{c} int" for c in path)), path)
    plan = out._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]
    # A scan for each level written would make eight; here two tables are read, one of them for the few levels above.
    assert plan.count("Sort [") == 1 and plan.count("hashpartitioning(d0") <= 3
    assert out.filter("level = 7").count() == len({r[1:] for r in data})
