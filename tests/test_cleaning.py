from __future__ import annotations

import datetime as dt
import math

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lodgeline.functions import columns as fn
from lodgeline.operators import calendar as cal
from lodgeline.operators import cleaning


@pytest.fixture
def sample(spark):
    return spark.createDataFrame(
        [
            ("ID1", 1, 2, 0, 2023, 5, 10, "Canceled", "Meal Plan 1", 10, 100.0, 1),
            ("ID2", 2, 3, 1, 2023, 5, 11, "Not_Canceled", "Meal Plan 2", 20, 150.0, 2),
        ],
        "Booking_ID string, no_of_weekend_nights int, no_of_week_nights int, no_of_children int, arrival_year int,"
        "arrival_month int, arrival_date int, booking_status string, type_of_meal_plan string, lead_time int,"
        "avg_price_per_room double, no_of_special_requests int",
    )


def test_clean_drops_unused_and_copies(sample):
    once = cleaning.clean(sample.unionAll(sample))
    assert "arrival_date" not in once.columns
    assert once.count() == 2
    assert rows(cleaning.clean(once)) == rows(once)
    assert cleaning.drop_unused(once).columns == once.columns


def test_project_names_missing_columns(sample):
    with pytest.raises(ValueError, match="no_of_adults"):
        cleaning.project(sample)


def test_nights_and_children(spark):
    df = spark.createDataFrame(
        [(1, 2, 0), (None, 2, None), (0, 0, 3)], "no_of_weekend_nights int, no_of_week_nights int, no_of_children int"
    )
    out = cleaning.has_children(cleaning.total_nights(df))
    assert rows(out, "total_nights", "has_children") == [(0, 1), (3, 0), (None, 0)]


def test_scaled_columns_have_mean_zero_and_unit_spread(sample):
    out = cleaning.standard_scale(cleaning.log1p_cols(cleaning.total_nights(sample)))
    got = out.agg(F.avg("lead_time").alias("m"), F.stddev_pop("avg_price_per_room").alias("s")).first()
    assert abs(got["m"]) < 1e-9 and abs(got["s"] - 1) < 1e-9
    assert out.columns == cleaning.total_nights(sample).columns


def test_scaling_a_constant_only_centres_it(spark):
    df = spark.createDataFrame([(5.0,), (5.0,)], "lead_time double")
    assert rows(cleaning.standard_scale(df)) == [(0.0,), (0.0,)]
    assert rows(cleaning.standard_scale(df.limit(0))) == []


def test_cast_align_rounds_half_to_even(spark):
    df = spark.createDataFrame([(0.5, "1.5"), (1.5, "x"), (2.4, None)], "lead_time double, avg_price_per_room string")
    out = cleaning.cast_align(df)
    assert rows(out) == [(0, 1.5), (2, None), (2, None)]
    assert [f.dataType.simpleString() for f in out.schema] == ["int", "double"]


def test_arrival_dates_of_impossible_months_are_null(spark):
    df = spark.createDataFrame(
        [(2024, 3, 1), (2024, 13, 1), (2024, 0, 5), (None, 2, 1), (2024, 1, None)],
        "arrival_year int, arrival_month int, lead_time int",
    )
    got = rows(cleaning.arrival_dates(df), "arrival_day", "reservation_day")
    assert got == [
        (dt.date(2024, 1, 1), None),
        (dt.date(2024, 3, 1), dt.date(2024, 2, 29)),
        (None, None),
        (None, None),
        (None, None),
    ]


def test_flags_treat_two_nulls_as_agreement(spark):
    df = spark.createDataFrame(
        [("Canceled", "Canceled", 0.25), ("Canceled", None, None), (None, None, 1.0)],
        "booking_status string, booking_status_pred_custom string, booking_status_proba_custom double",
    )
    got = rows(cleaning.prediction_flags(df), "good_prediction", "proba_other")
    assert got == [(0, None), (1, 0.0), (1, 0.75)]


def test_trailing_window_starts_at_midnight(spark):
    times = ["2024-01-01 00:00:00", "2023-12-31 23:59:59", "2024-01-08 12:00:00", "2024-01-08 12:00:01"]
    df = spark.createDataFrame([(t,) for t in times], "t string").select(F.col("t").cast("timestamp_ntz").alias("t"))
    out = cleaning.trailing(df, "t", fn.ntz("2024-01-08 12:00:00"))
    assert [str(r[0]) for r in rows(out)] == ["2024-01-01 00:00:00", "2024-01-08 12:00:00"]


def test_trailing_without_a_date_ends_now(spark):
    df = spark.range(1).select(F.current_timestamp().alias("t"))
    assert cleaning.trailing(df, "t").count() == 1
    assert cleaning.trailing(df.select((F.col("t") - F.expr("INTERVAL 9 DAYS")).alias("t")), "t").count() == 0


def test_trailing_filter_reaches_the_scan(spark, path):
    df = spark.range(3).select(F.expr("timestamp_ntz'2024-01-05 00:00:00'").alias("t"), "id")
    df.write.parquet(path)
    plan = cleaning.trailing(spark.read.parquet(path), "t", fn.ntz("2024-01-08 12:00:00"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(t" in text and "LessThanOrEqual(t" in text


def test_slice_ands_choices_and_ignores_empty_ones(sample):
    got = cleaning.slice_by(sample, {"arrival_year": [2023], "booking_status": ["Canceled"], "lead_time": []})
    assert rows(got, "Booking_ID") == [("ID1",)]


def test_drop_null_or_keep(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None)], "id int, prediction double")
    assert rows(cleaning.drop_null_or_keep(df, "prediction"), "id") == [(1,)]
    nothing = df.filter("id = 2")
    assert rows(cleaning.drop_null_or_keep(nothing, "prediction"), "id") == [(2,)]
    assert cleaning.drop_null_or_keep(df.limit(0), "prediction").count() == 0


def test_labels_have_opposite_codings(spark):
    df = spark.createDataFrame([("Canceled",), ("Not_Canceled",), ("other",), (None,)], "s string")
    out = df.select(
        "s",
        fn.encode_label("s", fn.CANCEL_FLAG).alias("flag"),
        fn.encode_label("s", fn.CLASS_INDEX).alias("index"),
        fn.outcome("s").alias("o"),
    )
    got = {r["s"]: (r["flag"], r["index"]) for r in out.collect()}
    assert got == {"Canceled": (1.0, 0), "Not_Canceled": (0.0, 1), "other": (None, None), None: (None, None)}
    back = df.select("s", fn.decode_label(fn.encode_label("s", fn.CLASS_INDEX), fn.CLASS_INDEX).alias("b"))
    assert {r["s"]: r["b"] for r in back.collect()}["Canceled"] == "Canceled"


def test_bins_and_text_numbers(spark):
    df = spark.createDataFrame([(0, "0.5"), (19, "1e-3"), (20, "n/a"), (None, None), (-1, "")], "l int, p string")
    got = rows(df.select(fn.bin_width("l").alias("b"), fn.parse_proba("p").alias("p")))
    assert got == [(-20, None), (0, 0.001), (0, 0.5), (20, None), (None, None)]


def test_epoch_and_iso_do_not_depend_on_the_zone(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-07-01 00:00:00.750000' AS t UNION ALL SELECT timestamp_ntz'1970-01-01'")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for name in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", name)
            got = rows(df.select(fn.epoch_ms(df, "t").alias("e"), fn.iso_text("t").alias("i")))
            assert got == [(0, "1970-01-01T00:00:00"), (1719792000000, "2024-07-01T00:00:00.750000")]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_hours_and_instants_survive_clock_changes(spark):
    gap, twice = "2024-03-10 02:30:00.25", "2024-11-03 01:30:00"
    df = spark.createDataFrame([(gap,), (twice,), ("2024-11-03 05:30:00",), ("2024-11-03 06:30:00",)], "s string")
    df = df.select(F.col("s").cast("timestamp_ntz").alias("t"))
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        hours = [str(r[0]) for r in rows(df.select(fn.bucket("t").alias("h")))]
        assert hours == [f"2024-{d}:00:00" for d in ("03-10 02", "11-03 01", "11-03 05", "11-03 06")]
        assert {str(r[0]) for r in rows(df.select(fn.bucket("t", "day")))} == {"2024-03-10 00:00:00", "2024-11-03 00:00:00"}
        back = df.select((fn.utc_wall(fn.utc_instant("t")) == F.col("t")).alias("same"), fn.epoch_ms(df, "t").alias("e"))
        assert {r["same"] for r in back.collect()} == {True} and back.select("e").distinct().count() == 4
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    with pytest.raises(ValueError, match="unit"):
        fn.bucket("t", "minute")


def test_value_frequencies_add_up(sample):
    out = cleaning.value_frequencies(sample, ["booking_status", "type_of_meal_plan"])
    totals = out.groupBy("feature").agg(F.sum("share").alias("s")).collect()
    assert all(math.isclose(r["s"], 1) for r in totals) and len(totals) == 2


def test_calendar_covers_whole_years(spark):
    df = spark.sql("SELECT date'2023-05-03' AS d UNION ALL SELECT date'2024-02-01'")
    days = cal.calendar(df, "d")
    assert days.count() == 365 + 366
    first = days.orderBy("date").first()
    assert (first["date"], first["quarter"], first["month"]) == (dt.date(2023, 1, 1), "Qtr 1", "January")
    assert cal.calendar(df.limit(0), "d").count() == 0
    daily = df.groupBy(F.col("d").alias("date")).agg(F.count("*").alias("n"))
    joined = cal.join_calendar(daily, "date", days, "n")
    assert joined.count() == days.count() and joined.agg(F.sum("n")).first()[0] == 2


def test_first_rows_in_order(spark):
    assert rows(cleaning.first_n(spark.range(100), 3, ["id"])) == [(0,), (1,), (2,)]
