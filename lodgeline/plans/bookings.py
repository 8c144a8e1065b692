"""Cleaning, derived columns, filters, calendar and feature tables over bookings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeline.functions import columns as fn
from lodgeline.operators import cleaning, features
from lodgeline.operators import calendar as cal
from lodgeline.operators.synth import check_generated, generate
from lodgeline.plans.registry import query
from lodgeline.plans.views import hash_of
from lodgeline.schemas import CAT_FEATURES, FEATURES, KEY, LOOKUP_FEATURES, TARGET
from lodgeline.sources.fixtures import Tables, latest

H = hash_of()
FEATURE_LIST = ", ".join(FEATURES)


@query("drop_unused", "SELECT * EXCLUDE (arrival_date) FROM bookings")
def drop_unused(t: Tables) -> DataFrame:
    return cleaning.drop_unused(t.bookings)


@query(
    "dedup_rows",
    """SELECT DISTINCT no_of_adults, no_of_children, type_of_meal_plan, room_type_reserved, booking_status
FROM bookings""",
)
def dedup_rows(t: Tables) -> DataFrame:
    few = ["no_of_adults", "no_of_children", "type_of_meal_plan", "room_type_reserved", "arrival_date", TARGET]
    return cleaning.clean(t.bookings.select(*few))


@query("project_features", f"SELECT {FEATURE_LIST}, booking_status FROM bookings")
def project_features(t: Tables) -> DataFrame:
    return cleaning.project(t.bookings)


@query(
    "derive_nights",
    """SELECT Booking_ID, no_of_weekend_nights + no_of_week_nights AS total_nights,
 CASE WHEN no_of_children > 0 THEN 1 ELSE 0 END AS has_children FROM bookings""",
)
def derive_nights(t: Tables) -> DataFrame:
    derived = cleaning.has_children(cleaning.total_nights(t.bookings))
    return derived.select(KEY, "total_nights", "has_children")


SCALED = ("lead_time", "avg_price_per_room", "total_nights", "no_of_special_requests")


@query(
    "log_scale",
    "WITH x AS (SELECT Booking_ID, ln(1 + lead_time) AS lead_time, ln(1 + avg_price_per_room) AS avg_price_per_room,"
    " no_of_weekend_nights + no_of_week_nights AS total_nights, no_of_special_requests FROM bookings),"
    f" s AS (SELECT {', '.join(f'avg({c}) AS m_{c}, stddev_pop({c}) AS d_{c}' for c in SCALED)} FROM x)"
    f" SELECT Booking_ID, {', '.join(f'round(({c} - m_{c}) / d_{c}, 6) AS {c}' for c in SCALED)} FROM x, s",
)
def log_scale(t: Tables) -> DataFrame:
    logged = cleaning.log1p_cols(cleaning.total_nights(t.bookings)).select(KEY, *SCALED)
    return cleaning.standard_scale(logged).select(KEY, *[F.round(c, 6).alias(c) for c in SCALED])


@query(
    "cast_align",
    """SELECT Booking_ID, CAST(round_even(lead_time + CAST(0.5 AS DOUBLE), 0) AS INT) AS lead_time,
 arrival_year, no_of_children, avg_price_per_room, booking_status FROM bookings""",
)
def cast_align(t: Tables) -> DataFrame:
    loose = t.bookings.select(
        KEY,
        (F.col("lead_time") + 0.5).alias("lead_time"),
        F.col("arrival_year").cast("string").alias("arrival_year"),
        F.col("no_of_children").cast("double").alias("no_of_children"),
        F.col("avg_price_per_room").cast("string").alias("avg_price_per_room"),
        TARGET,
    )
    return cleaning.cast_align(loose)


@query(
    "unscored_rows",
    f"SELECT Booking_ID, lead_time FROM bookings WHERE {H} < '4ccccccd'",
)
def unscored_rows(t: Tables) -> DataFrame:
    return cleaning.unscored(partly_scored(t), "booking_status_pred_custom").select(KEY, "lead_time")


def partly_scored(t: Tables) -> DataFrame:
    """Scored bookings of which three tenths lost their prediction."""
    lost = fn.key_hash(KEY) < fn.hash_share(0.3)
    names = ("booking_status_pred_custom", "booking_status_proba_custom")
    return t.predictions.withColumns({c: F.when(~lost, F.col(c)) for c in names})


@query(
    "last_7_days",
    """SELECT request_id, timestamp, prediction FROM inference_log
WHERE timestamp >= (SELECT CAST(CAST(max(ts) AS DATE) - 7 AS TIMESTAMP) FROM events)
 AND timestamp <= (SELECT max(ts) FROM events)""",
)
def last_7_days(t: Tables) -> DataFrame:
    recent = cleaning.trailing(t.log, "timestamp", latest(t.events, "ts"))
    return recent.select("request_id", "timestamp", "prediction")


@query(
    "slice_bookings",
    """SELECT Booking_ID, market_segment_type, arrival_year, booking_status FROM bookings
WHERE market_segment_type IN ('BUILDING', 'MACHINERY') AND arrival_year IN (1996, 1997)""",
)
def slice_bookings(t: Tables) -> DataFrame:
    chosen = {"market_segment_type": ["BUILDING", "MACHINERY"], "arrival_year": [1996, 1997], "booking_status": []}
    return cleaning.slice_by(t.bookings, chosen).select(KEY, "market_segment_type", "arrival_year", TARGET)


@query(
    "limit_n",
    "SELECT Booking_ID, lead_time FROM bookings ORDER BY lead_time DESC, Booking_ID LIMIT 10",
)
def limit_n(t: Tables) -> DataFrame:
    return cleaning.first_n(t.bookings.select(KEY, "lead_time"), 10, [F.col("lead_time").desc(), F.col(KEY)])


@query(
    "parse_proba",
    """SELECT Booking_ID, CASE WHEN arrival_date % 10 <> 0 THEN round(booking_status_proba_custom, 6) END AS proba
FROM predictions""",
)
def parse_proba(t: Tables) -> DataFrame:
    number = F.col("booking_status_proba_custom").cast("string")
    text = F.when(F.col("arrival_date") % 10 == 0, "n/a").otherwise(number)
    stored = t.predictions.select(KEY, text.alias("proba_text"))
    return stored.select(KEY, F.round(fn.parse_proba("proba_text"), 6).alias("proba"))


@query(
    "prediction_flags",
    """SELECT Booking_ID, CASE WHEN booking_status = booking_status_pred_custom THEN 1 ELSE 0 END AS good_prediction,
 round(proba_other, 6) AS proba_other FROM predictions""",
)
def prediction_flags(t: Tables) -> DataFrame:
    flagged = cleaning.prediction_flags(t.predictions)
    return flagged.select(KEY, "good_prediction", F.round("proba_other", 6).alias("proba_other"))


@query(
    "arrival_dates",
    """WITH d AS (SELECT Booking_ID, lead_time, CASE WHEN arrival_date = 31 THEN NULL
  ELSE make_date(arrival_year, arrival_month, 1) END AS arrival_day FROM bookings)
SELECT Booking_ID, arrival_day, CAST(arrival_day - lead_time AS DATE) AS reservation_day FROM d""",
)
def arrival_dates(t: Tables) -> DataFrame:
    # Month 13 does not exist, so these rows have no dates.
    month = F.when(F.col("arrival_date") == 31, 13).otherwise(F.col("arrival_month"))
    dated = cleaning.arrival_dates(t.bookings.withColumn("arrival_month", month))
    return dated.select(KEY, "arrival_day", "reservation_day")


@query(
    "encode_label",
    """SELECT Booking_ID, CAST(CASE booking_status WHEN 'Canceled' THEN 1 WHEN 'Not_Canceled' THEN 0 END AS DOUBLE)
  AS cancel_flag, CASE booking_status WHEN 'Canceled' THEN 0 WHEN 'Not_Canceled' THEN 1 END AS class_index,
 booking_status AS label, CASE WHEN booking_status = 'Not_Canceled' THEN 'Booking likely honored'
  ELSE 'Booking likely canceled' END AS outcome FROM bookings""",
)
def encode_label(t: Tables) -> DataFrame:
    return t.bookings.select(
        KEY,
        fn.encode_label(TARGET, fn.CANCEL_FLAG).alias("cancel_flag"),
        fn.encode_label(TARGET, fn.CLASS_INDEX).alias("class_index"),
        fn.decode_label(fn.encode_label(TARGET, fn.CLASS_INDEX), fn.CLASS_INDEX).alias("label"),
        fn.outcome(TARGET).alias("outcome"),
    )


@query(
    "drop_null_or_keep",
    "SELECT request_id, prediction FROM inference_log WHERE prediction IS NOT NULL",
)
def drop_null_or_keep(t: Tables) -> DataFrame:
    return cleaning.drop_null_or_keep(t.log, "prediction").select("request_id", "prediction")


@query(
    "category_freq",
    "WITH x AS ("
    + " UNION ALL ".join(f"SELECT '{c}' AS feature, {c} AS category FROM bookings" for c in CAT_FEATURES)
    + """), g AS (SELECT feature, category, count(*) AS n FROM x WHERE category IS NOT NULL GROUP BY 1, 2)
SELECT feature, category, n, round(n / sum(n) OVER (PARTITION BY feature), 6) AS share FROM g""",
)
def category_freq(t: Tables) -> DataFrame:
    return cleaning.value_frequencies(t.bookings, CAT_FEATURES).withColumn("share", F.round("share", 6))


# Calendar


@query(
    "calendar",
    """WITH b AS (SELECT make_date(min(year(update_timestamp_utc)), 1, 1) AS lo,
  make_date(max(year(update_timestamp_utc)), 12, 31) AS hi FROM bookings)
SELECT CAST(d AS DATE) AS date, CAST(year(d) AS INT) AS year, CAST(floor((month(d) + 2) / 3) AS INT) AS quarter_no,
 'Qtr ' || CAST(CAST(floor((month(d) + 2) / 3) AS INT) AS VARCHAR) AS quarter, CAST(month(d) AS INT) AS month_no,
 strftime(d, '%B') AS month, CAST(day(d) AS INT) AS day
FROM b, generate_series(b.lo, b.hi, INTERVAL 1 DAY) t(d)""",
)
def calendar(t: Tables) -> DataFrame:
    return cal.calendar(t.bookings, "update_timestamp_utc")


@query(
    "calendar_join",
    """WITH b AS (SELECT make_date(min(year(update_timestamp_utc)), 1, 1) AS lo,
  make_date(max(year(update_timestamp_utc)), 12, 31) AS hi FROM bookings),
c AS (SELECT CAST(update_timestamp_utc AS DATE) AS date, count(Booking_ID) AS bookings FROM bookings GROUP BY 1)
SELECT CAST(d AS DATE) AS date, CAST(month(d) AS INT) AS month_no, coalesce(c.bookings, 0) AS bookings
FROM b, generate_series(b.lo, b.hi, INTERVAL 1 DAY) t(d) LEFT JOIN c ON c.date = CAST(d AS DATE)""",
)
def calendar_join(t: Tables) -> DataFrame:
    daily = t.bookings.groupBy(F.to_date("update_timestamp_utc").alias("date")).agg(F.count(KEY).alias("bookings"))
    days = cal.calendar(daily, "date")
    return cal.join_calendar(daily, "date", days, "bookings").select("date", "month_no", "bookings")


# Feature table

TRAIN = f"(SELECT * FROM bookings WHERE {H} >= '33333333')"
TEST = f"(SELECT * FROM bookings WHERE {H} < '33333333')"


def sets(t: Tables) -> tuple[DataFrame, DataFrame]:
    return t.change(0.2, 1.0), t.change(0.0, 0.2)


def doubled_features(t: Tables) -> DataFrame:
    """Feature rows of all bookings, each key twice: an old row and the current one."""
    current = t.bookings.select(KEY, *LOOKUP_FEATURES, "update_timestamp_utc")
    old = current.withColumns(
        {
            "no_of_previous_cancellations": F.lit(-1),
            "update_timestamp_utc": F.col("update_timestamp_utc") - F.expr("INTERVAL 1 DAY"),
        }
    )
    return current.unionByName(old)


@query(
    "feature_table_build",
    "SELECT Booking_ID, no_of_previous_cancellations, no_of_previous_bookings_not_canceled FROM bookings",
)
def feature_table_build(t: Tables) -> DataFrame:
    return features.feature_table(*sets(t))


@query(
    "feature_high_water",
    f"""WITH tr AS {TRAIN}, te AS {TEST}
SELECT Booking_ID, no_of_previous_cancellations, no_of_previous_bookings_not_canceled FROM tr
WHERE update_timestamp_utc >= (SELECT max(update_timestamp_utc) FROM tr)
UNION ALL SELECT Booking_ID, no_of_previous_cancellations, no_of_previous_bookings_not_canceled FROM te
WHERE update_timestamp_utc >= (SELECT max(update_timestamp_utc) FROM te)""",
)
def feature_high_water(t: Tables) -> DataFrame:
    train, test = sets(t)
    fresh = features.newest(train).unionByName(features.newest(test))
    return fresh.select(KEY, *LOOKUP_FEATURES)


@query(
    "feature_refresh",
    f"""WITH tr AS {TRAIN}, te AS {TEST},
fresh AS (SELECT Booking_ID FROM tr WHERE update_timestamp_utc >= (SELECT max(update_timestamp_utc) FROM tr)
 UNION ALL SELECT Booking_ID FROM te WHERE update_timestamp_utc >= (SELECT max(update_timestamp_utc) FROM te))
SELECT b.Booking_ID, CASE WHEN f.Booking_ID IS NULL THEN -1 ELSE no_of_previous_cancellations END
 AS no_of_previous_cancellations, no_of_previous_bookings_not_canceled
FROM bookings b LEFT JOIN fresh f ON b.Booking_ID = f.Booking_ID""",
)
def feature_refresh(t: Tables) -> DataFrame:
    stale = t.bookings.select(KEY, F.lit(-1).alias(LOOKUP_FEATURES[0]), LOOKUP_FEATURES[1])
    return features.feature_refresh(stale, *sets(t))


@query(
    "feature_lookup",
    f"""SELECT Booking_ID, lead_time, CASE WHEN {H} < '80000000' THEN no_of_previous_cancellations END
 AS no_of_previous_cancellations, CASE WHEN {H} < '80000000' THEN no_of_previous_bookings_not_canceled END
 AS no_of_previous_bookings_not_canceled FROM bookings""",
)
def feature_lookup(t: Tables) -> DataFrame:
    known = t.change(0.0, 0.5, doubled_features(t))
    return features.feature_lookup(t.bookings.select(KEY, "lead_time"), known, order_by="update_timestamp_utc")


@query(
    "feature_training_set",
    f"""SELECT Booking_ID, {FEATURE_LIST}, no_of_weekend_nights + no_of_week_nights AS total_nights, booking_status
FROM bookings WHERE {H} >= '33333333'""",
)
def feature_training_set(t: Tables) -> DataFrame:
    train, test = sets(t)
    return features.training_set(train, features.feature_table(train, test))


@query(
    "udf_total_nights",
    "SELECT Booking_ID, no_of_weekend_nights + no_of_week_nights AS total_nights FROM bookings",
)
def udf_total_nights(t: Tables) -> DataFrame:
    name = features.register_total_nights(t.spark)
    bindings = {c: c for c in ("no_of_weekend_nights", "no_of_week_nights")}
    called = features.apply_function(t.bookings, name, features.TOTAL_NIGHTS, bindings)
    return called.select(KEY, "total_nights")


# Synthetic bookings


def synthetic(t: Tables, drift: bool) -> DataFrame:
    """As many synthetic bookings as there are bookings."""
    return generate(t.bookings, t.bookings.count(), drift=drift, base_ms=1_700_000_000_000, year=2024)


@query("synth_base")
def synth_base(t: Tables) -> DataFrame:
    return synthetic(t, False)


@query("synth_drift")
def synth_drift(t: Tables) -> DataFrame:
    return synthetic(t, True)


@query(
    "synth_schema_check",
    """SELECT count(*) AS n_rows, count(*) AS n_ids, TRUE AS non_negative, TRUE AS known_categories FROM bookings""",
)
def synth_schema_check(t: Tables) -> DataFrame:
    return check_generated(synthetic(t, False), t.bookings, [*CAT_FEATURES, TARGET])


@query(
    "synth_drift_check",
    "SELECT TRUE AS prices_double, TRUE AS years_are_recent, CAST(count(*) AS BIGINT) AS n_rows FROM bookings",
)
def synth_drift_check(t: Tables) -> DataFrame:
    """Under drift the mean price doubles and years lie in the last three."""
    base = synthetic(t, False).agg(F.avg("avg_price_per_room").alias("price"))
    drifted = synthetic(t, True).agg(
        F.count("*").alias("n_rows"),
        F.avg("avg_price_per_room").alias("doubled"),
        F.bool_and(F.col("arrival_year").between(2022, 2024)).alias("years_are_recent"),
    )
    doubles = F.abs(F.col("doubled") / F.col("price") - 2) < 1e-6
    return drifted.crossJoin(F.broadcast(base)).select(doubles.alias("prices_double"), "years_are_recent", "n_rows")
