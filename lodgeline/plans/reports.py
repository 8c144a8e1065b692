"""KPI measures and report queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeline.operators import cleaning, kpi
from lodgeline.operators import reports as ops
from lodgeline.plans.registry import query
from lodgeline.schemas import CAT_FEATURES, NUM_FEATURES, TARGET
from lodgeline.sources.fixtures import Tables

MONEY = ("revenue_estimated", "revenue_not_canceled", "revenue_canceled")
MEANS = ("avg_lead_time", "avg_lead_time_canceled", "pct_canceled")


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns if c in df.columns})


def measured(df: DataFrame) -> DataFrame:
    return rounded(df, 6, *MONEY, *MEANS)


# KPI measures


def kpi_sql(visible: str, source: str, by: str = "") -> str:
    """All measures; `visible` is the status condition, which the fixed measures ignore."""
    pick = f"{by}, " if by else ""
    group = f" GROUP BY {by}" if by else ""
    return f"""SELECT {pick}count(DISTINCT CASE WHEN {visible} THEN Booking_ID END) AS nb_bookings,
 round(sum(CASE WHEN {visible} THEN avg_price_per_room END), 6) AS revenue_estimated,
 round(avg(CASE WHEN {visible} THEN lead_time END), 6) AS avg_lead_time,
 count(DISTINCT CASE WHEN booking_status = 'Canceled' THEN Booking_ID END) AS nb_bookings_canceled,
 round(sum(CASE WHEN booking_status = 'Not_Canceled' THEN avg_price_per_room END), 6) AS revenue_not_canceled,
 round(sum(CASE WHEN booking_status = 'Canceled' THEN avg_price_per_room END), 6) AS revenue_canceled,
 round(avg(CASE WHEN booking_status = 'Canceled' THEN lead_time END), 6) AS avg_lead_time_canceled,
 round(CAST(CASE
  WHEN min(CASE WHEN {visible} THEN booking_status END) = max(CASE WHEN {visible} THEN booking_status END)
  THEN CASE WHEN min(CASE WHEN {visible} THEN booking_status END) = 'Canceled' THEN 1 ELSE 0 END
  ELSE count(DISTINCT CASE WHEN booking_status = 'Canceled' THEN Booking_ID END) / count(DISTINCT Booking_ID)
  END AS DOUBLE), 6) AS pct_canceled
FROM {source}{group}"""


@query("kpi_summary", kpi_sql("TRUE", "bookings WHERE market_segment_type IN ('BUILDING', 'MACHINERY')"))
def kpi_summary(t: Tables) -> DataFrame:
    return measured(kpi.measures(t.bookings, filters={"market_segment_type": ["BUILDING", "MACHINERY"]}))


@query("kpi_by_segment", kpi_sql("TRUE", "bookings", "market_segment_type"))
def kpi_by_segment(t: Tables) -> DataFrame:
    return measured(kpi.measures(t.bookings, by=["market_segment_type"]))


@query(
    "kpi_filter_override",
    kpi_sql("booking_status = 'Not_Canceled'", "bookings WHERE arrival_year IN (1996, 1997)", "arrival_year"),
)
def kpi_filter_override(t: Tables) -> DataFrame:
    chosen = {"booking_status": ["Not_Canceled"], "arrival_year": [1996, 1997]}
    return measured(kpi.measures(t.bookings, by=["arrival_year"], filters=chosen))


@query(
    "pct_canceled_by_status",
    """WITH r AS (SELECT market_segment_type, count(DISTINCT CASE WHEN booking_status = 'Canceled' THEN Booking_ID END)
  AS canceled, count(DISTINCT Booking_ID) AS total FROM bookings GROUP BY 1)
SELECT b.market_segment_type, booking_status, count(DISTINCT Booking_ID) AS nb_bookings,
 max(canceled) AS nb_bookings_canceled,
 CAST(CASE booking_status WHEN 'Canceled' THEN 1 ELSE 0 END AS DOUBLE) AS pct_canceled
FROM bookings b JOIN r ON b.market_segment_type = r.market_segment_type GROUP BY 1, 2
UNION ALL SELECT market_segment_type, NULL, total, canceled, round(canceled / total, 6) FROM r""",
)
def pct_canceled_by_status(t: Tables) -> DataFrame:
    names = ["nb_bookings", "nb_bookings_canceled", "pct_canceled"]
    cells = kpi.measures(t.bookings, names, by=["market_segment_type", TARGET])
    total = kpi.measures(t.bookings, names, by=["market_segment_type"])
    return measured(cells.unionByName(total.withColumn(TARGET, F.lit(None).cast("string"))))


# Bookings by axis, status, date and lead time

AXIS_SQL = " UNION ALL ".join(
    f"SELECT '{axis}' AS axis, CAST({expr} AS VARCHAR) AS axis_value, Booking_ID FROM bookings"
    for axis, expr in ((a, "CAST(floor(lead_time / 20) * 20 AS INT)" if a == "lead_time_bin" else a) for a in ops.AXES)
)


@query("bookings_by_axis", f"SELECT axis, axis_value, count(Booking_ID) AS bookings FROM ({AXIS_SQL}) x GROUP BY 1, 2")
def bookings_by_axis(t: Tables) -> DataFrame:
    return ops.all_axes(t.bookings)


@query(
    "bookings_by_segment",
    "SELECT market_segment_type AS axis_value, count(Booking_ID) AS bookings FROM bookings GROUP BY 1",
)
def bookings_by_segment(t: Tables) -> DataFrame:
    return ops.by_axis(t.bookings, "market_segment_type")


@query(
    "status_share",
    """SELECT booking_status, bookings, round(bookings / sum(bookings) OVER (), 6) AS share
FROM (SELECT booking_status, count(Booking_ID) AS bookings FROM bookings GROUP BY 1) g""",
)
def status_share(t: Tables) -> DataFrame:
    return rounded(ops.status_share(t.bookings), 6, "share")


HIERARCHY = """SELECT CAST(4 - (GROUPING(year) + GROUPING(quarter) + GROUPING(month) + GROUPING(day)) AS INT) AS level,
 year, quarter, month, day, booking_status, count(Booking_ID) AS bookings
FROM (SELECT Booking_ID, booking_status, CAST(year(d) AS INT) AS year, CAST(quarter(d) AS INT) AS quarter,
  CAST(month(d) AS INT) AS month, CAST(day(d) AS INT) AS day
 FROM (SELECT *, make_date(arrival_year, arrival_month, 1) - lead_time AS d FROM bookings) a) b
GROUP BY GROUPING SETS ((year, booking_status), (year, quarter, booking_status),
 (year, quarter, month, booking_status), (year, quarter, month, day, booking_status))"""


@query("bookings_by_date_hierarchy", HIERARCHY)
def bookings_by_date_hierarchy(t: Tables) -> DataFrame:
    return ops.date_hierarchy(cleaning.arrival_dates(t.bookings))


@query(
    "date_hierarchy_share",
    f"""SELECT *, round(bookings / sum(bookings) OVER (PARTITION BY level, year, quarter, month, day), 6) AS share
FROM ({HIERARCHY}) h""",
)
def date_hierarchy_share(t: Tables) -> DataFrame:
    return rounded(ops.date_hierarchy_share(cleaning.arrival_dates(t.bookings)), 6, "share")


BINS = """SELECT CAST(floor(lead_time / 20) * 20 AS INT) AS lead_time_bin, booking_status, count(Booking_ID) AS bookings
FROM bookings GROUP BY 1, 2"""


@query("lead_time_bins", BINS)
def lead_time_bins(t: Tables) -> DataFrame:
    return ops.lead_time_bins(t.bookings)


@query(
    "lead_time_share",
    f"SELECT *, round(bookings / sum(bookings) OVER (PARTITION BY lead_time_bin), 6) AS share FROM ({BINS}) b",
)
def lead_time_share(t: Tables) -> DataFrame:
    return rounded(ops.lead_time_share(t.bookings), 6, "share")


# Drivers and decomposition


def drivers_sql() -> str:
    def edge(c: str, i: int) -> str:
        # The least value with at least this share of the values at or below it.
        return f"(SELECT min(v) FROM ranked_{c} WHERE r >= {i} / 4.0 * n)"

    ranked, long = [], []
    for c in NUM_FEATURES:
        ranked.append(
            f"ranked_{c} AS (SELECT {c} AS v, row_number() OVER (ORDER BY {c}) AS r, count(*) OVER () AS n FROM bookings)"
        )
        bins = " + ".join(f"CASE WHEN {c} > {edge(c, i)} THEN 1 ELSE 0 END" for i in (1, 2, 3))
        long.append(f"SELECT hit, '{c}' AS factor, 'Q' || CAST(1 + {bins} AS VARCHAR) AS factor_value FROM b")
    long += [f"SELECT hit, '{c}' AS factor, {c} AS factor_value FROM b" for c in CAT_FEATURES]
    return f"""WITH b AS (SELECT *, CASE WHEN booking_status = 'Canceled' THEN 1 ELSE 0 END AS hit FROM bookings),
{", ".join(ranked)}, l AS ({" UNION ALL ".join(long)}),
g AS (SELECT factor, factor_value, count(*) AS n, sum(hit) AS h FROM l GROUP BY 1, 2),
w AS (SELECT *, sum(n) OVER (PARTITION BY factor) - n AS rest, sum(h) OVER (PARTITION BY factor) - h AS rest_h FROM g)
SELECT factor, factor_value, n, round(h / n, 6) AS rate,
 round(CASE WHEN rest > 0 THEN rest_h / rest END, 6) AS rest_rate,
 round((h / n) / nullif(CASE WHEN rest > 0 THEN rest_h / rest END, 0), 6) AS lift FROM w"""


@query("key_drivers", drivers_sql())
def key_drivers(t: Tables) -> DataFrame:
    return rounded(ops.key_drivers(t.bookings), 6, "rate", "rest_rate", "lift")


PATH = ("booking_status", "market_segment_type", "arrival_year", "room_type_reserved")
TREE = f"""SELECT CAST(4 - ({" + ".join(f"GROUPING({c})" for c in PATH)}) AS INT) AS level, {", ".join(PATH)},
 count(DISTINCT Booking_ID) AS bookings FROM bookings GROUP BY ROLLUP ({", ".join(PATH)})"""


@query("decomposition", TREE)
def decomposition(t: Tables) -> DataFrame:
    return ops.decompose(t.bookings, PATH)


@query(
    "decomposition_topk",
    f"""SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY level,
  {", ".join(f"CASE WHEN level > {i + 1} THEN {c} END" for i, c in enumerate(PATH[:-1]))}
  ORDER BY bookings DESC, {", ".join(f"{c} NULLS FIRST" for c in PATH)}) AS INT) AS rank
 FROM ({TREE}) t WHERE level > 0) r WHERE rank <= 4""",
)
def decomposition_topk(t: Tables) -> DataFrame:
    return ops.decompose_topk(t.bookings, PATH)


# The path of the report: all features with the lead time in bins, then the outcome.
LONG_PATH = (
    "booking_status", "market_segment_type", "room_type_reserved", "type_of_meal_plan", "arrival_year", "arrival_month",
    "arrival_date", "lead_time_bin", "no_of_adults", "no_of_children", "no_of_weekend_nights", "no_of_week_nights",
    "no_of_special_requests", "no_of_previous_cancellations", "no_of_previous_bookings_not_canceled", "repeated_guest",
    "required_car_parking_space",
)
LONG_TREE = f"""SELECT CAST({len(LONG_PATH)} - ({" + ".join(f"grouping({c})" for c in LONG_PATH)}) AS INT) AS level,
 {", ".join(LONG_PATH)}, count(DISTINCT Booking_ID) AS bookings
FROM (SELECT *, CAST(floor(lead_time / 20) * 20 AS INT) AS lead_time_bin FROM bookings) b GROUP BY ROLLUP ({", ".join(LONG_PATH)})"""


@query("decomposition_all_dimensions", LONG_TREE)
def decomposition_all_dimensions(t: Tables) -> DataFrame:
    bins = (F.floor(F.col("lead_time") / 20) * 20).cast("int")
    return ops.decompose(t.bookings.withColumn("lead_time_bin", bins), LONG_PATH)


# Prediction reports


def flagged(t: Tables) -> DataFrame:
    return cleaning.prediction_flags(t.predictions)


@query(
    "prediction_cards",
    """SELECT count(DISTINCT Booking_ID) AS scored_bookings,
 count(DISTINCT CASE WHEN booking_status_pred_basic = 'Canceled' THEN Booking_ID END) AS predicted_canceled,
 round(sum(CASE WHEN booking_status_pred_custom = 'Not_Canceled' THEN avg_price_per_room END), 6) AS revenue_kept,
 round(sum(CASE WHEN booking_status_pred_custom = 'Canceled' THEN avg_price_per_room END), 6) AS revenue_lost
FROM predictions""",
)
def prediction_cards(t: Tables) -> DataFrame:
    return rounded(ops.prediction_cards(t.predictions), 6, "revenue_kept", "revenue_lost")


@query(
    "prediction_mix",
    """SELECT booking_status_pred_custom, bookings, round(bookings / sum(bookings) OVER (), 6) AS share
FROM (SELECT booking_status_pred_custom, count(Booking_ID) AS bookings FROM predictions GROUP BY 1) g""",
)
def prediction_mix(t: Tables) -> DataFrame:
    return rounded(ops.prediction_mix(t.predictions), 6, "share")


@query(
    "prediction_matrix",
    """SELECT CAST(2 - GROUPING(booking_status_pred_custom) - GROUPING(market_segment_type) AS INT) AS level,
 booking_status_pred_custom, market_segment_type, count(DISTINCT Booking_ID) AS bookings,
 round(avg(proba_other), 6) AS avg_proba
FROM predictions GROUP BY ROLLUP (booking_status_pred_custom, market_segment_type)""",
)
def prediction_matrix(t: Tables) -> DataFrame:
    cells = ops.matrix(flagged(t), "booking_status_pred_custom", "market_segment_type", "proba_other")
    return rounded(cells, 6, "avg_proba")


@query(
    "price_proba_scatter",
    """SELECT Booking_ID, booking_status_pred_custom, round(avg(proba_other), 6) AS proba,
 round(sum(avg_price_per_room), 6) AS price FROM predictions GROUP BY 1, 2""",
)
def price_proba_scatter(t: Tables) -> DataFrame:
    return rounded(ops.price_proba_scatter(flagged(t)), 6, "proba", "price")


DETAIL_SUMS = [c for c in NUM_FEATURES if c not in ("arrival_month", "arrival_year", "avg_price_per_room")]


@query(
    "booking_details",
    f"""SELECT Booking_ID, booking_status_pred_custom, market_segment_type, room_type_reserved, type_of_meal_plan,
 round(avg(proba_other), 6) AS proba, {", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in DETAIL_SUMS)}
FROM predictions GROUP BY 1, 2, 3, 4, 5""",
)
def booking_details(t: Tables) -> DataFrame:
    return rounded(ops.booking_details(flagged(t)), 6, "proba")


@query(
    "confusion_matrix",
    """SELECT booking_status,
 count(DISTINCT CASE WHEN booking_status_pred_custom = 'Canceled' THEN Booking_ID END) AS Canceled,
 count(DISTINCT CASE WHEN booking_status_pred_custom = 'Not_Canceled' THEN Booking_ID END) AS Not_Canceled
FROM predictions GROUP BY 1""",
)
def confusion_matrix(t: Tables) -> DataFrame:
    return ops.confusion_matrix(t.predictions)


GOOD = "CASE WHEN booking_status = booking_status_pred_custom THEN 1 ELSE 0 END"


@query(
    "accuracy_over_time",
    f"""SELECT update_timestamp_utc, CAST(sum({GOOD}) AS BIGINT) AS good_predictions, count(Booking_ID) AS predictions,
 round(sum({GOOD}) / count(Booking_ID), 6) AS accuracy FROM predictions GROUP BY 1""",
)
def accuracy_over_time(t: Tables) -> DataFrame:
    return rounded(ops.accuracy_by(flagged(t), ["update_timestamp_utc"]), 6, "accuracy")


@query(
    "accuracy_card",
    f"""SELECT CAST(sum({GOOD}) AS BIGINT) AS nb_good_prediction, round(sum({GOOD}) / count(Booking_ID), 6) AS accuracy
FROM predictions""",
)
def accuracy_card(t: Tables) -> DataFrame:
    return rounded(kpi.good_predictions(flagged(t)), 6, "accuracy")


@query(
    "predictions_by_segment",
    f"""SELECT market_segment_type, CAST(sum({GOOD}) AS BIGINT) AS good_predictions, count(Booking_ID) AS predictions,
 round(sum({GOOD}) / count(Booking_ID), 6) AS accuracy FROM predictions GROUP BY 1""",
)
def predictions_by_segment(t: Tables) -> DataFrame:
    return rounded(ops.accuracy_by(flagged(t), ["market_segment_type"]), 6, "accuracy")


@query("last_update", "SELECT max(update_timestamp_utc) AS last_update FROM bookings")
def last_update(t: Tables) -> DataFrame:
    return ops.last_update(t.bookings)


