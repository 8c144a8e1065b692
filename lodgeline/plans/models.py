"""Splitting, training, scoring, evaluation and bookkeeping of the classifier."""

from __future__ import annotations

from functools import partial, reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgeline.functions.columns import key_hash, ntz
from lodgeline.operators import draws, tracking
from lodgeline.operators import models as ops
from lodgeline.plans.bookings import partly_scored
from lodgeline.plans.registry import query
from lodgeline.plans.views import hash_of
from lodgeline.schemas import BOOKING, CAT_FEATURES, FEATURES, KEY, TARGET
from lodgeline.scratch import scratch_path
from lodgeline.sources.fixtures import INTERCEPT, LINEAR, Tables, registry
from lodgeline.sources.storage import read_table, write_table

H = hash_of()


@query(
    "split_train_test",
    f"SELECT Booking_ID, CASE WHEN {H} < '33333333' THEN 'test' ELSE 'train' END AS split FROM bookings",
)
def split_train_test(t: Tables) -> DataFrame:
    return ops.with_split(t.bookings).select(KEY, "split")


@query(
    "split_exact",
    f"""SELECT Booking_ID, CASE WHEN row_number() OVER (ORDER BY {H}, Booking_ID) <= 500 THEN 'test' ELSE 'train' END
 AS split FROM bookings""",
)
def split_exact(t: Tables) -> DataFrame:
    train, test = draws.split_exact(t.bookings.select(KEY), 500)
    return train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))


LEVELS = {
    "market_segment_type": ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"),
    "room_type_reserved": tuple(f"Room_Type {i}" for i in range(1, 6)),
    "type_of_meal_plan": tuple(f"Meal Plan {i}" for i in range(1, 4)),
}
ONE_HOT = ", ".join(
    f"""CASE WHEN {c} = '{v}' THEN 1 ELSE 0 END AS "{c}={v}\"""" for c, levels in LEVELS.items() for v in levels
)


@query("one_hot", f"SELECT Booking_ID, {ONE_HOT} FROM bookings")
def one_hot(t: Tables) -> DataFrame:
    return ops.one_hot(t.bookings.select(KEY, *CAT_FEATURES), CAT_FEATURES).drop(*CAT_FEATURES)


def training_rows(t: Tables) -> tuple[DataFrame, DataFrame]:
    return ops.split(t.bookings.select(KEY, *FEATURES, TARGET))


@query("train_lr")
def train_lr(t: Tables) -> DataFrame:
    train, _ = training_rows(t)
    model = ops.fit_lr(train)
    return t.spark.createDataFrame(ops.coefficients(model), "feature string, coefficient double")


@query("score_batch")
def score_batch(t: Tables) -> DataFrame:
    train, test = training_rows(t)
    return ops.score(ops.fit_lr(train), test).select(KEY, "prediction", "label", "probability")


SCORES = """SELECT Booking_ID, CASE WHEN booking_status_pred_custom = 'Not_Canceled' THEN 1 ELSE 0 END AS prediction,
 booking_status_pred_custom AS label, round(booking_status_proba_custom, 6) AS probability FROM predictions"""


@query("score_linear", SCORES)
def score_linear(t: Tables) -> DataFrame:
    scored = ops.score_linear(t.bookings, LINEAR, INTERCEPT)
    return scored.select(KEY, "prediction", "label", F.round("probability", 6).alias("probability"))


@query("score_map_in_pandas", SCORES)
def score_map_in_pandas(t: Tables) -> DataFrame:
    scored = ops.score_map_in_pandas(t.bookings, LINEAR, INTERCEPT)
    return scored.withColumn("probability", F.round("probability", 6))


@query(
    "score_incremental",
    """SELECT Booking_ID, booking_status_pred_custom, round(booking_status_proba_custom, 6)
 AS booking_status_proba_custom FROM predictions""",
)
def score_incremental(t: Tables) -> DataFrame:
    scorer = partial(ops.score_linear, coefficients=LINEAR, intercept=INTERCEPT)
    names = ("booking_status_pred_custom", "booking_status_proba_custom")
    scored = ops.score_incremental(partly_scored(t), scorer, *names)
    return scored.select(KEY, names[0], F.round(names[1], 6).alias(names[1]))


def metrics_sql(prediction: str) -> str:
    return f"""(WITH lab AS (SELECT DISTINCT booking_status AS l FROM predictions
  UNION SELECT DISTINCT {prediction} FROM predictions),
 c AS (SELECT l, CAST(sum(CASE WHEN booking_status = l AND {prediction} = l THEN 1 ELSE 0 END) AS DOUBLE) AS tp,
   CAST(sum(CASE WHEN booking_status <> l AND {prediction} = l THEN 1 ELSE 0 END) AS DOUBLE) AS fp,
   CAST(sum(CASE WHEN booking_status = l AND {prediction} <> l THEN 1 ELSE 0 END) AS DOUBLE) AS fn
  FROM predictions CROSS JOIN lab GROUP BY l),
 m AS (SELECT tp, tp + fn AS sup, CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS pr,
   CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END AS rc FROM c)
 SELECT sum(tp) / sum(sup) AS accuracy, sum(sup * pr) / sum(sup) AS precision, sum(sup * rc) / sum(sup) AS recall,
  sum(sup * CASE WHEN pr + rc = 0 THEN 0 ELSE 2 * pr * rc / (pr + rc) END) / sum(sup) AS f1_score FROM m)"""


METRICS = ("accuracy", "precision", "recall", "f1_score")


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


@query(
    "weighted_metrics",
    f"SELECT {', '.join(f'round({m}, 6) AS {m}' for m in METRICS)} FROM {metrics_sql('booking_status_pred_custom')} x",
)
def weighted_metrics(t: Tables) -> DataFrame:
    return rounded(ops.weighted_metrics(t.predictions, TARGET, "booking_status_pred_custom"), *METRICS)


@query(
    "champion_gate",
    f"""SELECT round(a.f1_score, 6) AS f1_challenger, round(b.f1_score, 6) AS f1_champion,
 a.f1_score >= b.f1_score AS register
FROM {metrics_sql('booking_status_pred_custom')} a, {metrics_sql('booking_status_pred_basic')} b""",
)
def champion_gate(t: Tables) -> DataFrame:
    gate = ops.champion_gate(t.predictions, TARGET, "booking_status_pred_custom", "booking_status_pred_basic")
    return rounded(gate, "f1_challenger", "f1_champion")


@query(
    "registry_latest",
    """SELECT model_name, coalesce(a, r) AS version, CASE WHEN a IS NOT NULL THEN 'alias' ELSE 'ready' END AS found_by
FROM (SELECT model_name, max(CASE WHEN alias = 'latest-model' THEN version END) AS a,
  max(CASE WHEN status = 'READY' THEN version END) AS r FROM registry GROUP BY 1) g
WHERE coalesce(a, r) IS NOT NULL""",
)
def registry_latest(t: Tables) -> DataFrame:
    return ops.registry_latest(registry(t.raw("part")))


@query("run_log")
def run_log(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "runs")
    params = {"C": "1.0", "max_iter": "1000", "solver": "lbfgs"}
    version = tracking.input_version(t.predictions)
    for run_id, model in (("run-1", "booking_status_pred_basic"), ("run-2", "booking_status_pred_custom")):
        metrics = ops.weighted_metrics(t.predictions, TARGET, model)
        row = ops.run_log(metrics, run_id, params, "bookings", ntz("2024-01-31 00:00:00"), version)
        write_table(row, path, "append")
    return read_table(t.spark, path)


@query(
    "schema_check",
    """SELECT 'lead_time' AS "column", 'int' AS expected, 'string' AS actual,
 CAST(sum(CASE WHEN arrival_date = 31 THEN 1 ELSE 0 END) AS BIGINT) AS bad_rows FROM bookings
UNION ALL SELECT 'avg_price_per_room', 'double', 'string', 0
UNION ALL SELECT 'booking_status', 'string', NULL, count(*) FROM bookings""",
)
def schema_check(t: Tables) -> DataFrame:
    wrong = F.when(F.col("arrival_date") == 31, "?").otherwise(F.col("lead_time").cast("string"))
    loose = t.bookings.drop(TARGET).withColumns(
        {"lead_time": wrong, "avg_price_per_room": F.col("avg_price_per_room").cast("string")}
    )
    return ops.check_schema(loose, BOOKING)


@query("sample_with_replacement")
def sample_with_replacement(t: Tables) -> DataFrame:
    return draws.sample_n(t.bookings.select(*FEATURES), 100)


# Properties of what SQL cannot compute


@query(
    "score_batch_check",
    f"""SELECT count(*) AS n_rows, count(*) FILTER (arrival_date <> 31) AS n_answered, TRUE AS in_range, TRUE AS labels_agree
FROM bookings WHERE {H} < '33333333'""",
)
def score_batch_check(t: Tables) -> DataFrame:
    """Every test row comes back; those with a missing number without an answer."""
    train, test = ops.split(t.bookings.select(KEY, "arrival_date", *[c for c in FEATURES if c != "arrival_date"], TARGET))
    holes = test.withColumn("lead_time", F.when(F.col("arrival_date") != 31, F.col("lead_time")))
    scored = ops.score(ops.fit_lr(train), holes)
    return scored.agg(
        F.count("*").alias("n_rows"),
        F.count("label").alias("n_answered"),
        F.bool_and(F.col("probability").between(0, 1)).alias("in_range"),
        F.bool_and((F.col("probability") >= 0.5) == (F.col("label") == "Not_Canceled")).alias("labels_agree"),
    )


@query(
    "train_lr_check",
    f"""SELECT 1 + {sum(len(x) for x in LEVELS.values())} + 13 AS n_coefficients, count(*) AS n_rows, TRUE AS balanced
FROM bookings WHERE {H} >= '33333333'""",
)
def train_lr_check(t: Tables) -> DataFrame:
    """A free intercept is best only if the fitted mean is the observed one."""
    train, _ = training_rows(t)
    model = ops.fit_lr(train)
    gap = F.avg("probability") - F.avg((F.col(TARGET) == "Not_Canceled").cast("double"))
    return ops.score(model, train).agg(
        F.lit(len(ops.coefficients(model))).alias("n_coefficients"),
        F.count("*").alias("n_rows"),
        (F.abs(gap) < 1e-3).alias("balanced"),
    )


@query(
    "run_log_values",
    f"""WITH m AS (SELECT 'run-1' AS run_id, * FROM {metrics_sql('booking_status_pred_basic')} a
 UNION ALL SELECT 'run-2', * FROM {metrics_sql('booking_status_pred_custom')} b)
SELECT run_id, name, CAST(round(value, 6) AS VARCHAR) AS value
FROM (UNPIVOT m ON accuracy, "precision", recall, f1_score INTO NAME name VALUE value)
UNION ALL SELECT r, p, v FROM (VALUES ('run-1'), ('run-2')) runs(r),
 (VALUES ('C', '1.0'), ('max_iter', '1000'), ('solver', 'lbfgs')) params(p, v) WHERE (SELECT count(*) FROM predictions) > 0""",
)
def run_log_values(t: Tables) -> DataFrame:
    """The run log, a row for each parameter and metric."""
    log = run_log(t)
    metrics = log.select("run_id", F.explode("metrics").alias("name", "value"))
    params = log.select("run_id", F.explode("params").alias("name", "value"))
    return metrics.withColumn("value", F.round("value", 6).cast("string")).unionByName(params)


@query(
    "sample_check",
    "SELECT CAST(100 AS BIGINT) AS n_rows, TRUE AS from_source FROM (SELECT count(*) AS n FROM bookings) b WHERE n > 0",
)
def sample_check(t: Tables) -> DataFrame:
    drawn = draws.sample_n(t.bookings.select(KEY), 100)
    known = t.bookings.select(F.col(KEY).alias("known"))
    joined = drawn.join(known, F.col(KEY) == F.col("known"), "left")
    return joined.agg(F.count("*").alias("n_rows"), F.bool_and(F.col("known").isNotNull()).alias("from_source"))


# Draws, tracking and any model


@query(
    "split_exact_many",
    f"""SELECT split, count(*) AS n, min({H}) AS least_hash, max({H}) AS greatest_hash FROM (
 SELECT Booking_ID, CASE WHEN row_number() OVER (ORDER BY {H}, Booking_ID) <= 7777 THEN 'test' ELSE 'train' END AS split
 FROM bookings) s GROUP BY split""",
)
def split_exact_many(t: Tables) -> DataFrame:
    """Half of the bookings or more as test rows: the bound is found by counting, the parts are filters."""
    train, test = draws.split_exact(t.bookings.select(KEY), 7777)
    both = train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
    h = key_hash(KEY)
    return both.groupBy("split").agg(F.count("*").alias("n"), F.min(h).alias("least_hash"), F.max(h).alias("greatest_hash"))


@query(
    "sample_beyond_rows",
    """SELECT n_asked, CAST(n_asked AS BIGINT) AS n_rows, TRUE AS from_source
FROM (VALUES (1), (40000)) v(n_asked) WHERE (SELECT count(*) FROM bookings) > 0""",
)
def sample_beyond_rows(t: Tables) -> DataFrame:
    """One row, and more rows than there are, drawn with replacement."""
    parts = []
    for n in (1, 40_000):
        drawn = draws.sample_n(t.bookings.select(KEY), n, seed=n)
        known = t.bookings.select(F.col(KEY).alias("known"))
        joined = drawn.join(known, F.col(KEY) == F.col("known"), "left")
        parts.append(joined.agg(F.lit(n).alias("n_asked"), F.count("*").alias("n_rows"), F.bool_and(F.col("known").isNotNull()).alias("from_source")))
    return parts[0].unionByName(parts[1])


# Weights of a network of two hidden units over three features.
HIDDEN = ((0.2, -0.01, 0.4, 0.002), (-0.5, 0.006, -0.2, 0.004))
OUTPUT = (0.3, 1.2, -0.9)


def network(weights: tuple, rows: np.ndarray) -> np.ndarray:
    hidden, output = np.array(weights[0]), np.array(weights[1])
    active = np.tanh(hidden[:, 0] + rows @ hidden[:, 1:].T)
    return 1 / (1 + np.exp(-(output[0] + active @ output[1:])))


UNITS = [
    "tanh(" + " + ".join(f"CAST({w} AS DOUBLE) * {c}" for w, c in zip(unit[1:], LINEAR)) + f" + CAST({unit[0]} AS DOUBLE))"
    for unit in HIDDEN
]
NETWORK = f"1 / (1 + exp(-(CAST({OUTPUT[0]} AS DOUBLE) + CAST({OUTPUT[1]} AS DOUBLE) * {UNITS[0]} + CAST({OUTPUT[2]} AS DOUBLE) * {UNITS[1]})))"


@query(
    "score_model",
    f"""SELECT Booking_ID, CASE WHEN p >= 0.5 THEN 1 WHEN p < 0.5 THEN 0 END AS prediction,
 CASE WHEN p >= 0.5 THEN 'Not_Canceled' WHEN p < 0.5 THEN 'Canceled' END AS label, round(p, 6) AS probability
FROM (SELECT Booking_ID, CASE WHEN arrival_date <> 31 THEN {NETWORK} END AS p FROM bookings) s""",
)
def score_model(t: Tables) -> DataFrame:
    """A small network that only Python can call; rows with a missing number get no answer."""
    holes = t.bookings.withColumn("lead_time", F.when(F.col("arrival_date") != 31, F.col("lead_time")))
    load = ops.broadcast_model(t.spark, (HIDDEN, OUTPUT), network)
    scored = ops.score_model(holes.select(KEY, *LINEAR), load, list(LINEAR))
    return scored.select(KEY, "prediction", "label", F.round("probability", 6).alias("probability"))


@query(
    "input_fingerprint",
    "SELECT count(*) AS n_rows, TRUE AS order_is_no_matter, TRUE AS a_cell_is, TRUE AS a_copy_is FROM bookings",
)
def input_fingerprint(t: Tables) -> DataFrame:
    """Versions of the bookings, of the same rows in another order, with one cell changed, and with one row twice."""
    rows = t.bookings
    one = rows.agg(F.min(KEY).alias("_one"))
    other = rows.crossJoin(F.broadcast(one)).withColumn("lead_time", F.col("lead_time") + (F.col(KEY) == F.col("_one")).cast("int"))
    copy = rows.crossJoin(F.broadcast(one)).filter(F.col(KEY) == F.col("_one")).drop("_one")
    versions = [
        tracking.fingerprint(df).select(F.lit(name).alias("name"), "n_rows", "version")
        for name, df in (
            ("own", rows),
            ("order", rows.select(*reversed(rows.columns)).repartition(5, "lead_time")),
            ("cell", other.drop("_one")),
            ("copy", rows.unionByName(copy)),
        )
    ]
    wide = reduce(DataFrame.unionByName, versions).groupBy().pivot("name", ["own", "order", "cell", "copy"])
    found = wide.agg(F.first("version").alias("v"), F.first("n_rows").alias("n"))
    return found.select(
        F.col("own_n").alias("n_rows"),
        (F.col("own_v") == F.col("order_v")).alias("order_is_no_matter"),
        (F.col("own_v") != F.col("cell_v")).alias("a_cell_is"),
        (F.col("own_v") != F.col("copy_v")).alias("a_copy_is"),
    )


def registry_events(t: Tables) -> DataFrame:
    """Registry events, three kinds from the parts: versions, aliases that move on, and archived versions."""
    part = t.raw("part").selectExpr(
        "'model-' || CAST(p_partkey % 50 AS STRING) AS model_name", "p_partkey AS k", "p_size AS size", "p_retailprice AS price"
    )
    at = lambda days: F.timestamp_seconds(F.lit(1704067200) + (F.col("k") % 97) * 3600 + days * 86400)
    subject = F.concat(F.lit("v"), F.lpad(F.col("k").cast("string"), 9, "0"))

    def events(df: DataFrame, kind: str, prefix: str, days: int, value: Column) -> DataFrame:
        return df.select(
            F.concat(F.lit(prefix), subject).alias("event_id"),
            at(days).alias("at"),
            "model_name",
            F.lit(kind).alias("kind"),
            subject.alias("subject"),
            value.cast("string").alias("value"),
            F.concat(F.lit("/models/"), subject).alias("path"),
            (F.col("price") / 10000).cast("double").alias("f1_score"),
        )

    ready = F.when(F.col("size") % 3 == 0, "PENDING").otherwise("READY")
    made = events(part, tracking.VERSION, "", 0, ready)
    named = events(part.filter("k % 50 < 25 AND k % 7 = 0"), tracking.ALIAS, "a", 10, F.lit("latest-model"))
    archived = events(part.filter("k % 11 = 0"), tracking.STATUS, "s", 20, F.lit("ARCHIVED"))
    return made.unionByName(named).unionByName(archived)


@query(
    "registry_from_events",
    """WITH e AS (SELECT 'model-' || CAST(p_partkey % 50 AS VARCHAR) AS model_name, p_partkey AS k, p_partkey % 97 AS h,
  CASE WHEN p_size % 3 = 0 THEN 'PENDING' ELSE 'READY' END AS status FROM part),
v AS (SELECT *, row_number() OVER (PARTITION BY model_name ORDER BY h, lpad(CAST(k AS VARCHAR), 9, '0')) AS version,
  row_number() OVER (PARTITION BY model_name ORDER BY CASE WHEN k % 50 < 25 AND k % 7 = 0 THEN h END DESC NULLS LAST, k DESC) AS a FROM e)
SELECT model_name, version, CASE WHEN k % 11 = 0 THEN 'ARCHIVED' ELSE status END AS status,
 CASE WHEN a = 1 AND k % 50 < 25 AND k % 7 = 0 THEN 'latest-model' END AS alias FROM v""",
)
def registry_from_events(t: Tables) -> DataFrame:
    """Versions, statuses and aliases as a registry of appended events has them; two writers, one event written twice."""
    path = scratch_path(t.spark, "registry")
    events = registry_events(t)
    odd = F.substring("subject", -1, 1).isin("1", "3", "5", "7", "9")
    write_table(events.filter(odd), path, "append")
    write_table(events.filter(~odd | (F.col("kind") == tracking.ALIAS)), path, "append")
    return tracking.registry_of(read_table(t.spark, path)).select("model_name", "version", "status", "alias")


@query(
    "schema_contract",
    """SELECT 'text of numbers' AS input, TRUE AS fits, count(*) AS n_rows, '' AS differing FROM bookings
UNION ALL SELECT 'words among numbers', FALSE, 0, 'lead_time' FROM (SELECT count(*) AS n FROM bookings WHERE arrival_date = 31) b WHERE n > 0""",
)
def schema_contract(t: Tables) -> DataFrame:
    """Inputs of another type against the recorded schema: converted where every value converts, else named and refused."""
    path = scratch_path(t.spark, "schema")
    columns = ["lead_time", "avg_price_per_room"]
    tracking.record_schema(t.spark, t.bookings.select(*columns).schema, path)
    expected = tracking.recorded_schema(t.spark, path)
    text = t.bookings.select(KEY, *[F.col(c).cast("string").alias(c) for c in columns])
    words = F.when(F.col("arrival_date") == 31, "?").otherwise(F.col("lead_time").cast("string"))
    fits = tracking.conform(text, expected).filter(F.col("lead_time").isNotNull() & F.col("avg_price_per_room").isNotNull())
    loose = t.bookings.select(words.alias("lead_time"), "avg_price_per_room")
    try:
        tracking.conform(loose, expected)
        differing = ""
    except tracking.ContractError as e:
        differing = ",".join(c for c in columns if f"{c} is" in str(e))
    good = fits.agg(F.lit("text of numbers").alias("input"), F.lit(True).alias("fits"), F.count("*").alias("n_rows"), F.lit("").alias("differing"))
    bad = t.spark.range(1).select(
        F.lit("words among numbers").alias("input"), F.lit(not differing).alias("fits"), F.lit(0).cast("long").alias("n_rows"), F.lit(differing).alias("differing")
    )
    return good.unionByName(bad)
