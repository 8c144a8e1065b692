from __future__ import annotations

import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lodgeline.operators import payload as ops
from lodgeline.schemas import FEATURES

FEATURE_ROW = [3, 2031, 7.5, 41, 2, 1, 1, 4, 0, 1, 2, 1, 5, "Any", "Room A", "Meal B"]
SCHEMA = "request_time timestamp_ntz, request_id string, execution_duration_ms long, request string, response string"


def log(spark, *pairs):
    data = [("2024-01-01 00:00:00.9", str(i), 5, req, res) for i, (req, res) in enumerate(pairs)]
    df = spark.createDataFrame(data, SCHEMA.replace("timestamp_ntz", "string"))
    return df.withColumn("request_time", F.col("request_time").cast("timestamp_ntz"))


def request(*records) -> str:
    return json.dumps({"dataframe_records": list(records)})


def test_records_get_the_answer_at_their_position(spark):
    df = log(spark, (request({"lead_time": 1}, {"lead_time": 2}), json.dumps({"predictions": ["Canceled", "Not_Canceled"]})))
    got = rows(ops.flatten(df), "pos", "lead_time", "prediction", "timestamp_ms")
    assert got == [(0, 1, 1.0, 1704067200000), (1, 2, 0.0, 1704067200000)]
    assert ops.flatten(df).columns[5:21] == list(FEATURES)


def test_bad_input_gives_nulls_not_errors(spark):
    df = log(
        spark,
        (request({"lead_time": "x", "market_segment_type": "Online"}), json.dumps({"predictions": []})),
        ("{broken", "also broken"),
        (request(), None),
        (None, None),
        (request({"lead_time": 4}), json.dumps({"predictions": ["Maybe"]})),
    )
    got = rows(ops.flatten(df, keep_failed=True), "request_id", "lead_time", "prediction")
    assert got == [("0", None, None), ("4", 4, None)]


def test_failed_calls_stay_only_if_nothing_else_is_left(spark):
    good = (request({"lead_time": 1}), json.dumps({"predictions": ["Canceled"]}))
    bad = (request({"lead_time": 2}), None)
    assert rows(ops.flatten(log(spark, good, bad)), "lead_time") == [(1,)]
    assert rows(ops.flatten(log(spark, bad)), "lead_time") == [(2,)]
    assert ops.flatten(log(spark, good).limit(0)).count() == 0


def test_object_answers_carry_label_and_probability(spark):
    answer = {"predictions": [{"prediction": 1, "label": "Not_Canceled", "probability": 0.75}]}
    got = rows(ops.flatten(log(spark, (request({"lead_time": 1}), json.dumps(answer)))), "prediction", "probability")
    assert got == [(0.0, 0.75)]


def test_split_form_reads_cells_by_name(spark):
    columns = list(FEATURES)
    body = json.dumps({"dataframe_split": {"columns": columns, "data": [FEATURE_ROW, FEATURE_ROW[:4]]}})
    df = log(spark, (body, json.dumps({"predictions": ["Canceled", "Canceled"]})))
    first, short = ops.flatten(df, form="split").orderBy("pos").collect()
    assert [first[c] for c in FEATURES] == FEATURE_ROW
    assert short["lead_time"] == 41 and short["no_of_adults"] is None
    with pytest.raises(ValueError, match="form"):
        ops.flatten(df, form="csv")


def test_built_requests_can_be_flattened(spark):
    df = spark.createDataFrame(
        [("a", 3, 1.5, None, "2024-01-01 00:00:00")],
        "Booking_ID string, lead_time int, avg_price_per_room double, market_segment_type string, t string",
    ).withColumn("t", F.col("t").cast("timestamp_ntz"))
    built = ops.build(df, ["lead_time", "avg_price_per_room", "market_segment_type", "t"]).first()["request"]
    assert json.loads(built) == {
        "dataframe_records": [
            {"lead_time": 3, "avg_price_per_room": 1.5, "market_segment_type": None, "t": "2024-01-01T00:00:00"}
        ]
    }
    back = ops.flatten(log(spark, (built, json.dumps({"predictions": ["Canceled"]}))))
    assert rows(back, "lead_time", "avg_price_per_room", "market_segment_type") == [(3, 1.5, None)]


def test_json_is_parsed_once(spark, path):
    log(spark, (request({"lead_time": 1}), "{}")).write.parquet(path)
    plan = ops.flatten(spark.read.parquet(path), keep_failed=True)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(StructField(dataframe_records") == 1
