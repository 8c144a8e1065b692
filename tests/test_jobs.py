from __future__ import annotations

import random

from conftest import rows
from pyspark.sql import functions as F

from lodgeline import jobs
from lodgeline.operators import models
from lodgeline.schemas import BOOKING, INT_COLUMNS
from lodgeline.sources.storage import read_table, row_count


def csv(spark, path, n=200):
    rng = random.Random(2)
    data = []
    for i in range(n):
        row = {f.name: None for f in BOOKING}
        row.update({c: rng.randint(0, 3) for c in INT_COLUMNS})
        row.update(Booking_ID=f"BK{i}", avg_price_per_room=rng.random() * 100, lead_time=rng.randint(0, 300))
        row.update(arrival_year=2023, arrival_month=rng.randint(1, 12))
        row.update({c: rng.choice(["x", "y"]) for c in ("market_segment_type", "room_type_reserved", "type_of_meal_plan")})
        row["booking_status"] = "Canceled" if row["lead_time"] > 150 else "Not_Canceled"
        data.append(tuple(row[f.name] for f in BOOKING))
    df = spark.createDataFrame(data, BOOKING)
    df.unionAll(df).write.option("header", True).csv(path)
    return path


def test_prepare_train_gate_and_score(spark, path):
    source = csv(spark, f"{path}/csv")
    names, todo = (f"{path}/train", f"{path}/test"), f"{path}/todo"
    jobs.prepare_sets(spark, source, names, todo)
    train, test = read_table(spark, names[0]), read_table(spark, names[1])
    assert train.count() + test.count() == 200 and "arrival_date" not in train.columns

    registry, folder = f"{path}/registry", f"{path}/models"
    assert jobs.champion_path(spark, registry, "lr") is None
    first = jobs.train_and_register(train, test, "lr", folder, registry)
    assert first["register"] and first["f1_champion"] is None and first["f1_challenger"] > 0.8
    same = jobs.train_and_register(train, test, "lr", folder, registry)
    assert same["register"] and same["f1_champion"] == same["f1_challenger"]
    worse = jobs.train_and_register(
        train.withColumn("booking_status", F.when(F.col("booking_status") == "Canceled", "Not_Canceled").otherwise("Canceled")),
        test,
        "lr",
        folder,
        registry,
    )
    assert not worse["register"]
    assert rows(models.registry_latest(read_table(spark, registry))) == [("lr", 2, "alias")]

    jobs.prepare_sets(spark, source, names, todo, job_type="inference")
    assert row_count(spark, todo) == 200
    from pyspark.ml import PipelineModel

    model = PipelineModel.load(jobs.champion_path(spark, registry, "lr"))
    done = jobs.score_table(spark, todo, lambda df: models.score(model, df), "pred", "proba")
    assert (done.before, done.incoming, done.after) == (200, 200, 200)
    assert read_table(spark, todo).filter("pred IS NULL").count() == 0
    assert jobs.score_table(spark, todo, lambda df: models.score(model, df), "pred", "proba").incoming == 0


def test_refresh_appends_only_new_requests(spark, path):
    data = [
        (f"2024-01-0{i}", f"r{i}", 5, '{"dataframe_records":[{"lead_time":1},{"lead_time":2}]}', '{"predictions":["Canceled","Canceled"]}')
        for i in (1, 2, 3)
    ]
    log = spark.createDataFrame(
        data, "request_time string, request_id string, execution_duration_ms long, request string, response string"
    ).withColumn("request_time", F.col("request_time").cast("timestamp"))
    name = f"{path}/monitoring"
    first = jobs.refresh_monitoring(log.filter("request_id < 'r3'"), name, "lr")
    assert (first.before, first.incoming, first.after, first.verdict) == (0, 4, 4, "ok")
    second = jobs.refresh_monitoring(log, name, "lr")
    assert (second.incoming, second.after) == (2, 6)
    third = jobs.refresh_monitoring(log, name, "lr")
    assert (third.incoming, third.verdict) == (0, "no new rows")
    assert jobs.refresh_monitoring(log.limit(0), name, "lr").after == 6
