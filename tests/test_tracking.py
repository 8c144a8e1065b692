from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lodgeline import jobs
from lodgeline.operators import draws, models, tracking
from lodgeline.sources.storage import read_table


# Exact draws


def keyed(spark, n):
    return spark.range(n).select(F.concat(F.lit("k"), "id").alias("Booking_ID"), "id")


@pytest.mark.parametrize("n", [0, 1, 2, 37, 399, 400, 999])
def test_exact_split_is_the_top_of_the_hashes(spark, n):
    df = keyed(spark, 400)
    train, test = draws.split_exact(df, n)
    want = df.orderBy(models.key_hash("Booking_ID"), "Booking_ID").limit(n)
    assert rows(test, "id") == rows(want, "id")
    assert train.count() + test.count() == 400
    plan = test._jdf.queryExecution().executedPlan().toString() + train._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Limit", "Sort", "Exchange", "Join"))


def test_exact_split_keeps_a_key_together(spark):
    df = spark.createDataFrame([("a", 1)] * 10 + [("b", 2), ("c", 3), (None, 4)], "Booking_ID string, v int")
    for n in range(14):
        train, test = draws.split_exact(df, n)
        assert test.count() <= n and train.count() + test.count() == 13
        assert not {r[0] for r in rows(train, "Booking_ID")} & {r[0] for r in rows(test, "Booking_ID")}
        assert test.filter("Booking_ID IS NULL").count() == 0


def test_bound_narrows_to_equal_hashes(spark):
    df = spark.range(50).select(F.lit("0123456789abcdef").alias("h"), "id")
    for n in (0, 7, 50, 60):
        bound = draws.least(df, F.col("h"), F.col("id"), n, width=16)
        assert rows(df.filter(bound.within(F.col("h"), F.col("id"))), "id") == sorted(((k,) for k in range(min(n, 50))), key=str)


@pytest.mark.parametrize("n", [1, 5, 49, 50, 51, 500])
def test_sample_has_n_rows_for_every_n(spark, n):
    df = spark.range(50)
    assert draws.sample_n(df, n).count() == n
    without = draws.sample_n(df, n, replace=False)
    assert without.count() == without.distinct().count() == min(n, 50)


def test_sample_is_uniform(spark):
    counts = {r["id"]: r["count"] for r in draws.sample_n(spark.range(20), 20_000).groupBy("id").count().collect()}
    assert len(counts) == 20 and all(abs(c - 1000) < 160 for c in counts.values())
    hits = [draws.sample_n(spark.range(4), 1, seed=s, replace=False).first()["id"] for s in range(24)]
    assert len(set(hits)) == 4
    plan = draws.sample_n(spark.range(50), 10)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Limit", "Sort", "Exchange", "Join"))


# Fingerprints


def test_fingerprint(spark):
    df = spark.createDataFrame([(1, "a", {"x": 1}), (2, None, None), (2, None, None)], "k int, s string, m map<string,int>")
    same = df.select("m", "s", "k").repartition(3)
    assert tracking.input_version(df) == tracking.input_version(same)
    others = [
        df.limit(0),
        df.distinct() if False else df.limit(2),
        df.unionAll(df.limit(1)),
        df.withColumn("s", F.coalesce("s", F.lit("null"))),
        df.withColumn("k", F.col("k").cast("long")),
        df.withColumnRenamed("s", "t"),
        df.withColumn("k", F.when(F.col("k") == 1, 3).otherwise(F.col("k"))),
        df.select(F.lit(None).cast("int").alias("k"), "s", "m"),
    ]
    versions = [tracking.input_version(x) for x in [df, *others]]
    assert len(set(versions)) == len(versions)
    assert tracking.fingerprint(df).first()["n_rows"] == 3


# Contracts


def test_contract(spark, path):
    df = spark.createDataFrame([(1, 2.0), (None, 3.0)], "a int, b double")
    tracking.record_schema(spark, df.schema, path)
    expected = tracking.recorded_schema(spark, path)
    assert expected == df.schema
    assert tracking.conform(df, expected).schema == df.schema
    text = spark.createDataFrame([("1", "2"), (None, "3.0")], "a string, b string")
    assert rows(tracking.conform(text, expected)) == rows(df)
    with pytest.raises(tracking.ContractError, match=r"a is string, expected int \(1 rows\), b is missing"):
        tracking.conform(spark.createDataFrame([("x",), ("7",)], "a string"), expected)


# Registry


def event(event_id, at, name, kind, subject, value):
    return (event_id, at, name, kind, subject, value, f"/m/{subject}", 0.5)


def test_registry_of_events(spark):
    made = [
        event("b", "2024-01-01", "m", "version", "b", "READY"),
        event("b-alias", "2024-01-01", "m", "alias", "b", "latest-model"),
        # Two jobs at once, and one event that a retry wrote twice.
        event("c", "2024-01-02", "m", "version", "c", "READY"),
        event("a", "2024-01-02", "m", "version", "a", "READY"),
        event("c", "2024-01-02", "m", "version", "c", "READY"),
        event("a-alias", "2024-01-02", "m", "alias", "a", "latest-model"),
        event("c-alias", "2024-01-02", "m", "alias", "c", "latest-model"),
        event("s", "2024-01-03", "m", "status", "a", "ARCHIVED"),
        event("z", "2024-01-03", "k", "version", "z", "PENDING"),
    ]
    events = spark.createDataFrame(made, tracking.EVENTS.replace("at timestamp", "at string")).withColumn("at", F.col("at").cast("timestamp"))
    registry = tracking.registry_of(events)
    assert rows(registry, "model_name", "version", "status", "alias", "event_id") == [
        ("k", 1, "PENDING", None, "z"),
        ("m", 1, "READY", None, "b"),
        ("m", 2, "ARCHIVED", None, "a"),
        ("m", 3, "READY", "latest-model", "c"),
    ]
    assert rows(models.registry_latest(events)) == [("m", 3, "alias")]
    assert tracking.registry_of(events.limit(0)).count() == 0


# Any Python model


def test_any_model(spark):
    df = spark.createDataFrame([(f"k{i}", float(i) if i % 7 else None, i) for i in range(100)], "Booking_ID string, x double, n int")

    class Stump:
        cut = 50.0

    load = models.broadcast_model(spark, Stump.cut, lambda cut, m: (m[:, 0] + 0 * m[:, 1] >= cut).astype(float))
    got = models.score_model(df.repartition(3), load, ["x", "n"], batch_size=8)
    want = [(f"k{i}", None if i % 7 == 0 else int(i >= 50)) for i in range(100)]
    assert rows(got, "Booking_ID", "prediction") == sorted(want, key=lambda r: r[0])
    assert models.score_model(df.limit(0), load, ["x", "n"]).count() == 0
    with pytest.raises(ValueError):
        models.score_model(df, load, ["missing"])


# Jobs


def test_training_records_its_input_and_scoring_checks_it(spark, path):
    from test_jobs import csv

    source = csv(spark, f"{path}/csv")
    jobs.prepare_sets(spark, source, (f"{path}/train", f"{path}/test"), f"{path}/todo")
    train, test = read_table(spark, f"{path}/train"), read_table(spark, f"{path}/test")
    registry, runs = f"{path}/registry", f"{path}/runs"
    for _ in range(2):
        jobs.train_and_register(train, test, "lr", f"{path}/models", registry, runs_name=runs)
    log = read_table(spark, runs)
    assert {r[0] for r in log.select("source_version").collect()} == {tracking.input_version(train)} and log.count() == 2
    assert rows(tracking.registry_of(read_table(spark, registry)), "version", "alias") == [(1, None), (2, "latest-model")]
    good = jobs.score_with_registered(spark, registry, "lr", test)
    assert good.count() == test.count() and good.filter("label IS NULL").count() == 0
    text = test.withColumn("lead_time", F.col("lead_time").cast("string"))
    assert rows(jobs.score_with_registered(spark, registry, "lr", text), "Booking_ID", "label") == rows(good, "Booking_ID", "label")
    with pytest.raises(tracking.ContractError, match="lead_time is string, expected int"):
        jobs.score_with_registered(spark, registry, "lr", test.withColumn("lead_time", F.lit("soon")))
    with pytest.raises(ValueError, match="no version"):
        jobs.score_with_registered(spark, registry, "other", test)


def test_refresh_reads_only_the_days_of_the_log(spark, path):
    body = '{"dataframe_records":[{"lead_time":1}]}'
    answer = '{"predictions":["Canceled"]}'
    kind = "request_time string, request_id string, execution_duration_ms long, request string, response string"

    def log(*requests):
        df = spark.createDataFrame([(t, r, 5, body, answer) for t, r in requests], kind)
        return df.withColumn("request_time", F.col("request_time").cast("timestamp"))

    first = log(("2024-01-01 10:00:00", "a"), ("2024-01-02 10:00:00", "b"), ("2024-01-03 23:59:59", "c"))
    assert jobs.refresh_monitoring(first, path, "lr").after == 3
    # A late request of an old day, one that is stored, one without a time.
    late = log(("2024-01-01 11:00:00", "d"), ("2024-01-01 10:00:00", "a"), (None, "e"))
    second = jobs.refresh_monitoring(late, path, "lr")
    assert (second.incoming, second.after) == (2, 5)
    assert jobs.refresh_monitoring(late.unionAll(first), path, "lr").incoming == 0
    flat = read_table(spark, path)
    held = jobs.stored_requests(spark, path, jobs.days_of(late), flat)
    plan = held._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [(" in plan or f"{jobs.REQUEST_DATE}#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert {f.split("request_date=")[1].split("/")[0] for f in held.inputFiles()} >= {"2024-01-01"}
    assert rows(held, "request_id") == [("a",), ("d",), ("e",)]


def test_refresh_of_tables_without_days_and_of_named_tables(spark, path):
    from lodgeline.operators.payload import flatten
    from lodgeline.sources import storage

    body, answer = '{"dataframe_records":[{"lead_time":1}]}', '{"predictions":["Canceled"]}'
    kind = "request_time string, request_id string, execution_duration_ms long, request string, response string"
    data = [(f"2024-01-0{k} 10:00:00", f"r{k}", 5, body, answer) for k in (1, 2, 3)]
    log = spark.createDataFrame(data, kind).withColumn("request_time", F.col("request_time").cast("timestamp"))
    storage.write_table(flatten(log.limit(1), model_name="lr"), path)
    assert jobs.refresh_monitoring(log, path, "lr").incoming == 2 and jobs.refresh_monitoring(log, path, "lr").after == 3
    assert storage.folder_columns(spark, path) == []
    with pytest.raises(ValueError, match="no folders by"):
        storage.write_table(flatten(log, model_name="lr").withColumn("d", F.lit(1)), path, "append", partition_by="d")
    name = "monitoring_by_day"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    assert jobs.refresh_monitoring(log.limit(2), name, "lr").after == 2
    assert jobs.refresh_monitoring(log, name, "lr").incoming == 1 and jobs.refresh_monitoring(log, name, "lr").after == 3
    assert storage.folder_columns(spark, name) == [jobs.REQUEST_DATE]
    spark.sql(f"DROP TABLE {name}")
