from __future__ import annotations

from conftest import rows
from pyspark.sql import functions as F

from lodgeline.operators import models, monitoring
from lodgeline.operators import payload as pay
from lodgeline.streaming import streams


def write_files(df, path, parts):
    """Each part becomes files of its own, so that it can be a micro-batch of its own."""
    for part in parts:
        df.filter(part).coalesce(1).write.mode("append").parquet(path)


def test_stream_of_a_folder_or_of_one_file(spark, path):
    spark.range(5).coalesce(1).write.parquet(path)
    file = next(f for f in spark.read.parquet(path).inputFiles()).replace("file://", "")
    schema = spark.read.parquet(path).schema
    for i, place in enumerate((path, file)):
        out = f"{path}-out{i}"
        streams.append_to(streams.read_stream(spark, place, schema), out, f"{out}-cp").awaitTermination()
        assert spark.read.parquet(out).count() == 5


def test_profile_of_a_stream_equals_the_batch(spark, path):
    df = spark.range(300).select(
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 97).cast("timestamp_ntz").alias("timestamp"),
        F.when(F.col("id") % 5 > 0, (F.col("id") % 2).cast("double")).alias("prediction"),
        F.concat(F.lit("m"), (F.col("id") % 2)).alias("model_name"),
    )
    write_files(df, path, ["timestamp < '2024-01-01 03:00:00'", "timestamp >= '2024-01-01 03:00:00'"])
    reader = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)
    counts = streams.profile_stream(reader)
    got = streams.run_profile(counts, f"{path}-out", f"{path}-cp")
    want = monitoring.profile(df)
    assert rows(got.select(*sorted(want.columns))) == rows(want.select(*sorted(want.columns)))


def test_each_key_is_taken_in_once_over_batches_and_restarts(spark, path):
    df = spark.createDataFrame(
        [("a", 1), ("a", 1), ("b", 1), ("a", 2), ("c", 2), ("b", 3)], "Booking_ID string, part int"
    )
    write_files(df, path, ["part = 1", "part = 2"])
    reader = lambda: spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)
    got = streams.run_ingest(reader(), f"{path}-out", f"{path}-cp")
    assert rows(got, "Booking_ID") == [("a",), ("b",), ("c",)]
    write_files(df, path, ["part = 3"])
    again = streams.run_ingest(reader(), f"{path}-out", f"{path}-cp")
    assert rows(again, "Booking_ID") == [("a",), ("b",), ("c",)]


def test_empty_streams_give_empty_results(spark, path):
    spark.range(0).select(F.lit("a").alias("Booking_ID")).write.parquet(path)
    schema = spark.read.parquet(path).schema
    got = streams.run_ingest(streams.read_stream(spark, path, schema), f"{path}-out", f"{path}-cp")
    assert got.count() == 0


def test_flatten_and_score_streams(spark, path):
    df = spark.createDataFrame(
        [("2024-01-01", "r1", 5, '{"dataframe_records":[{"lead_time":1}]}', '{"predictions":["Canceled"]}'), ("2024-01-01", "r2", 5, "x", None)],
        "request_time string, request_id string, execution_duration_ms long, request string, response string",
    ).withColumn("request_time", F.col("request_time").cast("timestamp_ntz"))
    df.write.parquet(path)
    flat = streams.flatten_stream(streams.read_stream(spark, path, df.schema))
    streams.append_to(flat, f"{path}-flat", f"{path}-cp").awaitTermination()
    assert rows(spark.read.parquet(f"{path}-flat").select("lead_time", "prediction")) == rows(
        pay.flatten(df).select("lead_time", "prediction")
    )
    scorer = lambda d: models.score_linear(d, {"lead_time": 1.0}, 0.0)
    stream = streams.read_stream(spark, f"{path}-flat", flat.schema).drop("prediction", "probability")
    streams.score_stream(stream, scorer, f"{path}-scored", f"{path}-cp2").awaitTermination()
    assert rows(spark.read.parquet(f"{path}-scored"), "label") == [("Not_Canceled",)]


# Batches as folders


def calls(spark, *times):
    return spark.createDataFrame([(t, 1.0, "m") for t in times], "timestamp string, prediction double, model_name string").withColumn(
        "timestamp", F.col("timestamp").cast("timestamp_ntz")
    )


def test_no_call_is_too_late(spark, path):
    """Three files, a trigger each, out of time order: all calls count."""
    parts = [calls(spark, t) for t in ("2024-01-02 00:00:00", "2024-01-03 00:00:00", "2024-01-01 00:00:00")]
    parts.append(calls(spark, "2024-01-01 00:10:00", None))
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(path)
        reader = spark.readStream.schema(part.schema).option("maxFilesPerTrigger", 1).parquet(path)
        got = streams.run_profile(streams.profile_stream(reader), f"{path}-out", f"{path}-cp", most=1)
        want = monitoring.profile(spark.read.parquet(path))
        assert rows(got.select(*sorted(want.columns))) == rows(want.select(*sorted(want.columns)))
    assert rows(got, "n") == [(1,), (1,), (2,)]
    # Old batches were folded, and the folder holds one fold only.
    from lodgeline.files import children

    assert [n for n in children(spark, f"{path}-out") if n.startswith("upto=")] == ["upto=1"]


def test_batches_run_again_count_once(spark, path):
    schema = spark.range(1).selectExpr("id AS k", "id AS n").schema
    add_up = lambda df: df.groupBy("k").agg(F.sum("n").alias("n"))
    from lodgeline.files import delete
    from lodgeline.streaming import batches

    write = lambda i: batches.put(spark.range(i + 1).selectExpr("id AS k", "1L AS n"), path, i)
    total = lambda: rows(add_up(batches.read_batches(spark, path, schema)), "k", "n")
    assert total() == []
    for i in (0, 1, 2):
        write(i)
    write(2)
    assert total() == [(0, 3), (1, 2), (2, 1)]
    assert not batches.fold(spark, path, schema, add_up, most=3)
    assert batches.fold(spark, path, schema, add_up, most=1, before=2)
    assert total() == [(0, 3), (1, 2), (2, 1)]
    write(1)  # is in the fold
    assert total() == [(0, 3), (1, 2), (2, 1)]
    # A fold that broke off before it was finished does not count.
    spark.range(9).selectExpr("id AS k", "7L AS n").write.parquet(f"{path}/upto=2")
    delete(spark, f"{path}/upto=2/_SUCCESS")
    assert total() == [(0, 3), (1, 2), (2, 1)]
    # One that broke off before it cleaned up does, and what it holds does not count again.
    add_up(batches.read_batches(spark, path, schema)).write.mode("overwrite").parquet(f"{path}/upto=2")
    assert total() == [(0, 3), (1, 2), (2, 1)]
    assert rows(batches.read_batches(spark, path, schema, before=3), "k") == [(0,), (1,), (2,)]


def test_a_batch_reads_only_its_key_folders(spark, path):
    from lodgeline.sources.storage import KEY_BUCKET, with_bucket

    df = spark.range(400).selectExpr("concat('k', id) AS Booking_ID", "id AS v")
    df.write.parquet(f"{path}/0")
    got = streams.run_ingest(streams.read_stream(spark, f"{path}/0", df.schema), f"{path}-out", f"{path}-cp", buckets=16)
    assert got.count() == 400
    batch = with_bucket(df.filter("v < 2").unionAll(spark.createDataFrame([("new", 1)], df.schema)), "Booking_ID", 16)
    fresh = streams.unseen_of(batch, f"{path}-out", df.schema, 1)
    assert rows(fresh, "Booking_ID") == [("new",)]
    touched = {r[0] for r in batch.select(KEY_BUCKET).distinct().collect()}
    assert len(touched) <= 3
    plan = fresh._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in plan and f"{KEY_BUCKET}#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "v#" not in plan.split("FileScan parquet [")[-1].split("]")[0]  # of the store only keys are read
    # A replayed batch sees the batches before it only, so it writes the same rows again.
    again = with_bucket(df, "Booking_ID", 16)
    assert streams.unseen_of(again, f"{path}-out", df.schema, 0).count() == 400


def test_ingest_folds_and_still_knows_every_key(spark, path):
    schema = "Booking_ID string, v long"
    for i in range(5):
        spark.createDataFrame([(f"k{j}", i) for j in range(i + 2)], schema).coalesce(1).write.mode("append").parquet(path)
        reader = streams.read_stream(spark, path, spark.read.parquet(path).schema)
        got = streams.run_ingest(reader, f"{path}-out", f"{path}-cp", buckets=4, most=1)
        assert rows(got, "Booking_ID") == [(f"k{j}",) for j in range(i + 2)]
    assert rows(got, "Booking_ID", "v") == [("k0", 0), ("k1", 0), ("k2", 1), ("k3", 2), ("k4", 3), ("k5", 4)]


def test_the_table_is_right_after_every_scored_batch(spark, path):
    from lodgeline.sources.storage import last_batch, read_table, write_table

    scorer = lambda d: models.score_linear(d, {"lead_time": 1.0}, -5.0).select("Booking_ID", "label", "probability")
    kind = "Booking_ID string, label string, probability double"
    write_table(spark.createDataFrame([("a", "kept", 0.1), ("b", None, None)], kind), path, "overwrite", buckets=4)
    batch = lambda *r: spark.createDataFrame(list(r), "Booking_ID string, lead_time int")
    put = lambda df, k: streams.score_batch(df, k, scorer, path, buckets=4)
    got = lambda: rows(read_table(spark, path), "Booking_ID", "label")
    assert last_batch(spark, path) == -1
    put(batch(("a", 9), ("b", 9), ("c", 1)), 0)
    assert got() == [("a", "kept"), ("b", "Not_Canceled"), ("c", "Canceled")] and last_batch(spark, path) == 0
    put(batch(("a", 9), ("b", 1), ("c", 9)), 0)  # finished before: skipped
    assert last_batch(spark, path) == 0
    put(batch(("d", None), ("b", 1)), 1)
    assert got() == [("a", "kept"), ("b", "Not_Canceled"), ("c", "Canceled"), ("d", None)]
    # The batch broke off before its number was written: it is put in again.
    from lodgeline.files import delete

    delete(spark, f"{path}/_last_batch")
    put(batch(("d", None), ("b", 1)), 1)
    assert got() == [("a", "kept"), ("b", "Not_Canceled"), ("c", "Canceled"), ("d", None)] and last_batch(spark, path) == 1
    put(batch(("d", 9), ("d", 9)), 2)  # an answer that was missing
    assert got()[-1] == ("d", "Not_Canceled")


def test_scoring_stream_creates_its_table(spark, path):
    df = spark.createDataFrame([("a", 9), ("b", 1)], "Booking_ID string, lead_time int")
    df.repartition(2).write.parquet(path)
    scorer = lambda d: models.score_linear(d, {"lead_time": 1.0}, -5.0).select("Booking_ID", "label", "probability")
    from lodgeline.sources.storage import read_table

    for _ in range(2):
        reader = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)
        streams.run_scoring(reader, scorer, f"{path}-out", f"{path}-cp").awaitTermination()
        assert rows(read_table(spark, f"{path}-out"), "Booking_ID", "label") == [("a", "Not_Canceled"), ("b", "Canceled")]
