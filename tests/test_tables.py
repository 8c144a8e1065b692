from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lodgeline.files import exists, is_file
from lodgeline.operators import features, tables
from lodgeline.schemas import BOOKING, TableNames
from lodgeline.scratch import scratch_path, shared_root
from lodgeline.sources import storage

SCHEMA = "Booking_ID string, lead_time int, update_timestamp_utc int"


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def test_latest_per_key_takes_the_newest_and_settles_ties(spark):
    df = frame(spark, [("a", 1, 1), ("a", 2, 2), ("b", 5, None), ("b", 4, 1), ("c", 7, 1), ("c", 8, 1)])
    got = rows(tables.latest_per_key(df, "Booking_ID", "update_timestamp_utc"), "Booking_ID", "lead_time")
    assert got == [("a", 2), ("b", 4), ("c", 8)]


def test_hot_key_is_cut_before_the_shuffle(spark):
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string"))
    df = spark.range(1000).select(key.alias("Booking_ID"), F.col("id").alias("v"))
    plan = tables.latest_per_key(df, "Booking_ID", "v")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    below = plan[plan.index("Exchange") :]
    assert "WindowGroupLimit" in below and "Partial" in below


def test_upsert_updates_inserts_and_is_idempotent(spark):
    target = frame(spark, [("a", 1, 1), ("b", 2, 1)])
    source = frame(spark, [("b", 20, 2), ("b", 21, 3), ("c", 30, 2)])
    once = tables.upsert(target, source)
    assert rows(once, "Booking_ID", "lead_time") == [("a", 1), ("b", 21), ("c", 30)]
    assert rows(tables.upsert(once, source)) == rows(once)
    assert rows(tables.upsert(target, source.limit(0))) == rows(target)


def test_upsert_needs_the_key(spark):
    with pytest.raises(ValueError, match="Booking_ID"):
        tables.upsert(frame(spark, []), spark.range(1))


def test_change_feed_reproduces_the_upsert(spark):
    old = frame(spark, [("a", 1, 1), ("b", 2, 1), ("d", None, 1)])
    source = frame(spark, [("b", 20, 2), ("c", 30, 2), ("d", None, 1)])
    feed = tables.change_feed(old, tables.upsert(old, source))
    assert rows(feed, "Booking_ID", "change_type", "lead_time") == [("b", "update", 20), ("c", "insert", 30)]
    gone = tables.change_feed(old, old.filter("Booking_ID <> 'a'"))
    assert rows(gone, "Booking_ID", "change_type", "lead_time") == [("a", "delete", 1)]


def test_write_audit_verdicts(spark):
    three, two = spark.range(3), spark.range(2)
    got = [
        tables.write_audit(None, two, two, "append").first()["verdict"],
        tables.write_audit(two, two, two, "append").first()["verdict"],
        tables.write_audit(two, two, two, "overwrite").first()["verdict"],
        tables.write_audit(three, two, two, "overwrite").first()["verdict"],
    ]
    assert got == ["ok", "no new rows", "ok", "data loss"]
    assert tables.write_audit(None, two, two, "append").first()["rows_before"] == 0


def test_ensure_columns_is_idempotent(spark):
    df = tables.ensure_columns(spark.range(1), {"p": "string", "id": "string"})
    assert df.columns == ["id", "p"] and df.schema["id"].dataType.simpleString() == "bigint"
    assert tables.ensure_columns(df, {"p": "string"}).columns == df.columns


def test_union_fills_missing_columns(spark):
    out = tables.union_by_name(spark.range(1).toDF("id"), spark.range(1).withColumn("x", F.lit("y")))
    assert rows(out, "x") == [("y",), (None,)]


@pytest.mark.parametrize("buckets", [0, 4])
def test_write_modes_on_paths(spark, path, buckets):
    first = frame(spark, [("a", 1, 1), ("b", 2, 1)])
    assert not storage.table_exists(spark, path) and storage.row_count(spark, path) == 0
    storage.write_table(first, path, "overwrite", buckets=buckets)
    storage.write_table(frame(spark, [("c", 3, 1)]), path, "append")
    assert storage.row_count(spark, path) == 3
    storage.write_table(frame(spark, [("b", 20, 2), ("d", 4, 2)]), path, "upsert")
    got = rows(storage.read_table(spark, path), "Booking_ID", "lead_time")
    assert got == [("a", 1), ("b", 20), ("c", 3), ("d", 4)]
    assert storage.bucket_count(spark, path) == buckets
    storage.write_table(first, path, "overwrite")
    assert storage.row_count(spark, path) == 2


def test_upsert_of_key_folders_leaves_the_others_alone(spark, path):
    import pathlib

    many = spark.range(200).select(F.concat(F.lit("k"), "id").alias("Booking_ID"), F.lit(1).alias("lead_time"))
    storage.write_table(many, path, "overwrite", buckets=16)
    before = {str(p): p.stat().st_mtime_ns for p in pathlib.Path(path).rglob("*.parquet")}
    storage.write_table(many.filter("Booking_ID = 'k7'").withColumn("lead_time", F.lit(2)), path, "upsert")
    after = {str(p): p.stat().st_mtime_ns for p in pathlib.Path(path).rglob("*.parquet")}
    kept = [p for p in before if after.get(p) == before[p]]
    folders = {p.split("key_bucket=")[1].split("/")[0] for p in set(before) - set(kept)}
    assert len(folders) == 1
    assert storage.read_table(spark, path).filter("lead_time = 2").count() == 1
    assert storage.row_count(spark, path) == 200


def test_named_tables_evolve_and_upsert(spark):
    name = "sets_named"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    storage.write_table(frame(spark, [("a", 1, 1)]), name, "append")
    storage.write_table(frame(spark, [("b", 2, 1)]).withColumn("extra", F.lit("x")), name, "append")
    storage.write_table(frame(spark, [("c", 3, 1)]), name, "append")
    assert rows(storage.read_table(spark, name), "Booking_ID", "extra") == [("a", None), ("b", "x"), ("c", None)]
    storage.write_table(frame(spark, [("a", 10, 2)]), name, "upsert")
    got = rows(storage.read_table(spark, name), "Booking_ID", "lead_time")
    assert got == [("a", 10), ("b", 2), ("c", 3)]
    assert not storage.table_exists(spark, f"{name}__staging")
    spark.sql(f"DROP TABLE {name}")


def test_unknown_modes_and_job_types_raise(spark, path):
    with pytest.raises(ValueError, match="mode"):
        storage.write_table(spark.range(1), path, "merge")
    with pytest.raises(ValueError, match="job type"):
        storage.save_sets(spark.range(1), spark.range(1), (path, path), path, job_type="other")


def test_save_sets_by_job_type(spark, path):
    train, test = spark.range(4), spark.range(2)
    storage.save_sets(train, test, (path + "1", path + "2"), path + "3")
    storage.save_sets(train, test, (path + "4", path + "5"), path + "3", job_type="inference")
    counts = [storage.row_count(spark, path + str(i)) for i in range(1, 6)]
    assert counts == [4, 2, 2, 0, 0]
    assert "update_timestamp_utc" in storage.read_table(spark, path + "3").columns


def test_csv_is_read_with_the_given_schema(spark, path):
    row = tables.ensure_columns(spark.range(1).toDF("lead_time"), {f.name: "string" for f in BOOKING})
    row.select(*BOOKING.names).write.option("header", True).csv(path)
    assert storage.read_bookings_csv(spark, path).schema == BOOKING
    assert storage.read_bookings_csv(spark, path).first()["lead_time"] == 0
    row.select(*reversed(BOOKING.names)).write.option("header", True).csv(path + "2")
    with pytest.raises(Exception, match="CSV header"):
        storage.read_bookings_csv(spark, path + "2").collect()


def test_table_names_check_the_environment():
    block = dict(
        catalog_name="c",
        schema_name="s",
        train_table="t",
        test_table="u",
        feature_table_name="f",
        batch_inference_table="b",
        volume_name="v",
    )
    names = TableNames.for_env({"dev": block}, "dev")
    assert names.qualified(names.train_table) == "c.s.t" and names.extra == {"volume_name": "v"}
    with pytest.raises(ValueError, match="environment"):
        TableNames.for_env({"dev": block}, "test")


def test_scratch_lies_in_the_shared_folder(spark, path):
    root = spark.conf.get("spark.checkpoint.dir")
    assert shared_root(spark) == root and scratch_path(spark, "x").startswith(root)
    spark.range(1).write.parquet(path)
    assert exists(spark, path) and not is_file(spark, path) and not exists(spark, path + "none")


# Feature table


def test_feature_lookup_keeps_rows_once(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("z", 3)], "Booking_ID string, n int")
    feat = spark.createDataFrame(
        [("a", 1, 1, 1), ("a", 2, 2, 2)],
        "Booking_ID string, no_of_previous_cancellations int, no_of_previous_bookings_not_canceled int, ts int",
    )
    got = features.feature_lookup(df, feat, order_by="ts")
    assert rows(got) == [("a", 1, 2, 2), ("a", 2, 2, 2), ("z", 3, None, None)]


def test_refresh_twice_adds_no_copies(spark):
    schema = (
        "Booking_ID string, no_of_previous_cancellations int, no_of_previous_bookings_not_canceled int, "
        "update_timestamp_utc int"
    )
    train = spark.createDataFrame([("a", 0, 0, 1), ("b", 1, 1, 2)], schema)
    test = spark.createDataFrame([("c", 2, 2, 5), ("b", 9, 9, 5)], schema)
    table = features.feature_table(train, test)
    assert rows(table) == [("a", 0, 0), ("b", 9, 9), ("c", 2, 2)]
    again = features.feature_refresh(features.feature_refresh(table, train, test), train, test)
    assert rows(again) == rows(table)


def test_newest_rows_are_filtered_in_the_scan(spark, path):
    spark.range(10).select(F.col("id").alias("update_timestamp_utc")).write.parquet(path)
    df = features.newest(spark.read.parquet(path))
    assert rows(df) == [(9,)]


def test_sql_function_matches_the_expression(spark):
    name = features.register_total_nights(spark)
    df = spark.createDataFrame([(1, 2), (None, 1)], "no_of_weekend_nights int, no_of_week_nights int")
    bindings = {c: c for c in df.columns}
    called = features.apply_function(df, name, "n", bindings)
    built = features.apply_function(df, features.total_nights_of, "n", bindings)
    assert rows(called, "n") == rows(built, "n") == [(3,), (None,)]


def test_parameters_are_bound_by_name(spark):
    df = spark.createDataFrame([(7, 2)], "x int, y int")
    out = features.apply_function(df, lambda a, b: a - b, "n", {"b": "y", "a": "x"})
    assert rows(out, "n") == [(5,)]
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION minus_of(a INT, b INT) RETURNS INT RETURN a - b")
    assert rows(features.apply_function(df, "minus_of", "n", {"b": "y", "a": "x"}), "n") == [(5,)]


def test_repeated_and_null_source_keys(spark):
    target = spark.createDataFrame([("a", 1), (None, 5)], "k string, v int")
    twice = spark.createDataFrame([("a", 2), ("a", 9)], "k string, v int")
    with pytest.raises(Exception, match="repeated k"):
        tables.upsert(target, twice, "k").collect()
    assert rows(tables.upsert(target, twice, "k", "v")) == [("a", 9), (None, 5)]
    for order in (None, "v"):
        with pytest.raises(Exception, match="null k"):
            tables.upsert(target, spark.createDataFrame([(None, 2)], "k string, v int"), "k", order).collect()


def test_null_ids_are_seen_once(spark):
    held = spark.createDataFrame([(None, 0), ("a", 0)], "id string, pos int")
    assert rows(tables.unseen(held, held, ["id", "pos"])) == []


def test_ties_of_map_columns(spark):
    df = spark.createDataFrame([(1, {"a": 1}), (1, {"b": 2})], "k int, m map<string,int>")
    assert tables.latest_per_key(df, "k").collect()[0]["m"] == {"b": 2}


def test_bucketed_appends(spark, path):
    df = spark.range(60).select(F.col("id").cast("string").alias("k"), "id")
    storage.write_table(df.filter("id < 50"), path, "append", "k", buckets=4)
    storage.write_table(df.filter("id >= 50"), path, "append", "k")
    assert storage.read_table(spark, path).count() == 60
    with pytest.raises(ValueError, match="4 key buckets"):
        storage.write_table(df, path, "append", "k", buckets=8)
    storage.write_table(df.withColumn("id", F.col("id") + 100), path, "upsert", "k")
    assert storage.read_table(spark, path).agg(F.count("*"), F.min("id")).first()[:] == (60, 100)


def test_partitioned_named_tables(spark):
    spark.sql("DROP TABLE IF EXISTS parted")
    df = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "k string, v int, p string")
    df.write.partitionBy("p").saveAsTable("parted")
    storage.write_table(spark.createDataFrame([("c", "x", 3)], "k string, p string, v int"), "parted", "append", "k")
    storage.write_table(spark.createDataFrame([("a", 9, "x", 1)], "k string, v int, p string, n int"), "parted", "upsert", "k")
    assert rows(spark.table("parted"), "k", "v", "p", "n") == [("a", 9, "x", 1), ("b", 2, "y", None), ("c", 3, "x", None)]
    assert spark.catalog.listColumns("parted")[-1].isPartition
    spark.sql("DROP TABLE parted")


def test_an_upsert_leaves_no_other_folder(spark, path):
    storage.write_table(spark.createDataFrame([("a", 1)], "k string, v int"), path, "overwrite", "k")
    storage.write_table(spark.createDataFrame([("a", 2), ("b", 3)], "k string, v int"), path, "upsert", "k")
    assert rows(storage.read_table(spark, path)) == [("a", 2), ("b", 3)]
    import pathlib

    assert [p.name for p in pathlib.Path(path).parent.iterdir()] == ["table"]


# Named tables in key folders


def files_of(spark, name) -> dict[str, list[str]]:
    out: dict[str, list[str]] = {}
    for f in spark.table(name).inputFiles():
        folder, file = f.rsplit("/", 2)[1:]
        out.setdefault(folder, []).append(file)
    return {k: sorted(v) for k, v in out.items()}


def test_upsert_of_a_named_table_leaves_other_folders_alone(spark):
    name = "bucketed"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    many = spark.range(200).selectExpr("concat('k', id) AS Booking_ID", "CAST(id AS INT) AS v")
    storage.write_table(many, name, "overwrite", buckets=8)
    assert storage.bucket_count(spark, name) == 8 and "key_bucket" not in storage.read_table(spark, name).columns
    before = files_of(spark, name)
    source = spark.createDataFrame([("k7", 1000, "x"), ("new", 1, "y")], "Booking_ID string, v int, extra string")
    touched = {f"key_bucket={r[0]}" for r in storage.with_bucket(source, "Booking_ID", 8).select("key_bucket").collect()}
    storage.write_table(source, name, "upsert")
    after = files_of(spark, name)
    assert {k for k in before if before[k] != after[k]} == touched
    got = storage.read_table(spark, name)
    assert got.count() == 201 and rows(got.filter("extra IS NOT NULL")) == [("k7", 1000, "x"), ("new", 1, "y")]
    storage.write_table(many.filter("v < 3").selectExpr("concat('m', v) AS Booking_ID", "v"), name, "append")
    assert storage.read_table(spark, name).count() == 204
    with pytest.raises(ValueError):
        storage.write_table(many, name, "append", buckets=3)
    spark.sql(f"DROP TABLE {name}")


def test_upsert_fills_an_empty_key_folder_of_a_named_table(spark):
    name = "bucketed_small"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    storage.write_table(spark.createDataFrame([("a", 1)], "Booking_ID string, v int"), name, "upsert", buckets=8)
    storage.write_table(spark.createDataFrame([(f"b{i}", i) for i in range(30)], "Booking_ID string, v int"), name, "upsert")
    assert storage.read_table(spark, name).count() == 31 and len(files_of(spark, name)) == 8
    spark.sql(f"DROP TABLE {name}")


def test_a_folder_left_aside_is_put_back(spark, path):
    import os

    many = spark.range(100).selectExpr("concat('k', id) AS Booking_ID", "CAST(id AS INT) AS v")
    storage.write_table(many, path, "overwrite", buckets=4)
    os.makedirs(f"{path}__old")
    os.rename(f"{path}/key_bucket=1", f"{path}__old/key_bucket=1")  # a crash between the two renames
    storage.write_table(spark.createDataFrame([("k5", -5)], many.schema), path, "upsert")
    assert storage.read_table(spark, path).count() == 100
    assert rows(storage.read_table(spark, path).filter("v < 0")) == [("k5", -5)]


def test_markers_alone_are_no_table(spark, path):
    spark.range(4, 5).write.json(f"{path}/_key_buckets")
    assert not storage.table_exists(spark, path)
    storage.write_table(spark.createDataFrame([("a", 1)], "Booking_ID string, v int"), path, "upsert", buckets=4)
    assert rows(storage.read_table(spark, path)) == [("a", 1)] and storage.bucket_count(spark, path) == 4
