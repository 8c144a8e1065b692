"""A third of all rows on one key: plans must split it or cut it before the shuffle."""

from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lodgeline.operators import features, kpi, tables

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def strict(spark):
    old = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


@pytest.fixture
def hot(strict, path):
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), "id"))
    df = strict.range(0, 60_000, 1, 16).select(key.alias("Booking_ID"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    df.write.parquet(path)
    return strict.read.parquet(path)


def final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    query = df._jdf.queryExecution()
    df.collect()
    return query.executedPlan().toString()


def test_lookup_splits_a_hot_booking(hot):
    feat = hot.select("Booking_ID").distinct().withColumns(
        {c: F.lit(1) for c in ("no_of_previous_cancellations", "no_of_previous_bookings_not_canceled")}
    )
    out = features.feature_lookup(hot, feat)
    assert "skew=true" in final_plan(out)
    assert out.count() == 60_000


def test_upsert_splits_a_hot_target_key(hot):
    source = hot.filter("Booking_ID LIKE 'k1%'").withColumn("v", F.lit("new"))
    out = tables.upsert(hot, source)
    assert "skew=true" in final_plan(out)
    assert out.count() == 60_000


def test_upsert_of_a_hot_source_key_sends_one_row_per_task(hot):
    out = tables.upsert(hot.filter("Booking_ID <> 'hot'"), hot.filter("Booking_ID = 'hot'"), order_by="v")
    assert out.filter("Booking_ID = 'hot'").count() == 1 and out.count() == 40_001


def test_change_feed_survives_copies_on_both_sides(hot):
    assert tables.change_feed(hot, hot.withColumn("v", F.upper("v"))).count() == 40_001


def test_distinct_measures_collapse_copies_before_the_shuffle(hot):
    df = hot.withColumns(
        {
            "booking_status": F.lit("Canceled"),
            "avg_price_per_room": F.lit(1.0),
            "lead_time": F.lit(1),
        }
    )
    out = kpi.measures(df, ["nb_bookings", "revenue_estimated"])
    assert rows(out) == [(40_001, 60_000.0)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "SortAggregate" not in plan and "partial_max" in plan
