"""Sources, sinks and table maintenance."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeline.functions.columns import ntz
from lodgeline.operators import tables as ops
from lodgeline.plans.registry import query
from lodgeline.plans.views import hash_of
from lodgeline.schemas import BOOKING_COLUMNS, KEY
from lodgeline.scratch import scratch_path
from lodgeline.sources import storage
from lodgeline.sources.fixtures import Tables, latest

H = hash_of()
SMALL = f"{KEY}, lead_time, booking_status"
RAW = ", ".join(BOOKING_COLUMNS)
OLD = f"SELECT {SMALL} FROM bookings WHERE {H} >= '33333333'"
NEW = f"SELECT {KEY}, lead_time + 1000 AS lead_time, booking_status FROM bookings WHERE {H} < '66666666'"
MERGED = """SELECT * FROM s UNION ALL
SELECT t.* FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.Booking_ID = t.Booking_ID)"""


def old_part(t: Tables) -> DataFrame:
    return t.change(0.2, 1.0).select(KEY, "lead_time", "booking_status")


def new_part(t: Tables) -> DataFrame:
    changed = t.change(0.0, 0.4).select(KEY, "lead_time", "booking_status")
    return changed.withColumn("lead_time", F.col("lead_time") + 1000)


@query("scan_bookings", "SELECT * FROM bookings")
def scan_bookings(t: Tables) -> DataFrame:
    return t.bookings


@query("csv_roundtrip", f"SELECT {RAW} FROM bookings")
def csv_roundtrip(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "csv")
    t.bookings.select(*BOOKING_COLUMNS).write.option("header", True).csv(path)
    return storage.read_bookings_csv(t.spark, path)


@query("write_overwrite", f"SELECT * FROM bookings WHERE {H} >= '80000000'")
def write_overwrite(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "overwrite")
    storage.write_table(t.change(0.0, 0.5), path, "overwrite")
    storage.write_table(t.change(0.5, 1.0), path, "overwrite")
    return storage.read_table(t.spark, path)


@query("write_append", "SELECT * FROM bookings")
def write_append(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "append")
    storage.write_table(t.change(0.0, 0.5), path, "append")
    storage.write_table(t.change(0.5, 1.0), path, "append")
    return storage.read_table(t.spark, path)


@query("write_upsert", f"WITH t AS ({OLD}), s AS ({NEW}) {MERGED}")
def write_upsert(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "upsert")
    storage.write_table(old_part(t), path, "overwrite", buckets=16)
    storage.write_table(new_part(t), path, "upsert")
    return storage.read_table(t.spark, path)


@query("write_upsert_named", f"WITH t AS ({OLD}), s AS ({NEW}) {MERGED}")
def write_upsert_named(t: Tables) -> DataFrame:
    """The same into a table of the catalog, which rewrites the key folders of the source only."""
    name = f"lodgeline_{uuid.uuid4().hex}"
    storage.write_table(old_part(t), name, "overwrite", buckets=16)
    storage.write_table(new_part(t), name, "upsert")
    return storage.read_table(t.spark, name)


@query(
    "schema_evolve_union",
    f"""SELECT {SMALL}, CAST(NULL AS VARCHAR) AS channel FROM bookings WHERE {H} < '80000000'
UNION ALL SELECT {SMALL}, 'web' AS channel FROM bookings WHERE {H} >= '80000000'""",
)
def schema_evolve_union(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "evolve")
    columns = [KEY, "lead_time", "booking_status"]
    storage.write_table(t.change(0.0, 0.5).select(*columns), path, "append")
    storage.write_table(t.change(0.5, 1.0).select(*columns, F.lit("web").alias("channel")), path, "append")
    return storage.read_table(t.spark, path)


@query("upsert_bookings", f"WITH t AS ({OLD}), s AS ({NEW}) {MERGED}")
def upsert_bookings(t: Tables) -> DataFrame:
    return ops.upsert(old_part(t), new_part(t), KEY)


@query(
    "write_audit",
    f"""WITH t AS ({OLD}), s AS ({NEW}), m AS ({MERGED}),
c AS (SELECT (SELECT count(*) FROM t) AS b, (SELECT count(*) FROM s) AS i, (SELECT count(*) FROM m) AS a)
SELECT b AS rows_before, i AS rows_incoming, a AS rows_after, a - b AS row_change,
 CASE WHEN a < b THEN 'data loss' WHEN a = b THEN 'no new rows' ELSE 'ok' END AS verdict FROM c""",
)
def write_audit(t: Tables) -> DataFrame:
    old, new = old_part(t), new_part(t)
    return ops.write_audit(old, new, ops.upsert(old, new, KEY), "upsert")


@query(
    "ensure_prediction_cols",
    """SELECT Booking_ID, lead_time, CAST(NULL AS VARCHAR) AS booking_status_pred_basic,
 CAST(NULL AS VARCHAR) AS booking_status_pred_custom, CAST(NULL AS DOUBLE) AS booking_status_proba_custom
FROM bookings""",
)
def ensure_prediction_cols(t: Tables) -> DataFrame:
    columns = {
        "lead_time": "int",
        "booking_status_pred_basic": "string",
        "booking_status_pred_custom": "string",
        "booking_status_proba_custom": "double",
    }
    return ops.ensure_columns(t.bookings.select(KEY, "lead_time"), columns)


@query(
    "stamp_ingest",
    """SELECT Booking_ID, lead_time, (SELECT max(update_timestamp_utc) FROM bookings) AS update_timestamp_utc
FROM bookings""",
)
def stamp_ingest(t: Tables) -> DataFrame:
    as_of = latest(t.raw("orders"), "o_orderdate")
    return ops.stamp(t.bookings.select(KEY, "lead_time"), as_of)


@query(
    "change_feed",
    f"""WITH t AS ({OLD}),
n AS (SELECT {KEY}, lead_time + CASE WHEN {H} < '66666666' THEN 1000 ELSE 0 END AS lead_time, booking_status
  FROM bookings WHERE {H} < 'cccccccd')
SELECT coalesce(n.Booking_ID, t.Booking_ID) AS Booking_ID,
 CASE WHEN t.Booking_ID IS NULL THEN 'insert' WHEN n.Booking_ID IS NULL THEN 'delete' ELSE 'update' END AS change_type,
 CASE WHEN n.Booking_ID IS NULL THEN t.lead_time ELSE n.lead_time END AS lead_time,
 CASE WHEN n.Booking_ID IS NULL THEN t.booking_status ELSE n.booking_status END AS booking_status
FROM t FULL OUTER JOIN n ON t.Booking_ID = n.Booking_ID
WHERE t.Booking_ID IS NULL OR n.Booking_ID IS NULL
 OR t.lead_time IS DISTINCT FROM n.lead_time OR t.booking_status IS DISTINCT FROM n.booking_status""",
)
def change_feed(t: Tables) -> DataFrame:
    old = old_part(t)
    new = new_part(t).unionByName(t.change(0.4, 0.8).select(*old.columns))
    return ops.change_feed(old, new, KEY)


@query("history_union", "SELECT * FROM bookings")
def history_union(t: Tables) -> DataFrame:
    train, test = t.change(0.2, 1.0), t.change(0.0, 0.2)
    return ops.union_by_name(train, test.select(*reversed(test.columns))).select(*train.columns)


@query(
    "latest_per_key",
    """SELECT user_id, event_id, ts, value FROM (
 SELECT user_id, event_id, ts, value,
  row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC, value DESC) AS rn FROM events)
WHERE rn = 1""",
)
def latest_per_key(t: Tables) -> DataFrame:
    return ops.latest_per_key(t.events.select("user_id", "event_id", "ts", "value"), "user_id", "ts")


@query(
    "table_probe",
    """SELECT 'stored by path' AS name, TRUE AS found, count(*) AS n_rows FROM bookings
UNION ALL SELECT 'stored by name', TRUE, count(*) FROM bookings
UNION ALL SELECT 'missing path', FALSE, count(*) FILTER (Booking_ID IS NULL) FROM bookings
UNION ALL SELECT 'missing name', FALSE, count(*) FILTER (Booking_ID IS NULL) FROM bookings""",
)
def table_probe(t: Tables) -> DataFrame:
    """Whether tables exist, and how many rows they have; a missing one counts none."""
    path, name = scratch_path(t.spark, "probe"), f"lodgeline_{uuid.uuid4().hex}"
    for place in (path, name):
        storage.write_table(t.bookings.select(KEY, "lead_time"), place)
    places = {"stored by path": path, "stored by name": name, "missing path": f"{path}-none", "missing name": f"{name}_none"}
    rows = [(k, storage.table_exists(t.spark, p), storage.row_count(t.spark, p)) for k, p in places.items()]
    return t.spark.createDataFrame(rows, "name string, found boolean, n_rows long")


@query(
    "write_modes",
    f"""WITH t AS ({OLD}), s AS ({NEW}), m AS ({MERGED})
SELECT 'overwrite' AS mode, 'written' AS outcome, count(*) AS n_rows, CAST(sum(lead_time) AS BIGINT) AS lead_times FROM s
UNION ALL SELECT 'append', 'written', count(*), CAST(sum(lead_time) AS BIGINT) FROM (SELECT * FROM t UNION ALL SELECT * FROM s)
UNION ALL SELECT 'upsert', 'written', count(*), CAST(sum(lead_time) AS BIGINT) FROM m
UNION ALL SELECT 'replace', 'refused', count(*), CAST(sum(lead_time) AS BIGINT) FROM t""",
)
def write_modes(t: Tables) -> DataFrame:
    """The same rows written over the same table in every mode, and in one that there is not."""
    parts = []
    for mode in (*storage.MODES, "replace"):
        path = scratch_path(t.spark, f"mode-{mode}")
        storage.write_table(old_part(t), path)
        try:
            storage.write_table(new_part(t), path, mode)
            outcome = "written"
        except ValueError:
            outcome = "refused"
        total = storage.read_table(t.spark, path).agg(F.count("*").alias("n_rows"), F.sum("lead_time").alias("lead_times"))
        parts.append(total.select(F.lit(mode).alias("mode"), F.lit(outcome).alias("outcome"), "n_rows", "lead_times"))
    return reduce(DataFrame.unionAll, parts)
