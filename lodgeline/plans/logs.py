"""Request and response logs: flatten, build, append."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeline import jobs
from lodgeline.operators import payload as ops
from lodgeline.operators.tables import append_unseen
from lodgeline.plans.registry import query
from lodgeline.schemas import FEATURES
from lodgeline.scratch import scratch_path
from lodgeline.sources.fixtures import Tables, payload
from lodgeline.sources.storage import read_table

SENT = ("lead_time", "avg_price_per_room", "market_segment_type", "no_of_children")
TYPES = {c: "VARCHAR" if c in FEATURES[-3:] else "DOUBLE" if c == "avg_price_per_room" else "INT" for c in FEATURES}


def flat_sql(sent: tuple[str, ...] = SENT, where: str = "", extra: str = "CAST(NULL AS DOUBLE) AS probability") -> str:
    cells = ", ".join(c if c in sent else f"CAST(NULL AS {TYPES[c]}) AS {c}" for c in FEATURES)
    return f"""SELECT timestamp, timestamp_ms, request_id, pos, execution_duration_ms, {cells}, prediction, {extra},
 'lr-basic' AS model_name FROM requests{where}"""


SCORED = " WHERE prediction IS NOT NULL"


@query("payload_flatten", flat_sql(where=SCORED))
def payload_flatten(t: Tables) -> DataFrame:
    return ops.flatten(payload(t.events), model_name="lr-basic")


@query("payload_flatten_failed", flat_sql())
def payload_flatten_failed(t: Tables) -> DataFrame:
    return ops.flatten(payload(t.events), keep_failed=True, model_name="lr-basic")


@query(
    "payload_custom",
    flat_sql(where=SCORED, extra="CAST(CASE prediction WHEN 1 THEN 0.25 ELSE 0.75 END AS DOUBLE) AS probability"),
)
def payload_custom(t: Tables) -> DataFrame:
    return ops.flatten(payload(t.events, predictions="objects"), model_name="lr-basic")


@query("payload_split", flat_sql(sent=SENT[:3], where=SCORED))
def payload_split(t: Tables) -> DataFrame:
    return ops.flatten(payload(t.events, form="split"), form="split", model_name="lr-basic")


@query(
    "payload_build",
    """SELECT request_id, '{"dataframe_records":[{"timestamp":"' || strftime(timestamp, '%Y-%m-%dT%H:%M:%S') ||
 CASE WHEN epoch_us(timestamp) % 1000000 = 0 THEN '' ELSE strftime(timestamp, '.%f') END ||
 '","lead_time":' || coalesce(CAST(lead_time AS VARCHAR), 'null') ||
 ',"execution_duration_ms":' || CAST(execution_duration_ms AS VARCHAR) ||
 ',"market_segment_type":"' || market_segment_type ||
 '","prediction":' || coalesce(CAST(prediction AS VARCHAR), 'null') || '}]}' AS request
FROM inference_log""",
)
def payload_build(t: Tables) -> DataFrame:
    columns = ["timestamp", "lead_time", "execution_duration_ms", "market_segment_type", "prediction"]
    return ops.build(t.log, columns, "request_id")


@query("payload_incremental", flat_sql(where=SCORED))
def payload_incremental(t: Tables) -> DataFrame:
    """A second refresh over the whole log adds only what the first, over a third of it, had not seen."""
    first = ops.flatten(payload(t.events.filter(F.col("event_id") % 3 == 0)), model_name="lr-basic")
    again = ops.flatten(payload(t.events), model_name="lr-basic")
    return append_unseen(first, again, ["request_id", "pos"])


@query("monitoring_refresh", f"SELECT *, CAST(timestamp AS DATE) AS request_date FROM ({flat_sql(where=SCORED)}) f")
def monitoring_refresh(t: Tables) -> DataFrame:
    """A stored table in folders by day, refreshed with a third of the log, then with all of it, then again."""
    path = scratch_path(t.spark, "monitoring")
    for events in (t.events.filter(F.col("event_id") % 3 == 0), t.events, t.events):
        jobs.refresh_monitoring(payload(events), path, "lr-basic")
    return read_table(t.spark, path)


@query(
    "refresh_of_empty_log",
    f"SELECT 'no new rows' AS verdict, CAST(0 AS BIGINT) AS incoming, count(*) AS n_before, count(*) AS n_after FROM ({flat_sql(where=SCORED)}) f",
)
def refresh_of_empty_log(t: Tables) -> DataFrame:
    """A refresh without new requests changes nothing."""
    path = scratch_path(t.spark, "monitoring")
    jobs.refresh_monitoring(payload(t.events), path, "lr-basic")
    done = jobs.refresh_monitoring(payload(t.events.filter(F.col("event_id") < 0)), path, "lr-basic")
    columns = "verdict string, incoming long, n_before long, n_after long"
    return t.spark.createDataFrame([(done.verdict, done.incoming, done.before, done.after)], columns)
