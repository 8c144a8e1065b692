"""The streaming forms, run over the given tables until nothing is left to read."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeline.operators.models import score_linear
from lodgeline.operators.tables import ensure_columns
from lodgeline.plans.bookings import partly_scored
from lodgeline.plans.logs import SCORED, flat_sql
from lodgeline.plans.monitoring import PROFILE, rounded
from lodgeline.plans.registry import query
from lodgeline.schemas import KEY
from lodgeline.scratch import scratch_path
from lodgeline.sources.fixtures import INTERCEPT, LINEAR, Tables, bookings, inference_log, payload
from lodgeline.sources.storage import read_table, write_table
from lodgeline.streaming import streams


def stream(t: Tables, name: str) -> DataFrame:
    return streams.read_stream(t.spark, t.path(name), t.raw(name).schema)


def folders(t: Tables, label: str) -> tuple[str, str]:
    root = scratch_path(t.spark, label)
    return f"{root}/rows", f"{root}/checkpoint"


@query("payload_flatten_stream", flat_sql(where=SCORED))
def payload_flatten_stream(t: Tables) -> DataFrame:
    path, checkpoint = folders(t, "flatten")
    flat = streams.flatten_stream(payload(stream(t, "events")), model_name="lr-basic")
    streams.append_to(flat, path, checkpoint).awaitTermination()
    return t.spark.read.schema(flat.schema).parquet(path)


@query("profile_30min_stream", PROFILE)
def profile_30min_stream(t: Tables) -> DataFrame:
    path, checkpoint = folders(t, "profile")
    calls = streams.profile_stream(inference_log(stream(t, "events")))
    return rounded(streams.run_profile(calls, path, checkpoint), "positive_rate", "null_rate")


@query("ingest_dedup_stream", "SELECT Booking_ID, lead_time, booking_status FROM bookings")
def ingest_dedup_stream(t: Tables) -> DataFrame:
    """Every booking comes twice and is taken in once."""
    path, checkpoint = folders(t, "ingest")
    arriving = bookings(stream(t, "orders"), t.raw("customer")).select(KEY, "lead_time", "booking_status")
    return streams.run_ingest(arriving.unionAll(arriving), path, checkpoint)


@query(
    "score_stream",
    """SELECT Booking_ID, booking_status_pred_custom AS label, round(booking_status_proba_custom, 6) AS probability
FROM predictions""",
)
def score_stream(t: Tables) -> DataFrame:
    """A table of bookings, partly scored; the others are scored as they come and put into it batch by batch."""
    path, checkpoint = folders(t, "score")
    scored = partial(score_linear, coefficients=LINEAR, intercept=INTERCEPT)
    names = {"booking_status_pred_custom": "label", "booking_status_proba_custom": "probability"}
    table = partly_scored(t).select(KEY, *[F.col(c).alias(n) for c, n in names.items()])
    write_table(ensure_columns(table, {"label": "string"}), path, "overwrite", buckets=8)
    arriving = bookings(stream(t, "orders"), t.raw("customer")).select(KEY, *LINEAR)
    scorer = lambda rows: scored(rows).select(KEY, "label", "probability")
    streams.run_scoring(arriving, scorer, path, checkpoint).awaitTermination()
    return read_table(t.spark, path).select(KEY, "label", F.round("probability", 6).alias("probability"))
