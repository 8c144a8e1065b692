"""The recurring jobs end to end: prepare, train, score, refresh monitoring.

Each is one lineage from its source tables to a write; only counts, metrics and verdicts come
back to the caller.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodgeline.functions.columns import utc_day
from lodgeline.operators import models, tracking
from lodgeline.operators.cleaning import clean
from lodgeline.operators.payload import flatten
from lodgeline.operators.tables import ensure_columns, unseen, verdict
from lodgeline.schemas import KEY, Roles
from lodgeline.scratch import scratch_path
from lodgeline.sources.storage import (
    folder_columns,
    read_bookings_csv,
    read_table,
    row_count,
    save_sets,
    table_exists,
    write_table,
)

REQUEST_DATE = "request_date"


@dataclass(frozen=True)
class Written:
    """Outcome of a write: rows before, written and after, and the audit's verdict."""

    before: int
    incoming: int
    after: int
    verdict: str


def audited_write(df: DataFrame, name: str, mode: str, key: str = KEY, partition_by: str | None = None) -> Written:
    """Write and audit.

    The rows are staged in the shared folder first, so they are computed once, and all counts read file footers only.
    Accumulators would not do: they may count a task that is run again twice.
    """
    spark = df.sparkSession
    before = row_count(spark, name)
    staging = scratch_path(spark, "incoming")
    df.write.parquet(staging)
    incoming_rows = spark.read.schema(df.schema).parquet(staging)
    incoming = incoming_rows.count()
    write_table(incoming_rows, name, mode, key, partition_by=partition_by)
    after = row_count(spark, name)
    word = spark.range(1).select(verdict(F.lit(before), F.lit(after), mode)).first()[0]
    return Written(before, incoming, after, word)


def prepare_sets(
    spark: SparkSession,
    csv_path: str,
    names: tuple[str, str],
    inference_name: str,
    job_type: str = "training",
    mode: str = "overwrite",
    test: float = 0.2,
) -> None:
    """Read, clean and split bookings and store the sets. For inference all rows are stored."""
    rows = clean(read_bookings_csv(spark, csv_path))
    train, held_out = models.split(rows, test)
    save_sets(train, held_out if job_type == "training" else rows, names, inference_name, job_type, mode)


def days_of(payload: DataFrame, time_column: str = "request_time") -> list[date | None]:
    """The days of a request log, in UTC: at most one value for each day it spans. Only the times are read."""
    return [r[0] for r in payload.select(utc_day(payload, time_column).alias("d")).distinct().collect()]


def on_days(days: list[date | None], column: str = REQUEST_DATE) -> Column:
    """Whether a row lies on one of the days; a filter on a partition column that leaves out whole folders."""
    there = F.col(column).isin([d for d in days if d is not None])
    return there | F.col(column).isNull() if None in days else there


def stored_requests(spark: SparkSession, name: str, days: list[date | None], like: DataFrame) -> DataFrame:
    """Day, id and position of the stored requests of these days; other days' folders are not read."""
    keys = [REQUEST_DATE, "request_id", "pos"]
    held = read_table(spark, name, T.StructType([like.schema[k] for k in keys]))
    return held.select(*keys).filter(on_days(days))


def refresh_monitoring(payload: DataFrame, name: str, model_name: str, keep_failed: bool = False) -> Written:
    """Append the requests the monitoring table does not hold yet; an empty log changes nothing.

    The table is laid out in folders by the day of the request, in UTC. A refresh reads only the folders of its own days,
    however long the history is; a late request of an old day is matched in the folder of that day. A request's time
    belongs to its id.
    """
    spark = payload.sparkSession
    flat = flatten(payload, keep_failed, model_name=model_name)
    if table_exists(spark, name) and REQUEST_DATE not in folder_columns(spark, name):
        # A table that was stored without folders by day is compared as a whole.
        flat = unseen(read_table(spark, name), flat, ["request_id", "pos"])
        return audited_write(flat, name, "append")
    flat = flat.withColumn(REQUEST_DATE, utc_day(flat, "timestamp"))
    if table_exists(spark, name):
        held = stored_requests(spark, name, days_of(payload), flat)
        flat = unseen(held, flat, [REQUEST_DATE, "request_id", "pos"])
    return audited_write(flat, name, "append", partition_by=REQUEST_DATE)


def score_table(
    spark: SparkSession, name: str, scorer: models.Scorer, prediction: str, proba: str, key: str = KEY
) -> Written:
    """Score the table's unscored rows and put them back. Rows without an answer are tried again next time."""
    table = ensure_columns(read_table(spark, name), {prediction: "string", proba: "double"})
    todo = table.filter(F.col(prediction).isNull()).drop(prediction, proba)
    scored = scorer(todo).withColumns({prediction: F.col("label"), proba: F.col("probability")})
    return audited_write(scored.select(*table.columns), name, "upsert", key)


def score_with_registered(
    spark: SparkSession, registry_name: str, model_name: str, df: DataFrame
) -> DataFrame:
    """Rows with the answers of the version to serve, once they fit what it was fitted on; see `tracking.conform`."""
    path = champion_path(spark, registry_name, model_name)
    if path is None:
        raise ValueError(f"no version of {model_name} is registered in {registry_name}")
    return models.score(PipelineModel.load(path), tracking.conform(df, tracking.recorded_schema(spark, _schema_path(path))))


def champion_path(spark: SparkSession, registry_name: str, model_name: str) -> str | None:
    """Path of the version to serve, or None before the first."""
    if not table_exists(spark, registry_name):
        return None
    events = read_table(spark, registry_name).filter(F.col("model_name") == model_name)
    registry = tracking.registry_of(events)
    latest = models.registry_latest(registry, model_name)
    found = registry.join(latest, ["model_name", "version"], "left_semi").first()
    return found["path"] if found else None


def _schema_path(model_path: str) -> str:
    return f"{model_path}__input_schema"


def train_and_register(
    train: DataFrame,
    test: DataFrame,
    model_name: str,
    model_folder: str,
    registry_name: str,
    roles: Roles = Roles(),
    params: Mapping[str, float] | None = None,
    runs_name: str | None = None,
) -> dict:
    """Fit, compare with the champion on the test rows, and register if at least as good.

    The schema of the features is kept beside the model. With `runs_name`, the run's parameters, metrics and the
    fingerprint of its training rows are added to that table.
    """
    spark = train.sparkSession
    challenger = models.fit_lr(train, roles, **(params or {}))
    scored = models.score(challenger, test).withColumnRenamed("label", "challenger")
    path = champion_path(spark, registry_name, model_name)
    if path:
        scored = models.score(PipelineModel.load(path), scored.drop("prediction", "probability"))
        scored = scored.withColumnRenamed("label", "champion")
    gate = models.champion_gate(scored, roles.target, "challenger", "champion" if path else None).first()
    event_id = uuid.uuid4().hex
    if runs_name:
        metrics = models.weighted_metrics(scored, roles.target, "challenger")
        settings = {k: str(v) for k, v in (params or {}).items()}
        version = tracking.input_version(train)
        write_table(models.run_log(metrics, event_id, settings, model_name, F.current_timestamp(), version), runs_name, "append")
    if gate["register"]:
        features = [*roles.cat_features, *roles.num_features]
        path = f"{model_folder}/{model_name}/{event_id}"
        challenger.write().overwrite().save(path)
        tracking.record_schema(spark, train.select(*features).schema, _schema_path(path))
        # The model stands complete before its event names it.
        event = tracking.version_event(spark.range(1), model_name, event_id, path, gate["f1_challenger"], F.current_timestamp())
        write_table(event, registry_name, "append")
    return gate.asDict()
