"""The batch operators on streams: flatten requests, profile windows, ingest once, score and upsert.

Sinks are parquet folders and tables, not the memory sink, so nothing gathers on the driver. What `foreachBatch` writes
goes by the number of the micro-batch: one that is run again after a failure replaces what it had written.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, StructField, StructType

from lodgeline.files import is_file
from lodgeline.functions.columns import utc_instant, utc_wall
from lodgeline.operators.monitoring import profile_flags, profile_rates
from lodgeline.operators.payload import flatten_rows
from lodgeline.operators.tables import latest_per_key
from lodgeline.schemas import KEY
from lodgeline.sources.storage import KEY_BUCKET, last_batch, table_exists, touched_rows, with_bucket, write_table
from lodgeline.streaming.batches import BATCH, OPEN, fold, put, read_batches

Scorer = Callable[[DataFrame], DataFrame]
#: Folders by key hash of an ingest store. One should hold about 1 GB of keys when the store is folded.
BUCKETS = 64


def read_stream(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Stream of a parquet folder, or of one file, which is picked out of its folder by name."""
    reader = spark.readStream.schema(schema)
    if is_file(spark, path):
        folder, name = path.rsplit("/", 1)
        return reader.option("pathGlobFilter", name).parquet(folder)
    return reader.parquet(path)


def append_to(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Run what is available into a parquet folder, each row once."""
    return (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(path)
    )


def _per_batch(stream: DataFrame, checkpoint: str, step: Callable[[DataFrame, int], None]) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def flatten_stream(payload: DataFrame, keep_failed: bool = False, **options) -> DataFrame:
    """Monitoring rows of a stream of requests; failed calls are dropped unless kept."""
    flat = flatten_rows(payload, **options)
    return flat if keep_failed else flat.filter(F.col("prediction").isNotNull())


def profile_stream(log: DataFrame, ts: str = "timestamp", width: str = "30 minutes", by: str = "model_name") -> DataFrame:
    """The window of each call of a stream, and what counts there. Row by row: no state, and no call is too late."""
    start = utc_wall(F.window("_at", width)["start"]).alias("window_start")
    return log.withColumn("_at", utc_instant(ts)).select(start, by, *profile_flags())


def run_profile(flags: DataFrame, path: str, checkpoint: str, by: str = "model_name", most: int = OPEN) -> DataFrame:
    """Add up the calls of each window over all micro-batches, however late they come; returns all windows so far.

    Each micro-batch writes its own counts, which are additive. Reading sums them, and when more than `most` batches
    stand open the older ones are folded to one row per window.
    """
    keys, sums = ["window_start", by], [c for c in flags.columns if c not in ("window_start", by)]
    schema = flags.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums]).schema
    spark = flags.sparkSession

    def add_up(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])

    def step(batch: DataFrame, batch_id: int) -> None:
        put(add_up(batch), path, batch_id)
        fold(batch.sparkSession, path, schema, add_up, most=most, before=batch_id)

    _per_batch(flags, checkpoint, step).awaitTermination()
    return profile_rates(add_up(read_batches(spark, path, schema).drop(BATCH)))


def unseen_of(batch: DataFrame, path: str, schema: StructType, batch_id: int, key: str = KEY) -> DataFrame:
    """One row for each key of a batch that no earlier batch holds. `batch` has its key buckets.

    Of the store only the keys in the folders that the batch falls in are read.
    """
    stored_schema = StructType([*[f for f in schema if f.name == key], StructField(KEY_BUCKET, IntegerType())])
    stored = read_batches(batch.sparkSession, path, stored_schema, before=batch_id)
    touched = [r[0] for r in batch.select(KEY_BUCKET).distinct().collect()]  # at most as many numbers as buckets
    held = stored.filter(F.col(KEY_BUCKET).isin(touched)).select(key)
    return latest_per_key(batch, key).join(held, key, "left_anti").select(*schema.names, KEY_BUCKET)


def run_ingest(
    stream: DataFrame, path: str, checkpoint: str, key: str = KEY, buckets: int = BUCKETS, most: int = OPEN
) -> DataFrame:
    """Take in each key once, over all micro-batches, however late a copy comes.

    What is stored is the state, in folders by key hash. A micro-batch reads the keys of its own folders only, so its
    cost goes with its keys, not with the history. Rows without a key are one key, taken in with each batch that has one.
    """
    spark, schema = stream.sparkSession, stream.schema
    stored = StructType([*schema.fields, StructField(KEY_BUCKET, IntegerType())])

    def step(batch: DataFrame, batch_id: int) -> None:
        fresh = unseen_of(with_bucket(batch, key, buckets), path, schema, batch_id, key)
        put(fresh, path, batch_id, by=[KEY_BUCKET])
        # The rows of a folder meet, so that a fold has few files.
        together = lambda rows: rows.hint("rebalance", KEY_BUCKET)
        fold(batch.sparkSession, path, stored, together, by=[KEY_BUCKET], most=most, before=batch_id)

    _per_batch(stream, checkpoint, step).awaitTermination()
    return read_batches(spark, path, stored).select(*schema.names)


def score_stream(stream: DataFrame, scorer: Scorer, path: str, checkpoint: str) -> StreamingQuery:
    """Score rows as they come and append them."""
    return append_to(scorer(stream), path, checkpoint)


def score_batch(batch: DataFrame, batch_id: int, scorer: Scorer, name: str, label: str = "label", key: str = KEY, buckets: int = BUCKETS) -> None:
    """Score what a micro-batch brings and put it into a table in key folders, unless it has an answer there.

    Only the folders of the batch's keys are read and written. The batch's number is kept beside the data: a batch that
    was put in is skipped, and one that broke off is put in again over what it left, row for row the same.
    """
    spark = batch.sparkSession
    if batch_id <= last_batch(spark, name):
        return
    rows = latest_per_key(batch, key)
    if table_exists(spark, name):
        answered = touched_rows(rows, name, key).filter(F.col(label).isNotNull()).select(key)
        rows = rows.join(answered, key, "left_anti")
    write_table(scorer(rows), name, "upsert", key, buckets=buckets, batch_id=batch_id)


def run_scoring(
    stream: DataFrame, scorer: Scorer, name: str, checkpoint: str, label: str = "label", key: str = KEY, buckets: int = BUCKETS
) -> StreamingQuery:
    """Score rows as they come and upsert them, so that the table is right after every micro-batch.

    The scorer returns the table's columns. Rows without an answer in the table are scored when they come again.
    """
    return _per_batch(stream, checkpoint, lambda batch, batch_id: score_batch(batch, batch_id, scorer, name, label, key, buckets))
