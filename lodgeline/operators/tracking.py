"""What a run used and made: fingerprints of tables, input contracts, and the registry as a table of events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodgeline.operators.models import LATEST_ALIAS, READY, check_schema

# Fingerprints


def _hashable(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType.simpleString()
    return F.to_json(F.struct(column)) if "map<" in kind or "variant" in kind else F.col(column)


def fingerprint(df: DataFrame) -> DataFrame:
    """One row: number of rows, a digest of columns and types, sum and xor of the row hashes, and a version made of them.

    The order of rows and of columns makes no difference, a changed cell or a repeated row does. All parts are sums, so
    they combine before the shuffle.
    """
    columns = sorted(df.columns)
    shape = ",".join(f"{c}:{df.schema[c].dataType.simpleString()}" for c in columns)
    # A null is no value of a hash function, so each cell says whether it is there.
    cells = [x for c in columns for x in (F.col(c).isNull(), _hashable(df, c))]
    h = F.xxhash64(F.lit(shape), *cells)
    half = F.shiftrightunsigned(h, 1).cast("decimal(20,0)")
    found = df.select(h.alias("h"), half.alias("half")).agg(
        F.count("*").alias("n_rows"),
        F.coalesce(F.sum("half"), F.lit(0)).cast("decimal(38,0)").alias("hash_sum"),
        F.coalesce(F.bit_xor("h"), F.lit(0)).cast("bigint").alias("hash_xor"),
    )
    parts = [F.col("n_rows"), F.lit(shape), F.col("hash_sum"), F.col("hash_xor")]
    return found.withColumn("version", F.substring(F.sha2(F.concat_ws("|", *[p.cast("string") for p in parts]), 256), 1, 16))


def input_version(df: DataFrame) -> str:
    return fingerprint(df).first()["version"]


# Input contracts


def record_schema(spark: SparkSession, schema: T.StructType, path: str) -> None:
    """Write a schema as JSON, beside the model that was fitted on it."""
    spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def recorded_schema(spark: SparkSession, path: str) -> T.StructType:
    import json

    return T.StructType.fromJson(json.loads(spark.read.text(path, wholetext=True).first()["value"].strip()))


class ContractError(ValueError):
    """The input does not hold what the model was fitted on."""


def conform(df: DataFrame, expected: T.StructType) -> DataFrame:
    """`df` with the expected columns in their recorded types.

    Columns of another type are converted if every value converts; otherwise, or if a column is missing, this stops
    with the columns that differ. One pass checks all columns, and none is made if no type differs.
    """
    off = [r for r in check_schema(df, expected).collect() if r["bad_rows"] or r["actual"] is None]
    if off:
        named = ", ".join(f"{r['column']} is {r['actual'] or 'missing'}, expected {r['expected']} ({r['bad_rows']} rows)" for r in off)
        raise ContractError(f"the input does not fit the model: {named}")
    actual = {f.name: f.dataType for f in df.schema}
    return df.withColumns({f.name: F.col(f.name).try_cast(f.dataType) for f in expected if actual[f.name] != f.dataType})


# The registry

EVENTS = (
    "event_id string, at timestamp, model_name string, kind string, subject string, value string, path string, f1_score double"
)
#: Kinds of events.
VERSION, ALIAS, STATUS = "version", "alias", "status"


def version_event(df: DataFrame, name: str, event_id: str, path: str, f1: float | None, at: Column) -> DataFrame:
    """The events of a new version that takes the latest alias, from a frame of one row."""

    def event(own: str, kind: str, value: str | None) -> Column:
        return F.struct(
            F.lit(own).alias("event_id"),
            at.alias("at"),
            F.lit(name).alias("model_name"),
            F.lit(kind).alias("kind"),
            F.lit(event_id).alias("subject"),
            F.lit(value).cast("string").alias("value"),
            F.lit(path).alias("path"),
            F.lit(f1).cast("double").alias("f1_score"),
        )

    return df.select(F.inline(F.array(event(event_id, VERSION, READY), event(f"{event_id}-alias", ALIAS, LATEST_ALIAS))))


def registry_of(events: DataFrame) -> DataFrame:
    """Versions of all models from the registry's events: model_name, version, status, alias, path, f1_score, event_id.

    Events are only ever added, so jobs that register at once need no lock: versions are numbered in the order of their
    events, by time, then id. An alias is held by the version that was given it last, and a status event changes the status
    from its time on. An event that was written twice counts once.
    """
    once = events.dropDuplicates(["model_name", "event_id"])
    order = Window.partitionBy("model_name").orderBy("at", "event_id")
    versions = once.filter(F.col("kind") == VERSION).withColumn("version", F.row_number().over(order).cast("bigint"))
    latest = F.struct("at", "event_id")
    holders = (
        once.filter(F.col("kind") == ALIAS)
        .groupBy("model_name", F.col("value").alias("alias"))
        .agg(F.max_by("subject", latest).alias("subject"))
        .groupBy("model_name", "subject")
        # A version with several aliases shows the one that is served.
        .agg(F.coalesce(F.max(F.when(F.col("alias") == LATEST_ALIAS, F.col("alias"))), F.min("alias")).alias("alias"))
    )
    statuses = once.filter(F.col("kind") == STATUS).groupBy("model_name", "subject").agg(F.max_by("value", latest).alias("changed"))
    named = versions.select("model_name", "version", "value", "path", "f1_score", F.col("event_id").alias("subject"))
    full = named.join(holders, ["model_name", "subject"], "left").join(statuses, ["model_name", "subject"], "left")
    return full.select(
        "model_name",
        "version",
        F.coalesce("changed", "value").alias("status"),
        "alias",
        "path",
        "f1_score",
        F.col("subject").alias("event_id"),
    )
