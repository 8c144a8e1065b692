"""Inference requests and responses held as JSON text, to and from monitoring rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodgeline.functions.columns import CANCEL_FLAG, encode_label, epoch_ms, iso_text
from lodgeline.operators.cleaning import drop_null_or_keep, require
from lodgeline.schemas import FEATURES, RECORD, type_of

REQUEST = T.StructType([T.StructField("dataframe_records", T.ArrayType(RECORD))])
SPLIT = T.StructType(
    [
        T.StructField(
            "dataframe_split",
            T.StructType(
                [
                    T.StructField("columns", T.ArrayType(T.StringType())),
                    T.StructField("data", T.ArrayType(T.ArrayType(T.StringType()))),
                ]
            ),
        )
    ]
)
RESPONSE = T.StructType([T.StructField("predictions", T.ArrayType(T.StringType()))])


def _requests(payload: DataFrame, form: str) -> DataFrame:
    """Payload with its parsed records: an array of structs, or of cell arrays with `names` beside it.

    Bad JSON gives null, a field of the wrong type gives null.
    """
    if form == "records":
        return payload.withColumn("records", F.from_json("request", REQUEST)["dataframe_records"])
    if form != "split":
        raise ValueError(f"unknown request form {form!r}, expected 'records' or 'split'")
    parsed = payload.withColumn("split", F.from_json("request", SPLIT)["dataframe_split"])
    return parsed.withColumns({"names": F.col("split.columns"), "records": F.col("split.data")})


def _feature(c: str, form: str) -> Column:
    if form == "records":
        return F.col("record")[c]
    # Position 0 means the column was not sent; index -1 then reads null.
    place = (F.array_position("names", c) - 1).cast("int")
    return F.get("record", place).try_cast(type_of(c))


def flatten(
    payload: DataFrame,
    keep_failed: bool = False,
    form: str = "records",
    model_name: str = "",
    time_column: str = "request_time",
    id_column: str = "request_id",
) -> DataFrame:
    """One monitoring row per request record, with the prediction at the record's position.

    Without `keep_failed`, rows without a known label are dropped, unless that leaves none.
    """
    flat = flatten_rows(payload, form, model_name, time_column, id_column)
    return flat if keep_failed else drop_null_or_keep(flat, "prediction")


def flatten_rows(
    payload: DataFrame,
    form: str = "records",
    model_name: str = "",
    time_column: str = "request_time",
    id_column: str = "request_id",
) -> DataFrame:
    """The row-wise part of `flatten`, which also runs on streams."""
    columns = [
        F.col(time_column).alias("timestamp"),
        epoch_ms(payload, time_column).alias("timestamp_ms"),
        F.col(id_column),
        F.col("execution_duration_ms"),
    ]
    parsed = _requests(payload, form).select(
        *columns,
        *(["names"] if form == "split" else []),
        "records",
        F.from_json("response", RESPONSE)["predictions"].alias("predictions"),
    )
    # An inner explode would put a filter on the parsed records below the parser, and parse thrice.
    exploded = parsed.select("*", F.posexplode_outer("records").alias("pos", "record")).filter("pos IS NOT NULL")
    answered = exploded.withColumn("raw", F.get("predictions", F.col("pos")))
    # A plain label is no JSON: asking it for a field would cost a caught exception per row.
    is_object = F.col("raw").startswith("{")
    labelled = answered.withColumns(
        {
            "label": F.when(is_object, F.get_json_object("raw", "$.label")).otherwise(F.col("raw")),
            "proba_text": F.when(is_object, F.get_json_object("raw", "$.probability")),
        }
    )
    return labelled.select(
        "timestamp",
        "timestamp_ms",
        id_column,
        "pos",
        "execution_duration_ms",
        *[_feature(c, form).alias(c) for c in FEATURES],
        encode_label("label", CANCEL_FLAG).cast("double").alias("prediction"),
        F.col("proba_text").try_cast("double").alias("probability"),
        F.lit(model_name).alias("model_name"),
    )


def build(df: DataFrame, columns: Sequence[str] = FEATURES, id_column: str = "Booking_ID") -> DataFrame:
    """One request per row with its features as JSON; timestamps become ISO text, nulls stay."""
    require(df, columns)

    def cell(c: str) -> Column:
        is_time = isinstance(df.schema[c].dataType, T.TimestampType | T.TimestampNTZType)
        return (iso_text(c) if is_time else F.col(c)).alias(c)

    body = F.struct(F.array(F.struct(*[cell(c) for c in columns])).alias("dataframe_records"))
    return df.select(id_column, F.to_json(body, {"ignoreNullFields": "false"}).alias("request"))
