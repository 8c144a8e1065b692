"""Column expressions. All are built-in expressions, so they stay in codegen."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodgeline.schemas import CANCELED, NOT_CANCELED

# The two codings of a label. They run in opposite directions.
CANCEL_FLAG = {CANCELED: 1.0, NOT_CANCELED: 0.0}
CLASS_INDEX = {CANCELED: 0, NOT_CANCELED: 1}
OUTCOME_HONORED = "Booking likely honored"
OUTCOME_CANCELED = "Booking likely canceled"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ntz(text: str) -> Column:
    """Timestamp without time zone, from its text."""
    return F.expr(f"timestamp_ntz'{text}'")


def bucket(ts: str | Column, unit: str = "hour") -> Column:
    """Start of the hour or day as a timestamp without time zone.

    It is found on the wall clock, so that no zone's clock change moves it.
    """
    wall = col(ts).cast("timestamp_ntz")
    day = F.to_date(wall).cast("timestamp_ntz")
    if unit == "day":
        return day
    if unit == "hour":
        return day + F.make_dt_interval(hours=F.hour(wall))
    raise ValueError(f"unknown unit {unit!r}, expected 'hour' or 'day'")


EPOCH = "1970-01-01 00:00:00"


def _since_epoch(ts: str | Column) -> Column:
    return (col(ts) - ntz(EPOCH)).cast("interval second")


def utc_instant(ts: str | Column) -> Column:
    """Instant of a zoneless timestamp that was taken in UTC, whatever the session's zone."""
    return F.timestamp_seconds(_since_epoch(ts).cast("decimal(18,6)"))


def utc_wall(instant: str | Column) -> Column:
    """Zoneless timestamp of an instant in UTC, whatever the session's zone."""
    seconds = (F.unix_micros(col(instant)).cast("decimal(20,0)") / 1000000).cast("decimal(18,6)")
    return ntz(EPOCH) + F.make_dt_interval(secs=seconds)


def utc_day(df: DataFrame, ts: str) -> Column:
    """Day of a timestamp in UTC, whatever the session's zone; zoneless timestamps are taken in UTC."""
    return F.to_date(utc_wall(ts) if isinstance(df.schema[ts].dataType, T.TimestampType) else col(ts))


def epoch_ms(df: DataFrame, ts: str) -> Column:
    """Epoch milliseconds with the sub-second part cut off."""
    if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        return _since_epoch(ts).cast("bigint") * 1000
    return F.unix_seconds(ts) * 1000


def iso_text(ts: str | Column) -> Column:
    """ISO text of a timestamp; microseconds appear only when there are some."""
    ts = col(ts)
    micros = F.date_format(ts, "SSSSSS")
    seconds = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    return F.when(micros == "000000", seconds).otherwise(F.concat(seconds, F.lit("."), micros))


def bin_width(c: str | Column, width: int = 20) -> Column:
    """Lower edge of the fixed-width bin; null stays null."""
    return (F.floor(col(c) / F.lit(width)) * width).cast("int")


def parse_proba(c: str | Column) -> Column:
    """Number held as text with a decimal point; null if it is none."""
    return col(c).try_cast("double")


def encode_label(c: str | Column, coding: Mapping[str, float | int]) -> Column:
    """Code of a label; null for anything that is not a known label."""
    out = F.lit(None)
    for label, code in coding.items():
        out = F.when(col(c) == label, F.lit(code)).otherwise(out)
    return out


def decode_label(c: str | Column, coding: Mapping[str, float | int]) -> Column:
    out = F.lit(None).cast("string")
    for label, code in coding.items():
        out = F.when(col(c) == F.lit(code), F.lit(label)).otherwise(out)
    return out


def outcome(c: str | Column) -> Column:
    return F.when(col(c) == NOT_CANCELED, OUTCOME_HONORED).otherwise(OUTCOME_CANCELED)


def key_hash(key: str | Column) -> Column:
    """First 32 bits of the key's MD5 as hex: spreads keys evenly and never depends on partitioning."""
    return F.substring(F.md5(col(key).cast("string")), 1, 8)


def hash_share(share: float) -> str:
    """Upper bound of `key_hash` that holds this share of all keys."""
    return f"{round(share * 0x100000000):08x}" if share < 1 else "g"

