"""Keyed table maintenance as DataFrame functions: evolve, dedupe, upsert, diff, audit."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodgeline.functions.columns import col
from lodgeline.operators.cleaning import require
from lodgeline.schemas import INGESTED_AT, KEY


def ensure_columns(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Add missing columns as typed nulls; columns already there stay as they are."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns})


def stamp(df: DataFrame, as_of: Column | None = None, column: str = INGESTED_AT) -> DataFrame:
    return df.withColumn(column, F.current_timestamp() if as_of is None else as_of)


def union_by_name(*frames: DataFrame) -> DataFrame:
    """Union by column name; a column one frame lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def latest_per_key(
    df: DataFrame,
    key: str | Sequence[str] = KEY,
    order_by: str | Sequence[str] | None = None,
) -> DataFrame:
    """One row per key: the greatest by `order_by`, then by the other columns, so ties are settled.

    Columns that have no order of their own, such as maps, are compared as JSON. The rank filter is pushed below the shuffle as a group limit: each task sends on at most one
    row of a key, so a hot key never gathers in one task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order = [] if order_by is None else [order_by] if isinstance(order_by, str) else list(order_by)
    ties = [c for c in df.columns if c not in keys and c not in order]
    ranked = [_orderable(df, c).desc_nulls_last() for c in order + ties] or [F.col(keys[0])]
    window = Window.partitionBy(*keys).orderBy(*ranked)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def _orderable(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType.simpleString()
    unordered = any(name in kind for name in ("map<", "variant"))
    return F.to_json(F.struct(column)) if unordered else F.col(column)


def one_per_key(source: DataFrame, key: str = KEY, order_by: str | None = None) -> DataFrame:
    """The source rows of an upsert: the latest of each key.

    Without an order a repeated key is an error when the rows are computed, and so is a null key in any case. Each
    task sends on two rows of a key at most.
    """
    named = F.when(F.col(key).isNull(), F.raise_error(F.lit(f"null {key} in the source of an upsert"))).otherwise(True)
    if order_by is not None:
        return latest_per_key(source, key, order_by).filter(named)
    window = Window.partitionBy(key).orderBy(F.lit(0))
    ranked = source.withColumn("_rank", F.row_number().over(window)).filter("_rank <= 2")
    message = F.concat(F.lit(f"repeated {key} without an order: "), F.col(key).cast("string"))
    single = F.when(F.col("_rank") == 2, F.raise_error(message)).otherwise(True)
    return ranked.filter(named).filter(single).drop("_rank")


def upsert(target: DataFrame, source: DataFrame, key: str = KEY, order_by: str | None = None) -> DataFrame:
    """Source rows replace target rows of the same key; other source rows are added.

    Several source rows of one key count as one, the latest by `order_by` or the time of ingestion; see `one_per_key`
    for sources without either. The anti join sees the plain source keys: small sources are broadcast by AQE, and a
    hot target key can be split.
    """
    require(target, [key])
    require(source, [key])
    order_by = order_by or (INGESTED_AT if INGESTED_AT in source.columns else None)
    kept = target.join(source.select(key), key, "left_anti")
    return union_by_name(kept, one_per_key(source, key, order_by))


def change_feed(old: DataFrame, new: DataFrame, key: str = KEY, order_by: str | None = None) -> DataFrame:
    """Rows that were inserted, updated or deleted between two versions of a keyed table.

    Updated rows carry their new values, deleted rows their last ones. Both sides are first cut
    to one row per key, which also partitions them for the join.
    """
    columns = [c for c in old.columns if c != key]
    require(new, [key, *columns])

    def side(df: DataFrame, name: str) -> DataFrame:
        return latest_per_key(df.select(key, *columns), key, order_by).select(
            F.col(key).alias(f"_{name}_key"), F.struct(*columns).alias(name)
        )

    before, after = side(old, "before"), side(new, "after")
    joined = before.join(after, F.col("_before_key") == F.col("_after_key"), "full_outer")
    kind = (
        F.when(F.col("_before_key").isNull(), "insert")
        .when(F.col("_after_key").isNull(), "delete")
        .otherwise("update")
    )
    changed = joined.filter(~F.col("before").eqNullSafe(F.col("after")))
    image = F.coalesce("after", "before")
    return changed.select(
        F.coalesce("_before_key", "_after_key").alias(key),
        kind.alias("change_type"),
        *[image[c].alias(c) for c in columns],
    )


# Verdicts of a write audit.
NO_NEW_ROWS = "no new rows"
DATA_LOSS = "data loss"
WRITE_OK = "ok"


def verdict(before: Column, after: Column, mode: str) -> Column:
    out = F.when(after < before, DATA_LOSS)
    if mode != "overwrite":
        out = out.when(after == before, NO_NEW_ROWS)
    return out.otherwise(WRITE_OK)


def write_audit(before: DataFrame | None, incoming: DataFrame, after: DataFrame, mode: str) -> DataFrame:
    """One row with the row counts around a write, their difference and a verdict.

    A table that did not exist before the write counts 0 rows.
    """

    def rows(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count("*").alias(name))

    counts = rows(after, "rows_after").crossJoin(F.broadcast(rows(incoming, "rows_incoming")))
    if before is None:
        counts = counts.withColumn("rows_before", F.lit(0).cast("bigint"))
    else:
        counts = counts.crossJoin(F.broadcast(rows(before, "rows_before")))
    return counts.select(
        "rows_before",
        "rows_incoming",
        "rows_after",
        (col("rows_after") - col("rows_before")).alias("row_change"),
        verdict(col("rows_before"), col("rows_after"), mode).alias("verdict"),
    )


def append_unseen(target: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target plus the incoming rows whose keys it does not hold yet."""
    return union_by_name(target, unseen(target, incoming, keys))


def unseen(target: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Incoming rows whose keys the target does not hold; nulls in keys are equal to each other."""
    held = target.select(*[F.col(k).alias(f"_held_{k}") for k in keys])
    same = [F.col(k).eqNullSafe(F.col(f"_held_{k}")) for k in keys]
    return incoming.join(held, same, "left_anti")
