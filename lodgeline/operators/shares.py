"""Totals and shares beside the groups of a grouped frame."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on these columns in which null matches null; the left columns are kept."""
    renamed = right.withColumnsRenamed({c: f"_r_{c}" for c in on})
    matches = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in on])
    return left.join(renamed, matches, how).drop(*[f"_r_{c}" for c in on])


def with_totals(grouped: DataFrame, within: Sequence[str], *totals: Column) -> DataFrame:
    """Add totals over the groups, or over the groups that agree in `within`.

    The grouped frame's shuffle is reused, so its input is read once. Unlike a window without
    partitions, no task holds all the groups. Without `within` the totals are one row.
    """
    if not within:
        return grouped.crossJoin(F.broadcast(grouped.agg(*totals)))
    return null_safe_join(grouped, grouped.groupBy(*within).agg(*totals), within)


def with_share(grouped: DataFrame, value: str, within: Sequence[str], name: str) -> DataFrame:
    """Add each row's share of the total of `value`, overall or among rows that agree in `within`."""
    total = f"_total_{value}"
    shared = with_totals(grouped, within, F.sum(value).alias(total))
    return shared.withColumn(name, F.col(value) / F.nullif(F.col(total), F.lit(0))).drop(total)
