"""Feature table: build, refresh, look up, and the training set assembled from it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgeline.operators.tables import latest_per_key, union_by_name
from lodgeline.schemas import INGESTED_AT, KEY, LOOKUP_FEATURES, Roles

TOTAL_NIGHTS = "total_nights"


def feature_table(*sets: DataFrame, columns: Sequence[str] = LOOKUP_FEATURES, ts: str = INGESTED_AT) -> DataFrame:
    """Latest lookup features of each booking over all sets."""
    rows = union_by_name(*[s.select(KEY, *columns, ts) for s in sets])
    return latest_per_key(rows, KEY, ts).drop(ts)


def newest(source: DataFrame, ts: str = INGESTED_AT) -> DataFrame:
    """Rows at or after the greatest timestamp of the table, which reaches the scan as a filter."""
    return source.filter(F.col(ts) >= source.agg(F.max(ts)).scalar())


def feature_refresh(
    features: DataFrame,
    *sets: DataFrame,
    columns: Sequence[str] = LOOKUP_FEATURES,
    ts: str = INGESTED_AT,
) -> DataFrame:
    """Feature table with the newest rows of each set put in, one row per booking."""
    fresh = union_by_name(*[newest(s, ts).select(KEY, *columns, ts) for s in sets])
    fresh = latest_per_key(fresh, KEY, ts).drop(ts)
    return features.join(fresh.select(KEY), KEY, "left_anti").unionByName(fresh)


def feature_lookup(
    df: DataFrame,
    features: DataFrame,
    key: str = KEY,
    columns: Sequence[str] = LOOKUP_FEATURES,
    order_by: str | None = None,
) -> DataFrame:
    """Add lookup features by key; every row stays, once.

    Features are cut to one row per key first, which leaves them partitioned by the key. The join
    is on the key and its hash, so Spark shuffles both sides for it, and AQE can split a key that
    is hot in `df`; a join on the key alone would reuse the partitioning and could not be split.
    """
    kept = features.select(key, *columns, *([order_by] if order_by else []))
    unique = latest_per_key(kept, key, order_by).select(key, *columns, F.xxhash64(key).alias("_hash"))
    hashed = df.withColumn("_hash", F.xxhash64(key))
    return hashed.join(unique, [key, "_hash"], "left").select(*df.columns, *columns)


def total_nights_of(no_of_weekend_nights: Column, no_of_week_nights: Column) -> Column:
    return (no_of_weekend_nights + no_of_week_nights).cast("int")


def apply_function(df: DataFrame, function, output: str, bindings: Mapping[str, str]) -> DataFrame:
    """Add a column computed by a function whose parameters are bound to columns by name.

    `function` is a Python function of columns, or the name of an SQL function.
    """
    if isinstance(function, str):
        arguments = ", ".join(f"{p} => `{c}`" for p, c in bindings.items())
        return df.withColumn(output, F.expr(f"{function}({arguments})"))
    return df.withColumn(output, function(**{p: F.col(c) for p, c in bindings.items()}))


def register_total_nights(spark, name: str = "calculate_total_nights") -> str:
    """Session SQL function of two ints; its body is inlined, so no rows leave the JVM."""
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(no_of_weekend_nights INT, no_of_week_nights INT) "
        "RETURNS INT RETURN no_of_weekend_nights + no_of_week_nights"
    )
    return name


def training_set(train: DataFrame, features: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """Training rows with lookup features from the feature table and the function feature."""
    base = train.drop(*roles.lookup_features, INGESTED_AT)
    looked_up = feature_lookup(base, features, roles.key, roles.lookup_features)
    bindings = {c: c for c in ("no_of_weekend_nights", "no_of_week_nights")}
    with_nights = apply_function(looked_up, total_nights_of, TOTAL_NIGHTS, bindings)
    return with_nights.select(roles.key, *roles.features, TOTAL_NIGHTS, roles.target)
