"""Micro-batches as folders: each is written once under its number, and old ones are folded into one.

A batch that is run again replaces its own folder, so nothing counts twice. A fold sums up all batches up to a number
in a folder of its own, beside them; readers take the fold that was finished last and only the batches after it, so a
crash at any point neither loses nor doubles a row.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from lodgeline.files import children, delete, exists

BATCH = "batch_id"
FOLD = "upto"
#: Batches that may stand unfolded.
OPEN = 32

Fold = Callable[[DataFrame], DataFrame]


def _finished(spark: SparkSession, path: str, names: list[str], kind: str) -> list[int]:
    numbers = (int(n.split("=")[1]) for n in names if n.startswith(f"{kind}="))
    return sorted(k for k in numbers if exists(spark, f"{path}/{kind}={k}/_SUCCESS"))


def _folders(spark: SparkSession, path: str) -> tuple[int, list[int]]:
    """Number of the last batch that is folded (-1: none), and the batches after it."""
    names = children(spark, path)
    folded = max(_finished(spark, path, names, FOLD), default=-1)
    return folded, [k for k in _finished(spark, path, names, BATCH) if k > folded]


def put(df: DataFrame, path: str, batch_id: int, by: Sequence[str] = ()) -> None:
    """Write a batch, in folders by the columns `by`. A batch that is folded already is not written again."""
    spark = df.sparkSession
    if batch_id <= _folders(spark, path)[0]:
        return
    df.write.mode("overwrite").partitionBy(*by).parquet(f"{path}/{BATCH}={batch_id}")


def read_batches(spark: SparkSession, path: str, schema: StructType, before: int | None = None) -> DataFrame:
    """All rows written so far, or in batches before `before`, with the number of their batch.

    Folded rows carry the number of the last batch folded with them. Empty before the first batch.
    """
    folded, own = _folders(spark, path)
    full = StructType([*schema.fields, StructField(BATCH, IntegerType())])
    own = [k for k in own if before is None or k < before]
    parts = []
    if folded >= 0:
        parts.append(spark.read.schema(schema).parquet(f"{path}/{FOLD}={folded}").withColumn(BATCH, F.lit(folded)))
    if own:
        # One scan; the path itself is the base, so that the batch's number is a partition column.
        places = [f"{path}/{BATCH}={k}" for k in own]
        parts.append(spark.read.schema(full).option("basePath", path).parquet(*places))
    if not parts:
        return spark.createDataFrame([], full)
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def fold(
    spark: SparkSession, path: str, schema: StructType, step: Fold, by: Sequence[str] = (), most: int = OPEN, before: int | None = None
) -> bool:
    """Fold all batches, or those before `before`, once more than `most` of them stand open; `step` sums them up.

    Only batches that the stream has finished may be folded: the one that is running is not one of them.
    """
    _, own = _folders(spark, path)
    own = [k for k in own if before is None or k < before]
    if len(own) <= most:
        return False
    rows = read_batches(spark, path, schema, own[-1] + 1).drop(BATCH)
    step(rows).write.mode("overwrite").partitionBy(*by).parquet(f"{path}/{FOLD}={own[-1]}")
    # From here on readers take the new fold; what it holds is only in the way.
    for name in children(spark, path):
        kind, _, k = name.partition("=")
        if (kind == BATCH and int(k) <= own[-1]) or (kind == FOLD and int(k) < own[-1]):
            delete(spark, f"{path}/{name}")
    return True
