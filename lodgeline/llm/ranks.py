"""Gapless numbers along an order, for tables of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgeline.llm.common import staged


def numbered(rows: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """`rows` with numbers from 1 along `order`, which should settle all ties.

    Rows are dealt to partitions by ranges of the order, and each partition numbers its own rows. The result is
    written, so the partitions are fixed; their sizes are added up, one number per partition.
    """
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    held = staged(sorted_rows, "ranges").withColumn("_part", F.shiftright("_id", 33))
    sizes = {r["_part"]: r["n"] for r in held.groupBy("_part").agg(F.count("*").alias("n")).collect()}
    starts, total = [], 0
    for part in sorted(sizes):
        starts.append((part, total))
        total += sizes[part]
    offsets = rows.sparkSession.createDataFrame(starts, "_part long, _start long")
    within = F.col("_id").bitwiseAND(F.lit(2**33 - 1))
    out = held.join(F.broadcast(offsets), "_part").withColumn(name, F.col("_start") + within + 1)
    return out.drop("_part", "_start", "_id")
