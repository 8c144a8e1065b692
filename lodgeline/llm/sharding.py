"""Shards cut from a Hilbert curve over several metadata columns.

Each document gets a cell: source and language by hash, length and id by their quantiles, all quantised to the same
number of bits. Cells are numbered along a Hilbert curve, rows are sorted by that number, and equal runs of rows are
cut from the order. Neighbours on the curve are neighbours in every dimension, so each shard spans short ranges of
length and id and few sources and languages, and readers can skip shards by any of them.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeline.llm.common import staged

OVERHEAD = 16


def hilbert_index(points: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of `points` (coordinates from 0 to 2**bits - 1).

    Turns coordinates into the transposed index by undoing the rotations from the top bit down, then Gray-decodes it
    and interleaves its bits.
    """
    x = points.astype(np.int64).T.copy()
    dims = len(x)
    for level in range(bits - 1, 0, -1):
        q, low = 1 << level, (1 << level) - 1
        for i in range(dims):
            turned = (x[i] & q) != 0
            swap = np.where(turned, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(turned, low, swap)
            x[i] ^= swap
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flip ^= np.where((x[-1] & (1 << level)) != 0, (1 << level) - 1, 0)
    x ^= flip
    out = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(dims):
            out = (out << 1) | ((x[i] >> level) & 1)
    return out


def _hashed(name: str, levels: int):
    return F.when(F.col(name).isNull(), 0).otherwise(F.pmod(F.crc32(F.col(name).cast("string").cast("binary")), F.lit(levels))).cast("int")


def curve_order(
    df: DataFrame, hashed: list[str], ranged: list[str], ties: list[str], bits: int = 5, name: str = "curve"
) -> DataFrame:
    """`df` with `curve` (place on the curve of its cell) and `place` (0 to n - 1 in the order of curve and `ties`).

    `hashed` columns are quantised by hash, `ranged` columns at their quantiles (a mergeable sketch of 2**bits - 1
    numbers). Nulls lie in the first level, and first among ties. The order is made by a range-partitioned sort: every
    partition numbers its own rows, and the partitions' sizes are added up. Nothing larger than one number per
    partition leaves the executors. Equal rows get neighbouring places in some order, which is written once and kept.
    """
    levels = 2**bits
    marks = [i / levels for i in range(1, levels)]
    cuts = {}
    if ranged:
        found = df.agg(*[F.percentile_approx(F.col(c).cast("double"), marks, 10_000).alias(c) for c in ranged]).first()
        cuts = {c: np.asarray(found[c] or [], float) for c in ranged}

    @F.pandas_udf("long")
    def place_on_curve(cells: pd.DataFrame) -> pd.Series:
        columns = [cells[c].to_numpy() for c in hashed]
        for c in ranged:
            v = cells[c].to_numpy(float)
            columns.append(np.where(np.isnan(v), 0, np.searchsorted(cuts[c], v, side="left")))
        return pd.Series(hilbert_index(np.stack(columns, axis=1), bits))

    cells = [_hashed(c, levels).alias(c) for c in hashed] + [F.col(c).cast("double").alias(c) for c in ranged]
    # Rows that tie in everything are spread by where they were read, so that no range has to hold them all.
    order = [name, *ties, "_salt"]
    ranked = (
        df.withColumns({name: place_on_curve(F.struct(*cells)), "_salt": F.xxhash64(F.monotonically_increasing_id())})
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id())
    )
    ranked = staged(ranked, "curve").withColumn("_part", F.shiftright("_id", 33))
    sizes = {r["_part"]: r["n"] for r in ranked.groupBy("_part").agg(F.count("*").alias("n")).collect()}
    starts, total = [], 0
    for part in sorted(sizes):
        starts.append((part, total))
        total += sizes[part]
    spark = df.sparkSession
    offsets = spark.createDataFrame(starts, "_part long, _start long")
    within = F.col("_id").bitwiseAND(F.lit(2**33 - 1))
    return (
        ranked.join(F.broadcast(offsets), "_part")
        .withColumn("place", F.col("_start") + within)
        .withColumn("total", F.lit(total).cast("long"))
        .drop("_part", "_start", "_id", "_salt")
    )


def hilbert_shards(documents: DataFrame, shards: int = 40, bits: int = 5) -> DataFrame:
    """Shard of every document, law `rows`: sizes differ by one row at most.

    Returns doc_id, size, text_crc32, law, shard, slot, grown_shard (null), curve. A null text counts as empty; null
    ids, sources, languages and lengths lie in the first level of their dimension; repeated rows are rows like any
    other; an empty table gives no rows. Other columns are ignored.
    """
    data = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    base = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.length(data) + OVERHEAD).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"),
        F.col("source").cast("string").alias("source"),
        F.col("lang").cast("string").alias("lang"),
    )
    ordered = curve_order(base, ["source", "lang"], ["size", "doc_id"], ["text_crc32", "doc_id"], bits)
    shard = F.expr(f"place * {shards} div total")
    first = F.expr(f"(shard * total + {shards - 1}) div {shards}")
    return ordered.withColumn("shard", shard).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        (F.col("place") - first).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "curve",
    )
