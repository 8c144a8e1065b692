"""Rows that share a key, brought together in blocks of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeline.llm.common import staged


def dealt(rows: DataFrame, size: int, weight: str | None = None) -> DataFrame:
    """`rows` (with key and node) dealt to blocks named by (key, lo, hi), sorted by them.

    A key with more than 2 * `size` rows is cut into chunks of about `size`, and each pair of chunks (lo, hi) is a block
    of its own, so no task needs a whole hot key; `chunk` says which of the two a row belongs to. With `weight`, sizes
    are sums of that expression.
    """
    counts = rows.groupBy("key").agg((F.sum(F.expr(weight)) if weight else F.count("*")).alias("_size"))
    large = staged(counts.where(F.col("_size") > 2 * size), "large-keys")
    none = F.lit(0)
    if large.isEmpty():
        out = rows.withColumns({"chunk": none, "lo": none, "hi": none})
    else:
        usual = rows.join(large, "key", "left_anti").withColumns({"chunk": none, "lo": none, "hi": none})
        parts = F.ceil(F.col("_size") / size).cast("int")
        cut = rows.join(large, "key").withColumn("_parts", parts)
        cut = cut.withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("_parts")).cast("int"))
        cut = cut.withColumn("_other", F.explode(F.sequence(none, F.col("_parts") - 1)))
        cut = cut.withColumns({"lo": F.least("chunk", "_other"), "hi": F.greatest("chunk", "_other")})
        out = usual.union(cut.select(usual.columns))
    return out.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The blocks of a task's rows, which `dealt` has sorted."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        names = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "lo", "hi")])
        cuts = [0, *(np.flatnonzero((names[:, 1:] != names[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            name = tuple(names[:, a])
            if name != last:
                if held:
                    yield pa.Table.from_batches(held).combine_chunks()
                held, last = [], name
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()
