"""Exact numbers of rows by the least values of a hash, without sorting rows or bringing them together."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgeline.functions.columns import key_hash
from lodgeline.schemas import KEY
from lodgeline.scratch import scratch_path

#: Hexadecimal digits of a hash that one counting pass settles: at most 65,536 numbers reach the driver.
DIGITS = 4


@dataclass(frozen=True)
class Bound:
    """A hash, and the greatest tie-break value that is within at that hash; no value: none is."""

    digest: str
    tie: object | None

    def within(self, digest: Column, tie: Column) -> Column:
        below = digest < self.digest
        if self.tie is not None:
            below = below | ((digest == self.digest) & (tie <= self.tie))
        return F.coalesce(below, F.lit(False))


def least(df: DataFrame, digest: Column, tie: Column, n: int, width: int = 8) -> Bound:
    """The bound that holds the `n` rows of least (digest, tie); `digest` is hexadecimal text of `width` digits.

    Each pass counts the rows by the next digits within the prefix found so far, so what is read narrows 65,536-fold,
    and ends at a few rows of one hash. Rows with equal hash and tie are within together, if they fit.
    """
    rows = df.select(digest.alias("_digest"), tie.alias("_tie")).filter("_digest IS NOT NULL")
    prefix, left = "", n
    while len(prefix) < width:
        size = min(len(prefix) + DIGITS, width)
        inside = rows.filter(F.col("_digest").startswith(prefix)) if prefix else rows
        counts = inside.groupBy(F.substring("_digest", 1, size).alias("p")).agg(F.count("*").alias("n")).collect()
        for p, count in sorted((r["p"], r["n"]) for r in counts):
            if count > left:
                prefix = p
                break
            left -= count
        else:
            return Bound("g", None)  # beyond all digits: every row is within
    last = None
    ties = rows.filter(F.col("_digest") == prefix).groupBy("_tie").agg(F.count("*").alias("n"))
    # Different ties of one hash; with 32 bits a four-billionth of all.
    for tie_value, count in sorted(((r["_tie"], r["n"]) for r in ties.collect()), key=lambda x: x[0]):
        if count > left:
            break
        last, left = tie_value, left - count
    return Bound(prefix, last)


def split_exact(df: DataFrame, test_rows: int, key: str = KEY) -> tuple[DataFrame, DataFrame]:
    """Split with a given number of test rows, those with the least key hashes. Both parts are plain filters.

    Rows of one key stay together, so a repeated key may leave the test set short of rows. Rows without a key are
    trained on.
    """
    digest, tie = key_hash(key), F.col(key)
    held_out = least(df, digest, tie, test_rows).within(digest, tie)
    return df.filter(~held_out), df.filter(held_out)


def _tagged(df: DataFrame, seed: int) -> DataFrame:
    """Rows with a random tag, written: from here on they are the same however often they are read."""
    number = F.monotonically_increasing_id()
    digest = F.lpad(F.lower(F.hex(F.xxhash64(F.rand(seed + 1), number))), 16, "0")
    path = scratch_path(df.sparkSession, "draws")
    df.withColumns({"_tag": digest, "_number": number}).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def sample_n(df: DataFrame, n: int, replace: bool = True, seed: int = 42) -> DataFrame:
    """Exactly `n` rows, each drawn uniformly; without replacement as many as there are, if there are fewer.

    With replacement every row is drawn a Poisson number of times, somewhat more than needed in all. Given their
    number, the draws are independent and uniform, and so are the `n` of them with the least random tags. Without
    replacement each row is kept with a probability, and the least tags decide again. Only the draws are written, and
    if there are too few of them they are drawn anew.
    """
    total = df.count()
    if total == 0 or n <= 0:
        return df.limit(0)
    if not replace and n >= total:
        return df
    share = (n + 6 * n**0.5 + 20) / total
    for attempt in range(64):
        drawn = df.sample(replace, share if replace else min(share, 1.0), seed + 1000 * attempt)
        drawn = _tagged(drawn, seed + 1000 * attempt)
        if drawn.count() >= n:
            tag, number = F.col("_tag"), F.col("_number")
            bound = least(drawn, tag, number, n, width=16)
            return drawn.filter(bound.within(tag, number)).drop("_tag", "_number")
    raise RuntimeError(f"no {n} draws in 64 attempts")
