"""Small helpers that the operators share."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgeline.scratch import scratch_path

#: ASCII white space, the separators of words.
WORD = r"[^\x20\x09-\x0D]+"


def staged(df: DataFrame, label: str) -> DataFrame:
    """`df`, written once to the shared folder and read again: later steps restart from the files."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{label}")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_column(name: str = "text") -> Column:
    """The text, empty where null."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def words(text: str) -> list[bytes]:
    """Words of the text with A-Z lowered, as UTF-8.

    On bytes, `split` knows exactly the six ASCII separators and `lower` only A-Z.
    """
    return text.encode("utf-8", "surrogatepass").lower().split()


class Memo(dict):
    """Values by key, made on first use; emptied when `limit` is reached, so that its memory is bounded."""

    def __init__(self, make: Callable, limit: int = 400_000):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.make(key)
        return value


#: Hash of a word; one table per worker process.
_HASHES = Memo(xxhash.xxh3_64_intdigest)


def word_hashes(tokens: list[bytes]) -> np.ndarray:
    """64-bit hashes of the words."""
    return np.fromiter(map(_HASHES.__getitem__, tokens), np.uint64, len(tokens))


def mixed(h: np.ndarray) -> np.ndarray:
    """Every output bit depends on every input bit; one to one (the finaliser of splitmix64)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def window_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """A hash for each run of `size` words; the whole sequence as one run if it is shorter; none without words."""
    n = len(h)
    if n == 0:
        return h
    size = min(size, n)
    out = np.zeros(n - size + 1, np.uint64)
    for k in range(size):
        out = mixed(out + h[k : n - size + 1 + k] + np.uint64(0x9E3779B97F4A7C15 * (k + 1) % 2**64))
    return out
