"""Near-duplicate vectors by iterative quantisation and multi-index Hamming tables.

Rotations are learnt that turn centred unit vectors into balanced binary codes: the principal axes are rotated so that
rounding to signs loses least. Substrings of the codes are the keys of tables; vectors that agree in a substring meet
in a bucket and are compared with their original components in double precision. How many tables are needed follows
from how many pairs at just the least cosine meet in none, which is measured on the sample, for differences in any
direction and for differences shaped like the data.

Buckets are worked off as matrix blocks. A block returns a number and a root for each of its vectors, never pairs; a
bucket beyond `BLOCK` vectors is cut into chunks, and every pair of chunks is a block of its own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgeline.llm.blocks import blocks, dealt
from lodgeline.llm.common import staged
from lodgeline.llm.components import components

#: Vectors of a chunk of a large bucket.
BLOCK = 2048

#: Pairs, at least, on which tables are measured.
PAIRS = 20_000


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision; the greatest component goes first, so that no square overflows."""
    x = vectors.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def iterative_quantisation(x: np.ndarray, rounds: int, rng: np.random.Generator) -> np.ndarray:
    """A rotation r such that the signs of x @ r are close to x @ r."""
    r, _ = np.linalg.qr(rng.standard_normal((x.shape[1], x.shape[1])))
    for _ in range(rounds):
        signs = np.where(x @ r >= 0, 1.0, -1.0)
        u, _, v = np.linalg.svd(x.T @ signs)
        r = u @ v
    return r


@dataclass
class Codes:
    """Centre, axes with their rotations, and the bits of each table."""

    mean: np.ndarray
    projection: np.ndarray
    tables: list[np.ndarray]

    def bits(self, units: np.ndarray) -> np.ndarray:
        return (units - self.mean) @ self.projection >= 0

    def substrings(self, units: np.ndarray) -> np.ndarray:
        """The key of each vector (row) in each table (column)."""
        bits = self.bits(units)
        out = np.empty((len(units), len(self.tables)), np.int64)
        for t, at in enumerate(self.tables):
            out[:, t] = bits[:, at] @ (1 << np.arange(len(at), dtype=np.int64))
        return out


def _at_cosine(units: np.ndarray, cosine: float, shape: np.ndarray | None, rng: np.random.Generator) -> np.ndarray:
    """A random unit vector at just this cosine from each row; the differences are isotropic or have a `shape`."""
    noise = rng.standard_normal(units.shape)
    if shape is not None:
        noise = noise @ shape
    noise -= (noise * units).sum(axis=1, keepdims=True) * units
    norm = np.sqrt((noise * noise).sum(axis=1, keepdims=True))
    return cosine * units + math.sqrt(1 - cosine**2) * noise / np.where(norm > 0, norm, 1)


def learn_codes(sample: np.ndarray, n: int, cosine: float, miss: float, most: int = 32, seed: int = 5) -> Codes:
    """Codes for `n` vectors of which `sample` are some.

    A substring has about log2(n) - 3 bits, so that buckets stay small as n grows; fewer, if more than `most` tables
    were needed to leave at most `miss` of the pairs at the least cosine apart. That share is counted on pairs made from
    a quarter of the sample, of which the rotations know nothing, for isotropic differences and for ones with the
    sample's covariance, and the worse one counts. If no bit serves, all vectors share one bucket, which compares every
    pair of blocks.
    """
    rng = np.random.default_rng(seed)
    units = unit(sample)
    back = np.arange(len(units)) % 4 == 3
    held = units[back] if back.any() else units
    values, axes = np.linalg.eigh(np.cov(units.T, bias=True).reshape(units.shape[1], -1))
    shape = np.sqrt(np.maximum(values, 0))[:, None] * axes.T
    mean = units[~back].mean(axis=0)
    centred = units[~back] - mean
    _, axes = np.linalg.eigh(centred.T @ centred)
    axes = axes[:, ::-1][:, : min(64, units.shape[1])]
    width = axes.shape[1]
    inside = centred @ axes
    some = np.resize(held, (max(len(held), PAIRS), units.shape[1]))
    ends = [(some - mean) @ axes, *((_at_cosine(some, cosine, own, rng) - mean) @ axes for own in (None, shape))]

    turns: list[np.ndarray] = []
    #: For each rotation the bits in which the pairs differ, by kind of difference.
    apart: list[list[np.ndarray]] = []

    def turn() -> None:
        turns.append(iterative_quantisation(inside, 30, rng))
        bits = [x @ turns[-1] >= 0 for x in ends]
        apart.append([bits[0] != other for other in bits[1:]])

    turn()
    for size in range(min(width, 30, max(6, round(math.log2(max(n, 2))) - 3)), 0, -1):
        tables: list[np.ndarray] = []
        missed = [np.ones(len(some), bool) for _ in apart[0]]
        while len(tables) < most:
            rotation, place = divmod(len(tables), width // size)
            if rotation == len(turns):
                turn()
            at = np.arange(place * size, (place + 1) * size)
            tables.append(at + rotation * width)
            missed = [own & differ[:, at].any(axis=1) for own, differ in zip(missed, apart[rotation])]
            if max(own.mean() for own in missed) <= miss:
                return Codes(mean, axes @ np.concatenate(turns[: rotation + 1], axis=1), tables)
    return Codes(mean, axes @ turns[0], [np.arange(0)])


def _proper(name: str) -> Column:
    v = F.col(name)
    finite = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce(finite & F.exists(v, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _roots(linked: np.ndarray) -> np.ndarray:
    """The least row reachable from each row."""
    root = np.arange(len(linked))
    while True:
        # Least root among the neighbours, then the root of the root.
        least = np.where(linked, root[None, :], len(root)).min(axis=1)
        new = np.minimum(root, least)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _block(vectors, nodes, weights, keys, chunks, table: int, cosine: float):
    """For each vector of a block its root, and the weight of its links not met in an earlier table."""
    order = np.argsort(nodes, kind="stable")
    vectors, nodes, weights, keys, chunks = vectors[order], nodes[order], weights[order], keys[order], chunks[order]
    units = unit(vectors)
    linked = units @ units.T >= cosine
    np.fill_diagonal(linked, False)
    if chunks.min() != chunks.max():
        linked &= chunks[:, None] != chunks[None, :]
    if not linked.any():
        return None
    first = linked.copy()
    for t in range(table):
        first &= keys[:, None, t] != keys[None, :, t]
    links = first.astype(np.int64) @ weights
    own = linked.any(axis=1)
    return nodes[own], nodes[_roots(linked)][own], links[own]


def _coded(classes: DataFrame, codes, width: int) -> DataFrame:
    """A row for each vector and table: key (table and substring), the vector, all its substrings."""
    kind = classes.schema["embedding"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = codes.value
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                own = known.substrings(unit(_matrix(part.column(2), width)))
                kind = pa.list_(pa.int64())
                subs = pa.array(list(own), kind)
                keys = pa.array(list(own | (np.arange(own.shape[1], dtype=np.int64) << 32)), kind)
                yield pa.record_batch([*part.columns, subs, keys], ["node", "n", "embedding", "subs", "keys"])

    schema = f"node long, n long, embedding {kind}, subs array<long>, keys array<long>"
    return classes.mapInArrow(run, schema).select("node", "n", "embedding", "subs", F.explode("keys").alias("key"))


def _compared(rows: DataFrame, width: int, cosine: float) -> DataFrame:
    """node, root, links of all blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            if block.num_rows < 2:
                continue
            get = lambda c: block.column(c).to_numpy()  # noqa: B023, E731
            vectors = _matrix(block.column("embedding").combine_chunks(), width)
            keys = block.column("subs").combine_chunks().flatten().to_numpy().reshape(block.num_rows, -1)
            out = _block(vectors, get("node"), get("n"), keys, get("chunk"), int(get("key")[0]) >> 32, cosine)
            if out is not None:
                yield pa.record_batch([pa.array(x) for x in out], ["node", "root", "links"])

    return rows.mapInArrow(run, "node long, root long, links long")


def near_vectors(
    embeddings: DataFrame, cosine: float = 0.95, miss: float = 0.002, sample_rows: int = 20_000
) -> DataFrame:
    """Links, component and survivor of every vector: vec_id, n_links, component_id, kept.

    Two vectors are linked if their cosine is `cosine` or more; pairs at just that cosine are missed with a probability
    of about `miss`, closer ones more rarely, and none below is linked. The rotations are learnt on `sample_rows`
    vectors at most, those with the least hash of the id. Equal vectors are one node that weighs as much as there are;
    vectors of different lengths are never linked. Vectors that are null, zero, empty or hold null or non-finite
    components have no links and are kept, as are rows without vec_id, whose component is null. An empty table gives no
    rows; other columns are ignored.
    """
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    proper = rows.where(_proper("embedding") & F.col("vec_id").isNotNull())
    classes = proper.groupBy("embedding").agg(F.min("vec_id").alias("node"), F.count("*").alias("n"))
    classes = staged(classes.select("node", "n", "embedding"), "classes")
    spark = embeddings.sparkSession
    found = []
    for r in classes.groupBy(F.size("embedding").alias("width")).agg(F.count("*").alias("n")).collect():
        own = classes.where(F.size("embedding") == r["width"])
        few = own.orderBy(F.xxhash64("node"), "node").limit(sample_rows).select("embedding").toArrow()
        codes = learn_codes(_matrix(few.column(0).combine_chunks(), r["width"]), r["n"], cosine, miss)
        shared = spark.sparkContext.broadcast(codes)
        found.append(_compared(dealt(_coded(own, shared, r["width"]), BLOCK), r["width"], cosine))
    if not found:
        found = [spark.createDataFrame([], "node long, root long, links long")]
    links = found[0]
    for more in found[1:]:
        links = links.union(more)
    links = staged(links, "vector-links")
    labels = components(links.select(F.col("node").alias("a"), F.col("root").alias("b")).distinct())
    sums = links.groupBy("node").agg(F.sum("links").alias("links"))
    known = classes.join(sums, "node", "left").join(labels, "node", "left")
    known = staged(
        known.select(
            F.col("embedding").alias("_embedding"),
            (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
            F.coalesce("component", "node").alias("component_id"),
        ),
        "vector-classes",
    )
    is_proper = _proper("embedding") & F.col("vec_id").isNotNull()
    linked = rows.where(is_proper).join(known, F.col("embedding") == F.col("_embedding"))
    alone = rows.where(~is_proper).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.select("vec_id", "n_links", "component_id").union(alone).select(
        "*", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept")
    )
