"""Near-duplicate texts by one-permutation hashing.

A text's set of word shingles is hashed once; the hash's top bits name a bin, and each bin keeps its least hash. Empty
bins borrow from the non-empty bin that comes first in an order drawn for each bin (optimal densification: any two
sets still agree in a bin with their Jaccard similarity as probability). Bands of bins are bucket keys.

Each bucket of the first bands becomes a star: its members are compared with one centre, on their full sets, and linked
members are joined to components. Buckets whose members still lie in several components are worked off as blocks.
Signatures tell which members have a partner apart that could be similar enough; only these come again with their full
sets. Their pairs are compared inside the block, the likeliest first and each in the first bucket where it meets, and a
pair that is joined already is not compared. A block returns one root for a member and never pairs. So a large group of
copies costs a star, and no pair that meets in a bucket is lost, be the bucket as large as it may.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeline.llm.blocks import blocks, dealt
from lodgeline.llm.common import mixed, staged, text_column, window_hashes, word_hashes, words
from lodgeline.llm.components import components

BINS = 256
BAND = 5
#: Bands whose buckets become stars.
STARS = 8
#: A pair of similarity 0.75 agrees in a share of its bins smaller by this with a probability of 5e-6, about as rarely
#: as it meets in no bucket.
SLACK = 0.12
#: Members of a chunk of a large bucket. A member that comes with its set counts once more for every 1,024 shingles.
BLOCK = 1024


def _bin_orders(bins: int) -> np.ndarray:
    """For each bin (row) the places of all bins in its own random order."""
    cells = np.arange(bins * bins, dtype=np.uint64) + np.uint64(1 << 40)
    return np.argsort(np.argsort(mixed(cells).reshape(bins, bins), axis=1), axis=1)


_ORDERS = _bin_orders(BINS)
_STARTS = np.arange(BINS, dtype=np.uint64) << np.uint64(64 - BINS.bit_length() + 1)


def shingle_set(text: str, size: int = 5) -> np.ndarray:
    """Hashes of the distinct shingles, ascending."""
    return np.unique(window_hashes(word_hashes(words(text)), size))


def signature(shingles: np.ndarray) -> np.ndarray:
    """One hash per bin; the set must not be empty."""
    first = np.searchsorted(shingles, _STARTS)
    last = np.append(first[1:], len(shingles))
    filled = np.flatnonzero(first < last)
    out = np.zeros(BINS, np.uint64)
    out[filled] = shingles[first[filled]]
    if len(filled) < BINS:
        empty = np.setdiff1d(np.arange(BINS), filled, assume_unique=True)
        out[empty] = out[filled[np.argmin(_ORDERS[np.ix_(empty, filled)], axis=1)]]
    return out


def band_keys(signed: np.ndarray, band: int = BAND) -> np.ndarray:
    n = len(signed) // band
    rows = signed[: n * band].reshape(n, band)
    key = np.arange(1, n + 1, dtype=np.uint64) << np.uint64(32)
    for k in range(band):
        key = mixed(key + rows[:, k])
    return key.view(np.int64)


def jaccard_reaches(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common > 0 and 100 * common >= percent * (len(a) + len(b) - common)


def signatures(documents: DataFrame, size: int = 5) -> DataFrame:
    """doc_id, n (size of the set), h (hash of the whole set) and keys; h and keys are null for empty sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                n, h, keys = [], [], []
                for text in part.column(1):
                    found = shingle_set(text.as_py(), size)
                    n.append(len(found))
                    h.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                    keys.append(band_keys(signature(found)) if len(found) else None)
                yield pa.record_batch(
                    [part.column(0), pa.array(n, pa.int64()), pa.array(h, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                    ["doc_id", "n", "h", "keys"],
                )

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_column().alias("text"))
    return rows.mapInArrow(run, "doc_id long, n long, h binary, keys array<long>")


def verified(pairs: DataFrame, texts: DataFrame, percent: int, size: int = 5) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are similar enough."""
    other = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    center = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, last_set = None, None
        for batch in batches:
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            keep = []
            for k in range(batch.num_rows):
                # Rows come sorted by centre from the join; two texts of one id are told apart by the text.
                text = batch.column("text_a")[k]
                if (a[k], text) != last:
                    last, last_set = (a[k], text), shingle_set(text.as_py(), size)
                if jaccard_reaches(last_set, shingle_set(batch.column("text_b")[k].as_py(), size), percent):
                    keep.append(k)
            yield pa.record_batch([pa.array([a[k] for k in keep], pa.int64()), pa.array([b[k] for k in keep], pa.int64())], ["a", "b"])

    return pairs.join(other, "b").join(center, "a").mapInArrow(run, "a long, b long")


def _labelled(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members with their component."""
    named = labels.select(F.col("node").alias("_node"), F.col("component").alias("_component"))
    joined = members.join(named, F.col("node") == F.col("_node"), "left")
    return joined.withColumn("component", F.coalesce("_component", "node")).drop("_node", "_component")


def _open_members(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of buckets that reach over several components, with their component."""
    m = _labelled(members.select("key", "band", "node", "n"), labels)
    spread = m.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("key")
    return staged(m.join(staged(spread, "open-buckets"), "key"), "open-members")


def _sketched(texts: DataFrame, size: int) -> DataFrame:
    """Signature of every node's text, 32 bits a bin, and its shingle set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                sets = [shingle_set(t.as_py(), size) for t in part.column(1)]
                signs = [(signature(s) & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes() for s in sets]
                columns = [part.column(0), pa.array(signs, pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())]
                yield pa.record_batch(columns, ["_node", "signs", "shingles"])

    return texts.select("node", "text").mapInArrow(run, "_node long, signs binary, shingles binary")


def _apart(block: pa.Table, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of a block (by row) in different components that could be similar enough, and their share of equal bins.

    Each pair that meets in no earlier band is there once.
    """
    get = lambda c: block.column(c).to_numpy()
    signs = np.frombuffer(b"".join(block.column("signs").to_pylist()), "<u4").reshape(block.num_rows, BINS)
    component, n, chunk, band = get("component"), get("n"), get("chunk"), int(get("band")[0])
    _, number, counts = np.unique(component, return_inverse=True, return_counts=True)
    largest = int(counts.argmax())
    bands, plausible = BINS // BAND, percent / 100 - SLACK
    first, second, shares = [], [], []
    for i in np.flatnonzero(number != largest).tolist():
        others = number != number[i]
        if chunk.min() != chunk.max():
            others &= chunk != chunk[i]
        # Of two members outside the largest component, the later one looks.
        others[i:] &= number[i:] == largest
        others &= 100 * np.minimum(n, n[i]) >= percent * np.maximum(n, n[i])
        at = np.flatnonzero(others)
        same = signs[at] == signs[i]
        agree = same[:, : bands * BAND].mean(axis=1)
        keep = agree >= plausible
        if band and keep.any():
            met = same[keep][:, : band * BAND].reshape(-1, band, BAND).all(axis=2).any(axis=1)
            keep[np.flatnonzero(keep)[met]] = False
        second.append(at[keep])
        shares.append(agree[keep])
        first.append(np.full(int(keep.sum()), i))
    if not first:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    return np.concatenate(first), np.concatenate(second), np.concatenate(shares)


MEMBER = "key long, band int, node long, n long, component long"


def _with_partner(rows: DataFrame, percent: int) -> DataFrame:
    """The members of blocks that have a plausible partner there, once for each bucket."""
    names = [c.split()[0] for c in MEMBER.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            i, j, _ = _apart(block, percent)
            if len(i):
                yield from block.select(names).take(np.union1d(i, j)).to_batches()

    return rows.mapInArrow(run, MEMBER).distinct()


def _merged(block: pa.Table, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of a block that are joined to another component there, and the least node of their class."""
    i, j, agree = _apart(block, percent)
    node = block.column("node").to_numpy()
    # Members of one component are one class from the start.
    _, start = np.unique(block.column("component").to_numpy(), return_inverse=True)
    parent = list(range(int(start.max()) + 1))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    shingles = block.column("shingles")
    sets: dict[int, np.ndarray] = {}

    def own(k: int) -> np.ndarray:
        if k not in sets:
            sets[k] = np.frombuffer(shingles[k].as_buffer(), np.uint64)
        return sets[k]

    changed = set()
    for k in np.argsort(-agree, kind="stable").tolist():
        a, b = find(start[i[k]]), find(start[j[k]])
        if a != b and jaccard_reaches(own(int(i[k])), own(int(j[k])), percent):
            parent[max(a, b)] = min(a, b)
            changed.update((int(i[k]), int(j[k])))
    roots = np.array([find(x) for x in range(len(parent))])[start]
    least = np.full(len(parent), np.iinfo(np.int64).max)
    at = np.array(sorted(changed), np.int64)
    # The two ends of each link say which components are one; the others follow by their component.
    np.minimum.at(least, roots[at], node[at])
    return node[at], least[roots[at]]


def _links(rows: DataFrame, percent: int) -> DataFrame:
    """a, b: at most one row for each member of a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            nodes, roots = _merged(block, percent)
            if len(nodes):
                yield pa.record_batch([pa.array(nodes), pa.array(roots)], ["a", "b"])

    return rows.mapInArrow(run, "a long, b long").where("a <> b").distinct()


def near_duplicates(documents: DataFrame, percent: int = 75, size: int = 5) -> DataFrame:
    """Set size, component and survivor of every document: doc_id, n_shingles, component_id, kept.

    Documents are linked if their sets of `size`-word shingles have a Jaccard similarity of `percent` or more; a
    shorter text is one shingle; texts without words are linked with nothing. Equal sets are one node of the graph,
    whose texts are never paired; rows with one doc_id are one node, too. Rows without doc_id are linked with nothing,
    have no component_id and are kept. An empty table gives no rows; other columns are ignored. Bins and bands are
    chosen for `percent` of 75 and above.
    """
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_column().alias("text"))
    signed = staged(signatures(documents, size), "signatures")
    named = signed.where("doc_id IS NOT NULL AND h IS NOT NULL")
    classes = staged(named.groupBy("h").agg(F.min("doc_id").alias("node")), "classes")
    leads = named.join(classes.withColumnRenamed("h", "_h"), (F.col("doc_id") == F.col("node")) & (F.col("h") == F.col("_h")))
    bands = leads.select("node", "n", F.posexplode("keys").alias("band", "key"))
    # Buckets of one node are left out before anything is joined.
    shared = bands.groupBy("key").agg(F.min("node").alias("center"), F.max("node").alias("hi")).where("center < hi").drop("hi")
    members = staged(bands.join(staged(shared, "buckets"), "key").distinct(), "members")
    nodes = members.select("node").distinct()
    whole = documents.join(nodes, F.col("doc_id") == F.col("node"), "left_semi")
    texts = staged(whole.select(F.col("doc_id").alias("node"), "text").distinct(), "texts")

    stars = members.where((F.col("band") < STARS) & (F.col("node") != F.col("center")))
    stars = stars.select(F.col("center").alias("a"), F.col("node").alias("b")).distinct()
    labels = components(staged(verified(staged(stars, "pairs"), texts, percent, size), "links"))
    left = _open_members(members, labels)
    if not left.isEmpty():
        own = texts.join(left.select("node").distinct(), "node", "left_semi")
        sketches = staged(_sketched(own, size), "sketches")
        signs = left.join(sketches.select("_node", "signs"), F.col("node") == F.col("_node")).drop("_node")
        closer = staged(_with_partner(dealt(signs, BLOCK), percent), "partners")
        if not closer.isEmpty():
            full = closer.join(sketches, F.col("node") == F.col("_node")).drop("_node")
            links = staged(_links(dealt(full, BLOCK, weight="1 + n div 1024"), percent), "links")
            labels = components(links.union(labels.select(F.col("node").alias("a"), F.col("component").alias("b"))))

    linked = signed.select("doc_id", "n", "h").where("doc_id IS NOT NULL AND h IS NOT NULL").join(classes, "h")
    linked = linked.join(labels, "node", "left")
    out = linked.select("doc_id", "n", F.coalesce("component", "node").alias("component_id"))
    alone = signed.where("doc_id IS NULL OR h IS NULL").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return out.union(alone).select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"),
    )


def survivors(documents: DataFrame, percent: int = 75, size: int = 5) -> DataFrame:
    """The kept documents with their own columns; of rows that share the kept doc_id, the one with the least hash.

    Only the ids that go are joined with the texts, so Spark may send them to the texts where they are few.
    """
    verdicts = near_duplicates(documents, percent, size)
    gone = staged(verdicts.where("NOT kept").select(F.col("doc_id").alias("_gone")).distinct(), "gone")
    twice = staged(
        documents.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("_twice")),
        "repeated-ids",
    )
    left = documents.join(gone, F.col("doc_id") == F.col("_gone"), "left_anti")
    if twice.isEmpty():
        return left
    once = left.join(twice, F.col("doc_id") == F.col("_twice"), "left_anti")
    rank = F.expr("row_number() OVER (PARTITION BY doc_id ORDER BY xxhash64(text))")
    again = left.join(twice, F.col("doc_id") == F.col("_twice"), "left_semi").withColumn("_rank", rank)
    return once.union(again.where("_rank = 1").drop("_rank"))
