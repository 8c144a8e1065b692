"""Best-fit decreasing packing of tokenised documents.

Documents are cut into pieces of at most `capacity` tokens. Pieces are packed by falling length, each into the
tightest open bin that takes it, which a segment tree over remaining capacities finds in logarithmic time. Pieces of
one length are alike, so the packer needs only how many there are of each length: it works on runs of equal pieces and
runs of equally full bins, and its input and work are bounded by the capacity, however many documents there are. Its
plan says where the k-th piece of each length goes; numbering the pieces of a length and looking up their places is
distributed.
"""

from __future__ import annotations

import os
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeline.llm.common import staged, text_column


class TightestBin:
    """Segment tree over remaining capacities: which capacities have an open bin."""

    def __init__(self, capacity: int):
        self.leaves = 1 << (capacity + 1).bit_length()
        self.any = [False] * (2 * self.leaves)

    def set(self, remaining: int, is_open: bool) -> None:
        k = remaining + self.leaves
        self.any[k] = is_open
        while k > 1:
            k >>= 1
            self.any[k] = self.any[2 * k] or self.any[2 * k + 1]

    def tightest(self, length: int) -> int | None:
        """The least remaining capacity of an open bin that is at least `length`."""
        k = length + self.leaves
        if self.any[k]:
            return length
        while k > 1:
            if k % 2 == 0 and self.any[k + 1]:
                k += 1
                while k < self.leaves:
                    k = 2 * k if self.any[2 * k] else 2 * k + 1
                return k - self.leaves
            k >>= 1
        return None


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Places of the pieces, given how many there are of each length.

    Rows (length, first, n, bin, offset): the pieces first, ..., first + n - 1 of that length lie at `offset` of the
    bins bin, ..., bin + n - 1. The result is that of packing piece by piece: equal pieces go one after another into
    equally full bins as long as there are any.
    """
    tree = TightestBin(capacity)
    runs: dict[int, list[tuple[int, int]]] = {}
    out, bins = [], 0

    def put(remaining: int, start: int, n: int) -> None:
        if remaining and n:
            runs.setdefault(remaining, []).append((start, n))
            tree.set(remaining, True)

    for length in sorted(counts, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"no place for a piece of length {length}")
        done, left = 0, counts[length]
        while left:
            room = tree.tightest(length)
            if room is None:
                room, start, n = capacity, bins, -(-left // (capacity // length))
                bins += n
            else:
                start, n = runs[room].pop()
                if not runs[room]:
                    tree.set(room, False)
            # The tightest bin stays the tightest while it takes such pieces, so each bin is filled before the next.
            fits = room // length
            used = min(n, -(-left // fits))
            last = min(left, used * fits) - (used - 1) * fits
            for k in range(fits):
                take = used if k < last else used - 1
                if take:
                    out.append((length, done, take, start, capacity - room + k * length))
                    done, left = done + take, left - take
            if used < n:
                put(room, start + used, n - used)
            if last == fits:
                put(room - fits * length, start, used)
            else:
                put(room - fits * length, start, used - 1)
                put(room - last * length, start + used - 1, 1)
    return out


def _load(tokenizer: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_str(tokenizer)


def _letter(c: str) -> bool:
    """Whether a character is a letter and stays one when it is composed and lowered, without a mark behind it."""
    return c.isalpha() and (c.isascii() or unicodedata.normalize("NFC", c).lower().isalpha())


class ChunkEncoder:
    """Ids of texts by the tokenizers library, which is asked once for each different word.

    No token of a tokenizer that drops white space reaches across a blank or a line feed, so a text's ids are those of
    its chunks between them. A sign after a letter is a token's limit as well, and ASCII is lowered alike everywhere,
    so chunks that differ in capitals or in a sign at the end share the ids of one word. Added tokens are looked for
    before anything is lowered, so chunks that would hold one in lower case are asked for as they stand.

    Texts are split and their different chunks found by Arrow, and ids are put together by taking from the ids of the
    different chunks, so Python handles each different chunk of a slice once. Only words are kept from slice to slice.
    """

    SIGNS = frozenset(".,;:!?")
    #: Chunks whose ids are put together at once.
    PART = 500_000

    def __init__(self, tokenizer: str, limit: int = 300_000):
        self.tokenizer, self.limit = _load(tokenizer), limit
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.added = [token.content.lower() for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.words: dict[str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.ends[[k for token, k in vocabulary.items() if token.endswith("</w>")]] = True
        self._learn(set(self.SIGNS))
        self.signs = {"": b"", **self.words}

    def _parts(self, chunks: list[str]) -> Iterator[tuple[str, str]]:
        """What to ask for instead of each chunk, and the sign at its end."""
        whole = " ".join(chunks).lower()
        added = [token for token in self.added if token in whole]
        signs = self.SIGNS
        for chunk in chunks:
            if added and any(token in chunk.lower() for token in added):
                yield chunk, ""
                continue
            sign = ""
            if chunk[-1:] in signs and _letter(chunk[-2:-1]):
                chunk, sign = chunk[:-1], chunk[-1]
            yield (chunk.lower() if chunk.isascii() else chunk), sign

    def _learn(self, needed: set[str]) -> None:
        todo = list(needed.difference(self.words))
        if len(self.words) + len(todo) > self.limit:
            # Words of this slice stay, the common ones among them.
            self.words = {w: self.words[w] for w in needed.intersection(self.words)}
        # A word of letters only is one word to the tokenizer as well.
        plain = [w for w in todo if w.isalpha()]
        for k in range(0, len(plain), 5_000):
            self._learn_plain(plain[k : k + 5_000])
        self._learn_each([w for w in todo if not w.isalpha()])

    def _learn_plain(self, words: list[str]) -> None:
        """Ask for many words in one text, and cut its ids where a word ends.

        If there are more ends than words, some letters were taken apart; halves are asked for until it is clear which.
        """
        (e,) = self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)
        ids = np.array(e.ids, "<u4")
        cuts = np.flatnonzero(self.ends[ids]) + 1
        if len(cuts) != len(words) or cuts[-1] != len(ids):
            if len(words) == 1:
                self._learn_each(words)
            else:
                self._learn_plain(words[: len(words) // 2])
                self._learn_plain(words[len(words) // 2 :])
            return
        data, cuts = ids.tobytes(), (4 * cuts).tolist()
        self.words.update(zip(words, (data[a:b] for a, b in zip([0, *cuts], cuts))))

    def _learn_each(self, words: list[str]) -> None:
        for k in range(0, len(words), 20_000):
            part = words[k : k + 20_000]
            for word, e in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False)):
                self.words[word] = np.array(e.ids, "<u4").tobytes()

    def __call__(self, texts: list[str] | pa.Array) -> Iterator[bytes]:
        array = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        chunks = pc.split_pattern(pc.replace_substring(array, "\n", " "), " ")
        bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(chunks).to_numpy(zero_copy_only=False))])
        coded = chunks.flatten().dictionary_encode()
        parts = list(self._parts(coded.dictionary.to_pylist()))
        self._learn({word for word, _ in parts})
        words, signs = self.words, self.signs
        ids = [words[word] + signs[sign] for word, sign in parts]
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        data, start = np.frombuffer(b"".join(ids), "<u4"), np.cumsum(size) - size
        number = coded.indices.to_numpy(zero_copy_only=False)
        out, ends = [], [np.zeros(1, np.int64)]
        for k in range(0, len(number), self.PART):
            own = number[k : k + self.PART]
            n = size[own]
            total = np.cumsum(n)
            ends.append(total + ends[-1][-1])
            if len(n):
                out.append(data[np.repeat(start[own] - (total - n), n) + np.arange(total[-1])])
        whole = np.concatenate(out) if out else np.empty(0, "<u4")
        cuts = np.concatenate(ends)[bounds].tolist()
        for a, b in zip(cuts, cuts[1:]):
            yield whole[a:b].tobytes()


#: Encoders of this worker process, by tokenizer.
_ENCODERS: dict[int, ChunkEncoder] = {}


def encoder(tokenizer: str) -> ChunkEncoder:
    key = zlib.crc32(tokenizer.encode())
    if key not in _ENCODERS:
        _ENCODERS[key] = ChunkEncoder(tokenizer)
    return _ENCODERS[key]


def slices(sizes: list[int], most: int = 8_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about so many bytes, one text at least."""
    start = size = 0
    for k, own in enumerate(sizes):
        size += own
        if size >= most:
            yield start, k + 1
            start, size = k + 1, 0
    if start < len(sizes):
        yield start, len(sizes)


PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long, _part int, _nth long"


def pieces(documents: DataFrame, tokenizer_json: str, end_id: int = 0, capacity: int = 2048) -> DataFrame:
    """Pieces of every document: its ids and `end_id`, cut every `capacity` tokens.

    `_part` and `_nth` number the pieces of each length within the task that made them.
    """
    shared = documents.sparkSession.sparkContext.broadcast(tokenizer_json)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = encoder(shared.value), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            for a, b in slices(pc.binary_length(texts).to_pylist()):
                rows: list[tuple] = []
                for doc, data in zip(ids[a:b], encode(texts.slice(a, b - a))):
                    data += end
                    for k in range(0, len(data), 4 * capacity):
                        own = data[k : k + 4 * capacity]
                        n = len(own) // 4
                        rows.append((doc, k // (4 * capacity), k // 4, n, zlib.crc32(own), part, int(seen[n])))
                        seen[n] += 1
                columns = list(zip(*rows))
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64()]
                names = [c.split()[0] for c in PIECES.split(", ")]
                yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_column().alias("text")).mapInArrow(run, PIECES)


def pack(documents: DataFrame, tokenizer_path: str, end_id: int = 0, capacity: int = 2048) -> DataFrame:
    """Every piece of every document with its sequence and offset there.

    A null or empty text is a piece of one token, the end. Repeated rows, and rows without id, are packed like any
    other. An empty table gives no rows; other columns are ignored. Which of several pieces of one length gets which
    place depends on how the table is read, the number of sequences does not.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        tokenizer = f.read()
    spark = documents.sparkSession
    cut = staged(pieces(documents, tokenizer, end_id, capacity), "pieces")
    own = cut.groupBy("length", "_part").agg((F.max("_nth") + 1).alias("n"))
    # A row for each length and task: the first number of the task's pieces among all of that length.
    starts = own.select(
        F.col("length").alias("_length"),
        F.col("_part").alias("_of"),
        F.expr("sum(n) OVER (PARTITION BY length ORDER BY _part) - n").alias("_first"),
    )
    counts = {r["length"]: r["n"] for r in own.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = best_fit_decreasing(counts, capacity)
    shared = spark.sparkContext.broadcast(np.array(plan, np.int64).reshape(-1, 5))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = shared.value
        order = np.lexsort((rows[:, 1], rows[:, 0]))
        rows = rows[order]
        # Numbers of pieces stay below 2**50 and lengths below 2**13, so both fit into one sorted key.
        keys = (rows[:, 0] << 50) | rows[:, 1]
        for batch in batches:
            if not batch.num_rows:
                continue
            length = batch.column("length").to_numpy(zero_copy_only=False).astype(np.int64)
            rank = batch.column("_rank").to_numpy(zero_copy_only=False).astype(np.int64)
            at = np.searchsorted(keys, (length << 50) | rank, side="right") - 1
            out = {c: batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")}
            out["length"] = pa.array(length)
            out["sequence_id"] = pa.array(rows[at, 3] + rank - rows[at, 1])
            out["offset"] = pa.array(rows[at, 4])
            yield pa.record_batch(list(out.values()), list(out))

    ranked = cut.join(starts, (F.col("length") == F.col("_length")) & (F.col("_part") == F.col("_of"))).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("_first") + F.col("_nth")).alias("_rank")
    )
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return ranked.mapInArrow(place, schema)
