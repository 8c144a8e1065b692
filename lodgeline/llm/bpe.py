"""Byte-pair encoding with an index of pair occurrences, and decoding.

The words of a batch that were not met before lie in one array of symbols. An index maps each mergeable pair to all
its positions there. Ranks are applied in ascending order, each at all its positions at once; a merge makes new pairs
with its two neighbours, which are entered into the index. A merged symbol exists only after its own rank, so new pairs
always have higher ranks, and one pass over the active ranks encodes the whole batch.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeline.llm.common import text_column
from lodgeline.llm.packing import slices
from lodgeline.llm.tokens import byte_symbols

#: Fixed value: how byte-level vocabularies of this kind cut texts into words.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

class Vocabulary:
    """Pieces and merges of a byte-level tokenizer file, as arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        symbols = byte_symbols()
        vocab = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.pieces = [b""] * (max([*vocab.values(), *self.special.values()], default=-1) + 1)
        for piece, k in vocab.items():
            if piece not in self.special:
                self.pieces[k] = bytes(symbols[c] for c in piece)
        for piece, k in self.special.items():
            self.pieces[k] = piece.encode()
        self.of_byte = np.array([vocab[c] for c, _ in sorted(symbols.items(), key=lambda x: x[1])], np.int64)
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.left = np.array([vocab[a] for a, _ in merges], np.int64)
        self.right = np.array([vocab[b] for _, b in merges], np.int64)
        self.made = np.array([vocab[a + b] for a, b in merges], np.int64)
        keys = self.left << 32 | self.right
        self.by_key = np.argsort(keys, kind="stable")
        self.keys = keys[self.by_key]

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 if it is never merged."""
        if not len(self.keys):
            return np.full(len(left), -1)
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.by_key[at], -1)


class PairIndex:
    """All words of a batch as linked symbols, and the positions of every mergeable pair by rank."""

    def __init__(self, vocabulary: Vocabulary, words: list[bytes]):
        self.v = vocabulary
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        self.starts = np.cumsum(sizes) - sizes
        n = int(sizes.sum())
        self.symbol = vocabulary.of_byte[np.frombuffer(b"".join(words), np.uint8)] if n else np.zeros(0, np.int64)
        # A place more than there are symbols: the end of all lists, with a symbol that is in no pair.
        self.symbol = np.append(self.symbol, -1)
        self.after = np.arange(1, n + 2)
        self.before = np.arange(-1, n)
        self.after[n] = n
        filled = sizes > 0
        self.after[(self.starts + sizes - 1)[filled]] = n
        self.before[self.starts[filled]] = n
        self.n = n
        self.places: dict[int, list[np.ndarray]] = {}
        self.active: list[int] = []
        self._enter(np.arange(n))

    def _enter(self, at: np.ndarray) -> None:
        """Index the pairs that begin at these positions."""
        ranks = self.v.ranks(self.symbol[at], self.symbol[self.after[at]])
        keep = ranks >= 0
        at, ranks = at[keep], ranks[keep]
        order = np.argsort(ranks, kind="stable")
        at, ranks = at[order], ranks[order]
        cuts = np.flatnonzero(np.diff(ranks)) + 1
        for rank, part in zip(ranks[np.concatenate(([0], cuts))].tolist() if len(ranks) else [], np.split(at, cuts)):
            if rank not in self.places:
                self.places[rank] = []
                heapq.heappush(self.active, rank)
            self.places[rank].append(part)

    def merge(self) -> None:
        """Apply all ranks, lowest first."""
        symbol, after, before = self.symbol, self.after, self.before
        while self.active:
            rank = heapq.heappop(self.active)
            parts = self.places.pop(rank)
            left, right = self.v.left[rank], self.v.right[rank]
            at = np.unique(np.concatenate(parts)) if len(parts) > 1 else np.sort(parts[0])
            at = at[(symbol[at] == left) & (symbol[after[at]] == right)]
            if left == right:
                at = self._apart(at)
            if not len(at):
                continue
            second = after[at]
            third = after[second]
            symbol[at] = self.v.made[rank]
            symbol[second] = -1
            after[at] = third
            before[third] = at
            before[self.n] = self.n
            previous = before[at]
            self._enter(np.concatenate((at, previous[previous < self.n])))

    def _apart(self, at: np.ndarray) -> np.ndarray:
        """Of pairs of one symbol that overlap, those that a walk from the left merges."""
        keep, taken = [], -1
        after = self.after
        for k in at.tolist():
            if k != taken:
                keep.append(k)
                taken = int(after[k])
        return np.array(keep, np.int64)

    def ids(self) -> Iterator[bytes]:
        """Each word's ids as little-endian unsigned 32-bit integers."""
        alive = self.symbol[:-1] >= 0
        ids = self.symbol[:-1][alive].astype("<u4")
        ends = np.append(np.cumsum(alive), 0)
        bounds = [0, *(ends[self.starts[1:] - 1]).tolist(), len(ids)] if len(self.starts) else [0]
        for a, b in zip(bounds, bounds[1:]):
            yield ids[a:b].tobytes()


class Encoder:
    """Texts to ids and back; ids of chunks met are kept, up to `limit` of them."""

    def __init__(self, vocabulary: Vocabulary, limit: int = 400_000):
        self.v, self.limit = vocabulary, limit
        self.known: dict[str, bytes] = {}
        self.specials = {t: np.array([k], "<u4").tobytes() for t, k in vocabulary.special.items()}
        found = sorted(map(regex.escape, self.specials), key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(found) + ")") if found else None

    @staticmethod
    def chunks(text: str) -> list[str]:
        """The text in parts that no word crosses.

        A single blank or line feed between visible characters always begins a word, so cutting there is safe, and
        much faster than finding all words. Texts with other white space are left to the word pattern.
        """
        if text.replace("\n", " ") != " ".join(text.split()) or "\x1e" in text:
            return WORDS.findall(text)
        return text.replace("\n", "\x1e\n\x1e").replace(" ", "\x1e ").split("\x1e") if text else []

    def parts(self, text: str) -> list[str]:
        """Chunks of the text; special tokens are chunks."""
        if self.cut is None or not any(s in text for s in self.specials):
            return self.chunks(text)
        out = []
        for k, part in enumerate(self.cut.split(text)):
            out.extend([part] if k % 2 else self.chunks(part))
        return out

    def learn(self, new: set[str]) -> None:
        """Encode these chunks, all words of them in one index."""
        split = {chunk: [w.encode("utf-8", "surrogatepass") for w in WORDS.findall(chunk)] for chunk in new}
        words = list({w for found in split.values() for w in found})
        index = PairIndex(self.v, words)
        index.merge()
        ids = dict(zip(words, index.ids()))
        for chunk, found in split.items():
            self.known[chunk] = ids[found[0]] if len(found) == 1 else b"".join([ids[w] for w in found])

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        split = [self.parts(text) for text in texts]
        met = set().union(*split)
        new = met.difference(self.known, self.specials)
        if len(self.known) + len(new) > self.limit:
            # Chunks of these texts stay, the common ones among them.
            self.known = {c: self.known[c] for c in met.intersection(self.known)}
        self.known.update(self.specials)
        self.learn(new)
        known = self.known
        for chunks in split:
            yield b"".join([known[c] for c in chunks])

    def decode(self, ids: bytes) -> str:
        pieces = self.v.pieces
        return b"".join([pieces[k] for k in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


#: Encoders of this worker process, by the vocabulary's path.
_ENCODERS: dict[str, Encoder] = {}


def encode_decode(documents: DataFrame, vocabulary_path: str) -> DataFrame:
    """Ids of every whole text, and the text decoded from them: doc_id, ids (binary, 32 bits each), decoded.

    A null or empty text has no ids and decodes to the empty text. Repeated rows and rows without id are encoded each;
    an empty table gives no rows; other columns are ignored.
    """
    shared = documents.sparkSession.sparkContext.broadcast(Vocabulary(vocabulary_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if vocabulary_path not in _ENCODERS:
            _ENCODERS[vocabulary_path] = Encoder(shared.value)
        codec = _ENCODERS[vocabulary_path]
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in slices(pc.binary_length(batch.column(1)).to_pylist()):
                ids = list(codec.encode(texts[a:b]))
                decoded = [codec.decode(x) for x in ids]
                yield pa.record_batch(
                    [batch.column(0).slice(a, b - a), pa.array(ids, pa.binary()), pa.array(decoded, pa.string())],
                    ["doc_id", "ids", "decoded"],
                )

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_column().alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids binary, decoded string")
