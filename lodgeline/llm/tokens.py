"""Lengths of greedy longest-match word pieces, by one walk through an automaton per word.

The trie of a vocabulary gets a failure link and a count for each node: when the walk cannot go on from a node, `pops`
pieces are certain (the longest matches of what was read) and the walk goes on at `fail`, which stands for what is
left. So a word's number of pieces is a sum of counts met on the way: time is linear in the word's length, and no piece
is cut out.
"""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeline.llm.common import Memo, text_column


class PieceCounter:
    """The automaton of a vocabulary of `initial` and `continuing` pieces.

    `initial` pieces begin a word and `continuing` pieces go on with it. Nodes are numbers; node 0 is the root of the
    initial pieces, node 1 that of the continuing ones.
    """

    def __init__(self, initial: list[bytes], continuing: list[bytes]):
        self.next: list[dict[int, int]] = [{}, {}]
        self.is_piece = [False, False]
        for root, found in ((0, initial), (1, continuing)):
            for piece in found:
                self._add(root, piece)
        self._link()

    def _add(self, root: int, piece: bytes) -> None:
        node = root
        for symbol in piece:
            child = self.next[node].get(symbol)
            if child is None:
                child = self.next[node][symbol] = len(self.next)
                self.next.append({})
                self.is_piece.append(False)
            node = child
        self.is_piece[node] = True

    def _link(self) -> None:
        """Breadth first, since a link depends on those of shorter strings only."""
        self.fail: list[int] = [-1] * len(self.next)
        self.pops: list[int] = [0] * len(self.next)
        queue = deque([0, 1])
        while queue:
            parent = queue.popleft()
            for symbol, node in self.next[parent].items():
                queue.append(node)
                if self.is_piece[node]:
                    self.fail[node], self.pops[node] = 1, 1
                    continue
                back, popped = self.fail[parent], self.pops[parent]
                while back >= 0 and symbol not in self.next[back]:
                    popped += self.pops[back]
                    back = self.fail[back]
                if back >= 0:
                    self.fail[node], self.pops[node] = self.next[back][symbol], popped

    def count(self, word: bytes) -> int:
        """Pieces of the word; 0 if the vocabulary cannot spell it."""
        step, fail, pops = self.next, self.fail, self.pops
        node = total = 0
        for symbol in word:
            while (child := step[node].get(symbol)) is None:
                total += pops[node]
                node = fail[node]
                if node < 0:
                    return 0
            node = child
        while node > 1:
            total += pops[node]
            node = fail[node]
        return total if node == 1 else 0


def byte_symbols() -> dict[str, int]:
    """The printable stand-ins of bytes in byte-level vocabularies.

    Bytes with a visible Latin-1 character stand for themselves, the others are numbered from 256 on.
    """
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(hidden)}


def byte_level_vocabulary(path: str) -> tuple[list[bytes], list[bytes]]:
    """Initial and continuing pieces of a byte-level vocabulary file: initial ones begin with a blank.

    Every byte is a continuing piece and the blank alone an initial one, so every word can be spelt.
    """
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = {t["content"] for t in spec["added_tokens"]}
    symbols = byte_symbols()
    found = [bytes(symbols[c] for c in piece) for piece in spec["model"]["vocab"] if piece not in special]
    return sorted(p for p in found if p[:1] == b" "), sorted(p for p in found if p[:1] != b" ")


#: Automata of this worker process with their counts of words met, by a key of the vocabulary.
_COUNTERS: dict[str, Memo] = {}


def word_lengths(documents: DataFrame, vocabulary_path: str) -> DataFrame:
    """Words and greedy word pieces of every whole text: doc_id, n_words, n_tokens, max_pieces.

    Words are split at ASCII white space; each is read with a blank before it. A null or empty text has none of
    either and max_pieces 0. Repeated rows and rows without id are counted each; an empty table gives no rows; other
    columns are ignored.
    """
    shared = documents.sparkSession.sparkContext.broadcast(byte_level_vocabulary(vocabulary_path))
    schema = "doc_id long, n_words long, n_tokens long, max_pieces long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if vocabulary_path not in _COUNTERS:
            automaton = PieceCounter(*shared.value)
            _COUNTERS[vocabulary_path] = Memo(lambda word: automaton.count(b" " + word))
        known = _COUNTERS[vocabulary_path]
        for batch in batches:
            rows = []
            for text in batch.column(1):
                found = [known[w] for w in text.as_py().encode("utf-8", "surrogatepass").split()]
                rows.append((len(found), sum(found), max(found, default=0)))
            columns = list(zip(*rows)) or [(), (), ()]
            yield pa.record_batch([batch.column(0), *(pa.array(c, pa.int64()) for c in columns)], schema.replace(" long", "").split(", "))

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_column().alias("text")).mapInArrow(run, schema)
