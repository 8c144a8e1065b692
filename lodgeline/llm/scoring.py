"""Language-model scores by a probabilistic suffix tree over words.

A state of the tree is a context of up to `depth` words. Every context of the training texts is a candidate; it is
retained if its next-word distribution diverges from that of its longest retained proper suffix by more than its own
parameters cost. A distribution is smoothed by absolute discounting into that of the suffix, down to the root, the
counts of single words. Each word is scored in the state of the longest retained suffix of the words before it.

The tree is never in one place. Texts lie in blocks, which ask buckets of hashes for the numbers and totals of their words.
All contexts that end in one word are tested, and the words after them scored, in one part of the tree, to which each
place of the texts is sent once; back come sums by text. A context too frequent for a part is hot: its edges are
counted in buckets, by block and not by place, its divergence is added up over the buckets, and the contexts one word
longer are parted among themselves. So all that is held at once is a block, a bucket or a part, and what is counted grows
with the corpus.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgeline.llm.common import mixed, staged, text_column, word_hashes, words
from lodgeline.scratch import scratch_path

#: Hash that stands for the end of a text.
END = np.uint64(0x5BD1E9955BD1E995)
#: Bits of a symbol number in the code of a context of a tree in memory.
SYMBOL_BITS = 20
#: Taken off each edge's count and given to the shorter context.
DISCOUNT = 0.5
#: Words of a block, about; a text is never cut.
BLOCK_WORDS = 500_000
#: Words of a corpus for which one set of buckets serves, and buckets of a set.
SET_WORDS, SET_BUCKETS = 1_000_000_000, 256
#: Buckets of a corpus of a few blocks.
FEW_BUCKETS = 16

#: Words of a part of the tree, about; a context that occurs so often is hot.
PART_WORDS = 1_000_000
#: Turns in which the parts of a large corpus are filled.
TURNS = 3
#: Divergence is added up in whole numbers of this fraction.
GAIN_UNIT = 2.0**20

#: Texts as ids, flags and sizes; different words as ascending hashes; and the place of each word among them.
BLOCK = "n long, n_words long, n_docs long, n_train long, docs binary, vocabulary binary, codes binary"
#: Arrays of length n, from a block to a bucket or part, or back.
MESSAGE = "block long, bucket long, kind string, n long, data binary"
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


@dataclass
class Symbols:
    """Words of the tree by hash; the last symbol, `rare`, is any other word."""

    hashes: np.ndarray
    counts: np.ndarray
    rare_count: int
    rare_kinds: int
    total: int
    kinds: int

    @property
    def rare(self) -> int:
        return len(self.hashes)

    def of(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, at, self.rare)

    def root(self) -> np.ndarray:
        counts = np.append(self.counts, self.rare_count)
        return (counts + 1.0) / (self.total + len(counts))


def _found(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Place of each wanted key among the sorted keys, -1 if absent."""
    if not len(keys):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


class Tree:
    """The same tree in memory, for corpora whose counts fit there.

    Retained contexts by depth, and the edges of all states; state 0 is the root.
    """

    def __init__(self, root: np.ndarray):
        self.root = root
        self.codes: list[np.ndarray] = []
        self.states: list[np.ndarray] = []
        self.parent = np.zeros(1, np.int64)
        self.rest = np.ones(1)
        self.edges = np.zeros(0, np.int64)
        self.values = np.zeros(0)

    def probability(self, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        out, share, state = np.zeros(len(state)), np.ones(len(state)), state.copy()
        while (live := np.flatnonzero(state)).size:
            own = state[live]
            at = _found(self.edges, own << (SYMBOL_BITS + 1) | symbol[live])
            out[live] += share[live] * np.where(at >= 0, self.values[at] if len(self.values) else 0.0, 0.0)
            share[live] *= self.rest[own]
            state[live] = self.parent[own]
        return out + share * self.root[symbol]

    def longest(self, codes: list[np.ndarray]) -> np.ndarray:
        """State of the longest retained context, given the codes of depth 1, 2, ..."""
        state = np.zeros(len(codes[0]) if codes else 0, np.int64)
        for own, states, code in zip(self.codes, self.states, codes):
            at = _found(own, code)
            state = np.where(at >= 0, states[at] if len(states) else 0, state)
        return state

    def grow(self, codes: np.ndarray, totals: np.ndarray, owner: np.ndarray, symbol: np.ndarray, count: np.ndarray) -> None:
        """Add the contexts of the next depth that diverge enough.

        codes (ascending) and totals are the candidates'; owner, symbol and count are their edges'.
        """
        depth = len(self.codes) + 1
        suffixes = [codes & ((1 << SYMBOL_BITS * d) - 1) for d in range(1, depth)]
        parent = self.longest(suffixes) if suffixes else np.zeros(len(codes), np.int64)
        n = totals.astype(float)
        value = (count - DISCOUNT) / n[owner]
        kept = np.bincount(owner, value, len(codes))
        rest = 1.0 - kept
        below = self.probability(parent[owner], symbol)
        smooth = value + rest[owner] * below
        share = count / n[owner]
        divergence = np.bincount(owner, share * np.log(smooth / below), len(codes))
        left = np.maximum(0.0, 1.0 - np.bincount(owner, share, len(codes)))
        divergence += left * np.log(np.maximum(rest, 1e-12))
        # An edge and a state each cost what describing them to a precision fit for n samples does.
        cost = 0.5 * np.log(n + 1.0) * (1.0 + np.bincount(owner, minlength=len(codes)))
        retained = (n * divergence > cost) & (rest > 0)
        state = np.cumsum(retained) - 1 + len(self.parent)
        own = retained[owner]
        edges = np.concatenate((self.edges, state[owner[own]] << (SYMBOL_BITS + 1) | symbol[own]))
        values = np.concatenate((self.values, value[own]))
        order = np.argsort(edges, kind="stable")
        self.edges, self.values = edges[order], values[order]
        self.parent = np.append(self.parent, parent[retained])
        self.rest = np.append(self.rest, rest[retained])
        self.codes.append(codes[retained])
        self.states.append(state[retained])


@dataclass
class Plan:
    """What all blocks know of the corpus."""

    depth: int
    symbol_share: float
    context_share: float
    #: Ranges of hashes by which contexts, and questions, are parted.
    parts: int
    buckets: int
    train_tokens: int = 0
    kinds: int = 0
    #: Parts are filled in turns, so that the disk holds only some of them at a time.
    turns: int = 1
    turn: int = 0
    #: Hot contexts by depth, as ascending hashes, and of the depths done: their count, number of edges, and if retained.
    hot: tuple[np.ndarray, ...] = ()
    states: tuple[tuple[np.ndarray, np.ndarray, np.ndarray], ...] = ()

    def root(self, count: np.ndarray) -> np.ndarray:
        return (count + 1.0) / (self.train_tokens + self.kinds + 1.0)

    def cost(self, n: np.ndarray, kinds: np.ndarray) -> np.ndarray:
        """An edge and a state each cost what describing them to a precision fit for n samples does."""
        return 0.5 * np.log(n + 1.0) * (1.0 + kinds)

    def retained(self, n: np.ndarray, gain: np.ndarray) -> np.ndarray:
        return (gain > 0) & (n > 0) & (n >= self.context_share * self.train_tokens)

    def after_single(self, below: np.ndarray) -> np.ndarray:
        """Probability of words after contexts that occur there and nowhere else, in training texts."""
        once = np.ones(1)
        smooth = (1.0 - DISCOUNT) + DISCOUNT * below
        return np.where(self.retained(once, np.log(smooth / below) - self.cost(once, once)), smooth, below)


def _blob(*arrays: np.ndarray) -> bytes:
    """Arrays of one length, byte by byte of their items, so that the many empty high bytes take no place."""
    planes = [np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T) for a in arrays]
    return pa.compress(b"".join(planes), codec="zstd", asbytes=True)


def _arrays(blob: bytes, n: int, *types: type) -> list[np.ndarray]:
    widths = [np.dtype(t).itemsize for t in types]
    raw = np.frombuffer(pa.decompress(blob, n * sum(widths), codec="zstd", asbytes=True), np.uint8)
    cuts = np.cumsum([0, *widths]) * n
    return [raw[a:b].reshape(w, n).T.copy().view(t).ravel() for a, b, w, t in zip(cuts, cuts[1:], widths, types)]


def _messages(rows: list[tuple]) -> pa.Table:
    """Rows of block, bucket, kind, n and data."""
    types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.binary())
    columns = list(zip(*rows)) or [()] * 5
    return pa.table([pa.array(c, t) for c, t in zip(columns, types)], ["block", "bucket", "kind", "n", "data"])


def _parted(of: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Value, begin and end of each run of equal values."""
    starts = np.flatnonzero(np.diff(of, prepend=-1))
    yield from zip(of[starts].tolist(), starts.tolist(), [*starts[1:].tolist(), len(of)])


def _range_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of each key in ascending order, and a place of each different one."""
    order = np.argsort(keys)
    ranked = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    number = np.empty(len(keys), np.int64)
    number[order] = np.cumsum(new) - 1
    return number, order[new]


def _longer(ends: np.ndarray, words_at: np.ndarray) -> np.ndarray:
    """Hashes of runs by last word: that of the run one word shorter at the word before, and the last word."""
    shorter = np.zeros(len(ends), np.uint64)
    shorter[1:] = ends[:-1]
    return mixed(shorter + words_at * np.uint64(0x9E3779B97F4A7C15))


class Block:
    """The words of a block: hashes of the different ones (ascending), and the number of each word among them."""

    def __init__(self, row: dict):
        self.name = row["block"]
        self.ids, self.held, self.sizes = _arrays(row["docs"], row["n_docs"], np.int64, np.uint8, np.uint32)
        (self.vocabulary,) = _arrays(row["vocabulary"], row["n_words"], np.uint64)
        (codes,) = _arrays(row["codes"], row["n"], np.uint32)
        self.codes = codes.astype(np.int64)
        self.sizes = self.sizes.astype(np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.train = np.repeat(self.held & 1 == 0, self.sizes)
        self.inside = np.arange(len(codes)) - np.repeat(self.starts, self.sizes)
        self.words_at = self.vocabulary[self.codes]

    def word_questions(self, plan: Plan) -> list[tuple]:
        """The different words and their counts in training texts and in all, by bucket."""
        n = len(self.vocabulary)
        trained, all_ = np.bincount(self.codes[self.train], minlength=n), np.bincount(self.codes, minlength=n)
        bounds = _parted(_range_of(self.vocabulary, plan.buckets))
        columns = self.vocabulary, trained.astype(np.uint32), all_.astype(np.uint32)
        return [(self.name, b, "word", hi - lo, _blob(*(c[lo:hi] for c in columns))) for b, lo, hi in bounds]

    def heavy(self, depth: int, least: float) -> Iterator[tuple[int, int, int]]:
        """Size, hash and count of the contexts that occur `least` times in the block."""
        at = np.flatnonzero(self.inside) - 1
        ends = self.words_at
        for size in range(1, depth + 1):
            ends = ends if size == 1 else _longer(ends, self.words_at)
            at = at[self.inside[at] >= size - 1]
            number, first = _numbered(ends[at])
            count = np.bincount(number, minlength=len(first))
            yield from ((size, k, n) for k, n in zip(ends[at[first[count >= least]]].view(np.int64).tolist(), count[count >= least].tolist()))
            at = at[count[number] >= least]

    def known(self, answers: dict[str, list[tuple]]) -> None:
        parts = [_arrays(data, n, np.uint32, np.int64, np.bool_) for n, data in answers["word"]]
        self.word, self.count, self.once = (np.concatenate(c)[self.codes] for c in zip(*parts))

    def before(self, flags: np.ndarray, depth: int) -> np.ndarray:
        """Number of words before each place, `depth` at most, up to the nearest with a flag."""
        out = np.minimum(self.inside, depth)
        for back in range(depth, 0, -1):
            at = np.flatnonzero(out >= back)
            out[at[flags[at - back]]] = back - 1
        return out

    def open(self, plan: Plan, answers: dict[str, list[tuple]]) -> tuple[np.ndarray, list[np.ndarray], tuple | None]:
        """Probability of each word in the hot contexts before it, the places that a cold context of each depth decides,
        and the next question about hot contexts."""
        probability, cold = plan.root(self.count), []
        self.deep = np.minimum(self.inside, plan.depth)
        if plan.symbol_share:
            self.deep = self.before(self.count < plan.symbol_share * plan.train_tokens, plan.depth)
        at, ends = np.arange(len(self.codes)), self.words_at
        for d in range(1, plan.depth + 1):
            at = at[self.deep[at] >= d]
            of = _found(plan.hot[d - 1], ends[at - 1]) if d <= len(plan.hot) else np.full(len(at), -1)
            cold.append(at[of < 0])
            at, of = at[of >= 0], of[of >= 0]
            if not len(at):
                break
            ends = _longer(ends, self.words_at)
            number, first = _numbered(ends[at])
            if len(plan.states) < d:
                trained = np.bincount(number[self.train[at]], minlength=len(first))
                keys, owner = ends[at[first]], of[first]
                return probability, cold, (d, keys, owner.astype(np.uint32), trained.astype(np.uint32), probability[at[first]])
            total = np.concatenate([_arrays(data, n, np.int64)[0] for n, data in answers[f"edge{d}"]])[number]
            n, kinds, retained = (x[of] for x in plan.states[d - 1])
            n = np.maximum(n, 1.0)
            inner = np.maximum(0.0, total - DISCOUNT) / n + DISCOUNT * kinds / n * probability[at]
            probability[at] = np.where(retained, inner, probability[at])
        return probability, cold, None

    def edge_questions(self, plan: Plan, answers: dict[str, list[tuple]]) -> list[tuple]:
        self.known(answers)
        question = self.open(plan, answers)[2]
        if question is None:
            return []
        d, keys, *columns = question
        bounds = _parted(_range_of(keys, plan.buckets))
        return [(self.name, b, f"edge{d}", hi - lo, _blob(keys[lo:hi], *(c[lo:hi] for c in columns))) for b, lo, hi in bounds]

    def context_questions(self, plan: Plan, answers: dict[str, list[tuple]]) -> list[tuple]:
        """The words after cold contexts, by part of their contexts, and the sums of all other words by text."""
        self.known(answers)
        probability, cold, _ = self.open(plan, answers)
        reach = np.minimum(self.deep, self.before(self.once, plan.depth))
        text = np.repeat(np.arange(len(self.sizes)), self.sizes)
        closed, out = np.ones(len(self.codes), bool), []
        # Kind k: contexts up to k - 1 words are done.
        for start, at in enumerate(cold, 1):
            asks = reach[at] >= start
            alone, at = at[~asks & self.train[at]], at[asks]
            for d in range(start, plan.depth + 1):
                alone = alone[self.deep[alone] >= d]
                probability[alone] = plan.after_single(probability[alone])
            closed[at] = False
            h = np.zeros(len(at), np.uint64)
            for back in range(1, start + 1):
                h = mixed(h + self.word[at - back])
            part = _range_of(h, plan.parts) + (start - 1) * plan.parts
            now = np.flatnonzero(part % plan.turns == plan.turn)
            order = now[np.argsort(part[now], kind="stable")]
            at, part = at[order], part[order]
            columns = [np.where(reach[at] >= back, self.word[at - back], np.uint32(0)) for back in range(1, plan.depth + 1)]
            columns += [self.word[at], self.train[at], reach[at].astype(np.uint8), self.deep[at].astype(np.uint8)]
            value = self.count[at] if start == 1 else probability[at]
            for p, lo, hi in _parted(part):
                of = np.diff(text[at[lo:hi]], prepend=0).astype(np.uint32)
                out.append((self.name, p, f"after{start}", hi - lo, _blob(*(c[lo:hi] for c in columns), of, value[lo:hi])))
        if not plan.turn:
            n = len(self.sizes)
            known = np.bincount(text, self.count > 0, n).astype(np.int64)
            base = np.bincount(text, np.log10(plan.root(self.count)), n)
            score = np.bincount(text[closed], np.log10(probability[closed]), n)
            out.append((self.name, -1 - self.name, "texts", n, _blob(self.ids, self.held, self.sizes, known, base, score)))
        return out


def _blocks(documents: DataFrame, block_words: int) -> DataFrame:
    """doc_id, held_out and text, as blocks of whole texts."""

    def packed(held: list) -> pa.RecordBatch:
        ids, outs, hashes = zip(*held)
        coded = pa.array(np.concatenate(hashes)).dictionary_encode()
        vocabulary = coded.dictionary.to_numpy()
        order = np.argsort(vocabulary)
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order))
        sizes = np.array([len(h) for h in hashes], np.uint32)
        # Bit 0: held out; bit 1: without id.
        flags = np.array([out | (k is None) << 1 for k, out in zip(ids, outs)], np.uint8)
        docs = _blob(np.array([k or 0 for k in ids], np.int64), flags, sizes)
        n_train = int(sizes[flags & 1 == 0].sum())
        row = [len(coded), len(vocabulary), len(sizes), n_train, docs, _blob(vocabulary[order]), _blob(rank[coded.indices.to_numpy()])]
        return pa.record_batch([pa.array([x]) for x in row], ["n", "n_words", "n_docs", "n_train", "docs", "vocabulary", "codes"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for doc_id, out, text in zip(*batch.columns):
                hashes = np.append(word_hashes(words(text.as_py())), END)
                held.append((doc_id.as_py(), out.as_py(), hashes))
                size += len(hashes)
                if size >= block_words:
                    yield packed(held)
                    held, size = [], 0
        if held:
            yield packed(held)

    return documents.mapInArrow(run, BLOCK).withColumn("block", F.monotonically_increasing_id())


def _by_block(rows: DataFrame, label: str) -> DataFrame:
    """`rows`, written in buckets of the block, so that the rounds bring answers to them and never shuffle them again."""
    spark = rows.sparkSession
    parts, name = int(spark.conf.get("spark.sql.shuffle.partitions")), f"lodgeline_{label}_{uuid.uuid4().hex}"
    writer = rows.repartition(parts, "block").write.option("compression", "zstd").option("path", scratch_path(spark, f"llm-{label}"))
    with _shuffles_dropped(spark):
        writer.bucketBy(parts, "block").sortBy("block").saveAsTable(name)
    table = spark.table(name)
    # The files stay; only their name goes.
    spark.sql(f"DROP TABLE {name}")
    return table


def _word_answers(questions: pa.Table, buckets: int) -> pa.Table:
    """Number and total of a bucket's words, and if one occurs once in all texts, for each block that has asked, in the order of its question.

    Frequent words have low numbers, which take less place.
    """
    rows = questions.sort_by("block").to_pylist()
    parts = [_arrays(r["data"], r["n"], np.uint64, np.uint32, np.uint32) for r in rows]
    keys, trained, all_ = (np.concatenate(c) for c in zip(*parts))
    number, first = _numbered(keys)
    total, often = (np.bincount(number, x, len(first)).astype(np.int64) for x in (trained, all_))
    rank = np.empty(len(first), np.uint32)
    rank[np.argsort(-often, kind="stable")] = np.arange(len(first))
    # Numbers of different buckets differ, too.
    if len(first) * buckets > 2**32:
        raise OverflowError("more different words than 32 bits can number")
    rank = rank * np.uint32(buckets) + np.uint32(rows[0]["bucket"])
    return _told(rows, "word", int((total > 0).sum()), number, rank, total, often == 1)


def _told(rows: list[dict], kind: str, n: int, number: np.ndarray, *columns: np.ndarray, data: bytes = b"") -> pa.Table:
    """What each block of `rows` asked for, and a row for no block."""
    bucket, out = rows[0]["bucket"], [(-1, rows[0]["bucket"], kind, n, data)]
    cuts = np.cumsum([0, *(r["n"] for r in rows)])
    for r, lo, hi in zip(rows, cuts, cuts[1:]):
        out.append((r["block"], bucket, kind, r["n"], _blob(*(c[number[lo:hi]] for c in columns))))
    return _messages(out)


def _edge_answers(questions: pa.Table) -> pa.Table:
    """Totals of edges of hot contexts, and in the row for no block these edges: context, count and shorter probability."""
    rows = questions.sort_by("block").to_pylist()
    parts = [_arrays(r["data"], r["n"], np.uint64, np.uint32, np.uint32, np.float64) for r in rows]
    keys, owner, count, below = (np.concatenate(c) for c in zip(*parts))
    number, first = _numbered(keys)
    total = np.bincount(number, count, len(first)).astype(np.int64)
    seen = total > 0
    data = _blob(owner[first[seen]], total[seen], below[first[seen]])
    return _told(rows, rows[0]["kind"], int(seen.sum()), number, total, data=data)


def _hot_states(edges: DataFrame, plan: Plan, contexts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Count, number of edges, and if retained, of the hot contexts of a depth, from their edges in buckets."""

    def summed(value: Callable[..., list[np.ndarray]]) -> list[np.ndarray]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for r in (r for batch in batches for r in batch.to_pylist() if r["n"]):
                owner, count, below = _arrays(r["data"], r["n"], np.uint32, np.int64, np.float64)
                at = np.unique(owner)
                sums = [np.bincount(owner, x, contexts)[at] for x in value(owner, count, below)]
                yield pa.record_batch([pa.array(at.astype(np.int64)), *(pa.array(np.rint(x).astype(np.int64)) for x in sums)], ["context", "a", "b"])

        sums = edges.mapInArrow(run, "context long, a long, b long").groupBy("context").agg(F.sum("a"), F.sum("b"))
        out = np.zeros((2, contexts))
        for k, a, b in sums.collect():
            out[:, k] = a, b
        return list(out)

    n, kinds = summed(lambda owner, count, below: [count, np.ones(len(count))])

    def gains(owner: np.ndarray, count: np.ndarray, below: np.ndarray) -> list[np.ndarray]:
        smooth = (count - DISCOUNT) / n[owner] + DISCOUNT * kinds[owner] / n[owner] * below
        # As whole numbers, so that the sum does not depend on the order.
        return [count * np.log(smooth / below) * GAIN_UNIT, np.zeros(len(count))]

    gain = summed(gains)[0] / GAIN_UNIT
    return n, kinds, plan.retained(n, gain - plan.cost(n, kinds))


def _after(
    before: list[np.ndarray], word: np.ndarray, train: np.ndarray, reach: np.ndarray, deep: np.ndarray, below: np.ndarray, start: int, plan: Plan
) -> np.ndarray:
    """Probability of each word, given that in contexts shorter than `start`; all words after each context are here.

    Contexts have up to `deep` words; longer ones than `reach` occur once.
    """
    out, alone = below.copy(), np.zeros(0, np.int64)
    at, context = np.arange(len(word)), np.zeros(len(word), np.uint64)
    for d in range(1, plan.depth + 1):
        more = reach[at] >= d
        alone = np.concatenate((alone, at[~more & train[at]]))
        at, context = at[more], context[more]
        number, first = _numbered(context << np.uint64(32) | before[d - 1][at])
        context = number.astype(np.uint64)
        if d < start:
            continue
        repeated = np.bincount(number, minlength=len(first))[number] > 1
        alone = np.concatenate((alone, at[~repeated & train[at]]))
        alone = alone[deep[alone] >= d]
        out[alone] = plan.after_single(out[alone])
        at, context, number = at[repeated], context[repeated], number[repeated]
        edge, place = _numbered(context << np.uint64(32) | word[at])
        count, own = np.bincount(edge, train[at], len(place)), out[at[place]]
        of, seen = number[place], count > 0
        n, kinds = np.bincount(of, count, len(first)), np.bincount(of[seen], minlength=len(first))
        rest = DISCOUNT * kinds / np.maximum(n, 1.0)
        inner = np.maximum(0.0, count - DISCOUNT) / np.maximum(n, 1.0)[of] + rest[of] * own
        gain = np.bincount(of[seen], count[seen] * np.log(inner[seen] / own[seen]), len(first)) - plan.cost(n, kinds)
        out[at] = np.where(plan.retained(n, gain)[of], inner, own)[edge]
    return out


def _sums(questions: pa.Table, plan: Plan) -> pa.Table:
    """The logarithms of the words of a part, added by text of each block."""
    rows = questions.sort_by("block").to_pylist()
    if rows[0]["kind"] == "texts":
        return questions
    start = int(rows[0]["kind"][len("after") :])
    types = [*[np.uint32] * plan.depth, np.uint32, np.bool_, np.uint8, np.uint8, np.uint32, np.int64 if start == 1 else np.float64]
    parts = [_arrays(r["data"], r["n"], *types) for r in rows]
    *before, word, train, reach, deep, steps, value = (np.concatenate(c) for c in zip(*parts))
    below = plan.root(value) if start == 1 else value
    logs = np.log10(_after(before, word, train, reach, deep, below, start, plan))
    out, cuts = [], np.cumsum([0, *(r["n"] for r in rows)])
    for r, lo, hi in zip(rows, cuts, cuts[1:]):
        text = np.cumsum(steps[lo:hi], dtype=np.int64)
        begins = np.flatnonzero(np.diff(text, prepend=-1))
        steps_of = np.diff(text[begins], prepend=0).astype(np.uint32)
        out.append((r["block"], r["bucket"], "sums", len(begins), _blob(steps_of, np.add.reduceat(logs[lo:hi], begins))))
    return _messages(out)


def _scores(told: pa.Table, plan: Plan) -> pa.Table:
    """A block's texts, with the sums of all parts."""
    # The block's own row has the lowest bucket.
    own, *rows = told.sort_by("bucket").to_pylist()
    types = np.int64, np.uint8, np.int64, np.int64, np.float64, np.float64
    ids, flags, sizes, known, base, score = _arrays(own["data"], own["n"], *types)
    for r in rows:
        steps, sums = _arrays(r["data"], r["n"], np.uint32, np.float64)
        score[np.cumsum(steps, dtype=np.int64)] += sums
    columns = [pa.array(ids, mask=flags & 2 > 0), pa.array(flags & 1 > 0), sizes, known, np.full(len(sizes), plan.train_tokens), base, score]
    return pa.table(dict(zip(["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"], columns)))


@contextmanager
def _shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a written stage go when it is written; nothing reads them again."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def held_out():
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) == 2, F.lit(False))


def suffix_tree_scores(
    documents: DataFrame,
    symbol_share: float = 0.0,
    context_share: float = 0.0,
    depth: int = 3,
    block_words: int = BLOCK_WORDS,
    part_words: int = PART_WORDS,
) -> DataFrame:
    """Scores of every whole text: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learnt from the documents that are not held out. Each text ends in one more token, so a null or empty text has one
    token. Null ids are not held out. Repeated rows are learnt from and scored each; an empty table gives no rows, and
    a corpus without training texts gives every token the probability 1. Other columns are ignored.

    By default every context that occurs is tested. Contexts that make up less than `context_share` of the training
    tokens, or hold a word below `symbol_share`, are not retained. Words, and hot contexts, are told apart by 64-bit hashes.
    """
    spark = documents.sparkSession
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), text_column().alias("text"))
    blocks = _by_block(_blocks(rows, block_words), "blocks")
    whole = blocks.agg(F.sum("n_train").alias("n_train"), F.sum("n").alias("n"), F.count("*").alias("blocks")).first()
    tokens = whole["n"] or 0
    buckets = FEW_BUCKETS if tokens < 8 * block_words else SET_BUCKETS * (1 + tokens // SET_WORDS)
    plan = Plan(depth, symbol_share, context_share, max(FEW_BUCKETS, 1 + tokens // part_words), buckets, whole["n_train"] or 0)

    def answered(questions: DataFrame, answer: Callable, label: str) -> DataFrame:
        with _shuffles_dropped(spark):
            return staged(questions.groupBy("bucket").applyInArrow(answer, MESSAGE), label)

    def told(answers: DataFrame, method: str) -> DataFrame:
        def run(block: pa.Table, known: pa.Table) -> pa.Table:
            by_kind: dict[str, list] = {}
            for r in known.sort_by("bucket").to_pylist():
                by_kind.setdefault(r["kind"], []).append((r["n"], r["data"]))
            return _messages(getattr(Block(block.to_pylist()[0]), method)(now, by_kind))

        now = plan
        return blocks.groupBy("block").cogroup(answers.where("block >= 0").groupBy("block")).applyInArrow(run, MESSAGE)

    def word_questions(block: pa.Table) -> pa.Table:
        return _messages(Block(block.to_pylist()[0]).word_questions(plan))

    answers = answered(blocks.groupBy("block").applyInArrow(word_questions, MESSAGE), lambda t: _word_answers(t, buckets), "words")
    plan = replace(plan, kinds=answers.where("block < 0").agg(F.sum("n")).first()[0] or 0)
    # A context that occurs `part_words` times occurs at least so often in some block, and half as often in such blocks.
    plan = replace(plan, hot=_hot(blocks, depth, part_words, whole["blocks"]) if tokens > part_words else ())
    for d in range(1, len(plan.hot) + 1):
        edges = answered(told(answers, "edge_questions"), _edge_answers, f"edges-{d}")
        state = _hot_states(edges.where("block < 0"), plan, len(plan.hot[d - 1]))
        plan = replace(plan, states=(*plan.states, state))
        answers = answers.union(edges)
    sums = spark.createDataFrame([], MESSAGE)
    turns = TURNS if tokens > part_words else 1
    for turn in range(turns):
        plan = replace(plan, turns=turns, turn=turn)
        sums = sums.union(answered(told(answers, "context_questions"), lambda t: _sums(t, plan), f"sums-{turn}"))
    return sums.groupBy("block").applyInArrow(lambda t: _scores(t, plan), SCORES)


def _hot(blocks: DataFrame, depth: int, part_words: int, n_blocks: int) -> tuple[np.ndarray, ...]:
    """By depth, all contexts that occur `part_words` times, and some that occur half as often: few, in any corpus."""

    def run(block: pa.Table) -> pa.Table:
        rows = list(Block(block.to_pylist()[0]).heavy(depth, part_words / (2 * n_blocks)))
        return pa.table([pa.array(c, pa.int64()) for c in (list(zip(*rows)) or [()] * 3)], ["size", "context", "n"])

    found = blocks.groupBy("block").applyInArrow(run, "size long, context long, n long").groupBy("size", "context").agg(F.sum("n").alias("n"))
    rows = found.where(F.col("n") >= part_words / 2).collect()
    by_depth = [np.sort(np.array([r["context"] for r in rows if r["size"] == d], np.int64).view(np.uint64)) for d in range(1, depth + 1)]
    return tuple(x for x in by_depth if len(x))
