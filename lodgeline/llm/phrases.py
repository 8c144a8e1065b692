"""Phrases whose words stand together, mined by Toivonen's method.

A sample proposes phrases: it is mined level by level at a lowered threshold. One pass over all texts then counts the
proposed phrases and their negative border, which are the phrases that are not proposed but whose parts are. A border
phrase that turns out frequent is a failure of the sample: it joins the proposals, and a further pass counts the failures
and the border they add, until a pass finds no failure. Then no frequent phrase is left out, whatever the sample was.

Proposals are tested in a bit map of fixed size, built by Spark's bitmap aggregates, which is all that is broadcast. A
phrase that only shares a proposal's bit is counted as well, which costs time and changes nothing. Proposed phrases are
counted by their words, border phrases by a 64-bit hash, whose count can only be too high: the next pass counts by words
what it lets through.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodgeline.llm.common import mixed, staged, text_column

#: Words of the longest phrases.
MOST = 4
#: One document in so many is in the sample.
SAMPLE = 16
#: Bits of the map of proposals: 2**27 bits are 16 MB.
BITS = 27
#: Bytes of text that are worked on at once.
PART = 1_000_000
#: Counts by hash, and by words, that a task holds before it sends them on.
HELD = 5_000_000
NAMED = 1_000_000

_PIECES = bytes.maketrans(b".,;:!?\x0b\x0c\r", b"\n" * 9)
_IN_WORD = np.ones(256, bool)
_IN_WORD[list(b" \t\n")] = False
#: Hash of a byte, and the base of a word's polynomial hash, which is odd and so has an inverse among 64-bit numbers.
_BYTES = mixed(np.arange(1, 257, dtype=np.uint64))
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)


@lru_cache(maxsize=4)
def _powers(base: int, n: int) -> np.ndarray:
    return np.concatenate([np.ones(1, np.uint64), np.multiply.accumulate(np.full(n - 1, base, np.uint64))])


class Slice(NamedTuple):
    """Prepared bytes of several texts, or of a part of a long one.

    For each text: where it starts, where what earlier slices have not shown starts, and the number of its language.
    """

    data: bytes
    starts: list[int]
    fresh: list[int]
    langs: list[int]
    names: list[str]


def _parts(text: bytes) -> Iterator[tuple[bytes, int]]:
    """A text with pieces ending at line feeds, in parts, and how many bytes of each the part before has shown.

    A part ends at a blank, and the next one starts with its last words, so that no phrase is lost.
    """
    text = text.lower().translate(_PIECES)
    start = shown = 0
    while True:
        end = text.find(b" ", start + shown + PART)
        if end < 0:
            yield text[start:], shown
            return
        yield text[start:end], shown
        back = end
        for _ in range(MOST - 1):
            # Back over blanks, then over a word.
            back = start + len(text[start:back].rstrip(b" \t\n"))
            back = max(start, *(text.rfind(c, start, back) + 1 for c in (b" ", b"\t", b"\n")))
        start, shown = back, end - back


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[Slice]:
    held: list[bytes] = []
    spans: list[tuple[int, int, str]] = []
    size = 0

    def cut() -> Slice:
        names = sorted({lang for _, _, lang in spans})
        number = {lang: k for k, lang in enumerate(names)}
        return Slice(b"\n".join([*held, b""]), [a for a, _, _ in spans], [a + n for a, n, _ in spans], [number[lang] for _, _, lang in spans], names)

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            for part, shown in _parts(text.as_py()):
                spans.append((size, shown, lang))
                held.append(part)
                size += len(part) + 1
                if size >= PART:
                    yield cut()
                    held, spans, size = [], [], 0
    if held:
        yield cut()


class Words(NamedTuple):
    """Starts, ends, hashes, pieces and languages of a slice's words, and whether they are shown for the first time."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    piece: np.ndarray
    lang: np.ndarray
    fresh: np.ndarray


def _words(s: Slice) -> Words:
    """The words, found and hashed over all bytes at once.

    A word's hash is the sum of its bytes' hashes times powers of a base: a difference of running sums, brought back
    to the power zero by the inverse. Its length is mixed in.
    """
    data = np.frombuffer(s.data, np.uint8)
    inside = np.concatenate([[False], _IN_WORD[data], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edges[::2], edges[1::2]
    size = max(1 << (len(data)).bit_length(), 2)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTES[data] * _powers(_BASE, size)[: len(data)])])
    h = mixed((sums[end] - sums[start]) * _powers(_INVERSE, size)[start] + (end - start).astype(np.uint64))
    piece = np.cumsum(data == 10)[start]
    text = np.searchsorted(np.array(s.starts), start, side="right") - 1
    return Words(start, end, h, piece, np.array(s.langs)[text], start >= np.array(s.fresh)[text])


def _levels(w: Words, names: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For 1 to MOST words: the hash of the phrase from each word on, and whether it is one and is not shown before."""
    seeds = np.array([xxhash.xxh3_64_intdigest(name) for name in names], np.uint64)
    # A phrase's hash comes from that of the phrase without its last word, so its length and order are in it.
    found = mixed(w.hash ^ seeds[w.lang])
    yield found, w.fresh
    for k in range(1, MOST):
        n = max(len(w.hash) - k, 0)
        found = mixed(found[:n] + mixed(w.hash[k:] + np.uint64(k)))
        yield found, (w.piece[:n] == w.piece[k:]) & w.fresh[k:]


def _has(bits: np.ndarray | None, h: np.ndarray) -> np.ndarray:
    if bits is None:
        return np.zeros(len(h), bool)
    shift = 64 - int(len(bits) * 8 - 1).bit_length()
    at = h >> np.uint64(shift)
    return (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & np.uint8(1) != 0


def _joined(known: np.ndarray | None, n: int) -> np.ndarray:
    """Whether both parts of a phrase, without its last and without its first word, are proposed."""
    return np.ones(n, bool) if known is None else known[:n] & known[1 : n + 1]


class _Border:
    """Counts by hash in order of the hash; new ones are put in among them whenever some are held back."""

    def __init__(self):
        self.hash, self.n = np.empty(0, np.uint64), np.empty(0, np.int32)
        self.held: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, h: np.ndarray) -> bool:
        """Whether there are so many that they should be sent on."""
        h, n = np.unique(h, return_counts=True)
        self.held.append((h, n.astype(np.int32)))
        self.size += len(h)
        if self.size > HELD // 8:
            self.merge()
        return len(self.hash) > HELD

    def merge(self) -> None:
        if not self.held:
            return
        h = np.concatenate([h for h, _ in self.held])
        n = np.concatenate([n for _, n in self.held])
        self.held, self.size = [], 0
        order = np.argsort(h)
        h, n = h[order], n[order]
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        h, n = h[first], np.add.reduceat(n, first)
        at = np.searchsorted(self.hash, h)
        known = np.zeros(len(h), bool)
        inside = at < len(self.hash)
        known[inside] = self.hash[at[inside]] == h[inside]
        self.n[at[known]] += n[known]
        self.n = np.insert(self.n, at[~known], n[~known])
        self.hash = np.insert(self.hash, at[~known], h[~known])

    def take(self) -> Iterator[pa.RecordBatch]:
        self.merge()
        for k in range(0, len(self.hash), 100_000):
            part = self.hash[k : k + 100_000].view(np.int64)
            empty = pa.nulls(len(part), pa.string())
            n = pa.array(self.n[k : k + 100_000], pa.int64())
            yield pa.record_batch([empty, empty, pa.array(part), n], ["lang", "phrase", "hash", "n"])
        self.hash, self.n = self.hash[:0], self.n[:0]


class _Named:
    """Counts by hash in order of the hash, with each phrase's language and words, which are taken from the text once."""

    def __init__(self):
        self.hash, self.n, self.at = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int32)
        self.phrases: list[bytes] = []
        self.langs: list[str] = []

    def add(self, h: np.ndarray, n: np.ndarray, words: Callable[[int], tuple[str, bytes]]) -> None:
        """Counts of different hashes; `words` gives language and phrase of the k-th of them."""
        order = np.argsort(h)
        h, n = h[order], n[order]
        at = np.searchsorted(self.hash, h)
        known = np.zeros(len(h), bool)
        inside = at < len(self.hash)
        known[inside] = self.hash[at[inside]] == h[inside]
        self.n[at[known]] += n[known]
        new = np.flatnonzero(~known)
        first = len(self.phrases)
        for k in order[new].tolist():
            lang, phrase = words(k)
            self.langs.append(lang)
            self.phrases.append(phrase)
        self.at = np.insert(self.at, at[new], np.arange(first, len(self.phrases), dtype=np.int32))
        self.n = np.insert(self.n, at[new], n[new])
        self.hash = np.insert(self.hash, at[new], h[new])

    def take(self) -> Iterator[pa.RecordBatch]:
        n = np.empty(len(self.n), np.int64)
        n[self.at] = self.n
        for k in range(0, len(n), 100_000):
            phrases = pa.array(self.phrases[k : k + 100_000], pa.binary()).cast(pa.string())
            langs, none = pa.array(self.langs[k : k + 100_000], pa.string()), pa.nulls(len(phrases), pa.int64())
            yield pa.record_batch([langs, phrases, none, pa.array(n[k : k + 100_000])], ["lang", "phrase", "hash", "n"])
        self.__init__()


def _shared(spark: SparkSession, bits: np.ndarray | None) -> Broadcast:
    """The map for all tasks, compressed: with few proposals it is next to nothing."""
    return spark.sparkContext.broadcast(None if bits is None else zlib.compress(bits.tobytes(), 1))


def _opened(shared: Broadcast) -> np.ndarray | None:
    return None if shared.value is None else np.frombuffer(zlib.decompress(shared.value), np.uint8)


def _counted(texts: DataFrame, shared: Broadcast, earlier: Broadcast, least: int, name: bool, first: bool) -> DataFrame:
    """Counts of `least` or more that no earlier pass has: lang, phrase, hash, n.

    `shared` are the proposals now and `earlier` those of the pass before. Proposed phrases come with their words (not
    without `name`), border phrases with their hash. The first pass also counts all words of a language, as the
    phrase without words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, then = _opened(shared), _opened(earlier)
        border, named, totals = _Border(), _Named(), Counter()
        for part in _slices(batches):
            known = known_then = None
            w, names = _words(part), part.names
            found: list[tuple[np.ndarray, np.ndarray, np.ndarray, int]] = []
            for k, (h, whole) in enumerate(_levels(w, names), 1):
                open_now = _joined(known, len(h))
                # Before the first pass nothing was counted; after it words have all been.
                open_then = np.zeros(len(h), bool) if first else _joined(known_then, len(h))
                known, known_then = _has(now, h), _has(then, h)
                if name:
                    todo = np.flatnonzero(whole & open_now & known & ~(open_then & known_then))
                    own, at, n = np.unique(h[todo], return_index=True, return_counts=True)
                    found.append((own, n, todo[at], k))
                new = h[whole & open_now & ~open_then & ~known]
                if len(new) and border.add(new):
                    yield from border.take()
                if first and name and k == 1:
                    totals.update(dict(zip(names, np.bincount(w.lang[whole], minlength=len(names)).tolist())))
            if found:
                at = np.concatenate([at for _, _, at, _ in found])
                size = np.concatenate([np.full(len(at), k) for _, _, at, k in found])
                lang, start, end = w.lang[at], w.start[at], w.end[at + size - 1]

                def words(k: int, part=part, lang=lang, start=start, end=end, size=size) -> tuple[str, bytes]:
                    phrase = part.data[start[k] : end[k]]
                    return part.names[lang[k]], b" ".join(phrase.split()) if size[k] > 1 else phrase

                named.add(np.concatenate([h for h, _, _, _ in found]), np.concatenate([n for _, n, _, _ in found]), words)
                if len(named.hash) > NAMED:
                    yield from named.take()
        yield from named.take()
        yield from border.take()
        if totals:
            langs, n = list(totals), list(totals.values())
            empty, none = pa.array([""] * len(n), pa.string()), pa.nulls(len(n), pa.int64())
            yield pa.record_batch([pa.array(langs, pa.string()), empty, none, pa.array(n, pa.int64())], ["lang", "phrase", "hash", "n"])

    rows = texts.mapInArrow(run, "lang string, phrase string, hash long, n long")
    # A task has added up what it met, and most of the border is met once: adding up again before the shuffle only
    # fills memory. So rows are dealt by their key first.
    rows = rows.repartition("lang", "phrase", "hash")
    counts = rows.groupBy("lang", "phrase", "hash").agg(F.sum("n").alias("n"))
    return counts.where((F.col("n") >= least) | (F.col("phrase") == ""))


def _with(bits: np.ndarray | None, hashes: DataFrame, size: int) -> np.ndarray | None:
    """`bits` with those of `hashes` set, or the same if there are none."""
    place = F.shiftrightunsigned("hash", 64 - size) + 1
    maps = hashes.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")
    )
    # At most 2**size bits in all.
    found = maps.collect()
    if not found:
        return bits
    out = np.zeros(2**size // 8, np.uint8) if bits is None else bits.copy()
    for row in found:
        own = np.frombuffer(row["bits"], np.uint8)
        at = (row["bucket"] - 1) * len(own)
        room = out[at : at + len(own)]
        room |= own[: len(room)]
    return out


def frequent(documents: DataFrame, least: int = 30, sample: int = SAMPLE, size: int = BITS) -> DataFrame:
    """All phrases of up to four words that occur `least` times or more in a language: lang, phrase, n.

    The phrase without words counts all words of a language. See `collocations` for words and pieces.
    """
    named = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(sample))
    placed = documents.select(named.alias("lang"), text_column().cast("binary").alias("text"), place.alias("place"))
    texts, drawn = placed.select("lang", "text"), placed.where("place = 0").select("lang", "text")
    spark = documents.sparkSession
    bits, out = None, None
    now = before = _shared(spark, None)
    lowered = max(2, 3 * least // (4 * sample))
    # The sample is mined level by level, as its border holds the next longer phrases; then all texts, until a pass finds
    # no failure. Nothing that an earlier pass over the sample has seen counts as seen by the passes over all texts.
    for rows, threshold, name in ((drawn, lowered, False), (texts, least, True)):
        then, passes = before, 0
        while name or passes < MOST:
            found = staged(_counted(rows, now, then, threshold, name, first=passes == 0), "counted" if name else "proposed")
            passes += 1
            if name:
                named = found.where("phrase IS NOT NULL").select("lang", "phrase", "n")
                out = named if out is None else out.union(named)
            more = _with(bits, found.where("hash IS NOT NULL"), size)
            if more is bits:
                break
            # Two maps are alive at a time; the files of older ones go.
            if then is not before:
                then.destroy()
            bits, then, now = more, now, _shared(spark, more)
        if then is not before:
            then.destroy()
    return out


def collocations(documents: DataFrame, least: int = 30, percent: int = 80, top: int = 2000, sample: int = SAMPLE, size: int = BITS) -> DataFrame:
    """The best phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased (A-Z) and split at `.,;:!?` and line ends into pieces, those at blanks and tabs into words.
    A phrase of 2 to 4 words that occurs a >= `least` times is cut in two; of the cuts the one with the least score
    floor(2000000 * a / (l + r)) counts, ties to the shortest first part, where l and r are the counts of both parts. A
    phrase goes if a longer one around it occurs in `percent` of its places or more. Null texts have no words, null
    languages are `und`, repeated rows count again, rows without id count like any other, an empty table gives no rows
    and other columns are ignored.
    """
    found = frequent(documents, least, sample, size)
    totals = found.where("phrase = ''").select(F.col("lang").alias("_lang"), F.col("n").alias("_words"))
    counts = found.where("phrase <> ''").select("lang", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("words"))
    counts = staged(counts, "phrases")
    phrases = counts.where(F.size("words") > 1)

    cuts = phrases.select("lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("cut"))
    cuts = cuts.select(
        "lang",
        "phrase",
        "a",
        "cut",
        F.array_join(F.expr("slice(words, 1, cut)"), " ").alias("_first"),
        F.array_join(F.expr("slice(words, cut + 1, size(words) - cut)"), " ").alias("_rest"),
    )

    def part(column: str, n: str) -> DataFrame:
        return counts.select(F.col("lang").alias(f"_lang{n}"), F.col("phrase").alias(f"_{n}"), F.col("a").alias(n))

    both = cuts.join(part("_first", "l"), (F.col("lang") == F.col("_langl")) & (F.col("_first") == F.col("_l")))
    both = both.join(part("_rest", "r"), (F.col("lang") == F.col("_langr")) & (F.col("_rest") == F.col("_r")))
    score = F.expr("CAST(a AS DECIMAL(20, 0)) * 2000000 div (l + r)")
    best = both.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("best"))

    longer = phrases.where(F.size("words") > 2)
    starts = F.expr(
        """flatten(transform(sequence(2, size(words) - 1), k ->
           transform(sequence(1, size(words) - k + 1), i -> array_join(slice(words, i, k), ' '))))"""
    )
    around = longer.select(F.col("lang").alias("_in"), F.explode(starts).alias("_part"), F.col("a").alias("_around"))
    around = around.groupBy("_in", "_part").agg(F.max("_around").alias("_around"))
    kept = best.join(around, (F.col("lang") == F.col("_in")) & (F.col("phrase") == F.col("_part")), "left")
    kept = kept.where(F.expr(f"_around IS NULL OR CAST(_around AS DECIMAL(20, 0)) * 100 < CAST(a AS DECIMAL(20, 0)) * {percent}"))

    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    flat = kept.select("lang", "phrase", "a", "best.l", "best.r", F.col("best.score").cast("long").alias("score"))
    ranked = flat.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    # One row per language.
    named = ranked.join(totals, F.col("lang") == F.col("_lang"))
    return named.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("_words").alias("n"), "score")


SQL = r"""WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
total AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang),
g AS MATERIALIZED (SELECT lang, phrase, count(*)::BIGINT AS f, string_split(phrase, ' ') AS ws FROM (
       SELECT lang, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase
       FROM w JOIN (SELECT unnest([1, 2, 3, 4]) AS k) ON len(ws) >= k)
     GROUP BY lang, phrase HAVING count(*) >= 30),
cut AS (SELECT lang, phrase, f, k, array_to_string(ws[1:k], ' ') AS a, array_to_string(ws[k + 1:], ' ') AS b
        FROM g JOIN (SELECT unnest([1, 2, 3]) AS k) ON k < len(ws)),
scored AS (SELECT cut.lang, cut.phrase, cut.f AS a, x.f AS l, y.f AS r, (cut.f::HUGEINT * 2000000 // (x.f + y.f))::BIGINT AS score, k
           FROM cut JOIN g x ON x.lang = cut.lang AND x.phrase = cut.a JOIN g y ON y.lang = cut.lang AND y.phrase = cut.b
           QUALIFY row_number() OVER (PARTITION BY cut.lang, cut.phrase ORDER BY score, k) = 1),
inner_part AS (SELECT lang, f, unnest(flatten(list_transform(range(2, len(ws)), lambda k:
                 list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))))) AS phrase
               FROM g WHERE len(ws) > 2),
around AS (SELECT lang, phrase, max(f) AS f FROM inner_part GROUP BY lang, phrase),
kept AS (SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, encode(s.phrase)) AS rank
         FROM scored s LEFT JOIN around o ON s.lang = o.lang AND s.phrase = o.phrase
         WHERE o.f IS NULL OR 100 * o.f::HUGEINT < 80 * a::HUGEINT)
SELECT lang, rank, phrase, a, l, r, n, score FROM kept JOIN total USING (lang) WHERE rank <= 2000"""
