"""Importance resampling of documents towards a target collection.

A 256-byte table lower-cases A-Z and blanks all separators of the UTF-8 bytes in one `translate`; `split` then gives
the words. A run of words is hashed by chaining CRC-32: the sum so far is the seed for the next word. Counters reduce
the words of a slice before they are hashed, and a task sends on one number for each bucket it met.

The gain of a bucket is the logarithm of how much more frequent it is in the target than in the documents. A document's
weight is the mean gain of its features, and a Gumbel number drawn from the hash of its id is added, so that the
greatest scores are a sample without replacement in proportion to the weights.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeline.llm.common import Memo, staged, text_column
from lodgeline.llm.ranks import numbered


def _byte_table() -> bytes:
    """Lower case for A-Z; a blank for all other ASCII but digits and letters; bytes from 0x80 on stay."""
    table = bytearray(range(256))
    for b in range(128):
        if not chr(b).isalnum():
            table[b] = 0x20
        elif 0x41 <= b <= 0x5A:
            table[b] = b + 32
    return bytes(table)


BYTES = _byte_table()
#: Bytes of a text that are split at once.
PART = 1 << 23


def word_lists(data: bytes, part: int = PART) -> Iterator[list[bytes]]:
    """The words of a text, in lists of about `part` bytes of text, so that long texts need no more memory."""
    data = data.translate(BYTES)
    if len(data) <= part:
        yield data.split()
        return
    start = 0
    while start < len(data):
        end = data.find(b" ", start + part)
        end = len(data) if end < 0 else end
        yield data[start:end].split()
        start = end


def longer_runs(words: list[bytes], most: int, carried: list[bytes]) -> Iterator[list[int]]:
    """CRC-32 of all runs of 2 to `most` words that end in `words`, one list for each length.

    `carried` are the words before `words`. Runs of k + 1 words go on from the sums of the runs of k words.
    """
    words = carried + words
    sums = [crc32(w) for w in words[: len(words) - 1]]
    for k in range(1, most):
        sums = [crc32(w, crc32(b" ", s)) for s, w in zip(sums, words[k:])]
        # Runs within the carried words were given before.
        yield sums[max(0, len(carried) - k) :]
        sums = sums[:-1]


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(text_column().cast("binary").alias("text"))


def bucket_counts(documents: DataFrame, most: int = 1, buckets: int = 10_000) -> DataFrame:
    """How many features of all texts fall into each bucket that occurs: bucket, n."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        met: Counter = Counter()

        def reduce() -> None:
            at = np.fromiter((crc32(w) for w in met), np.int64, len(met)) % buckets
            np.add.at(total, at, np.fromiter(met.values(), np.int64, len(met)))
            met.clear()

        for batch in batches:
            for text in batch.column(0):
                carried: list[bytes] = []
                for words in word_lists(text.as_py()):
                    met.update(words)
                    if most > 1:
                        for sums in longer_runs(words, most, carried):
                            np.add.at(total, np.array(sums, np.int64) % buckets, 1)
                        carried = (carried + words)[-(most - 1) :]
                    if len(met) > 200_000:
                        reduce()
        reduce()
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    counts = _texts(documents).mapInArrow(run, "bucket long, n long")
    return counts.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: dict[int, int], target: dict[int, int], buckets: int = 10_000) -> list[int]:
    """Gain of every bucket from the counts of the documents and of the target: thousandths of a natural logarithm."""
    s_all, t_all = float(sum(source.values()) + buckets), float(sum(target.values()) + buckets)
    out = []
    for b in range(buckets):
        s, t = float(source.get(b, 0) + 1), float(target.get(b, 0) + 1)
        out.append(math.floor(1000 * math.log(t * s_all / (s * t_all))))
    return out


def gumbel(doc_id: int, seed: int = 2024) -> int:
    """A number of the standard Gumbel distribution in thousandths, drawn from the hash of the id."""
    h = int(hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


WEIGHTS = "doc_id long, n_words long, n_features long, weight long, score long"


def weighted(documents: DataFrame, gain: list[int], most: int = 1, seed: int = 2024) -> DataFrame:
    """Words, features, weight and score of every document."""
    buckets = len(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.array(gain, np.int64)
        of_word = Memo(lambda word: gain[crc32(word) % buckets])
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                n = features = total = 0
                carried: list[bytes] = []
                for words in word_lists(text.as_py()):
                    n += len(words)
                    features += len(words)
                    total += sum(map(of_word.__getitem__, words))
                    if most > 1:
                        for sums in longer_runs(words, most, carried):
                            features += len(sums)
                            total += int(table[np.array(sums, np.int64) % buckets].sum())
                        carried = (carried + words)[-(most - 1) :]
                weight = total // features if features else 0
                rows.append((doc, n, features, weight, None if doc is None else weight + gumbel(doc, seed)))
            columns = zip(*rows) if rows else [[]] * 5
            yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], [c.split()[0] for c in WEIGHTS.split(", ")])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_column().cast("binary").alias("text"))
    return rows.mapInArrow(run, WEIGHTS)


def resampled(
    documents: DataFrame,
    target: DataFrame,
    percent: int = 10,
    least_words: int = 20,
    most: int = 1,
    buckets: int = 10_000,
    seed: int = 2024,
) -> DataFrame:
    """Weight, score and rank of every document: doc_id, n_features, weight, score, rank (null if not drawn).

    Features are runs of 1 to `most` words. Of the documents with `least_words` words or more, `percent` in a hundred
    with the greatest scores are drawn, ties to the smaller id. A null or empty text has no features and weight 0. A
    row without doc_id has no score and takes no part in the draw. Rows that repeat an id are drawn one by one, in any
    order among them. An empty target leaves the documents' own counts; an empty table gives no rows; other columns
    are ignored.
    """
    # The driver holds one number per bucket.
    counts = [{r["bucket"]: r["n"] for r in bucket_counts(df, most, buckets).collect()} for df in (documents, target)]
    scored = weighted(documents, gains(*counts, buckets), most, seed).withColumn("_row", F.monotonically_increasing_id())
    scored = staged(scored, "weights")
    open_rows = scored.where((F.col("n_words") >= least_words) & F.col("score").isNotNull())
    # Gains lie within 1000 * ln(2**63) and Gumbel numbers of 32 bits within -3200 and 23000, so there are at most some
    # 110,000 different scores.
    found = sorted(((r["score"], r["n"]) for r in open_rows.groupBy("score").agg(F.count("*").alias("n")).collect()), reverse=True)
    drawn = percent * sum(n for _, n in found) // 100
    cut, above = None, 0
    for score, n in found:
        if above >= drawn:
            break
        cut, above = score, above + n
    claims = F.lit(False) if cut is None else (F.col("n_words") >= least_words) & F.coalesce(F.col("score") >= cut, F.lit(False))
    ranked = numbered(scored.where(claims), [F.desc("score"), F.asc("doc_id"), F.asc("_row")])
    rank = F.when(F.col("rank") <= drawn, F.col("rank"))
    columns = ["doc_id", "n_features", "weight", "score"]
    rest = scored.where(~claims).select(*columns, F.lit(None).cast("long").alias("rank"))
    return rest.union(ranked.select(*columns, rank.alias("rank")))


#: CRC-32 in SQL: the table of a byte's sums, and a word's sum over its bytes in hexadecimal.
SQL = r"""WITH crc AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[],
             lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END) AS c FROM range(256) r(i))),
own AS MATERIALIZED (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM documents),
goal AS (SELECT unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark),
bytes AS (SELECT word, list_transform(range(0, length(hex(encode(word))) // 2),
             lambda k: ('0x' || substr(hex(encode(word)), 2 * k + 1, 2))::UBIGINT) AS b
          FROM (SELECT word FROM own UNION SELECT word FROM goal)),
word AS MATERIALIZED (SELECT word, (xor(list_reduce(list_prepend(4294967295::UBIGINT, b),
             lambda c, x: xor(c >> 8, crc.t[((xor(c, x) & 255) + 1)::BIGINT])), 4294967295::UBIGINT) % 10000)::BIGINT AS bucket
         FROM bytes, crc),
s AS (SELECT bucket, count(*) AS s FROM own JOIN word USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM goal JOIN word USING (word) GROUP BY bucket),
gain AS MATERIALIZED (SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT sum(s) FROM s) + 10000)::DOUBLE
             / ((s + 1)::DOUBLE * ((SELECT coalesce(sum(t), 0) FROM t) + 10000)::DOUBLE)))::BIGINT AS gain
         FROM s LEFT JOIN t USING (bucket)),
w AS (SELECT doc_id, count(*) AS n, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
      FROM own JOIN word USING (word) JOIN gain USING (bucket) GROUP BY doc_id),
d AS (SELECT doc_id, coalesce(n, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
             coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5)::DOUBLE / 4294967296)))::BIGINT AS score
      FROM documents LEFT JOIN w USING (doc_id)),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM d WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score::BIGINT AS score,
       CASE WHEN rank <= 10 * (SELECT count(*) FROM r) // 100 THEN rank END::BIGINT AS rank
FROM d LEFT JOIN r USING (doc_id)"""
