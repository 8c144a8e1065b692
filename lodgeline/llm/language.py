"""Language ID: sparse multinomial logistic regression on TF-IDF character n-grams.

Texts become counts of hashed character n-grams, weighted by document frequencies over all training rows and scaled to
length one. Weights are learnt with follow-the-regularised-leader and an elastic net, which leaves most of them zero;
a temperature found on rows held back makes the scores probabilities. The model is fitted on a bounded sample
(`per_language` rows of each language at most), everything else covers all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeline.llm.common import staged, text_column

BITS = 13
ORDERS = (1, 2, 3)
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")

#: Odd factors that spread code points over 64 bits.
_SPREAD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def gram_counts(text: str, bits: int = BITS) -> np.ndarray:
    """Counts of the hashed n-grams of the lowered text."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(1)
    out = np.zeros(1 << bits, np.int64)
    for order in ORDERS:
        if len(points) < order:
            break
        key = np.full(len(points) - order + 1, order, np.uint64)
        for k in range(order):
            key = (key ^ points[k : len(points) - order + 1 + k]) * _SPREAD[k]
            key ^= key >> np.uint64(29)
        out += np.bincount((key * _SPREAD[0] >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return out


def tf_idf(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Rows of counts as rows of length one; rows without n-grams stay zero."""
    x = np.log1p(counts) * idf
    norm = np.sqrt((x * x).sum(axis=-1, keepdims=True))
    return x / np.where(norm > 0, norm, 1)


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float

    def probabilities(self, counts: np.ndarray) -> np.ndarray:
        return softmax((tf_idf(counts, self.idf) @ self.weights.T + self.bias) / self.temperature)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def ftrl(
    rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, n_labels: int, dims: int,
    epochs: int = 4, rate: float = 0.5, beta: float = 1.0, l1: float = 0.05, l2: float = 0.01, seed: int = 7,
) -> tuple[np.ndarray, np.ndarray]:
    """Weights (label x feature) and biases by FTRL-proximal; `rows` are (feature numbers, values).

    Each feature keeps the sum of its adjusted gradients and of their squares; its weight follows in closed form, zero
    while the sum is within the L1 penalty. The bias is a feature of value one without penalty.
    """
    z, n = np.zeros((n_labels, dims + 1)), np.zeros((n_labels, dims + 1))
    one, two = np.full(dims + 1, l1), np.full(dims + 1, l2)
    one[dims] = two[dims] = 0.0

    def weights(at) -> np.ndarray:
        shrunk = np.sign(z[:, at]) * one[at] - z[:, at]
        return np.where(np.abs(z[:, at]) <= one[at], 0.0, shrunk / ((beta + np.sqrt(n[:, at])) / rate + two[at]))

    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for k in order.permutation(len(rows)):
            features, values = rows[k]
            at, x = np.append(features, dims), np.append(values, 1.0)
            w = weights(at)
            p = softmax(w @ x)
            p[labels[k]] -= 1.0
            gradient = np.outer(p, x)
            squares = n[:, at] + gradient**2
            z[:, at] += gradient - (np.sqrt(squares) - np.sqrt(n[:, at])) / rate * w
            n[:, at] = squares
    w = weights(np.arange(dims + 1))
    return w[:, :dims], w[:, dims]


def best_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the logits with the least log loss, on a fine geometric grid."""
    grid = np.geomspace(0.05, 20, 241)
    at = np.arange(len(labels))
    losses = [-np.log(np.maximum(softmax(logits / t)[at, labels], 1e-300)).mean() for t in grid]
    return float(grid[int(np.argmin(losses))])


def _document_frequencies(training: DataFrame) -> tuple[int, np.ndarray]:
    """Number of training texts, and of those with each n-gram: every task adds up its own and sends one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = 0, np.zeros(1 << BITS, np.int64)
        for batch in batches:
            for text in batch.column(0):
                total += 1
                seen += gram_counts(text.as_py()) > 0
        if total:
            yield pa.record_batch([pa.array(np.append(np.arange(1 << BITS), -1)), pa.array(np.append(seen, total))], ["gram", "n"])

    found = training.select("text").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()
    out = np.zeros((1 << BITS) + 1, np.int64)
    for r in found:
        out[r["gram"]] = r["n"]
    return int(out[-1]), out[:-1]


def _sample(training: DataFrame, per_language: int) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """(language, n-grams, counts) of the `per_language` rows of each language with the least hash of id and text; all, if
    there are fewer.

    The rows of each 2**-16 of the hashes are counted; rows beyond the part that completes the sample are dropped where
    they are read. Equal rows are one row with their number until the end, so what is ranked does not grow with copies.
    """
    place = F.xxhash64("doc_id", "text")
    part = F.shiftright(place, 48)
    counts = training.groupBy(F.col("lang").alias("_lang"), part.alias("_part")).agg(F.count("*").alias("_n"))
    before = F.expr("sum(_n) OVER (PARTITION BY _lang ORDER BY _part) - _n")
    needed = counts.withColumn("_before", before).where(F.col("_before") < per_language)
    last = staged(needed.groupBy("_lang").agg(F.max("_part").alias("_last")), "languages")
    near = training.join(last, F.col("lang") == F.col("_lang")).where(part <= F.col("_last"))
    kinds = near.groupBy("lang", "doc_id", "text").agg(F.count("*").alias("_n"))
    before = F.expr("sum(_n) OVER (PARTITION BY lang ORDER BY xxhash64(doc_id, text), doc_id, text) - _n")
    few = kinds.withColumn("_before", before).where(F.col("_before") < per_language)
    few = few.select("lang", "text", F.least("_n", F.lit(per_language) - F.col("_before")).alias("_n"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams, counts = [], []
            for text in batch.column(1):
                own = gram_counts(text.as_py())
                grams.append(np.flatnonzero(own).astype(np.int32))
                counts.append(own[grams[-1]].astype(np.int32))
            kind = pa.list_(pa.int32())
            columns = [batch.column(0), pa.array(grams, kind), pa.array(counts, kind), batch.column(2)]
            yield pa.record_batch(columns, ["lang", "grams", "counts", "n"])

    rows = few.mapInArrow(run, "lang string, grams array<int>, counts array<int>, n long").toArrow().to_pydict()
    found = zip(rows["lang"], rows["grams"], rows["counts"], rows["n"])
    out = [(lang, np.array(g, np.int64), np.array(c, np.int64)) for lang, g, c, n in found if len(g) for _ in range(n)]
    return sorted(out, key=lambda r: (r[0], len(r[1]), r[1].tobytes(), r[2].tobytes()))


def train(training: DataFrame, per_language: int = 1000) -> Model | None:
    """A model from columns doc_id, text and lang; None if no row has a text with a letter and a language.

    A fifth of the sample is held back for the temperature.
    """
    training = training.where("lang IS NOT NULL").where(F.col("text").rlike(r"\p{L}"))
    total, seen = _document_frequencies(training)
    if not total:
        return None
    idf = np.log((1 + total) / (1 + seen)) + 1
    sample = _sample(training, per_language)
    if not sample:
        return None
    languages = sorted({lang for lang, _, _ in sample})
    labels = np.array([languages.index(lang) for lang, _, _ in sample])
    rows = []
    for _, grams, counts in sample:
        x = np.log1p(counts) * idf[grams]
        rows.append((grams, x / np.sqrt((x * x).sum())))
    # Every fifth row of each language; the sample lies sorted by language.
    back = np.array([(k - int(np.searchsorted(labels, labels[k]))) % 5 == 4 for k in range(len(labels))])
    fit = np.flatnonzero(~back)
    weights, bias = ftrl([rows[k] for k in fit], labels[fit], len(languages), 1 << BITS)
    held = np.flatnonzero(back)
    temperature = 1.0
    if len(held) and len(languages) > 1:
        logits = np.stack([weights[:, rows[k][0]] @ rows[k][1] + bias for k in held])
        temperature = best_temperature(logits, labels[held])
    return Model(languages, idf, weights, bias, temperature)


def predict(documents: DataFrame, model: Model | None) -> DataFrame:
    """`documents` (any columns, `text` among them) with lang_pred and score; without a model all are `und`."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    place = documents.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            names, scores = [], []
            for start in range(0, batch.num_rows, 64):
                texts = [t.as_py() or "" for t in batch.column(place).slice(start, 64)]
                certain = np.zeros((len(texts), 1))
                if known is not None:
                    certain = known.probabilities(np.stack([gram_counts(t) for t in texts]))
                best = certain.argmax(axis=1)
                for k, text in enumerate(texts):
                    named = known is not None and LETTER.search(text) is not None
                    names.append(known.languages[best[k]] if named else UNKNOWN)
                    scores.append(float(certain[k, best[k]]) if named else 0.0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=[*batch.schema.names, "lang_pred", "score"],
            )

    schema = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in documents.schema.fields)
    return documents.mapInArrow(run, f"{schema}, lang_pred string, score double")


def is_held_out():
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def _rows(documents: DataFrame) -> DataFrame:
    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), text_column().alias("text")
    )


def identify(documents: DataFrame, per_language: int = 1000) -> DataFrame:
    """Language of every whole text: doc_id, held_out, lang_pred, score.

    Learnt from the rows that are not held out; only the text is used for a prediction. A text that is null or has no
    letter is `und` with score 0, and so is every text if there is nothing to learn from. Null ids are not held out.
    Repeated rows are predicted each; an empty table gives no rows; other columns are ignored.
    """
    rows = _rows(documents)
    model = train(rows.where(~is_held_out()), per_language)
    return predict(rows.select("doc_id", is_held_out().alias("held_out"), "text"), model).drop("text")


def of_known_language(documents: DataFrame, least_score: float = 0.4, per_language: int = 1000) -> DataFrame:
    """The documents with a recognised language and at least this score, with their own columns, whatever they are called.

    A null or empty text, and one without a letter, goes. Rows without id or language are judged by their text like any
    other, and so is each repeated row; an empty table gives no rows. If there is nothing to learn from, no language can be told from another, and all documents with a letter are returned.
    """
    columns = documents.columns
    model = train(_rows(documents), per_language)
    if model is None:
        return documents.where(text_column().rlike(r"\p{L}"))
    named = predict(documents.select(F.struct(*[F.col(c) for c in columns]).alias("row"), text_column().alias("text")), model)
    kept = named.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least_score))
    return kept.select(*[F.col("row")[c].alias(c) for c in columns])
