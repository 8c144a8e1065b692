"""Quality rules whose thresholds come from the data, per language and source.

Each text is measured; every (language, source) gets a mergeable quantile sketch of each measure (`percentile_approx`:
partial summaries per task, merged per group), from which fences are set a few interquartile ranges off the median.
Documents are then joined with the fences of their group. `SLACK` is the least distance of a fence from the median, so
that a group of very even documents does not reject one for a trifle.

All of it is DataFrame functions; no Python runs on the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgeline.llm.common import staged, text_column

BLANKS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"

#: Least distance of a fence from the median.
SLACK = {"symbol_share": 0.1, "dup_line_share": 0.4, "repeat_share": 0.35, "word_length": 3.0}

#: Measures with a fence below the median as well as above.
TWO_SIDED = ("word_length",)

#: Interquartile ranges between the median and a fence.
REACH = 5.0

#: A sketch holds about so many values.
ACCURACY = 10_000

COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def _without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def _window_hashes(words: Column) -> Column:
    """A 64-bit hash of each 3-word window."""
    places = F.sequence(F.lit(1), F.size(words) - 2)
    hashes = F.transform(
        places, lambda i: F.xxhash64(F.element_at(words, i), F.element_at(words, i + 1), F.element_at(words, i + 2))
    )
    return F.when(F.size(words) >= 3, hashes).otherwise(F.array().cast("array<bigint>"))


def _covered(ordered: Column) -> Column:
    """Words in windows that occur twice or more, given the windows' (h, i), sorted.

    Equal windows are neighbours. The places of the repeated ones are walked in order, each adding the words that the
    one before did not cover.
    """
    same = lambda x, k: F.coalesce(F.get(ordered, k)["h"] == x["h"], F.lit(False))
    repeated = F.filter(ordered, lambda x, k: same(x, k - 1) | same(x, k + 1))
    at = F.array_sort(F.transform(repeated, lambda x: x["i"]))
    start = F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last"))
    walked = F.aggregate(
        at, start, lambda s, p: F.struct((s["n"] + F.least(F.lit(3), p - s["last"])).alias("n"), p.alias("last"))
    )
    return walked["n"]


def measured(documents: DataFrame, text: Column) -> DataFrame:
    """`documents` with the counts of `COUNTS` on each whole text.

    The steps stand in projections of their own, so that no array is made twice.
    """
    split = documents.withColumn("_text", text).withColumns(
        {
            "_words": F.array_remove(F.split("_text", r"[\x20\x09-\x0D]+"), ""),
            "_lines": F.filter(F.split("_text", "\n"), lambda line: _without(line, BLANKS) != ""),
        }
    )
    hashed = split.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.length(_without(F.col("_text"), BLANKS)).cast("long"),
            "n_symbols": (F.length("_text") - F.length(_without(F.col("_text"), SYMBOLS))).cast("long"),
            "n_lines": F.size("_lines").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "_hashes": _window_hashes(F.col("_words")),
        }
    ).drop("_words", "_lines", "_text")
    any_twice = F.size(F.array_distinct("_hashes")) < F.size("_hashes")
    pairs = F.transform("_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    ordered = hashed.withColumn("_ordered", F.when(any_twice, F.array_sort(pairs))).drop("_hashes")
    return ordered.withColumn("n_repeat_words", F.coalesce(_covered(F.col("_ordered")), F.lit(0)).cast("long")).drop("_ordered")


def shares() -> dict[str, Column]:
    """The measures that get fences."""
    over = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    return {
        "symbol_share": over("n_symbols", "word_chars"),
        "dup_line_share": over("n_dup_lines", "n_lines"),
        "repeat_share": over("n_repeat_words", "n_words"),
        "word_length": over("word_chars", "n_words"),
    }


def fences(counted: DataFrame) -> DataFrame:
    """A row for each language and source, with the bounds of each measure; documents without words are left out.

    `_lang` and `_source` may be null, as a group of their own.
    """
    quartiles = [0.25, 0.5, 0.75]
    found = (
        counted.where("n_words > 0")
        .groupBy(F.col("lang").alias("_lang"), F.col("source").alias("_source"))
        .agg(*[F.percentile_approx(c, quartiles, ACCURACY).alias(name) for name, c in shares().items()])
    )
    bounds = []
    for name in shares():
        low, mid, high = (F.col(name)[k] for k in range(3))
        reach = F.greatest(F.lit(REACH) * (high - low), F.lit(SLACK[name]))
        bounds.append((mid + reach).alias(f"_max_{name}"))
        if name in TWO_SIDED:
            bounds.append((mid - reach).alias(f"_min_{name}"))
    return found.select("_lang", "_source", *bounds)


def judged(counted: DataFrame, bounds: DataFrame) -> DataFrame:
    """`counted` with base_failed and kept, by a join with the bounds of each row's group.

    The bounds should be a written table: Spark then knows its size and broadcasts it only if it is small.
    """
    joined = counted.join(
        bounds, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")), "left"
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    # A sum of faults, not a conjunction: the parts of a conjunction would be pushed below the join, and the counts in
    # them be worked out again for each mention.
    faults = failed.cast("int")
    for name, c in shares().items():
        faults = faults + F.coalesce((c > F.col(f"_max_{name}")).cast("int"), F.lit(1))
        if name in TWO_SIDED:
            faults = faults + F.coalesce((c < F.col(f"_min_{name}")).cast("int"), F.lit(1))
    return joined.select(*counted.columns, failed.alias("base_failed"), (faults == 0).alias("kept"))


def quality(documents: DataFrame) -> DataFrame:
    """Counts and verdict for every document: doc_id, `COUNTS`, base_failed, kept.

    A document is kept if it has 50 words, at most half of them in repeated 3-word windows, and no measure beyond its
    group's fences. A null or empty text has no words and fails. Null languages and sources are groups of their own.
    Repeated rows count each; an empty table gives no rows; other columns are ignored.
    """
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"),
        text_column().alias("text"),
    )
    counted = staged(measured(rows, F.col("text")).drop("text"), "counts")
    bounds = staged(fences(counted), "fences")
    return judged(counted, bounds).select("doc_id", *COUNTS, "base_failed", "kept")


def filtered(documents: DataFrame) -> DataFrame:
    """The documents that are kept, with their own columns, whatever they are called.

    The texts are read twice, for the fences and for the verdict, and are never shuffled. A null or empty text goes, since
    it has no 50 words; rows without id, language or source are judged like any other, null being a group of its own.
    Repeated rows stay or go together, and each that stays is returned. An empty table gives no rows.
    """
    columns = documents.columns
    text = text_column()
    keys = [F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source")]
    bounds = staged(fences(measured(documents.select(*keys, text.alias("text")), F.col("text"))), "fences")
    whole = documents.select(F.struct(*[F.col(c) for c in columns]).alias("_row"), *keys, text.alias("text"))
    kept = judged(measured(whole, F.col("text")), bounds).where("kept")
    return kept.select(*[F.col("_row")[c].alias(c) for c in columns])


def _fence_sql(name: str, sql: str) -> str:
    rank = "least(n, greatest(1, ceil(%s * n)::BIGINT))"
    parts = ", ".join(f"max(v) FILTER (r = {rank % p}) AS {q}" for p, q in ((0.25, "lo"), (0.5, "mid"), (0.75, "hi")))
    reach = f"greatest({REACH}::DOUBLE * (hi - lo), {SLACK[name]}::DOUBLE)"
    return f"""{name}_f AS (
  SELECT lang, source, mid + {reach} AS upper_fence, mid - {reach} AS lower_fence FROM (
    SELECT lang, source, {parts} FROM (
      SELECT lang, source, {sql} AS v, row_number() OVER (PARTITION BY lang, source ORDER BY {sql}) AS r,
             count(*) OVER (PARTITION BY lang, source) AS n
      FROM m WHERE n_words > 0)
    GROUP BY lang, source))"""


SHARES_SQL = {
    "symbol_share": "n_symbols::DOUBLE / greatest(word_chars, 1)",
    "dup_line_share": "n_dup_lines::DOUBLE / greatest(n_lines, 1)",
    "repeat_share": "n_repeat_words::DOUBLE / greatest(n_words, 1)",
    "word_length": "word_chars::DOUBLE / greatest(n_words, 1)",
}

SQL = (
    r"""WITH d AS MATERIALIZED (SELECT doc_id, lang, source, coalesce(text, '') AS text, row_number() OVER () AS k FROM documents),
w AS MATERIALIZED (SELECT k, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
word AS (SELECT k, unnest(words) AS a, unnest(range(1, len(words) + 1)) AS i FROM w),
win AS MATERIALIZED (SELECT k, i, a, lead(a, 1) OVER o AS b, lead(a, 2) OVER o AS c FROM word
        WINDOW o AS (PARTITION BY k ORDER BY i) QUALIFY c IS NOT NULL),
twice AS (SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY k, a, b, c) AS n FROM win) WHERE n > 1),
rep AS (SELECT k, count(DISTINCT p) AS n FROM (SELECT k, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY k),
m AS MATERIALIZED (SELECT doc_id, lang, source, len(words)::BIGINT AS n_words,
             coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
             len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(lines)::BIGINT AS n_lines,
             (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
             coalesce(rep.n, 0)::BIGINT AS n_repeat_words
      FROM d JOIN w USING (k) LEFT JOIN rep USING (k)),
"""
    + ",\n".join(_fence_sql(name, sql) for name, sql in SHARES_SQL.items())
    + """
SELECT m.doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND """
    + " AND ".join(
        f"coalesce({sql} <= {name}_f.upper_fence{f' AND {sql} >= {name}_f.lower_fence' if name in TWO_SIDED else ''}, false)"
        for name, sql in SHARES_SQL.items()
    )
    + " AS kept\nFROM m "
    + " ".join(
        f"LEFT JOIN {name}_f ON m.lang IS NOT DISTINCT FROM {name}_f.lang AND m.source IS NOT DISTINCT FROM {name}_f.source"
        for name in SHARES_SQL
    )
)
