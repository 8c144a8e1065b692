"""Exact quantiles of many columns by narrowing value ranges."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass
class Search:
    """The value of rank `rank` (from 1) among the rows of `column` within `low` and `high`.

    A bound of None is open; the rows at a given bound are not among them.
    """

    column: str
    rank: int
    rows: int
    low: float | None = None
    high: float | None = None

    def inside(self) -> Column:
        c = F.col(self.column)
        keep = c.isNotNull()
        if self.low is not None:
            keep = keep & (c > F.lit(self.low))
        if self.high is not None:
            keep = keep & (c < F.lit(self.high))
        return F.when(keep, c)


COUNTABLE = 1_000  # rows between two values that are counted value by value


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], shares: Sequence[float], accuracy: int = 10_000, countable: int = COUNTABLE
) -> dict[str, list]:
    """Per column and share, the least value with at least that share of the values at or below it.

    A mergeable sketch brackets each quantile between two values, and exact counts tell whether it is one of them or
    lies between. Then only the rows between are looked at, some ten-thousandth, until they are few enough to be
    counted value by value. Tables of any size go this way. The first round takes the counts and the sketches in one
    aggregation; a round is two aggregations for all columns together, and what reaches the driver are the brackets.
    """
    counts = [F.count(c).alias(f"n{i}") for i, c in enumerate(columns)]
    around = [[s for p in shares for s in _around(p, 3 / accuracy)] for _ in columns]
    sketches = [F.percentile_approx(c, a, accuracy).alias(f"e{i}") for i, (c, a) in enumerate(zip(columns, around, strict=True))]
    first = df.agg(*counts, *sketches).first()
    found: dict[tuple[str, float], object] = {(c, p): None for c in columns for p in shares}
    searches: dict[tuple[str, float], Search] = {}
    for i, c in enumerate(columns):
        n = first[f"n{i}"]
        for p in shares if n else ():
            searches[c, p] = Search(c, max(1, ceil(round(p * n, 6))), n)
    edges = [first[f"e{i}"] for i in range(len(columns)) if first[f"n{i}"]]
    between: dict[tuple[str, float], Search] = {}
    while searches:
        _narrow(df, searches, found, edges or _brackets(df, searches, accuracy))
        edges = []
        for key in [k for k, s in searches.items() if s.rows <= countable]:
            between[key] = searches.pop(key)
    if between:
        found.update(_count_values(df, between))
    return {c: [found[c, p] for p in shares] for c in columns}


def _around(share: float, margin: float) -> list[float]:
    return [max(0.0, share - margin), min(1.0, share + margin)]


def _by_range(searches: dict) -> list[list[tuple]]:
    """Keys of the searches that are over the same rows, together."""
    ranges: dict[tuple, list] = {}
    for key, s in searches.items():
        ranges.setdefault((s.column, s.low, s.high), []).append(key)
    return list(ranges.values())


def _count_values(df: DataFrame, searches: dict[tuple[str, float], Search]) -> dict:
    """Results of searches among few distinct values each, by a running count over the values."""
    groups = _by_range(searches)
    names = [str(i) for i in range(len(groups))]
    ranks = F.array(*[F.array(*[F.lit(searches[k].rank) for k in keys]) for keys in groups])
    wide = df.select(*[searches[k[0]].inside().cast("double").alias(i) for i, k in zip(names, groups, strict=True)])
    hits = wide.unpivot([], names, "i", "v").filter("v IS NOT NULL").groupBy("i", "v").agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("i").orderBy("v"))
    running = hits.withColumn("upto", upto).withColumn("i", F.col("i").cast("int"))
    reached = F.filter(F.get(ranks, F.col("i")), lambda r: (r > F.col("upto") - F.col("n")) & (r <= F.col("upto")))
    out = {}
    for row in running.select("i", "v", F.explode(reached).alias("rank")).collect():
        for key in groups[row["i"]]:
            if searches[key].rank == row["rank"]:
                out[key] = row["v"]
    return out


def _brackets(df: DataFrame, searches: dict, accuracy: int) -> list[list]:
    """Two values around the result of each search; searches over the same rows share a sketch."""
    sketches = []
    for keys in _by_range(searches):
        own = [searches[k] for k in keys]
        around = [x for s in own for x in _around(s.rank / s.rows, 2 / accuracy + 1 / s.rows)]
        sketches.append(F.percentile_approx(own[0].inside(), around, accuracy))
    return list(df.agg(*sketches).first())


def _narrow(df: DataFrame, searches: dict, found: dict, edges: list[list]) -> None:
    """Replace each search by its result or by one over the rows between two values."""
    groups = _by_range(searches)  # they share a sketch and a tally
    cuts = [sorted(set(e)) for e in edges]
    tallies = _tally(df, [searches[keys[0]].inside() for keys in groups], cuts)

    for keys, around, cut, tally in zip(groups, edges, cuts, tallies, strict=True):
        for key, low, high in zip(keys, around[::2], around[1::2], strict=True):
            s = searches.pop(key)
            a, b = 2 * cut.index(low) + 1, 2 * cut.index(high) + 1
            below, at_low = sum(tally[:a]), tally[a]
            mid, at_high = sum(tally[a + 1 : b]), tally[b] if b > a else 0
            rank = s.rank - below
            if rank <= 0:
                searches[key] = Search(s.column, s.rank, below, s.low, low)
            elif rank <= at_low:
                found[key] = low
            elif rank <= at_low + mid:
                searches[key] = Search(s.column, rank - at_low, mid, low, high)
            elif rank <= at_low + mid + at_high:
                found[key] = high
            else:
                passed = at_low + mid + at_high
                searches[key] = Search(s.column, rank - passed, s.rows - below - passed, high, s.high)


def _tally(df: DataFrame, values: list[Column], cuts: list[list]) -> list[list[int]]:
    """Rows per place of each value among its cuts: place 2j+1 is at cut j, 2j just before it."""

    def place(v: Column, cut: list) -> Column:
        steps = [F.when(v > F.lit(e), 2).when(v == F.lit(e), 1).otherwise(0) for e in cut]
        return F.when(v.isNotNull(), sum(steps[1:], steps[0]))

    names = [str(i) for i in range(len(values))]
    wide = df.select(*[place(v, cut).alias(i) for i, v, cut in zip(names, values, cuts, strict=True)])
    hits = wide.unpivot([], names, "i", "place").filter("place IS NOT NULL")
    out = [[0] * (2 * len(cut) + 1) for cut in cuts]
    for row in hits.groupBy("i", "place").agg(F.count("*").alias("n")).collect():
        out[int(row["i"])][row["place"]] = row["n"]
    return out
