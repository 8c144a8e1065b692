"""Importance resampling against a plain computation."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lodgeline.llm import resampling
from lodgeline.llm.ranks import numbered

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall((text or "").translate(UPPER))


def features(text, most):
    own = plain_words(text)
    return [" ".join(own[i : i + k]) for k in range(1, most + 1) for i in range(len(own) - k + 1)]


def plain(docs, target, most, percent=10, least=20, buckets=10_000):
    place = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = (Counter(place(f) for text in texts for f in features(text, most)) for texts in ([x for _, x in docs], target))
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets))))
    out = []
    for doc, text in docs:
        own = features(text, most)
        weight = sum(gain(place(f)) for f in own) // len(own) if own else 0
        h = int(hashlib.sha256(f"2024:{doc}".encode()).hexdigest()[:8], 16)
        score = None if doc is None else weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((doc, len(own), weight, score, len(plain_words(text)) >= least and doc is not None))
    open_rows = sorted((-score, doc) for doc, _, _, score, fits in out if fits)
    rank = {doc: k + 1 for k, (_, doc) in enumerate(open_rows[: percent * len(open_rows) // 100])}
    return [(doc, n, weight, score, rank.get(doc)) for doc, n, weight, score, _ in out]


WORDS = ["the", "Sea", "sea2", "ÉTÉ", "été", "a-b", "x_y", "日本", "c\x00d", "naïve", "\x85z", "10%", "　"]


def texts(n):
    rng = __import__("random").Random(5)
    return [(k, " ".join(rng.choice(WORDS) for _ in range(rng.randrange(60)))) for k in range(n)]


def found(spark, docs, target, **options):
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    goal = spark.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id long, text string")
    return [tuple(r) for r in resampling.resampled(frame, goal, **options).collect()]


@pytest.mark.parametrize("most", [1, 3])
def test_resampling(spark, most):
    docs, target = texts(300), ["the sea the SEA été", "naïve 10 10", None]
    want = plain(docs, target, most)
    assert sorted(found(spark, docs, target, most=most)) == sorted(want)
    assert sum(r[4] is not None for r in want) > 15


def test_odd_rows(spark):
    long_text = "sea the " * 30_000
    docs = [(1, None), (2, ""), (3, "-- %%"), (None, "the sea " * 20), (None, None), (5, long_text), (6, "été " * 25)]
    docs += [(k, "the sea " * 12) for k in range(10, 40)]
    key = lambda r: tuple(str(v) for v in r)
    assert sorted(found(spark, docs, ["sea"]), key=key) == sorted(plain(docs, ["sea"], 1), key=key)
    # Without a target, without documents, with other columns of any name.
    assert sorted(found(spark, docs, []), key=key) == sorted(plain(docs, [], 1), key=key)
    assert found(spark, [], ["sea"]) == []
    clashing = spark.createDataFrame([(1, "the sea", 7, "x", 1.0)], "doc_id long, text string, rank long, score string, _row double")
    assert [r[0] for r in resampling.resampled(clashing, clashing).collect()] == [1]


def test_repeated_ids_are_drawn_one_by_one(spark):
    docs = [(4, "the sea " * 12)] * 30 + [(5, "sea " * 24)] * 30
    ranks = sorted(r[4] for r in found(spark, docs, ["sea"], percent=50) if r[4])
    assert ranks == list(range(1, 31))


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aB9 -é\t", max_size=80), st.integers(1, 4), st.integers(1, 30))
def test_parts_of_a_long_text(text, most, part):
    data = text.encode()
    runs, carried, words = Counter(), [], []
    for own in resampling.word_lists(data, part):
        words += own
        runs.update(zlib.crc32(w) for w in own)
        if most > 1:
            for sums in resampling.longer_runs(own, most, carried):
                runs.update(sums)
            carried = (carried + own)[-(most - 1) :]
    assert words == [w.encode() for w in plain_words(text)]
    assert runs == Counter(zlib.crc32(f.encode()) for f in features(text, most))


def test_numbers_run_on_over_partitions(spark):
    frame = spark.range(1000).selectExpr("id % 7 AS a", "id").repartition(9)
    rows = numbered(frame, [frame["a"].desc(), frame["id"]]).collect()
    assert [(r["a"], r["id"]) for r in sorted(rows, key=lambda r: r["rank"])] == sorted(((k % 7, k) for k in range(1000)), key=lambda r: (-r[0], r[1]))
    assert sorted(r["rank"] for r in rows) == list(range(1, 1001))
    assert numbered(frame.where("id < 0"), [frame["id"]]).collect() == []
