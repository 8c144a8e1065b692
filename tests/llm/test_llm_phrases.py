"""Phrase mining against a plain count."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from lodgeline.llm import phrases

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
KIND = "doc_id long, text string, lang string"


def grams(docs) -> tuple[dict, Counter]:
    counts, totals = defaultdict(Counter), Counter()
    for _, text, lang in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", (text or "").translate(UPPER)):
            words = re.findall(r"[^ \t]+", piece)
            totals[lang] += len(words)
            counts[lang].update(tuple(words[i : i + k]) for k in range(1, 5) for i in range(len(words) - k + 1))
    return counts, totals


def plain(docs, least=30, percent=80, top=2000) -> list[tuple]:
    counts, totals = grams(docs)
    out = []
    for lang, f in counts.items():
        found = []
        for p, a in f.items():
            if len(p) == 1 or a < least:
                continue
            score, _, l, r = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))  # noqa: E741
            found.append((score, a, " ".join(p), l, r))
        around = Counter()
        for p, a in f.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    around[p[i : i + k]] = max(around[p[i : i + k]], a)
        found = [x for x in found if 100 * around[tuple(x[2].split(" "))] < percent * x[1]]
        found.sort(key=lambda x: (-x[0], -x[1], x[2].encode()))
        out += [(lang, k + 1, p, a, l, r, totals[lang], s) for k, (s, a, p, l, r) in enumerate(found[:top])]
    return sorted(out)


def found(spark, docs, **options) -> list[tuple]:
    return sorted(tuple(r) for r in phrases.collocations(spark.createDataFrame(docs, KIND), **options).collect())


def made(n: int, seed: int = 1) -> list[tuple]:
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(60)] + ["The", "été", "x\x00y", "a\x85b", "É"]
    fixed = [["new", "york", "City"], ["on", "the", "other", "hand", "side"], ["rare", "pair"], ["a b", "c"]]
    out = []
    for k in range(n):
        text = []
        for _ in range(rng.randrange(40)):
            text += rng.choice(fixed) if rng.random() < 0.3 else [rng.choices(words, weights=range(len(words), 0, -1))[0]]
            text.append(rng.choice(["", "", "", ",", ". ", "\n", "\t", " \r\n", "!"]))
        out.append((k, " ".join(text), rng.choice(["en", "en", "de", None])))
    return out


@pytest.mark.parametrize("options", [{}, {"least": 5, "percent": 60, "top": 40}, {"least": 5, "sample": 1}, {"least": 5, "sample": 10**9}, {"least": 4, "size": 15}])
def test_phrases(spark, options):
    """Whatever the sample holds, and however crowded the map of proposals is, the result is the same."""
    docs = made(400)
    want = plain(docs, **{k: v for k, v in options.items() if k in ("least", "percent", "top")})
    assert want and found(spark, docs, **options) == want


def test_long_texts_are_read_in_parts(spark, monkeypatch):
    docs = made(60) + [(100, " ".join(t for _, t, _ in made(80, 2)), "en"), (101, "aa bb cc dd " * 4000, "en")]
    want = plain(docs, least=5)
    monkeypatch.setattr(phrases, "PART", 50)
    monkeypatch.setattr(phrases, "MOST", 4)
    batch = __import__("pyarrow").record_batch([[d[2] or "und" for d in docs], [(d[1] or "").encode() for d in docs]], ["lang", "text"])
    counts, _ = grams(docs)
    for k in range(1, 5):
        total = Counter()
        for part in phrases._slices(iter([batch])):
            w = phrases._words(part)
            _, whole = list(phrases._levels(w, part.names))[k - 1]
            for i in np.flatnonzero(whole):
                phrase = part.data[w.start[i] : w.end[i + k - 1]].split()
                total[part.names[w.lang[i]], tuple(x.decode() for x in phrase)] += 1
        assert total == Counter({(lang, p): n for lang, own in counts.items() for p, n in own.items() if len(p) == k})
    monkeypatch.undo()
    assert found(spark, docs, least=5) == want


def test_hashes_tell_words_apart():
    words = [f"w{k}" for k in range(3000)] + ["a" * k for k in range(1, 300)] + ["ab", "ba", "\x00", "\x00\x00"]
    part = phrases.Slice((" ".join(words * 2) + "\n").encode(), [0], [0], [0], ["en"])
    w = phrases._words(part)
    assert len(w.hash) == 2 * len(words) and len(set(w.hash.tolist())) == len(words)
    assert (w.hash[: len(words)] == w.hash[len(words) :]).all()


def test_odd_rows(spark):
    docs = [(1, None, "en"), (2, "", None), (3, " \t\n.,", "en"), (None, "b a " * 20, None), (None, "b a " * 20, "und")]
    docs += [(4, "The end. " * 7, "en")] * 6
    assert found(spark, docs) == plain(docs)
    assert found(spark, []) == []
    clashing = spark.createDataFrame(
        [(1, "u v w " * 40, "en", "x", 1, "y")], KIND + ", phrase string, n long, words string"
    )
    assert [r["phrase"] for r in phrases.collocations(clashing).collect()] == [x[2] for x in plain([(1, "u v w " * 40, "en")])]


def test_score_passes_64_bits(spark):
    a = 9_000_000_000_000_000_000
    row = spark.sql(f"SELECT CAST({a}L AS DECIMAL(20, 0)) * 2000000 div ({a // 2}L + {a // 2}L) AS s").first()
    assert row["s"] == 2000000
