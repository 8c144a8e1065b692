"""Personal data: patterns against their plain form, the model against enumeration, and planted spans."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import time
from collections import Counter

import pytest
from conftest import TESTDATA
from hypothesis import given, settings
from hypothesis import strategies as st

from lodgeline.llm import personal as P

FOLDER = str(TESTDATA / "sf0.01")


def plain(text: str) -> list[tuple[int, int, int]]:
    out = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append((1, *m.span()))
    for k, pattern, least, most in ((2, r"[0-9]([\x20-]?[0-9])+", 16, 19), (3, r"\+[0-9][\x20().0-9-]+[0-9]", 8, 15)):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if least <= len(digits) <= most and (k == 3 or P.luhn(digits)):
                out.append((k, *m.span()))
    return out


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(list("0123456789") + [".", ".", " ", "-", "+", "(", ")", "@", "@", "a", "B", "é", "_", "\n", "192.168.", "a@b.", "4111 1111 1111 1111", "٣"]), max_size=40).map("".join))
def test_base_spans(text):
    assert P.base_spans(text) == plain(text)


def test_luhn():
    assert P.luhn("4111111111111111") and not P.luhn("4111111111111112")


@pytest.mark.parametrize("bad", ["a" * 300_000, "1" * 300_000, "1." * 150_000, "1 " * 150_000, "a@" * 150_000, "+1 " * 100_000, "a@b" * 100_000, "+1(" * 100_000, "x at y " * 40_000 + " dot "])
def test_long_texts_take_linear_time(bad):
    start = time.process_time()
    found = P.zones(bad)
    base, open_regions = P.base_spans(bad, found), P.regions(bad, found)
    P.added(open_regions, base, {(3, "bias"): 1.0})
    assert time.process_time() - start < 20


def subsets(found):
    for n in range(len(found) + 1):
        for own in itertools.combinations(range(len(found)), n):
            if all(found[i].end <= found[j].start or found[j].end <= found[i].start for i, j in itertools.combinations(own, 2)):
                yield own


def test_model_against_enumeration():
    rng = random.Random(4)
    for _ in range(30):
        spans = {(a, a + rng.randrange(1, 5), rng.randrange(4)) for a in (rng.randrange(8) for _ in range(8))}
        found = [P.Candidate(a, b, k, ()) for a, b, k in sorted(spans)]
        scores = [rng.uniform(-2, 2) for _ in found]
        sets = {own: sum(scores[i] for i in own) for own in subsets(found)}
        total, p = P.marginals(found, scores)
        assert total == pytest.approx(math.log(sum(math.exp(s) for s in sets.values())))
        for i in range(len(found)):
            assert p[i] == pytest.approx(sum(math.exp(s - total) for own, s in sets.items() if i in own))
        best = P.best_set(found, scores)
        assert sum(scores[found.index(c)] for c in best) == pytest.approx(max(sets.values()))
    assert P.best_set([], []) == [] and P.marginals([], []) == (0.0, [])


def test_entities_are_bounded():
    text = "call " + " ".join("12" for _ in range(200))
    found = [c for r in P.regions(text, P.zones(text)) for c in P.candidates(r)]
    assert found and max(text[c.start : c.end].count(" ") for c in found) < P.GROUPS


def planted(spark):
    """The given texts, and documents with spans of known places that no pattern finds."""
    rng, rows = random.Random(8), []
    for k in range(120):
        a, b, c = rng.randrange(200, 999), rng.randrange(100, 999), rng.randrange(1000, 9999)
        digits = "4" + "".join(str(rng.randrange(10)) for _ in range(14))
        card = next(digits + str(d) for d in range(10) if P.luhn(digits + str(d)))
        own = [f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"user{k} [at] mail{k % 7} [dot] example [dot] com", ".".join(card[i : i + 4] for i in (0, 4, 8, 12))][k % 4]
        rows.append((10**6 + k, f"Some words before {own} and words after it.", ["phone", "phone", "email", "card"][k % 4], 18, 18 + len(own)))
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    return documents.union(spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")), rows


@pytest.mark.skipif(not TESTDATA.exists(), reason="needs the given tables")
def test_query_and_planted_spans(spark):
    documents, rows = planted(spark)
    found = {r["doc_id"]: r for r in P.personal_data(documents).collect()}
    texts = {r["doc_id"]: r["text"] or "" for r in documents.collect()}
    assert found.keys() == texts.keys()
    for doc, text in texts.items():
        base, counts = plain(text), Counter(k for k, _, _ in plain(text))
        r = found[doc]
        named = ",".join(f"{P.KINDS[k]}:{a}:{b}" for k, a, b in base)
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [counts[k] for k in range(4)]
        assert r["base_sha256"] == hashlib.sha256(named.encode()).hexdigest()
        spans = r["spans"].split(",") if r["spans"] else []
        assert set(named.split(",") if named else []) <= set(spans)
        order = [(P.KINDS.index(s.split(":")[0]), int(s.split(":")[1])) for s in spans]
        assert order == sorted(order)
    hits = sum(f"{kind}:{a}:{b}" in found[doc]["spans"].split(",") for doc, _, kind, a, b in rows)
    assert hits >= 0.95 * len(rows)
    clean = [doc for doc, text in texts.items() if doc < 10**6 and not plain(text)]
    assert sum(found[doc]["spans"] != "" for doc in clean) <= 0.01 * len(clean)


def test_odd_rows(spark):
    mail = "x a.b@c-d.org y"
    docs = [(1, None), (2, ""), (3, mail), (3, mail), (None, mail), (None, None), (4, "\n\x00@ +1 .")]
    docs += [(k, f"tel +1 ({200 + k}) 555-0{100 + k} or {k}.{k}.0.{k} card 4111 1111 1111 1111") for k in range(10, 60)]
    kind = "doc_id long, text string"
    out = P.personal_data(spark.createDataFrame(docs, kind)).collect()
    assert Counter(r["doc_id"] for r in out) == Counter(d[0] for d in docs)
    assert all(r["spans"] == "email:2:13" for r in out if r["doc_id"] == 3)
    assert next(r["spans"] for r in out if r["doc_id"] == 1) == ""
    assert P.personal_data(spark.createDataFrame([], kind)).collect() == []
    # Nothing to learn from, and columns with the names of the result.
    bare = spark.createDataFrame([(1, "call 555 123 4567", 3, "x", 1)], kind + ", base long, regions string, spans long")
    assert [r["spans"] for r in P.personal_data(bare).collect()] == [""]
