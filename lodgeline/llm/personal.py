"""Personal data in texts: patterns, and a semi-Markov conditional random field for what they miss.

Patterns give the base spans, each found in linear time. Between them lie regions that look alike: groups of digits,
and words around a sign for "at". In a region, whole spans are candidates for a kind, scored by features of the span
as a whole (digits, groups, separators, check digit, domain, neighbours). Entities are bounded in groups, so dynamic
programming over the candidates' ends finds the best set of spans and kinds at once, and in training the total over all
sets. Whatever is in no span scores zero.

The model is fitted on base spans of a bounded sample, and on copies of them in other spellings (other separators, no
country code, "at" in words), against copies made wrong and regions that surely hold no span.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodgeline.llm.common import staged, text_column

KINDS = ("email", "ip", "card", "phone")
#: Groups of digits, and labels of a domain, that an entity has at most.
GROUPS = 12
#: Regions the model is fitted on: so many with a base span of each kind, and so many without.
PER_CLASS = 400

# Base patterns. Groups never give back what they took, which changes no match and keeps long texts linear.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_ZONE = re.compile(r"[0-9](?:[ .-]?[0-9])*+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGITS = re.compile(r"[0-9]+")

# Regions.
_GAP = re.compile(r"[ ().-]{1,3}")
_AT = re.compile(r"@|[\[({] ?at ?[\])}]|(?<= )at(?= )", re.IGNORECASE)
_BEFORE = re.compile(r"[A-Za-z0-9._%+-]{1,64} ?\Z")
_DOT = r"(?:\.|[\[({] ?dot ?[\])}]|dot)"
_AFTER = re.compile(rf" ?[A-Za-z0-9-]{{1,63}}(?: ?{_DOT} ?[A-Za-z0-9-]{{1,63}}){{1,{GROUPS}}}", re.IGNORECASE)
_FIRST = re.compile(r" ?[A-Za-z0-9-]{1,63}")
_LABEL = re.compile(rf"( ?{_DOT} ?)([A-Za-z0-9-]{{1,63}})", re.IGNORECASE)


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = ord(d) - 48
        if k % 2:
            v = 2 * v - 9 if v > 4 else 2 * v
        total += v
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(_DIGITS.findall(s))


def emails(text: str) -> list[tuple[int, int]]:
    """The part before each @ is the longest that reaches back to the last match, as the leftmost match has it."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        # A sign that is no part of a match bounds the next one.
        last = at + 1
        if domain:
            out.append((start, domain.end()))
            last = domain.end()
        at = text.find("@", last)
    return out


class Zone(NamedTuple):
    start: int
    end: int


def zones(text: str) -> list[Zone]:
    """Runs of digits with single blanks, points and hyphens between; addresses and cards lie within one."""
    return [Zone(*m.span()) for m in _ZONE.finditer(text)]


def base_spans(text: str, found: list[Zone] | None = None) -> list[tuple[int, int, int]]:
    """(kind, start, end) of all base spans, by kind, then start."""
    out = [(0, a, b) for a, b in emails(text)]
    found = zones(text) if found is None else found
    for z in found:
        if z.end - z.start > 6 and text.count(".", z.start, z.end) > 2:
            for m in _IP.finditer(text, z.start, z.end):
                if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) < 256 for p in m.group().split(".")):
                    out.append((1, *m.span()))
    for z in found:
        if z.end - z.start > 15:
            for m in _CARD.finditer(text, z.start, z.end):
                if m.end() - m.start() < 38:
                    digits = _digits(m.group())
                    if 16 <= len(digits) <= 19 and luhn(digits):
                        out.append((2, *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(map(len, _DIGITS.findall(m.group()))) <= 15:
                out.append((3, *m.span()))
    return out


class Region(NamedTuple):
    """A stretch of text with candidates; `left` and `right` are its neighbours."""

    start: int
    text: str
    left: str
    right: str


#: Kinds of separators; all others count as mixed.
_SEPARATORS = {"": "none", " ": "blank", "-": "hyphen", ".": "point"}


def regions(text: str, found: list[Zone]) -> list[Region]:
    """Stretches of digits with 7 digits or more, and words around signs for "at"."""
    out: list[tuple[int, int]] = []
    k = 0
    while k < len(found):
        start, end = found[k]
        k += 1
        while k < len(found) and found[k].start - end < 4 and _GAP.fullmatch(text, end, found[k].start):
            end = found[k].end
            k += 1
        if end - start > 6 and sum(map(len, _DIGITS.findall(text, start, end))) > 6:
            while start and text[start - 1] in "+(":
                start -= 1
            out.append((start, end))
    if "@" in text or " dot " in text or "at]" in text or "at)" in text or "at}" in text:
        last = 0
        for m in _AT.finditer(text):
            before = _BEFORE.search(text[max(last, m.start() - 66) : m.start()])
            after = _AFTER.match(text, m.end())
            if before and after:
                out.append((m.start() - len(before.group()), after.end()))
                last = after.end()
    return [Region(a, text[a:b], text[max(0, a - 24) : a], text[b : b + 1]) for a, b in out]


class Candidate(NamedTuple):
    start: int
    end: int
    kind: int
    features: tuple[str, ...]


def _beside(c: str) -> str:
    return "edge" if not c else "letter" if c.isalpha() else "digit" if c.isdigit() else "blank" if c.isspace() else "sign"


def _word_before(left: str) -> str:
    parts = re.findall(r"[^\W\d_]+", left)
    return parts[-1].lower()[-12:] if parts else ""


def _number_candidates(r: Region) -> Iterator[Candidate]:
    groups = [m.span() for m in _DIGITS.finditer(r.text)]
    for i, (first, _) in enumerate(groups):
        start = first
        while start and r.text[start - 1] in "+(" and first - start < 2:
            start -= 1
        digits, seps = "", []
        for j in range(i, min(i + GROUPS, len(groups))):
            if j > i:
                seps.append(r.text[groups[j - 1][1] : groups[j][0]])
            digits += r.text[slice(*groups[j])]
            if len(digits) > 19:
                break
            end = groups[j][1]
            is_ip = j - i == 3 and seps == ["."] * 3
            # Numbers of single digits are lists, not entities.
            sparse = 2 * (j - i) > len(digits)
            if (len(digits) < 7 or sparse) and not is_ip:
                continue
            lengths = "-".join(str(b - a) for a, b in groups[i : j + 1])
            kinds = {_SEPARATORS.get(s, "bracket" if set(s) <= set("() ") else "mixed") for s in seps} or {"none"}
            before, after = r.text[start - 1] if start else r.left[-1:], r.text[end] if end < len(r.text) else r.right
            shared = (
                f"digits={len(digits)}",
                f"groups={lengths if j - i < 6 else j - i}",
                f"separators={'+'.join(sorted(kinds))}",
                f"head={r.text[start:first]}",
                f"before={_beside(before)}",
                f"after={_beside(after)}",
                f"word={_word_before(r.left) if i == 0 else ''}",
                f"whole={i == 0 and j == len(groups) - 1}",
            )
            if is_ip:
                parts = [int(r.text[a:b]) for a, b in groups[i : j + 1]]
                yield Candidate(start, end, 1, ("bias", f"octets={max(parts) < 256}", f"head={r.text[start:first]}", *shared[4:]))
            if len(digits) >= 13 and not sparse:
                yield Candidate(start, end, 2, ("bias", f"luhn={luhn(digits)}", *shared))
            if 6 < len(digits) < 16 and not sparse:
                yield Candidate(start, end, 3, ("bias", *shared))


def _address_candidates(r: Region) -> Iterator[Candidate]:
    for m in _AT.finditer(r.text):
        before = _BEFORE.search(r.text[: m.start()])
        first = _FIRST.match(r.text, m.end())
        if not (before and first):
            continue
        local, at = before.group().strip(), r.text[m.start() : m.end()].lower()
        start = m.start() - len(before.group())
        spaced = r.text[m.start() - 1] == " "
        end, dots = first.end(), set()
        for n in range(GROUPS):
            label = _LABEL.match(r.text, end)
            if not label:
                break
            end = label.end()
            dots.add(label.group(1).strip().lower() + ("_" if " " in label.group(1) else ""))
            more = _LABEL.match(r.text, end) is not None
            yield Candidate(
                start,
                end,
                0,
                (
                    "bias",
                    f"at={at}{'_' if spaced else ''}",
                    f"dots={'+'.join(sorted(dots))}",
                    f"last={label.group(2).lower()[:12]}",
                    f"plain={label.group(2).isalpha()}",
                    f"labels={n + 2}",
                    f"more={more}",
                    f"signs={bool(set(local) & set('._%+-0123456789'))}",
                    f"short={len(local) < 3}",
                    f"before={_beside(r.left[-1:] if start == 0 else r.text[start - 1])}",
                ),
            )


def candidates(r: Region) -> list[Candidate]:
    """Possible entities of a region; none has more than GROUPS groups."""
    return list((_address_candidates if _AT.search(r.text) else _number_candidates)(r))


Weights = dict[tuple[int, str], float]


def _scores(found: list[Candidate], w: Weights) -> list[float]:
    return [sum(w.get((c.kind, f), 0.0) for f in c.features) for c in found]


def _log_add(a: float, b: float) -> float:
    if a < b:
        a, b = b, a
    return a if b == -math.inf else a + math.log1p(math.exp(b - a))


def _stops(found: list[Candidate]) -> list[int]:
    return sorted({c.start for c in found} | {c.end for c in found})


def marginals(found: list[Candidate], scores: list[float]) -> tuple[float, list[float]]:
    """Logarithm of the total over all sets of spans that do not overlap, and the probability of each candidate."""
    stops = _stops(found)
    place = {p: k for k, p in enumerate(stops)}
    ends, starts = defaultdict(list), defaultdict(list)
    for k, c in enumerate(found):
        ends[place[c.end]].append(k)
        starts[place[c.start]].append(k)
    n = len(stops)
    ahead, behind = [0.0] * n, [0.0] * n
    for p in range(1, n):
        ahead[p] = ahead[p - 1]
        for k in ends[p]:
            ahead[p] = _log_add(ahead[p], ahead[place[found[k].start]] + scores[k])
    for p in range(n - 2, -1, -1):
        behind[p] = behind[p + 1]
        for k in starts[p]:
            behind[p] = _log_add(behind[p], behind[place[found[k].end]] + scores[k])
    total = ahead[-1] if n else 0.0
    return total, [math.exp(ahead[place[c.start]] + s + behind[place[c.end]] - total) for c, s in zip(found, scores)]


def best_set(found: list[Candidate], scores: list[float]) -> list[Candidate]:
    """The spans of the greatest score in all; of equal ones, those that end first."""
    stops = _stops(found)
    place = {p: k for k, p in enumerate(stops)}
    ends = defaultdict(list)
    for k, c in enumerate(found):
        ends[place[c.end]].append(k)
    best, taken = [0.0] * len(stops), [-1] * len(stops)
    for p in range(1, len(stops)):
        best[p] = best[p - 1]
        for k in ends[p]:
            score = best[place[found[k].start]] + scores[k]
            if score > best[p]:
                best[p], taken[p] = score, k
    out, p = [], len(stops) - 1
    while p > 0:
        if taken[p] < 0:
            p -= 1
        else:
            out.append(found[taken[p]])
            p = place[out[-1].start]
    return out[::-1]


Labelled = tuple[Region, frozenset[tuple[int, int, int]]]


def _spelled(r: Region, kind: int, a: int, b: int, rng: random.Random) -> Iterator[Labelled]:
    """The region with its one span spelled otherwise, and with a span made wrong."""
    span = r.text[a:b]

    def put(own: str, right: bool = True) -> Labelled:
        gold = frozenset({(kind, a, a + len(own))}) if right else frozenset()
        return Region(r.start, r.text[:a] + own + r.text[b:], r.left, r.right), gold

    if kind == 0:
        local, domain = span.split("@")
        for at, dot in ((" at ", " dot "), ("[at]", "[dot]"), ("(at)", "(dot)"), (" (at) ", "."), ("(at)", "."), (" [at] ", " [dot] "), ("@", " dot "), (" @ ", " . ")):
            yield put(local + at + domain.replace(".", dot))
        other = re.findall(r"[A-Za-z]+", r.left) or ["look"]
        words = [rng.choice(other) for _ in range(3)]
        yield put(f"{words[0]} at {words[1]} dot {words[2]}", False)
        yield put(f"{local} at {words[1]} . {words[2]}", False)
    elif kind == 1:
        parts = span.split(".")
        parts[rng.randrange(4)] = str(rng.randrange(256, 1000))
        yield put(".".join(parts), False)
    elif kind == 2:
        digits = _digits(span)
        wrong = digits[:-1] + str((int(digits[-1]) + rng.randrange(1, 10)) % 10)
        for sep in (".", "  ", " - "):
            cut = [digits[k : k + 4] for k in range(0, len(digits), 4)]
            yield put(sep.join(cut))
            yield put(sep.join(wrong[k : k + 4] for k in range(0, len(wrong), 4)), False)
        yield put(wrong, False)
    else:
        groups = _DIGITS.findall(span)
        for own in (groups, groups[1:]):
            n = sum(map(len, own))
            if len(own) > 1 and 9 < n < 16:
                for sep in (" ", "-", "."):
                    yield put(sep.join(own))
                if len(own) > 2:
                    yield put(f"({own[0]}) {'-'.join(own[1:])}")
        digits = "".join(groups)
        yield put(digits, False)
        yield put(digits[:8], False)
        yield put("-".join((digits[:4], digits[4:6], digits[6:8])), False)


def training_set(rows: list[tuple[Region, list[tuple[int, int, int]]]], seed: int = 12) -> list[Labelled]:
    """Regions with their spans, and other spellings of those with one span."""
    rng, out = random.Random(seed), []
    for r, spans in rows:
        own = [(k, a - r.start, b - r.start) for k, a, b in spans if a >= r.start and b <= r.start + len(r.text)]
        if len({k for k, _, _ in own}) < len(own) or any(x[1] < y[2] and y[1] < x[2] for x in own for y in own if x < y):
            continue
        out.append((r, frozenset(own)))
        if len(own) == 1:
            out += _spelled(r, *own[0], rng)
    return out


def fit(examples: list[Labelled], rounds: int = 8, rate: float = 0.5, penalty: float = 1e-3, seed: int = 12) -> Weights:
    """Weights of greatest conditional likelihood, by adaptive gradient steps over the regions in random order.

    Kinds without an example get no weights, and no span is ever of such a kind.
    """
    ready = []
    for r, gold in examples:
        found = candidates(r)
        named = {(c.kind, c.start, c.end) for c in found}
        if found and gold <= named:
            ready.append((found, [(c.kind, c.start, c.end) in gold for c in found]))
    kinds = {c.kind for found, right in ready for c, ok in zip(found, right) if ok}
    ready = [([c for c in found if c.kind in kinds], [ok for c, ok in zip(found, right) if c.kind in kinds]) for found, right in ready]
    w: Weights = defaultdict(float)
    squares: dict = defaultdict(lambda: 1e-6)
    rng = random.Random(seed)
    for _ in range(rounds):
        rng.shuffle(ready)
        for found, right in ready:
            _, p = marginals(found, _scores(found, w))
            step: dict = defaultdict(float)
            for c, ok, q in zip(found, right, p):
                if abs(ok - q) > 1e-4:
                    for f in c.features:
                        step[c.kind, f] += ok - q
            for key, g in step.items():
                g -= penalty * w[key]
                squares[key] += g * g
                w[key] += rate * g / math.sqrt(squares[key])
    return {key: v for key, v in w.items() if v}


def fit_with_unmarked(marked: list[Labelled], unmarked: list[Region]) -> Weights:
    """The model of marked regions and of those unmarked ones that are surely without a span.

    Regions without a base span may well hold what the patterns miss. So a first model of the marked regions alone
    says which of them more likely hold no span than any; only these count as such in the second fit.
    """
    w = fit(marked)
    sure = []
    for r in unmarked:
        found = [c for c in candidates(r) if (c.kind, "bias") in w]
        if marginals(found, _scores(found, w))[0] < math.log(2):
            sure.append((r, frozenset()))
    return fit(marked + sure)


def added(found: list[Region], base: list[tuple[int, int, int]], w: Weights) -> list[tuple[int, int, int]]:
    """Spans of the model that overlap no base span."""
    kinds = {kind for kind, _ in w}
    taken = sorted((a, b) for _, a, b in base)
    reach, furthest = [], 0
    for _, b in taken:
        furthest = max(furthest, b)
        reach.append(furthest)
    starts, out = [a for a, _ in taken], []
    for r in found:

        def free(c: Candidate, r: Region = r) -> bool:
            k = bisect_left(starts, r.start + c.end)
            return k == 0 or reach[k - 1] <= r.start + c.start

        own = [c for c in candidates(r) if c.kind in kinds and free(c)]
        out += [(c.kind, r.start + c.start, r.start + c.end) for c in best_set(own, _scores(own, w))]
    # Two regions may touch; the first keeps the text.
    out.sort(key=lambda s: s[1:])
    kept: list[tuple[int, int, int]] = []
    for s in out:
        if not kept or s[1] >= kept[-1][2]:
            kept.append(s)
    return kept


SPAN = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())])
REGION = pa.struct([("start", pa.int64()), ("text", pa.string()), ("left", pa.string()), ("right", pa.string())])
SCANNED = (
    "doc_id long, base array<struct<kind: int, start: long, end: long>>, "
    "regions array<struct<start: long, text: string, left: string, right: string>>"
)


def scanned(documents: DataFrame) -> DataFrame:
    """doc_id, base spans and regions of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, found = [], []
            for text in batch.column(1):
                text = text.as_py()
                own = zones(text)
                base.append([dict(zip(("kind", "start", "end"), s)) for s in base_spans(text, own)])
                found.append([r._asdict() for r in regions(text, own)])
            columns = [batch.column(0), pa.array(base, pa.list_(SPAN)), pa.array(found, pa.list_(REGION))]
            yield pa.record_batch(columns, ["doc_id", "base", "regions"])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_column().alias("text"))
    return rows.mapInArrow(run, SCANNED)


def learned(rows: DataFrame, per_class: int = PER_CLASS) -> Weights:
    """The model of a table that `scanned` made.

    It is fitted on `per_class` regions with a base span of each kind and as many without, those with the least hash;
    equal regions count once.
    """
    each = rows.select("base", F.explode("regions").alias("r")).where(F.length("r.text") <= 400)
    inside = F.filter("base", lambda s: (s["start"] >= F.col("r.start")) & (s["end"] <= F.col("r.start") + F.length("r.text")))
    each = each.select("r", inside.alias("own"))
    kind = F.when(F.size("own") == 0, -1).when(F.size("own") == 1, F.col("own")[0]["kind"]).otherwise(-2)
    keyed = each.select("r", "own", kind.alias("kind"), F.xxhash64("r.text", "r.left", "r.right").alias("h"))
    # Equal regions gather in one task in no step: each task sends on one of them.
    once = keyed.groupBy("kind", "h").agg(F.first(F.struct("r", "own")).alias("row"))
    order = Window.partitionBy("kind").orderBy("h")
    drawn = once.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= per_class)
    # At most 6 * per_class short rows.
    found = sorted(drawn.select("kind", "h", "row").collect(), key=lambda x: (x["kind"], x["h"]))
    marked, unmarked = [], []
    for row in (x["row"] for x in found):
        r, own = Region(**row["r"].asDict()), [(s["kind"], s["start"], s["end"]) for s in row["own"]]
        marked.append((r, own)) if own else unmarked.append(r)
    return fit_with_unmarked(training_set(marked), unmarked)


FOUND = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def _named(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def personal_data(documents: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """Personal data of every text: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans.

    The counts and the digest are those of the base spans; `spans` also has those that the model adds, which overlap no
    base span. Texts are searched whole, once. A null or empty text has no spans; repeated rows are rows like any other,
    also without id; without base spans nothing is learnt and nothing added; an empty table gives no rows; other columns
    are ignored.
    """
    rows = staged(scanned(documents), "regions")
    shared = documents.sparkSession.sparkContext.broadcast(learned(rows, per_class))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for batch in batches:
            out = []
            for doc, own, found in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "base", "regions"))):
                base = [(s["kind"], s["start"], s["end"]) for s in own]
                more = added([Region(**r) for r in found], base, w)
                counts = [sum(s[0] == k for s in base) for k in range(4)]
                digest = hashlib.sha256(_named(base).encode()).hexdigest()
                out.append((doc, *counts, digest, _named(base + more)))
            columns = list(zip(*out)) if out else [[]] * 7
            kinds = [pa.int64()] * 5 + [pa.string()] * 2
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], [c.split()[0] for c in FOUND.split(", ")])

    return rows.mapInArrow(run, FOUND)
