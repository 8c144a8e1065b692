"""Main text of web pages: by markup, and by a suffix array over all pages of a host.

Markup names menus, footers, adverts, comments and the like by tags, roles and classes, and articles by `article`,
`main` and their kin. Text that is neither is open. What is left of a page, declared or open, is then judged by the
pages of its host: their token streams are a suffix array cut off at `RUN` tokens. The suffixes of a host that begin with
the same `RUN` tokens lie together (one bucket of the array, found by the shuffle), and a bucket with suffixes of several
different pages is a repeated substring. Tokens covered by one are boilerplate, the unique runs between them are kept.

Declared text is boilerplate on stronger evidence only, since articles may be copied: `DECLARED_RUN` tokens on end that
stand in more than half of the host's declared texts, and no more than half of the text. What stands in more than half of
them does so in at least one of any parts the pages are dealt into, so each task names the buckets that do in its own
pages, and only these are counted over all pages. So long a run holds the least bucket of each `NEIGHBOURS`, so only these
are looked at first; around those that repeat, all buckets are counted, which extends each substring to its full length.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeline.llm.common import Memo, mixed, staged, window_hashes

#: Tokens that must agree, and different pages on which they must stand, for a substring to be boilerplate.
RUN = 6
PAGES = 3
#: Tokens on end that must repeat in declared text.
DECLARED_RUN = 12
NEIGHBOURS = DECLARED_RUN - RUN + 1
#: Open text so many times as long as what a class declares says that the class means something else.
OUTWEIGHED = 3

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>",
    re.DOTALL,
)
#: The same without quoted values, for pages on which looking for their ends has cost too much.
LOOSE_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>()()()", re.DOTALL)
#: Characters that may be searched in vain for the ends of tags, as a multiple of the page's length.
SEARCHES = 16
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
NAME_PART = re.compile(r"[a-z]+|[A-Z][a-z]*|\d+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr input button label select textarea output meter progress svg".split()
)
#: Elements whose content is text up to their end tag.
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template".split())
DROPPED_TAGS = frozenset(
    "script style textarea title xmp iframe noembed noframes noscript template head nav footer aside form button "
    "select option datalist object audio video canvas map dialog menu svg".split()
)
DROPPED_ROLES = frozenset(
    "navigation contentinfo complementary search form dialog alertdialog alert menu menubar toolbar tablist status".split()
)
#: Parts of class names and ids.
DROPPED_NAMES = frozenset(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar aside footer ad ads advert adverts advertisement "
    "advertising adsense sponsor sponsored promo promotion cookie cookies consent gdpr notice notices popup modal "
    "overlay newsletter subscribe subscription signup signin login register share sharing social comment comments "
    "reply replies disqus respond discussion related recommended recommendations widget toolbar pagination pager "
    "search copyright disclaimer alert toast teaser hidden".split()
)
HEADER_NAMES = frozenset("header masthead banner topbar".split())
#: Class names that only say that the page also has such a part.
ABOUT_OTHERS = frozenset("has no with without".split())
ARTICLE_NAMES = frozenset(
    "article articlebody article-body article-content article-text post post-body post-content entry entry-content "
    "story story-body content main main-content maincontent page-content blog-post text".split()
)
NEVER_DROPPED = frozenset("html body main article".split())
#: Depth at which nesting is no longer followed.
DEPTH = 2000


@dataclass
class Page:
    """Blocks in page order with their rank (2: declared by tag or role, 1: by class, 0: open), and the other text."""

    blocks: list[tuple[int, str]] = field(default_factory=list)
    boilerplate: list[str] = field(default_factory=list)

    def _best(self) -> int:
        return max((rank for rank, _ in self.blocks), default=2)

    def _trusted(self) -> int:
        """The rank of the main text; 0 if nothing is declared, or by a class only and much less than what is open."""
        best = self._best()
        if best == 1:
            declared, other = (sum(len(text) for rank, text in self.blocks if rank == k) for k in (1, 0))
            return 0 if other > OUTWEIGHED * declared else 1
        return best

    def decided(self) -> str | None:
        """The main text if the page declares it, None if it has open text only."""
        best = self._trusted()
        return " ".join(text for rank, text in self.blocks if rank == best) if best else None

    def beside(self) -> str:
        """The blocks that are not part of the declared main text."""
        best = self._trusted()
        return " ".join(text for rank, text in self.blocks if rank < best)


def _attributes(source: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(source)}


def _judge(name: str, source: str, inside: int) -> tuple[bool, int]:
    """Whether an element is dropped, and its rank as a container of the article."""
    if not source.strip(" /\n\t"):
        drop, rank = name in DROPPED_TAGS, 2 if name in ("article", "main") else 0
        return drop or (name == "header" and not inside), rank
    a = _attributes(source)
    role = a.get("role", "").strip().lower()
    drop = name in DROPPED_TAGS or role in DROPPED_ROLES or "hidden" in a
    drop = drop or a.get("aria-hidden", "").lower() == "true" or "display:none" in a.get("style", "").replace(" ", "").lower()
    header = name == "header" or role == "banner"
    labels = (a.get("class", "") + " " + a.get("id", "")).split()
    rank = 2 if name in ("article", "main") or role in ("main", "article") or a.get("itemprop") == "articleBody" else 0
    for label in labels:
        parts = {p.lower() for p in NAME_PART.findall(label)}
        if not parts & ABOUT_OTHERS:
            drop = drop or (bool(parts & DROPPED_NAMES) and name not in NEVER_DROPPED)
            drop = drop or (bool(parts & {"comment", "comments", "related", "teaser"}) and name == "article")
            header = header or bool(parts & HEADER_NAMES)
        if label.lower() in ARTICLE_NAMES:
            rank = max(rank, 1)
    drop = drop or (header and not inside and not rank)
    return drop, 0 if drop else rank


#: Verdicts on elements seen; pages of a site repeat the same tags.
_VERDICTS = Memo(lambda key: _judge(*key), 50_000)


def read_page(source: str) -> Page:
    """Split a page into blocks. Broken markup is read as far as it goes: missing end tags end with their parents."""
    page = Page()
    # Open elements: name, dropped, rank, both including what stands above.
    stack: list[tuple[str, bool, int]] = []
    parts: list[str] = []
    linked = total = links = 0
    dropped, rank = False, 0

    def flush() -> None:
        nonlocal linked, total
        if parts:
            text = " ".join("".join(parts).split())
            parts.clear()
            if text:
                # Open text that is nearly all links is a menu.
                if dropped or (not rank and linked > 0.6 * total):
                    page.boilerplate.append(text)
                else:
                    page.blocks.append((rank, text))
        linked = total = 0

    def add(text: str) -> None:
        nonlocal linked, total
        if "&" in text:
            text = html.unescape(text)
        parts.append(text)
        total += len(text)
        if links:
            linked += len(text)

    def close(depth: int) -> None:
        nonlocal dropped, rank, links
        gone = stack[depth:]
        if any(name not in INLINE or down != dropped for name, down, _ in gone) or (depth and stack[depth - 1][1] != dropped):
            flush()
        links = max(0, links - sum(name == "a" for name, _, _ in gone))
        del stack[depth:]
        _, dropped, rank = stack[-1] if stack else ("", False, 0)

    at, end = 0, len(source)
    # No tag ends behind the last `>`, so none is looked for there.
    last, pattern, vain = source.rfind(">") + 1, TAG, 0
    while at < end:
        m = pattern.search(source, at, last) if at < last else None
        if m is None:
            rest = source.find("<!--", at)
            add(source[at : rest if rest >= 0 else end])
            break
        if m[5]:
            # The strict form was tried in vain, at most up to the last `>`.
            vain += last - m.start()
            pattern = TAG if vain <= SEARCHES * end + (1 << 20) else LOOSE_TAG
        if m.start() > at:
            add(source[at : m.start()])
        at = m.end()
        name = m[2] or m[5]
        if name is None:
            continue
        name = name.lower()
        if m[1] or m[4]:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == name:
                    close(depth)
                    break
            else:
                if name not in INLINE:
                    flush()
            continue
        if name in RAW:
            stop = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.IGNORECASE).search(source, at, max(at, last))
            at = stop.end() if stop else end
            continue
        if name not in INLINE:
            # A block ends an open paragraph, a list item or cell the one before.
            for depth in range(len(stack) - 1, max(-1, len(stack) - 8), -1):
                if stack[depth][0] == "p" or (stack[depth][0] == name and name in ("li", "td", "th", "tr", "dt", "dd", "option")):
                    close(depth)
                    break
                if stack[depth][0] not in INLINE:
                    break
            flush()
        attributes = (m[3] if m[2] else m[6]) or ""
        if name in VOID or attributes.endswith("/") and name not in INLINE and len(stack) >= DEPTH:
            continue
        if len(stack) >= DEPTH:
            continue
        drop, own = _VERDICTS[(name, attributes, min(rank, 1))]
        if drop and not dropped:
            flush()
        stack.append((name, dropped or drop, max(rank, own)))
        dropped, rank = stack[-1][1:]
        links += name == "a"
    flush()
    return page


_TOKENS = Memo(lambda token: xxhash.xxh3_64_intdigest(token.encode("utf-8", "surrogatepass")))


def _starts(tokens: list[str], host: int, declared: bool = False) -> np.ndarray:
    """The bucket of the suffix at each token: host and first `RUN` tokens. The last suffixes are too short for one.

    The lowest bit tells the buckets of declared texts from the others.
    """
    if len(tokens) < RUN:
        return np.zeros(0, np.int64)
    hashes = np.fromiter(map(_TOKENS.__getitem__, tokens), np.uint64, len(tokens))
    return mixed(window_hashes(hashes, RUN) ^ np.uint64(host)).view(np.int64) & ~1 | int(declared)


def _least(buckets: np.ndarray) -> np.ndarray:
    """Places of the least bucket of each `NEIGHBOURS`; equal runs of `DECLARED_RUN` tokens have such a bucket in common."""
    if len(buckets) < NEIGHBOURS:
        return np.zeros(0, np.int64)
    least = np.lib.stride_tricks.sliding_window_view(buckets, NEIGHBOURS).argmin(axis=1)
    return np.unique(least + np.arange(len(least)))


def _host(url: str | None) -> str:
    m = re.match(r"\s*[a-zA-Z][\w+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", url or "")
    return m[1].lower() if m else ""


PARSED = "page_id long, url string, host long, stream long, declared boolean, text string, others array<string>"


def _parsed(pages: DataFrame) -> DataFrame:
    """text: the declared main text, or all open text. stream: names the page's texts. others: the texts beside it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                hosts, streams, declared, texts, others = [], [], [], [], []
                for url, source in zip(part.column(1), part.column(2)):
                    page = read_page(source.as_py())
                    text = page.decided()
                    own = " ".join(t for _, t in page.blocks) if text is None else text
                    other = [page.beside(), " ".join(page.boilerplate)]
                    host = xxhash.xxh3_64_intdigest(_host(url.as_py()).encode("utf-8", "surrogatepass"))
                    stream = "\n".join([str(host), str(text is None), own, *other])
                    hosts.append(host - 2**63)
                    streams.append(xxhash.xxh3_64_intdigest(stream.encode("utf-8", "surrogatepass")) - 2**63)
                    declared.append(text is not None)
                    texts.append(own)
                    others.append(other)
                columns = [
                    pa.array(hosts, pa.int64()),
                    pa.array(streams, pa.int64()),
                    pa.array(declared, pa.bool_()),
                    pa.array(texts, pa.string()),
                    pa.array(others, pa.list_(pa.string())),
                ]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), *columns], names=[c.split()[0] for c in PARSED.split(", ")]
                )

    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    )
    return rows.mapInArrow(run, PARSED)


def _suffixes(parsed: DataFrame, text: bool = True, others: bool = False) -> DataFrame:
    """stream, place, bucket of the suffixes of the page's own text, of `others` beside it (place -1), or of both.

    Of declared texts the least of neighbours, or those around `places` if the pages have this column.
    """
    near = "places" in parsed.columns
    wanted = ["host", "stream", "declared", *["text"] * text, *["others"] * others, *["places"] * near]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                streams, places, buckets = [], [], []
                for row in part.to_pylist():
                    host = row["host"] + 2**63
                    found = []
                    if text:
                        own = _starts(row["text"].split(" "), host, row["declared"])
                        if near:
                            around = np.array(row["places"])[:, None] + np.arange(1 - NEIGHBOURS, NEIGHBOURS)
                            at = np.unique(around[(around >= 0) & (around < len(own))])
                        else:
                            at = _least(own) if row["declared"] else np.arange(len(own))
                        found.append(own[at])
                        places.append(at)
                    if others:
                        beside = [_starts(other.split(), host) for other in row["others"]]
                        found += beside
                        places.append(np.full(sum(map(len, beside)), -1))
                    buckets += found
                    streams.append(np.full(sum(map(len, found)), row["stream"]))
                columns = [np.concatenate(streams), np.concatenate(places).astype(np.int32), np.concatenate(buckets)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["stream", "place", "bucket"])

    return parsed.select(*wanted).mapInArrow(run, "stream long, place int, bucket long")


def _often(declared: DataFrame, at_once: int = 2_000_000) -> DataFrame:
    """Buckets that stand in more than half of the texts that a host has in some part of the table: host, bucket.

    `declared` has no copies. A part is what a task holds when it has about `at_once` buckets, or has read all.
    """

    def part(hosts: list[int], held: list[np.ndarray]) -> pa.RecordBatch:
        bucket, first, n = np.unique(np.concatenate(held), return_index=True, return_counts=True)
        # A bucket has one host.
        of = np.repeat(np.array(hosts, np.int64), [len(own) for own in held])[first]
        known, texts = np.unique(hosts, return_counts=True)
        most = 2 * n > texts[np.searchsorted(known, of)]
        return pa.record_batch([pa.array(of[most]), pa.array(bucket[most])], ["host", "bucket"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hosts, held, size = [], [], 0
        for batch in batches:
            for host, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = _starts(text.as_py().split(" "), host + 2**63, True)
                hosts.append(host)
                held.append(np.unique(own[_least(own)]))
                size += len(held[-1])
                if size >= at_once:
                    yield part(hosts, held)
                    hosts, held, size = [], [], 0
        if hosts:
            yield part(hosts, held)

    return declared.select("host", "text").mapInArrow(run, "host long, bucket long").distinct()


def _repeated(suffixes: DataFrame) -> DataFrame:
    """Buckets that stand on enough different pages, the number of these pages, and one of them."""
    seen = suffixes.select("bucket", "stream").distinct()
    return seen.groupBy("bucket").agg(F.count("*").alias("n"), F.min("stream").alias("sample")).where(F.col("n") >= PAGES)


def _in_most(repeated: DataFrame, declared: DataFrame) -> DataFrame:
    """Of the buckets of declared texts those that stand in more than half of the host's."""
    streams = declared.select("host", "stream").distinct()
    sizes = streams.groupBy(F.col("host").alias("_host")).agg(F.count("*").alias("pages"))
    own = repeated.where(F.col("bucket").bitwiseAND(F.lit(1)) == 1).join(streams, F.col("sample") == F.col("stream"))
    return own.join(sizes, F.col("host") == F.col("_host")).where(2 * F.col("n") > F.col("pages")).select("bucket")


def _unique_runs(rows: DataFrame) -> DataFrame:
    """The texts but for the tokens that a repeated substring (`covered`: its places) covers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for declared, text, covered in zip(*(batch.column(c).to_pylist() for c in ("declared", "text", "covered"))):
                if covered:
                    own = text.split(" ")
                    gone = np.zeros(len(own) + 2, np.int8)
                    for p in covered:
                        gone[p + 1 : p + 1 + RUN] = 1
                    if declared:
                        edges = np.flatnonzero(np.diff(gone))
                        for a, b in zip(edges[::2], edges[1::2]):
                            if b - a < DECLARED_RUN:
                                gone[a + 1 : b + 1] = 0
                        # What is mostly repeated is a copied article.
                        if 2 * gone.sum() > len(own):
                            gone[:] = 0
                    text = " ".join(t for t, g in zip(own, gone[1:]) if not g)
                texts.append(text)
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"]
            )

    return rows.mapInArrow(run, "page_id long, url string, text string")


def main_text(pages: DataFrame) -> DataFrame:
    """Main text of every page: page_id, url, text, n_chars.

    A null or empty page, or one without article, has the empty text. Copies of a page count as one page when
    repetition is counted. A null url is a host of its own. Repeated rows are extracted each; an empty table gives no
    rows; other columns are ignored.
    """
    parsed = staged(_parsed(pages).withColumn("row", F.monotonically_increasing_id()), "pages")
    open_pages, declared = parsed.where("NOT declared"), parsed.where("declared")
    # Open texts, by all that is not declared.
    beside = _suffixes(declared, text=False, others=True).union(_suffixes(open_pages, others=True))
    repeated = staged(_repeated(beside).select("bucket"), "repeated")
    covered = _suffixes(open_pages).join(repeated, "bucket").select("stream", "place")
    # Declared texts.
    copied = declared.groupBy(F.col("stream").alias("_stream")).agg(F.min("row").alias("first"), F.count("*").alias("n"))
    marked = declared.join(staged(copied.where("n > 1"), "copied"), F.col("stream") == F.col("_stream"), "left")
    often = staged(_often(marked.where("first IS NULL OR first = row")), "often")
    hosts = staged(often.select("host").distinct(), "hosts")
    found = _suffixes(declared.join(hosts, "host", "left_semi")).join(often.select("bucket"), "bucket")
    found = staged(found.select("stream", "place", "bucket"), "found")
    anchors = staged(_in_most(_repeated(found), declared), "anchors")
    anchored = found.join(anchors, "bucket").groupBy("stream").agg(F.collect_set("place").alias("places"))
    near = staged(_suffixes(declared.join(staged(anchored, "anchored"), "stream")), "near")
    full = staged(_in_most(_repeated(near), declared), "full")
    covered = covered.union(near.join(full, "bucket").select("stream", "place"))
    places = staged(covered.groupBy("stream").agg(F.collect_set("place").alias("covered")), "covered")
    text = _unique_runs(parsed.select("page_id", "url", "declared", "text", "stream").join(places, "stream", "left"))
    return text.withColumn("n_chars", F.length("text").cast("long"))
