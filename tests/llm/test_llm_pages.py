"""Pages that markup misleads, and very long broken ones."""

from __future__ import annotations

import time
from collections import Counter

import pytest

from lodgeline.llm import extraction

LONG = "The long article that goes on for quite a while and says many things about the world"


def test_a_class_on_little_text_does_not_hide_the_article(spark):
    page = "<div class='text'>Cookie stuff</div><div class='body'><p>{}</p></div>"
    assert extraction.read_page(page.format(LONG)).decided() is None
    assert extraction.read_page("<div class='text'>" + LONG + "</div><div>Short</div>").decided() == LONG
    assert extraction.read_page("<article>Short</article><div>" + LONG + "</div>").decided() == "Short"
    rows = [(k, f"http://h.example/{k}", page.format(f"{LONG} on page {k}")) for k in range(2)]
    found = {r["page_id"]: r["text"] for r in extraction.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(found[k] == f"Cookie stuff {LONG} on page {k}" for k in range(2))


@pytest.mark.parametrize(
    "unit", ["<a ", '<a ">"', "<!", "</script ", "<script></script ", '<a "', "<a '\">", "<", "<!--", "<p>x", "<!x", "<a b='", "</p", "<a =\">\" "]
)
@pytest.mark.parametrize("end", ["", ">", '">', "'>"])
def test_broken_pages_take_linear_time(unit, end):
    source = unit * (1_000_000 // len(unit)) + end
    start = time.process_time()
    extraction.read_page(source)
    assert time.process_time() - start < 8


def test_text_behind_the_last_tag_is_text():
    read = lambda s: " ".join(t for _, t in extraction.read_page(s).blocks)
    assert read("<p>a</p> b < c <d") == "a b < c <d"
    assert read("a <b") == "a <b" and read("<p>a</p>b <!-- c") == "a b"
    # The strict form gives way to the loose one, and every word is still there.
    source = '<b ">"' * 400_000 + "<p>end of it</p>"
    assert read(source).endswith("end of it")


def test_a_notice_inside_declared_articles_goes(spark):
    notice = "get our best stories of the week by mail every friday morning and never miss any of them"
    story = "story{0} begins{0} here{0} and{0} has{0} many{0} words{0} which{0} no{0} other{0} page{0} of{0} the{0} host{0} holds{0} at{0} all{0}"
    kind = "page_id long, url string, html string"
    own = {k: (story.format(k), story.format(f"x{k}")) for k in range(5)}
    page = "<article><p>{}</p><div class=q{}>{}</div><p>{}</p></article>"
    rows = [(k, "http://h.example/x", page.format(a, k, notice, b)) for k, (a, b) in own.items()]
    # The same words, on a minority of the pages of another host.
    rows += [(10 + k, "http://o.example/x", page.format(a, k, notice if k < 2 else "", b)) for k, (a, b) in own.items()]
    # One article on all pages of a host is a copied one, and a short phrase is no notice.
    rows += [(20 + k, "http://c.example/x", f"<article>{story.format('')} x{k}</article>") for k in range(5)]
    rows += [(30 + k, "http://s.example/x", page.format(a, k, "by our own writer in the city", b)) for k, (a, b) in own.items()]
    found = {r["page_id"]: r["text"] for r in extraction.main_text(spark.createDataFrame(rows, kind)).collect()}
    for k, (a, b) in own.items():
        assert found[k] == f"{a} {b}"
        assert found[10 + k] == (f"{a} {notice} {b}" if k < 2 else f"{a} {b}")
        assert found[20 + k] == f"{story.format('')} x{k}"
        assert found[30 + k] == f"{a} by our own writer in the city {b}"


def test_least_buckets_are_shared_by_equal_runs():
    words = [f"w{k}" for k in range(200)]
    shared = [f"s{k}" for k in range(extraction.DECLARED_RUN)]
    one, two = (extraction._starts(words[a:b] + shared + words[b:c], 7, True) for a, b, c in ((0, 20, 50), (60, 133, 180)))
    assert set(one[extraction._least(one)]) & set(two[extraction._least(two)])


def test_parts_name_all_that_most_texts_hold(spark):
    host = 3
    texts = [" ".join(f"{'s' if 20 <= j < 34 and k % 3 else f'p{k}-'}{j}" for j in range(60)) for k in range(60)]
    rows = spark.createDataFrame([(host, t) for t in texts], "host long, text string").repartition(5)
    starts = [extraction._starts(t.split(" "), host + 2**63, True) for t in texts]
    counts = Counter(b for own in starts for b in set(own[extraction._least(own)].tolist()))
    most = {b for b, n in counts.items() if 2 * n > len(texts)}
    for at_once in (1, 100, 10_000):
        named = {r["bucket"] for r in extraction._often(rows, at_once).collect()}
        assert most and most <= named
