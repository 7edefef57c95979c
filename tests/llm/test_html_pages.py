"""Pages generated with marked text, standing headings, and hostile, deep and cut-off markup."""

import json
import random
import time

import pytest

from partloom.llm import html_wrapper


def pages(spark, each):
    return spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(each)], "page_id long, url string, html string")


def text_of(spark, each):
    return [r.text for r in html_wrapper.extract(pages(spark, each)).orderBy("page_id").collect()]


@pytest.mark.parametrize("n", [1, 3, 5, 8])
def test_standing_headings_stay_whatever_the_number_of_siblings(spark, n):
    each = [(f"http://h/{i}", f"<nav>Menu</nav><article><h1>Title {i}</h1><p>word{i}</p><h2>Conclusion</h2><p>end{i}</p></article><footer>Foot</footer>") for i in range(n)]
    assert text_of(spark, each) == [f"Title {i} word{i} Conclusion end{i}" for i in range(n)]


def generated(r, k, names):
    """A page of a template with random class names, and its marked text."""
    words = lambda n: " ".join(f"w{r.randrange(10**6)}" for _ in range(n))
    wanted = [words(4), *[words(r.randint(20, 60)) for _ in range(r.randint(2, 6))]]
    if r.random() < 0.5:
        wanted.insert(2, "Standing heading")
    body = "".join(f"<p>{t}</p>" if i else f"<h1>{t}</h1>" for i, t in enumerate(wanted))
    menu = "".join(f"<li><a href='/{i}'>Entry {i}</a></li>" for i in range(6))
    side = "" if r.random() < 0.5 else f"<aside><p>{words(5)}</p></aside>"
    return f"<html><head><title>T{k}</title><script>var x = '<p>no</p>';</script></head><body><div class={names[0]}><ul>{menu}</ul></div>{side}<div class={names[1]}>{body}</div><div class={names[2]}><p>All rights are ours</p></div><footer>{words(3)}</footer></body></html>", " ".join(wanted)


def test_marked_text_of_generated_pages(spark):
    r = random.Random(12)
    each, want = [], []
    for h in range(6):
        names = [f"c{r.randrange(10**6)}" for _ in range(3)]
        for k in range([1, 2, 4, 7, 12, 20][h]):
            page, text = generated(r, k, names)
            each.append((f"http://host{h}/{k}", page))
            want.append(text)
    assert text_of(spark, each) == want


def test_the_wrapper_decides(spark):
    """Without its wrapper's slots a page has no text; and no slots of another template give it one."""
    page = "<div class=a><p>one two</p></div>"
    paths, texts = zip(*html_wrapper.blocks(page), strict=True)
    whole = json.dumps(list(html_wrapper.fold(paths)))
    assert html_wrapper.main_text(paths, texts, whole, frozenset([0])) == "one two"
    assert html_wrapper.main_text(paths, texts, "[]", frozenset([0])) == html_wrapper.main_text(paths, texts, whole, frozenset()) == ""


@pytest.mark.parametrize(
    "page",
    ["<a x " * 200_000 + '"', "<a x='" * 200_000, "<div>" * 60_000 + "x" + "</div>" * 60_000, "<div class='" + "n " * 100_000 + "'>x</div>", "<p>a" * 100_000, "<span>" * 50_000 + "<li>y" * 50_000, "<!-- " * 100_000, "</p>" * 200_000, "<script>" * 100_000, "&lt;" * 200_000],
    ids=["open quote", "quotes", "deep", "classes", "paragraphs", "spans", "comments", "closes", "raw", "references"],
)
def test_hostile_pages_take_time_that_grows_with_them(page):
    began = time.time()
    found = list(html_wrapper.blocks(page))
    assert time.time() - began < 15
    assert sum(len(p) for p, _ in found) < 200 * len(page) + 10_000


def test_attributes_and_quotes():
    read = lambda page: [t for _, t in html_wrapper.blocks(page)]
    assert read('<p title="a > b" x=\'>\'>one</p><p>two') == ["one", "two"]
    assert read("<p it's>three</p>") == ["three"]  # no quote follows
    assert read("<b>a</b> <p>b<br>c</p></p></div>d") == ["a", "b", "c", "d"]
    assert read("x < y and <3 and a<b") == ["x < y and <3 and a"]


def test_long_streams_are_aligned():
    r = random.Random(1)
    a = [f"s{r.randrange(4000)}" for _ in range(3000)]
    b = [x for x in a if r.random() < 0.9]
    for k in range(50):
        b.insert(r.randrange(len(b)), f"new{k}")
    began = time.time()
    done, i, j = [], 0, 0
    for op, p, q, x, y in html_wrapper.opcodes(a, b):
        assert (p, x) == (i, j)
        i, j = q, y
        if op == "equal":
            assert a[p:q] == b[x:y]
            done += a[p:q]
    assert (i, j) == (len(a), len(b)) and len(done) > 0.8 * len(b) and time.time() - began < 20
    wrapper = html_wrapper.align(tuple(a), tuple(b))
    machine = html_wrapper.Matcher(wrapper)
    assert machine.match(a[:200] and b) is not None and machine.match(a) is not None
