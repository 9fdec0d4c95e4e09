"""Main text by line-block distribution: what surges, what dives, and what a name alone cannot take away."""

import random

import pytest

from shelfwright.llm import main_text
from shelfwright.llm.main_text import passages, windows

of = main_text.main_text
LONG = ("This is a long paragraph of the page. " * 20).strip()


def plain_passages(lengths, window, floor):
    """Line by line, every window summed anew."""
    up = [sum(lengths[max(0, i - window + 1) : i + 1]) > floor for i in range(len(lengths))]
    down = [sum(lengths[i : i + window]) > floor for i in range(len(lengths))]
    out, i = [], 0
    while i < len(lengths):
        if up[i] and lengths[i]:
            j = i
            while j + 1 < len(lengths) and up[j + 1]:
                j += 1
            ends = [k for k in range(i + 1, j + 1) if lengths[k] and down[k]]
            out.append((i, max([i, *ends]) + 1))
            i = j + 1
        i += 1
    return out


def test_passages_equal_plain_ones():
    rnd = random.Random(4)
    for _ in range(3000):
        lengths = [rnd.choice([0, 0, 1, 3, 9, 40]) for _ in range(rnd.randrange(14))]
        window, share = rnd.randrange(1, 5), rnd.choice([0.0, 0.1, 0.25, 0.7])
        assert windows(lengths, window) == [sum(lengths[max(0, i - window + 1) : i + 1]) for i in range(len(lengths))]
        floor = share * max(windows(lengths, window), default=0)
        assert passages(lengths, window, floor) == plain_passages(lengths, window, floor)


def test_the_floor_follows_the_page():
    assert passages([5, 0, 0, 0, 100, 90, 0, 0, 0, 6]) == [(4, 6)]
    assert passages([5, 0, 0, 0, 10, 9, 0, 0, 0, 6]) == [(0, 1), (4, 6), (9, 10)]
    assert passages([]) == passages([0, 0]) == []


def test_labels_around_the_text_go_without_an_article():
    page = f"<div>My Site</div><div>Posted in News</div><h1>Title</h1><p>{LONG}</p><div>small print</div><p>{LONG}</p><div>Filed under x</div>"
    assert of(page) == f"Title {LONG} small print {LONG}"


def test_without_passages_labels_would_stay(monkeypatch):
    page = f"<div>My Site</div><p>{LONG}</p>"
    assert of(page) == LONG
    monkeypatch.setattr(main_text, "passages", lambda lengths, *a, **k: [(0, len(lengths))])
    assert of(page) == f"My Site {LONG}"


@pytest.mark.parametrize("mark", ["class=reply", "id=share", "class='social x'", "role=alert"])
def test_a_doubtful_name_does_not_take_prose(mark):
    assert of(f"<article><p>{LONG}</p><p {mark}>So he said.</p></article>") == f"{LONG} So he said."
    assert of(f"<article><p>{LONG}</p><section {mark}><p>{LONG}</p></section></article>") == f"{LONG} {LONG}"
    assert of(f"<article><p>{LONG}</p><div {mark}><a href=x>Share</a> <b>on</b></div></article>") == LONG
    assert of(f"<p>{LONG}</p><div {mark}>Share it</div>") == LONG


@pytest.mark.parametrize(
    "mark",
    ["class=commentlist", "id=disqus_thread", "class=post-comments-wrapper", "class=ad-slot", "class=adsbygoogle"]
    + ["class=sidebar-left", "class='x cookie-bar'", "class=newsletter-box", "class=footer-bottom", "class=comment-list"],
)
@pytest.mark.parametrize("page", ["<article><p>{0}</p>{1}</article>", "<main><p>{0}</p>{1}</main>", "<div><p>{0}</p></div>{1}"])
def test_a_sure_name_takes_even_prose(mark, page):
    assert of(page.format(LONG, f"<div {mark}><p>{LONG}</p><p>Nice one.</p></div>")) == LONG


def test_formulas_stay():
    assert of("<article><p>So <math><mi>a</mi><mo>=</mo><mi>b</mi></math> holds.</p></article>") == "So a=b holds."


def test_clashing_columns(spark):
    rows = [(1, f"<article>{LONG}</article>", "old", 7, "r"), (1, None, None, None, None), (None, "", "x", 1, "y")]
    pages = spark.createDataFrame(rows, "page_id long, html string, text string, n_chars int, `__row` string")
    out = main_text.extract_main_text(pages)
    assert out.columns == ["page_id", "text", "n_chars", "__row"]
    assert [tuple(r) for r in out.collect()] == [(1, LONG, len(LONG), "r"), (1, "", 0, None), (None, "", 0, "y")]
    assert main_text.extract_main_text(pages.limit(0)).count() == 0
