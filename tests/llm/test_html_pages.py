"""Broken and very long pages, pages without an article element, text below the body, decoding against trying every choice."""

import time
from itertools import product

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import html_extract
from tidemark.llm.html_extract import chosen, main_text, parse, tags_of

BROKEN = {
    "tags": "<a " * 83_000,
    "quotes": '<a "' * 60_000,
    "buttons": "<button " * 30_000,
    "end tags": "<p>x</q></section>" * 14_000,
    "comments": "<!" * 120_000,
    "scripts": "<script>" + "</script " * 27_000,
    "titles": "<title" * 40_000,
    "hidden": "<select>" + "<div></p>" * 25_000,
}


@pytest.mark.parametrize("name", BROKEN)
def test_broken_pages_are_read_in_one_pass(name):
    tags_of("<a>")
    begin = time.process_time()
    parse(BROKEN[name])
    assert time.process_time() - begin < 0.9


def test_a_tag_that_is_not_closed_takes_no_text_with_it():
    assert [t for _, t in parse("<p>one <b two</p><p title='a<b>c'>three</p><p>1 < 2</p>").blocks] == ["one <b two", "three", "1 < 2"]


def test_deep_pages(spark):
    html = "<div>" * 3000 + "<p>" + "Some text, as an article has it. " * 20 + "</p>"
    page = parse(html)
    x, parents, depth = html_extract.features([page])
    assert depth.max() == 3001 and chosen(np.ones(len(depth)), parents, depth).all()


def decode_by_trying(odds, parents):
    best = None
    for pick in product([False, True], repeat=len(odds)):
        if all((up < 0 and on) or (up >= 0 and (not on or pick[up])) for on, up in zip(pick, parents, strict=True)):
            total = sum(o for o, on in zip(odds, pick, strict=True) if on)
            best = total if best is None else max(best, total)
    return best


@settings(deadline=None, max_examples=80)
@given(st.lists(st.tuples(st.integers(-8, 8), st.integers(0, 100)), min_size=1, max_size=10), st.integers(1, 2))
def test_decoding_is_the_best_of_all_choices(nodes, roots):
    """Odds are odd multiples of a half, so that no node has odds of nothing."""
    parents = np.array([-1 if k < roots else r % k for k, (_, r) in enumerate(nodes)])
    odds = np.array([o + 0.5 for o, _ in nodes])
    depth = np.zeros(len(nodes), np.int64)
    for k, up in enumerate(parents):
        depth[k] = 0 if up < 0 else depth[up] + 1
    keep = chosen(odds, parents, depth)
    assert keep[parents < 0].all() and all(not keep[k] or up < 0 or keep[up] for k, up in enumerate(parents))
    assert odds[keep].sum() == decode_by_trying(odds, parents)


SENTENCES = [
    "The river rises in the hills above the town and reaches the plain after a day. ",
    "Old bridges cross it in four places, and two of them are open to walkers only. ",
    "In spring the water is high, so the lower fields are left to the birds for weeks. ",
]


def made_page(k):
    paragraphs = [f"Part {k} {j}. " + "".join(SENTENCES[(j + i + k) % 3] for i in range(3)).strip() for j in range(4)]
    menu = "".join(f'<li><a href="#">Link {j}</a></li>' for j in range(6))
    body = "".join(f"<p>{p}</p>" for p in paragraphs)
    html = f"<html><body>Accept all cookies now<nav class=menu><ul>{menu}</ul></nav><div class=content>{body}</div><footer>&copy; site {k}</footer></body></html>"
    return html, "\n".join(paragraphs)


def test_pages_without_an_article_element(spark):
    made = [made_page(k) for k in range(40)]
    rows = [(k, f"u{k}", html) for k, (html, _) in enumerate(made)] + [(40, "u", None), (41, "u", "bare text only"), (41, "u", "")]
    found = main_text(spark.createDataFrame(rows, "page_id int, url string, html string")).collect()
    texts = {r.page_id: r.text for r in found if r.page_id < 40}
    right = sum(texts[k] == expected for k, (_, expected) in enumerate(made))
    assert right >= 36 and not any("cookies" in t or "Link" in t or "site" in t for t in texts.values())
    assert sorted(r.text for r in found if r.page_id >= 40) == ["", "", "bare text only"]


def test_long_page(spark):
    paragraphs = [f"Paragraph {i}. {SENTENCES[i % 3].strip()}" for i in range(6000)]
    html = "<html><body><nav><ul><li><a>Home</a></li></ul></nav><article>" + "".join(f"<p>{p}</p>" for p in paragraphs) + "</article></body></html>"
    small = [(k, "u", made_page(k)[0].replace("<div class=content>", "<article>").replace("</div>", "</article>")) for k in range(12)]
    found = main_text(spark.createDataFrame([(99, "u", html), *small], "page_id int, url string, html string"))
    row = found.filter("page_id = 99").first()
    assert row.text == "\n".join(paragraphs) and row.n_chars == len(row.text)


def test_long_pages_alone(spark):
    """Trees are fitted where all pages are too long to be fitted whole."""
    menu = "<html><body><nav><ul>" + "".join(f"<li><a href=x>Link {j}</a></li>" for j in range(9)) + "</ul></nav><article>"
    made = ["\n".join(f"Part {k} {i}. {SENTENCES[(i + k) % 3].strip()}" for i in range(2100)) for k in range(3)]
    pages = [menu + "".join(f"<p>{p}</p>" for p in text.split("\n")) + "</article></body></html>" for text in made]
    assert min(map(len, pages)) > html_extract.FIT_CHARS
    found = main_text(spark.createDataFrame([(k, "u", p) for k, p in enumerate(pages)], "page_id int, url string, html string"))
    assert {r.page_id: r.text for r in found.collect()} == dict(enumerate(made))
