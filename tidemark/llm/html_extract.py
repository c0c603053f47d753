"""Main text of web pages: boosted trees over DOM nodes, decoded so that the choices agree along the tree.

A page is parsed into a tree of block elements (inline tags only mark links). Features of a node: its tag, words of class, id
and role (also those of its ancestors), depth, amount, density, links and punctuation of the text below it, and statistics
among its siblings. Gradient-boosted trees give every node the log-odds of being part of the article. Decoding chooses the set
of nodes with the largest sum of log-odds in which no chosen node has an ancestor that isn't: one pass up and one down.

There are no labelled pages, so labels are made: a bounded sample of pages (``FIT_PAGES`` by a hash of the id; of pages of more than ``FIT_CHARS`` characters
their first ``FIT_CUT``) whose article element is known is rebuilt in many layouts, with other containers and names, and with menus, headers, footers, sidebars,
notices, adverts, forms and reader comments made from the pages' own sentences. The trees are fitted on the nodes of these, and on
the sampled pages as found, where elements whose tag or class names tell so count as not the article. Where no page has an article
element, the layouts are made from the pages' long blocks, and nothing is taken as found.

Defined results: null or empty html, and a page without text, give an empty text; markup that isn't closed is closed as
browsers do for blocks; raw text of scripts, styles and form controls is never text, and a script or style without an end tag
goes on to the end of the page; titles, frames and text fields without one go on to the next tag. Buttons, lists to select from,
drawings, templates and noscript are left out; without an end tag they end with their block or where the next one begins. What stands in
a head beside titles, scripts and styles is text, as browsers move it to the body. Rows that repeat are extracted one by one.
A line break tag is a white space. Text below the body that stands in no block is kept where it is half of the page's text or more.
A tag that isn't closed before the next "<" is text. Other columns are kept out of the result. An empty table gives an empty one.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.boosting import Trees, fit_trees

FIT_PAGES, LAYOUTS, PAGES_AT_ONCE = 500, 3, 64
#: Pages of more characters are extracted like all others, but the trees are fitted on their beginnings: the sample fits the driver.
FIT_CHARS, FIT_CUT = 200_000, 20_000

# Attributes: quoted values may hold anything. A tag that isn't closed ends its trial at the next "<", so that a page of
# such tags is read in one pass.
_INSIDE = r"(?:[^<>\"']|\"[^\"]*\"|'[^']*')*"
_TAG = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(script|style|textarea|title|iframe)(?=[\s/>])(?:{_INSIDE}|[^<>]*)>"
    rf"|<(/?)([a-zA-Z][^\s/<>]*)({_INSIDE})>|<(/?)(button|select|svg|template|noscript)(?=[\s/>])([^<>]*)>|<[!?][^<>]*>",
    re.S | re.I,
)
# Elements whose content is raw text, by what is looked for to end it (a second title or frame tells that the first
# has no end), and elements that are left out with all they hold.
_RAW_END = {name: re.compile(rf"<(/){name}(?=[\s/>])[^<>]*>", re.I) for name in ("script", "style", "textarea")}
_RAW_END |= {name: re.compile(rf"<(/?){name}(?=[\s/>])[^<>]*>", re.I) for name in ("title", "iframe")}
LEFT_OUT = frozenset({"button", "select", "svg", "template", "noscript"})
NESTING = frozenset({"svg", "template"})
_UNQUOTED_END = re.compile(r"=\s*[^\s\"'=]+$")
_ATTRIBUTE = re.compile(r"(?:class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORD = re.compile(r"[a-z]+")

# Elements that make blocks of their own, and those that end an open paragraph or list item.
BLOCKS = frozenset(
    "html body div p section article main header footer nav aside form fieldset ul ol li dl dt dd table thead tbody tr td th "
    "h1 h2 h3 h4 h5 h6 blockquote pre figure figcaption details summary address hr center dialog menu".split()
)
VOID = frozenset({"hr"})
SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "p": {"p"}}
TAGS = ("nav header footer aside form article main section div p ul li table blockquote").split()
# Words of class, id and role by what they tell.
GROUPS = {
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs toc pagination pager tabs toolbar",
    "frame": "header footer masthead topbar bottombar copyright legal credits",
    "side": "sidebar aside related recommended recommendations trending popular widget widgets rail complementary more",
    "advert": "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner",
    "notice": "cookie cookies consent notice alert popup modal overlay gdpr privacy subscribe newsletter signup login paywall",
    "comment": "comment comments reply replies respond disqus discussion thread reader feedback responses",
    "share": "share sharing social follow twitter facebook tags meta byline author",
    "article": "article content main post entry story text body prose page",
}
_GROUP_OF = {w: k for k, words in enumerate(GROUPS.values()) for w in words.split()}
N_GROUPS = len(GROUPS)
#: Set on made pages at elements that are not part of the article.
MARK = "data-is=no"


@dataclass
class Page:
    """Nodes in page order (a parent before its children) and the text runs: node, text."""

    tags: list[str] = field(default_factory=list)
    parents: list[int] = field(default_factory=list)
    flags: list[int] = field(default_factory=list)
    links: list[int] = field(default_factory=list)
    marked: list[bool] = field(default_factory=list)
    blocks: list[tuple[int, str]] = field(default_factory=list)

    def node(self, tag: str, parent: int, attributes: str) -> int:
        bits = 0
        if attributes:
            for value in _ATTRIBUTE.finditer(attributes):
                for word in _WORD.findall((value[1] or value[2] or value[3] or "").lower()):
                    k = _GROUP_OF.get(word)
                    if k is not None:
                        bits |= 1 << k
        self.tags.append(tag)
        self.parents.append(parent)
        self.flags.append(bits)
        self.links.append(0)
        self.marked.append(MARK in attributes)
        return len(self.tags) - 1


def tags_of(source: str) -> list[tuple[int, int, str, str, str]]:
    """Start, end, slash, name and attributes of all tags; raw text belongs to its tag, a comment has no name.

    Without an end tag, scripts and styles go on to the end of the page, the text of others to the next tag.
    """
    out, at, endless = [], 0, set()
    while m := _TAG.search(source, at):
        at = m.end()
        if not m[1]:
            out.append((m.start(), at, m[2] or m[5] or "", (m[3] or m[6] or "").lower(), m[4] or m[7] or ""))
            continue
        name = m[1].lower()
        end = None if name in endless else _RAW_END[name].search(source, at)
        if end and end[1]:
            at = end.end()
        else:
            if not end:
                endless.add(name)
            at = len(source) if name in ("script", "style") else source.find("<", at)
            at = len(source) if at < 0 else at
        out.append((m.start(), at, "", name, ""))
    return out


def closes_itself(attributes: str) -> bool:
    return attributes.endswith("/") and not _UNQUOTED_END.search(attributes)


def ended(tags: list[tuple[int, int, str, str, str]]) -> set[int]:
    """Indices of the start tags of left-out elements that have an end tag of their own."""
    out, opened = set(), {name: [] for name in LEFT_OUT}
    for k, (_, _, slash, name, attributes) in enumerate(tags):
        if name in LEFT_OUT:
            if slash:
                if opened[name]:
                    out.add(opened[name].pop())
            elif not closes_itself(attributes):
                if name not in NESTING:
                    opened[name].clear()
                opened[name].append(k)
    return out


def parse(source: str) -> Page:
    """The tree and the blocks of text of a page, in page order."""
    page = Page()
    root = page.node("body", -1, "")
    stack, run, in_link, at = [root], [], False, 0
    tags = tags_of(source)
    has_end = ended(tags)
    # The open left-out element, whether its end tag comes, how often it is nested, and the blocks open in it.
    hidden, sure, depth_in, inner, within = "", False, 0, [], Counter()
    # How many blocks of a name are open: an end tag that has none is passed over without a look at the stack.
    opened: Counter[str] = Counter()

    def flush():
        if run:
            text = " ".join(html.unescape("".join(run)).split())
            if text:
                page.blocks.append((stack[-1], text))
            run.clear()

    def close(depth):
        flush()
        opened.subtract(page.tags[n] for n in stack[depth:])
        del stack[depth:]

    for k, (begin, end, slash, name, attributes) in enumerate(tags):
        if begin > at and not hidden:
            piece = source[at:begin]
            run.append(piece)
            if in_link:
                page.links[stack[-1]] += len(piece.strip())
        at = end
        if hidden:
            if name == hidden and (slash or name in NESTING):
                if slash or not closes_itself(attributes):
                    depth_in += -1 if slash else 1
                if not depth_in:
                    hidden = ""
                continue
            if name in LEFT_OUT and name == hidden:
                hidden = ""  # a button or list ends an open one
            elif sure and not slash:
                if name in BLOCKS and name not in VOID:
                    inner.append(name)
                    within[name] += 1
                continue
            elif name in BLOCKS and name not in VOID:
                if slash and within[name] > 0:
                    while (gone := inner.pop()) != name:
                        within[gone] -= 1
                    within[name] -= 1
                    continue
                if slash and not opened[name]:
                    continue
                hidden = ""  # its block ends, or it was never closed
            else:
                continue
        if not name:
            continue
        if name in LEFT_OUT:
            if not slash:
                if name in ("button", "select"):
                    run.append(" ")
                if not closes_itself(attributes):
                    hidden, sure, depth_in, inner, within = name, k in has_end, 1, [], Counter()
        elif name == "a":
            in_link = not slash
        elif name in ("br", "img", "input", "textarea"):
            run.append(" ")
        elif name in BLOCKS and name not in ("html", "body"):
            if slash:
                if opened[name] <= 0:
                    flush()
                    continue
                depth = len(stack) - 1
                while page.tags[stack[depth]] != name:
                    depth -= 1
                close(depth)
                continue
            in_link = False
            if page.tags[stack[-1]] == "p":
                close(len(stack) - 1)
            closing = SAME.get(name)
            if closing and page.tags[stack[-1]] in closing:
                close(len(stack) - 1)
                if name == "tr" and page.tags[stack[-1]] == "tr":
                    close(len(stack) - 1)
            flush()
            if name not in VOID:
                stack.append(page.node(name, stack[-1], attributes))
                opened[name] += 1
    if at < len(source) and not hidden:
        run.append(source[at:])
    flush()
    return page


def features(pages: list[Page]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, parents, depths) of all nodes of all pages, one page after the other."""
    first = np.cumsum([0, *[len(p.tags) for p in pages]])
    n = int(first[-1])
    parents = np.concatenate([np.where(np.array(p.parents) < 0, -1, np.array(p.parents) + f) for p, f in zip(pages, first, strict=False)])
    flags = np.concatenate([p.flags for p in pages])
    links = np.concatenate([p.links for p in pages]).astype(float)
    tags = [t for p in pages for t in p.tags]
    own, stops, runs, words, place = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n), np.full(n, -1.0)
    for page, f in zip(pages, first, strict=False):
        before = 0
        for node, text in page.blocks:
            k = node + f
            own[k] += len(text)
            stops[k] += text.count(".") + text.count(",") + text.count("?") + text.count("!")
            words[k] += text.count(" ") + 1
            runs[k] += 1
            if place[k] < 0:
                place[k] = before
            before += len(text)
    depth = np.zeros(n, np.int64)
    inherited = flags.copy()
    tag_code = np.array([TAGS.index(t) if t in TAGS else len(TAGS) for t in tags])
    outer = np.zeros(n, np.int64)  # tags of ancestors, as bits
    for k in np.flatnonzero(parents >= 0):  # parents come first
        up = parents[k]
        depth[k] = depth[up] + 1
        inherited[k] |= inherited[up]
        outer[k] = outer[up] | 1 << tag_code[up]
    sums = np.stack([own, links, stops, runs, words, np.ones(n), (tag_code == TAGS.index("p")).astype(float)], axis=1)
    below = sums.copy()
    children = np.zeros(n)
    for at in reversed(levels(depth)[1:]):
        np.add.at(below, parents[at], below[at])
        np.add.at(children, parents[at], 1)
    safe = np.maximum(parents, 0)
    nth = np.zeros(n)
    seen: dict[int, int] = {}
    for k, up in enumerate(parents):
        nth[k] = seen.get(up, 0)
        seen[up] = seen.get(up, 0) + 1
    page_of = np.repeat(np.arange(len(pages)), np.diff(first))
    whole = np.maximum(below[first[:-1]][:, 0][page_of], 1)
    siblings = np.maximum(children[safe], 1)
    headings = np.array([len(t) == 2 and t[0] == "h" and t[1].isdigit() for t in tags], float)
    text, link, stop, run, word, nodes, paragraphs = below.T
    columns = [
        np.log1p(text), link / np.maximum(text, 1), stop / np.maximum(word, 1), text / nodes, text / np.maximum(run, 1), np.log1p(nodes),
        np.log1p(paragraphs), text / whole, text / np.maximum(text[safe], 1), own / np.maximum(text, 1), depth, children, nth, siblings,
        nth / siblings, np.where(place < 0, 0, place) / whole, np.arange(n) - first[page_of], headings,
        link[safe] / np.maximum(text[safe], 1), stop[safe] / np.maximum(word[safe], 1), np.log1p(paragraphs[safe]), text[safe] / whole,
        *[(tag_code == k).astype(float) for k in range(len(TAGS))],
        *[(outer >> k & 1).astype(float) for k in range(6)],
        *[(flags >> k & 1).astype(float) for k in range(N_GROUPS)],
        *[(inherited >> k & 1).astype(float) for k in range(N_GROUPS - 1)],
    ]
    return np.stack(columns, axis=1).astype(np.float32), parents, depth


def levels(depth: np.ndarray) -> list[np.ndarray]:
    """The nodes of every depth, the roots first."""
    order = np.argsort(depth, kind="stable")
    return np.split(order, np.flatnonzero(np.diff(depth[order])) + 1)


def chosen(odds: np.ndarray, parents: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """The nodes with the largest sum of log-odds such that every chosen node's parent is chosen; roots always are."""
    best = odds.copy()
    by_depth = levels(depth)[1:]
    for at in reversed(by_depth):
        np.add.at(best, parents[at], np.maximum(best[at], 0))
    keep = depth == 0
    for at in by_depth:
        keep[at] = keep[parents[at]] & (best[at] > 0)
    return keep


def extract(sources: list[str], trees: Trees | None) -> list[str]:
    """The main text of every page."""
    pages = [parse(s) for s in sources]
    if not pages:
        return []
    x, parents, depth = features(pages)
    keep = chosen(trees.odds(x), parents, depth) if trees else np.ones(len(x), bool)
    out, first = [], 0
    for page in pages:
        bare = trees is None or is_bare(page)
        out.append("\n".join(text for node, text in page.blocks if keep[first + node] and (node or bare)))
        first += len(page.tags)
    return out


def is_bare(page: Page) -> bool:
    """Does the text that stands in no block make up half of the page or more?"""
    inside = sum(len(text) for node, text in page.blocks if node)
    return sum(len(text) for node, text in page.blocks if not node) >= inside


def layouts(source: str, others: list[str], rng: np.random.Generator) -> list[str]:
    """Pages made of one page's article, in which all that is added carries the mark."""
    made = re.search(r"<article[^>]*>(.*?)</article>", source, re.S | re.I)
    if not made:
        return []
    return [_layout(made[1], others, rng) for _ in range(LAYOUTS)]


def _layout(inner: str, others: list[str], rng: np.random.Generator) -> str:
    pick = lambda *x: x[rng.integers(len(x))]

    def some(least, most):
        words = others[rng.integers(len(others))].split()
        n = int(rng.integers(least, most + 1))
        return html.escape(" ".join((words * (n // max(len(words), 1) + 1))[:n]))

    def links(n):
        return "".join(f'<li><a href="#">{some(1, 4)}</a></li>' for _ in range(n))

    def junk(kind):
        if kind == "menu":
            body, tag = f"<ul>{links(int(rng.integers(3, 12)))}</ul>", pick("nav", "div", "ul", "nav")
            name = pick("nav", "menu", "main-menu", "navbar", "breadcrumbs", "")
        elif kind == "header":
            body, tag, name = f"<h2>{some(2, 6)}</h2><p>{some(3, 12)}</p>" + pick("", f"<ul>{links(4)}</ul>"), pick("header", "div"), pick("header", "masthead", "top-header")
        elif kind == "footer":
            body, tag, name = f"<p>&copy; {some(3, 20)}</p>" * int(rng.integers(1, 3)), pick("footer", "div", "footer"), pick("footer", "page-footer", "copyright", "")
            body = pick(body, "&copy; site &middot; " + some(3, 20))
        elif kind == "side":
            body, tag = pick(f"<ul>{links(6)}</ul>", f"<h3>{some(2, 4)}</h3><p>{some(5, 40)}</p>", f"<p>{some(10, 50)}</p>" * 2), pick("aside", "div", "section")
            name = pick("sidebar", "related", "widget", "right-rail", "trending")
        elif kind == "advert":
            body, tag = pick(some(3, 25), f"<p>{some(3, 25)}</p>", f'<a href="#">{some(2, 12)}</a>'), pick("div", "div", "aside", "section", "p")
            name = pick("ad", "advert", "ads", "sponsored", "promo", "banner-ad", "advertisement")
        elif kind == "notice":
            body, tag, name = f"<p>{some(6, 30)}</p>" + pick("", "<button>OK</button>"), pick("div", "section", "dialog"), pick("cookie-notice", "consent", "notice", "newsletter", "alert", "popup")
        elif kind == "form":
            body, tag, name = f"<label>{some(1, 4)}</label><input><p>{some(3, 15)}</p>", "form", pick("", "search", "signup", "contact")
        else:
            body = "".join(pick(f'<div class="comment"><p>{some(5, 60)}</p></div>', f"<li><p>{some(5, 60)}</p></li>", f"<p>{some(5, 60)}</p>") for _ in range(int(rng.integers(1, 6))))
            body, tag, name = f"<h3>{some(1, 3)}</h3>" + body, pick("section", "div", "ul", "aside"), pick("comments", "comment-list", "discussion", "reader-comments", "responses")
        attribute = pick("class", "id", "class") if name else ""
        return f"<{tag} data-is=no" + (f' {attribute}="{name}">' if name else ">") + f"{body}</{tag}>"

    def may(kind, chance):
        return junk(kind) if rng.random() < chance else ""

    pieces = re.split(r"(?=<p>)", inner)
    if rng.random() < 0.3:  # short articles
        pieces = pieces[: int(rng.integers(1, 4))]
    for _ in range(int(rng.integers(0, 3))):
        pieces.insert(int(rng.integers(1, len(pieces) + 1)), junk(pick("advert", "advert", "side", "form", "notice")))
    tag = pick("article", "div", "main", "section", "article", "div")
    name = pick("", "content", "post", "entry-content", "story", "article-body", "main-text", "x1", "wrap")
    body = f"<{tag}" + (f' {pick("class", "id")}="{name}">' if name else ">") + "".join(pieces) + may("comment", 0.2) + f"</{tag}>"
    if rng.random() < 0.3:
        body = f"<main>{body}</main>"
    if rng.random() < 0.3:
        body = f'<div class="{pick("container", "row", "layout", "wrapper")}">{may("side", 0.5)}{body}{may("side", 0.5)}</div>'
    before = may("notice", 0.3) + may("header", 0.5) + may("menu", 0.7) + may("advert", 0.5) + may("form", 0.2)
    after = may("comment", 0.5) + may("side", 0.4) + may("advert", 0.2) + may("form", 0.2) + may("footer", 0.8) + may("notice", 0.1)
    body = before + body + after
    return f'<html><body>{body if rng.random() < 0.7 else f"<div id=page>{body}</div>"}</body></html>'


def labelled(source: str) -> tuple[Page, np.ndarray]:
    """A made page and its nodes' labels: 0 from a marked element down, 1 elsewhere."""
    page = parse(source)
    labels = np.ones(len(page.tags), np.int64)
    for k, up in enumerate(page.parents):
        labels[k] = not page.marked[k] and (up < 0 or labels[up])
    return page, labels


def fit(pages: DataFrame, page_id="page_id", source="html") -> Trees | None:
    """Trees fitted on layouts made from at most ``FIT_PAGES`` pages: those with an article element, and where no page has one,
    the paragraphs that stand out by length of any pages. None if there are none of these either."""
    whole = F.col(source)
    # An article that is cut ends where its page is cut.
    begun = F.when(F.length(whole) > FIT_CHARS, F.concat(F.substring(whole, 1, FIT_CUT), F.lit("</article>"))).otherwise(whole)
    every = pages.select(F.col(page_id).cast("string").alias("id"), begun.alias("html")).filter(F.col("html").isNotNull())
    rows = _sample(every.filter(F.col("html").rlike("(?i)<article")))
    rng = np.random.default_rng(8)
    if rows:
        sentences = [t for r in rows for t in extract([r], None)[0].split("\n") if t] or ["text"]
        made = [labelled(s) for r in rows for s in layouts(r, sentences, rng)]
        for r in rows:
            made.append(labelled(_as_found(r)))
            made.append(labelled(_first_paragraph(_as_found(r))))
    else:
        texts = [[text for _, text in parse(r).blocks] for r in _sample(every)]
        sentences = [t for own in texts for t in own]
        made = [labelled(_layout(inner, sentences, rng)) for own in texts if (inner := _paragraphs(own)) for _ in range(LAYOUTS)]
    if not made:
        return None
    x, parents, _ = features([p for p, _ in made])
    y = np.concatenate([labels for _, labels in made])
    inner = parents >= 0  # roots are chosen anyway
    return fit_trees(x[inner], y[inner].astype(float))


def _sample(pages: DataFrame) -> list[str]:
    """At most ``FIT_PAGES`` pages (id, html), by a hash of the id; of rows with one id a single one."""
    ids = pages.select("id").orderBy(F.xxhash64("id"), "id").limit(FIT_PAGES)
    return [r["html"] for r in pages.join(F.broadcast(ids), "id").dropDuplicates(["id"]).orderBy("id").collect()]


def _first_paragraph(source: str) -> str:
    """A page whose article ends after its first paragraph."""
    last, at = source.rfind("</article>"), 0
    while 0 <= (begin := source.find("<p>", at)) < last:
        after, at = source.find("<p>", begin + 3), source.find("</article>", begin + 3)
        if 0 <= after < at:
            return source[:after] + source[last:]
    return source


def _paragraphs(texts: list[str]) -> str:
    """The blocks of at least a fifth of the longest one's length, and of 60 characters, as paragraphs."""
    least = max(60, max(map(len, texts), default=0) // 5)
    return "".join(f"<p>{html.escape(t)}</p>" for t in texts if len(t) >= least)


def _as_found(source: str) -> str:
    """A page with marks at the elements whose tags or names say that they are not the article."""
    out = re.sub(r"<(nav|header|footer|aside|form)\b", r"<\1 data-is=no", source, flags=re.I)
    return re.sub(r"<div(?= class=\"(?:ad|ads|advert)\")", "<div data-is=no", out, flags=re.I)


def main_text(pages: DataFrame, page_id="page_id", url="url", source="html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    trees = fit(pages, page_id, source)
    slim = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(source).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), PAGES_AT_ONCE):
                some = batch.slice(at, PAGES_AT_ONCE)
                texts = extract([s or "" for s in some.column(2).to_pylist()], trees)
                yield pa.record_batch([some.column(0), some.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    kind = slim.schema["page_id"].dataType.simpleString()
    out = slim.mapInArrow(run, f"page_id {kind}, url string, text string")
    return out.select(F.col("page_id").alias(page_id), F.col("url").alias(url), "text", F.length("text").cast("bigint").alias("n_chars"))
