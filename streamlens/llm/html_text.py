"""Main text of web pages: boosted trees over the nodes of the page, decoded from the top of the tree down.

A page is read once into its block elements; text of inline elements belongs to the block around it. Features of a
block are its tag, tokens of its attributes and of those around it, text and link density of its subtree, depth,
and how it compares with its siblings. The trees give each block a probability of being article text. Decoding
picks the best set of blocks under the rule that nothing inside a dropped block is kept: a tree recursion compares
the value of a block with that of dropping all of it.

Training pages are made on the driver from a bounded sample (``SAMPLE`` pages): their own layout where it is marked
by semantic elements, and their texts put into many other layouts whose parts are known.

A null or empty page gives an empty text. Pages cut off anywhere, unclosed and wrongly nested elements are read as
far as they go: text of an unclosed head counts, a drawing or a selection list at the next block or with its
parent, frames and the like without an end tag are empty; only code without an end tag ends the page. Repeated pages give repeated rows; other columns are kept unless they clash with ``text`` or ``n_chars``.
"""

from __future__ import annotations

import html
import random
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamlens.llm import trees
from streamlens.llm.words import pieces

SAMPLE = 200
LAYOUTS = 500
RUN = 1 << 19

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</([a-zA-Z][^\s>/]*)[^>]*(?:>|\Z)"""
    r"""|<([a-zA-Z][^\s>/]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<([a-zA-Z][^\s>/]*)([^>]*)(?:>|\Z)""",
    re.S,
)
# Elements without a place in the text. CODE holds no markup; the others end with their own end tag, and without one
# anywhere after them they are empty. DRAWN holds no blocks: the next block ends it, as the end of its parent does.
CODE = {"script", "style"}
HIDDEN = {"noscript", "template", "iframe", "textarea", "title", "object", "annotation", "annotation-xml"}
DRAWN = {"svg", "select"}
# A head holds nothing but hidden elements and these, so its end, which need not be written, does not matter.
IN_HEAD = {"head", "meta", "link", "base"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
TAGS = (
    "html body div p article main section nav header footer aside form ul ol li dl dt dd table tbody thead tr td th h1 h2 h3 h4 h5 h6 "
    "blockquote pre figure figcaption address details summary fieldset button label"
).split()
NUMBER = {t: i for i, t in enumerate(TAGS)}
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
# Stems of attribute tokens.
STEMS = (
    "article content post entry main story text body title headline nav menu header footer side cookie consent notice banner advert "
    "promo sponsor share social relat recommend comment reply respon subscri newsletter sign login form bread pagin widget modal popup "
    "copyright legal tag author meta search alert hidden skip"
).split()
STEM = re.compile("|".join(STEMS))
AD = re.compile(r"(?:^|[\s_\"'-])ads?(?:$|[\s_\"'0-9-])")
LATE = len(STEMS) + 1


class Page(NamedTuple):
    """Block elements in page order (0 is the page itself) and the texts between their tags.

    ``own``: letters, words, letters in links, sentence marks, links, inline tags of the block outside inner blocks.
    ``text``: (block, text) in page order; block -1 is a break between blocks.
    """

    tag: list[int]
    parent: list[int]
    depth: list[int]
    stems: list[int]
    own: list[list[int]]
    text: list[tuple[int, str]]


def read(source: str | None) -> Page:
    page = Page([-1], [0], [0], [0], [[0] * 6], [])
    if not source:
        return page
    open_: list[tuple[str, int]] = []  # names of open elements and the block each belongs to
    block, link, at, drawn = 0, 0, 0, 0
    ends: dict[str, int] = {}  # where the last end tag of a name stands

    def text(part: str) -> None:
        if drawn:
            return
        if "&" in part:
            part = html.unescape(part)
        words = part.split()
        page.text.append((block, part))
        if words:
            n = sum(map(len, words))
            own = page.own[block]
            own[0] += n
            own[1] += len(words)
            own[2] += n if link else 0
            own[3] += part.count(".") + part.count(",") + part.count("!") + part.count("?")

    def close(upto: int) -> None:
        nonlocal block, link, drawn
        while len(open_) > upto:
            name, _ = open_.pop()
            if name == "a":
                link -= 1
            if name in DRAWN:
                drawn -= 1
            if name in NUMBER:
                page.text.append((-1, " "))
        block = open_[-1][1] if open_ else 0

    while True:
        m = TOKEN.search(source, at)
        if m is None:
            text(source[at:])
            break
        if m.start() > at:
            text(source[at : m.start()])
        at = m.end()
        ended, started = m.group(1), m.group(2) or m.group(4)
        if ended:
            name = ended.lower()
            for k in range(len(open_) - 1, -1, -1):
                if open_[k][0] == name:
                    close(k)
                    break
                if name not in NUMBER and open_[k][0] in NUMBER:
                    break
            continue
        if not started:
            continue
        name, rest = started.lower(), m.group(3) or m.group(5) or ""
        if name in IN_HEAD:
            continue
        if name in CODE or name in HIDDEN:
            if name not in ends:
                ends[name] = max((m.start() for m in re.finditer(rf"</{name}(?=[\s/>])", source[at:], re.I)), default=-1) + at
            if ends[name] > at or ends[name] == at and source.startswith("</", at):
                at = re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(source, at).end()
            elif name in CODE:
                break
            elif name in ("title", "textarea"):
                at = source.find("<", at) if "<" in source[at:] else len(source)
            page.text.append((-1, " "))
            continue
        if drawn and name in NUMBER and not any(n == "foreignobject" for n, _ in open_[-64:]):
            for k in range(len(open_) - 1, -1, -1):
                if open_[k][0] in DRAWN:
                    close(k)
                    if not drawn:
                        break
        if name in DRAWN:
            page.text.append((-1, " "))
            if not rest.endswith("/"):
                drawn += 1
                open_.append((name, block))
            continue
        if name == "br" or name == "hr":
            page.text.append((-1, " "))
        page.own[block][5] += 1
        if name in VOID or rest.endswith("/") and name not in NUMBER:
            continue
        if name in NUMBER:
            shut = CLOSES.get(name, set())
            for k in range(len(open_) - 1, -1, -1):
                inner = open_[k][0]
                if inner == "p" and name not in ("button", "label") or inner in shut:
                    close(k)
                    break
                if inner in NUMBER and not (shut and inner not in ("ul", "ol", "table", "dl")):
                    break
            page.text.append((-1, " "))
            rest = rest.lower()
            found = 0
            if rest:
                for stem in STEM.findall(rest):
                    found |= 1 << STEMS.index(stem)
                if AD.search(rest):
                    found |= 1 << len(STEMS)
            page.tag.append(NUMBER[name])
            page.parent.append(block)
            page.depth.append(page.depth[block] + 1)
            page.stems.append(found)
            page.own.append([0] * 6)
            block = len(page.tag) - 1
        elif name == "a":
            link += 1
            page.own[block][4] += 1
        open_.append((name, block))
    return page


class Nodes(NamedTuple):
    """The blocks of several pages, one after another; ``parent`` counts over all."""

    parent: np.ndarray
    depth: np.ndarray
    own: np.ndarray
    features: np.ndarray
    first: np.ndarray


def by_depth(depth: np.ndarray) -> list[np.ndarray]:
    """The blocks of each depth, from one sort."""
    order = np.argsort(depth, kind="stable")
    return np.split(order, np.searchsorted(depth[order], np.arange(1, int(depth.max()) + 1)))


def features(pages: list[Page]) -> Nodes:
    size = np.array([len(p.tag) for p in pages])
    first = np.concatenate(([0], np.cumsum(size)))
    parent = np.concatenate([np.array(p.parent) + f for p, f in zip(pages, first, strict=False)])
    depth = np.concatenate([np.array(p.depth) for p in pages])
    tag = np.concatenate([np.array(p.tag) for p in pages])
    own = np.concatenate([np.array(p.own, float) for p in pages])
    stems = np.concatenate([np.array(p.stems, np.int64) for p in pages])
    n = len(tag)
    levels = by_depth(depth)
    whole = np.column_stack((own, np.ones(n)))
    around, tags_around = stems.copy(), np.where(tag >= 0, np.left_shift(1, np.maximum(tag, 0)), 0)
    for level in levels[1:]:
        around[level] |= around[parent[level]]
        tags_around[level] |= tags_around[parent[level]]
    for level in reversed(levels[1:]):
        np.add.at(whole, parent[level], whole[level])
    inner = np.flatnonzero(depth > 0)
    brothers = np.bincount(parent[inner], minlength=n)
    longest = np.zeros(n)
    np.maximum.at(longest, parent[inner], whole[inner, 0])
    alike = np.zeros(n)
    key = parent[inner] * 64 + tag[inner]
    _, where, times = np.unique(key, return_inverse=True, return_counts=True)
    alike[inner] = times[where]
    order = np.zeros(n)
    by_parent = inner[np.argsort(parent[inner], kind="stable")]
    start = np.flatnonzero(np.diff(parent[by_parent], prepend=-1))
    order[by_parent] = np.arange(len(by_parent)) - np.repeat(start, np.diff(np.append(start, len(by_parent))))
    total = whole[np.repeat(first[:-1], size), 0]
    ratio = lambda a, b: a / np.maximum(b, 1)
    columns = [
        depth, np.log1p(own[:, 0]), np.log1p(whole[:, 0]), ratio(whole[:, 2], whole[:, 0]), ratio(own[:, 2], own[:, 0]),
        ratio(whole[:, 0], whole[:, 6] + whole[:, 5]), ratio(whole[:, 1], whole[:, 6]), ratio(whole[:, 3], whole[:, 1]),
        np.log1p(whole[:, 4]), np.log1p(whole[:, 6]), brothers, brothers[parent], alike, ratio(order, brothers[parent]),
        ratio(whole[:, 0], whole[parent, 0]), ratio(whole[:, 0], longest[parent]), ratio(whole[:, 0], total),
        ratio(whole[parent, 2], whole[parent, 0]), np.log1p(whole[parent, 0]),
    ]
    columns += [tag == k for k in range(len(TAGS))]
    columns += [tags_around[parent] >> k & 1 for k in range(len(TAGS))]
    columns += [stems >> k & 1 for k in range(LATE)]
    columns += [around[parent] >> k & 1 for k in range(LATE)]
    return Nodes(parent, depth, own, np.column_stack(columns).astype(np.float32), first)


def decode(nodes: Nodes, logit: np.ndarray) -> np.ndarray:
    """Which blocks are kept: the set with the largest sum of log-probabilities in which no kept block is inside a
    dropped one. A block counts by the letters it holds itself."""
    mass = 0.1 + np.sqrt(nodes.own[:, 0])
    keep = -np.logaddexp(0, -logit) * mass
    drop = -np.logaddexp(0, logit) * mass
    levels = by_depth(nodes.depth)
    for level in reversed(levels[1:]):
        np.add.at(keep, nodes.parent[level], np.maximum(keep[level], drop[level]))
        np.add.at(drop, nodes.parent[level], drop[level])
    kept = np.ones(len(logit), bool)
    for level in levels[1:]:
        kept[level] = kept[nodes.parent[level]] & (keep[level] >= drop[level])
    return kept


def joined(page: Page, kept: np.ndarray) -> str:
    return " ".join("".join(part if block >= 0 else " " for block, part in page.text if block < 0 or kept[block]).split())


def extract(sources: list[str | None], model: trees.Trees) -> list[str]:
    pages = [read(s) for s in sources]
    nodes = features(pages)
    kept = decode(nodes, model.logit(nodes.features))
    return [joined(p, kept[a:b]) for p, a, b in zip(pages, nodes.first[:-1], nodes.first[1:], strict=True)]


# Training pages: parts of made layouts carry the mark ``data-k``; it is 1 for article text and 0 for the rest.
_MARK = re.compile(r' data-k="([01])"')
ARTICLE = "article|main|section|div|div class=article-body|div class=content|div id=main-content|div class=post-content|div class=entry|div class=story-text|div itemprop=articleBody|td class=content|div class=text".split("|")
ASIDE = {
    "menu": "nav|div class=menu|ul class=main-nav|div id=navigation|div class=breadcrumbs|div class=pagination|div class=tags|div class=skip-links",
    "head": "header|div class=header|div id=masthead class=site-header|div class=top-banner",
    "foot": "footer|div class=footer|div id=footer class=legal|div class=copyright",
    "side": "aside|div class=sidebar|div class=side-bar widget|section class=related-posts|div class=recommended|div class=widget-area",
    "note": "div class=cookie-notice|div id=cookie-consent|div class=alert notice|div class=modal popup|section class=banner",
    "advert": "div class=ad|div class=ads|aside class=advert|div id=ad-slot-3|div class=sponsored promo|section class=promo",
    "form": "form|div class=newsletter subscribe|form class=login|div class=search-form|fieldset",
    "talk": "section class=comments|div id=comments|ol class=comment-list|div class=reader-comments|div class=responses|section id=replies",
    "share": "div class=share|div class=social-links|ul class=social",
}
SEMANTIC_OUT = {NUMBER[t] for t in ("nav", "header", "footer", "aside", "form", "button")}


def _open(spec: str, mark: int) -> tuple[str, str]:
    name, *attributes = spec.split(" ", 1)
    written = ""
    if attributes:
        written = " " + re.sub(r"=([^=]*?)(?= \w+=|$)", r'="\1"', attributes[0])
    return f'<{name}{written} data-k="{mark}">', f"</{name}>"


def made_page(rng: random.Random, texts: list[str]) -> str:
    """A page in a random layout with marked parts."""
    def sentence(most: int) -> str:
        words = rng.choice(texts).split()
        a = rng.randrange(len(words))
        return html.escape(" ".join(words[a : a + rng.randint(1, most)]))

    bare = rng.random() < 0.15  # layouts without telling attributes

    def wrap(spec: str, mark: int, inner: str) -> str:
        a, b = _open(spec.split(" ")[0] if bare and not mark else spec, mark)
        return a + inner + b

    def linked(mark: int) -> str:
        return wrap(rng.choice(("li", "div", "span" if mark else "p")), mark, f'<a href="/x">{sentence(4)}</a>')

    def part(kind: str) -> str:
        spec = rng.choice(ASIDE[kind].split("|"))
        if kind in ("menu", "share"):
            inner = wrap("ul", 0, "".join(linked(0) for _ in range(rng.randint(2, 9))))
        elif kind == "form":
            inner = f'{wrap("label", 0, sentence(5))}<input name="q">{wrap("button", 0, sentence(2))}'
            if rng.random() < 0.5:
                inner = wrap("p", 0, sentence(14)) + inner
        elif kind == "talk":
            inner = wrap("h3", 0, sentence(3)) + "".join(
                wrap("div class=comment" if rng.random() < 0.7 else "li", 0, wrap("p", 0, sentence(40))) for _ in range(rng.randint(1, 6))
            )
        elif kind == "side" and rng.random() < 0.6:
            inner = wrap("h3", 0, sentence(4)) + "".join(linked(0) if rng.random() < 0.6 else wrap("p", 0, sentence(30)) for _ in range(rng.randint(1, 6)))
        else:
            inner = "".join(wrap(rng.choice(("p", "div")), 0, sentence(25)) for _ in range(rng.randint(1, 3))) if rng.random() < 0.5 else sentence(25)
        return wrap(spec, 0, inner)

    def paragraph() -> str:
        body = sentence(rng.choice((3, 20, 80, 200)))
        if rng.random() < 0.3:
            body += f' <a href="/y">{sentence(3)}</a> <b>{sentence(3)}</b> {sentence(30)}<br>{sentence(10)}'
        return body

    def blocks() -> str:
        out = [wrap("h1", 1, sentence(12))] if rng.random() < 0.7 else []
        for _ in range(rng.choice((0, 1, 2, 4, 8, 14))):
            kind = rng.random()
            if kind < 0.72:
                out.append(wrap(rng.choice(("p", "p", "p", "div")), 1, paragraph()))
            elif kind < 0.78:
                out.append(wrap(rng.choice(("h2", "h3")), 1, sentence(7)))
            elif kind < 0.84:
                out.append(wrap(rng.choice(("ul", "ol")), 1, "".join(wrap("li", 1, sentence(15)) for _ in range(rng.randint(1, 5)))))
            elif kind < 0.88:
                out.append(wrap(rng.choice(("blockquote", "pre", "figure")), 1, sentence(25)))
            elif kind < 0.91:
                out.append(wrap("table", 1, wrap("tr", 1, wrap("td", 1, sentence(5)) + wrap("td", 1, sentence(5)))))
            else:
                out.append(part(rng.choice(("advert", "share", "side", "form", "note"))))
        return "".join(out)

    content = wrap(rng.choice(ARTICLE), 1, blocks())
    if rng.random() < 0.3:
        content = wrap(rng.choice(("div class=wrapper", "main", "div id=page", "section")), 1, content + (part("talk") if rng.random() < 0.5 else ""))
    before = [part(k) for k in ("head", "menu", "note", "advert") if rng.random() < 0.6]
    after = [part(k) for k in ("share", "talk", "side", "advert", "form", "menu", "foot") if rng.random() < 0.5]
    rng.shuffle(before)
    if rng.random() < 0.3 and after:
        before.append(after.pop(0))
    body = "".join((*before, content, *after))
    for _ in range(rng.randint(0, 2)):
        body = wrap(rng.choice(("div class=container", "div", "div id=wrap")), 1, body)
    return f"<html><body>{body}</body></html>"


def labelled(source: str) -> tuple[Page, np.ndarray]:
    """A made page and the labels of its blocks."""
    marks = [1, 1, 1]
    names = re.finditer(r"<([a-z0-9]+)[^>]*?( data-k=\"([01])\")?>", source)
    marks += [int(m.group(3)) for m in names if m.group(3) and m.group(1) in NUMBER]
    page = read(_MARK.sub("", source))
    return page, np.array(marks, float)


def by_layout(page: Page) -> np.ndarray | None:
    """Labels of a page whose article is marked by a semantic element, else nothing."""
    core = {NUMBER["article"], NUMBER["main"]}
    if not core & set(page.tag):
        return None
    inside = [False] * len(page.tag)
    for k in range(1, len(page.tag)):
        if page.tag[k] in SEMANTIC_OUT or page.stems[k] >> len(STEMS) & 1:
            continue
        inside[k] = inside[page.parent[k]] or page.tag[k] in core
    label = np.array(inside, float)
    for k in range(len(page.tag) - 1, 0, -1):  # what holds an article is kept, too
        label[page.parent[k]] = max(label[page.parent[k]], label[k])
    label[0] = 1
    return label


def fit(pages: DataFrame, column: str = "html", at_most: int = SAMPLE, layouts: int = LAYOUTS, most_letters: int = 20_000) -> trees.Trees:
    """Learn from at most ``at_most`` pages of up to ``most_letters`` letters, chosen by hash, and ``layouts`` made pages."""
    short = pages.where(F.col(column).isNotNull() & (F.char_length(column) <= most_letters)).select(
        F.col(column).alias("page"), F.xxhash64(column).alias("h")
    )
    # hashes first, so that tasks send numbers and not pages to the driver
    chosen = [r.h for r in short.select("h").distinct().orderBy("h").limit(at_most).collect()]
    rows = short.where(F.col("h").isin(chosen)).groupBy("h").agg(F.min("page").alias("page")).orderBy("h").collect() if chosen else []
    rng = random.Random(7)
    read_, labels, texts = [], [], []
    for row in rows:
        page = read(row.page)
        texts += [t for _, t in page.text if len(t.split()) > 2]
        label = by_layout(page)
        if label is not None:
            read_.append(page)
            labels.append(label)
    texts = texts or ["one two three four five six seven eight nine ten"]
    for _ in range(layouts):
        page, label = labelled(made_page(rng, texts))
        if len(label) == len(page.tag):
            read_.append(page)
            labels.append(label)
    nodes = features(read_)
    y = np.concatenate(labels)
    return trees.fit(nodes.features, y, 0.3 + np.log1p(nodes.own[:, 0]) / 5)


def main_text(pages: DataFrame, model: trees.Trees, column: str = "html") -> DataFrame:
    """``pages`` without its source, with ``text`` and ``n_chars`` (code points)."""
    kept = [f for f in pages.schema.fields if f.name not in ("text", "n_chars", column)]
    schema = T.StructType([*kept, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, column, RUN):
            texts = extract(batch.column(column).to_pylist(), model)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(f.name) for f in kept], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=schema.names,
            )

    return pages.mapInArrow(run, schema)
