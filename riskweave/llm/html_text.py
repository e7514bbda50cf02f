"""Main text of web pages by the ratios of tag paths.

A page is cut into blocks of text, each at the end of a path of block elements from the root. Per path, the length of
the text, its punctuation and its share outside links are summed up and divided by the blocks there. Both ratios are
smoothed over neighbouring blocks in page order and fused; blocks over a threshold are the core. A marked article that
holds nearly all of the core's text is the article, else the smallest container of all core blocks. Its blocks are the main text, short ones too, but
for parts that say themselves what they are (menus, forms, adverts, comments and the like).
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.scratch import small_batches

TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']+|"[^"]*"|'[^']*'|["'])*)>?""", re.S)
NAMES = re.compile(r"""\b(class|id|role|hidden)\b\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
WORDS = re.compile(r"[a-z]+")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var".split())
#: Skipped up to their end tag, whatever they hold.
RAW = frozenset("script style title textarea noscript iframe template xmp noframes svg".split())
ASIDE = frozenset("nav footer aside form menu dialog button head fieldset legend option input select".split())
#: Words in class, id or role that name a part beside the article, and words that do so at times.
PARTS = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs sidebar aside ad ads advert adverts advertisement sponsor sponsored banner "
    "cookie cookies consent notice notices popup modal overlay comment comments respond disqus newsletter "
    "footer masthead topbar toolbar widget login signup pagination pager skip complementary contentinfo".split())
MAYBE = frozenset("promo promotion share sharing social related recommended subscribe subscription search copyright legal".split())
#: How far a block is set aside, and what its ratio then counts for; hidden blocks never count.
FREE, NAMED, SET_ASIDE, HIDDEN = 0, 1, 2, 3
WEIGHT = {FREE: 1.0, NAMED: 0.3, SET_ASIDE: 0.01}
#: Elements that carry text of the element around them.
TEXT_TAGS = frozenset(
    "p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption blockquote pre figure figcaption address hr details summary".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: An element opened closes these before it.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "body": {"head"},
          "thead": {"tr", "td", "th"}, "tbody": {"tr", "td", "th", "thead"}, "tfoot": {"tr", "td", "th", "tbody"}}
#: What implied end tags don't reach beyond.
SCOPE = frozenset("table ul ol dl article section div main body html blockquote".split())
PUNCTUATION = re.compile(r"[.,;:!?…。、，；：！？]")
#: Share of the usual fused ratio of prose that makes a block core, and of the core's text that a marked article holds.
CORE_SHARE, HELD_SHARE = 0.2, 0.9


@dataclass
class Block:
    path: int  # number of the tag path, equal for equal paths
    element: int  # number of the element it ends in, 0 for the page
    text: str
    linked: int
    aside: int


@dataclass
class Element:
    """An open element: tag, number, path, how far it or one around it is set aside, and whether one is an article."""

    tag: str
    number: int
    path: int
    aside: int
    article: bool


def _part_names(attributes: str) -> tuple[str, int]:
    """First class as part of the path, and how far class, id, role or hidden set the element aside."""
    label, aside = "", FREE
    for name, *values in NAMES.findall(attributes):
        name, value = name.lower(), next(filter(None, values), "")
        if name == "hidden":
            aside = HIDDEN
            continue
        words = WORDS.findall(value.lower())
        aside = max(aside, SET_ASIDE if not PARTS.isdisjoint(words) else NAMED if not MAYBE.isdisjoint(words) else FREE)
        if name == "class" and value.split():
            label = value.split()[0]
    return label, aside


def blocks(page: str) -> tuple[list[Block], list[int], list[int], list[str]]:
    """Blocks of text in page order, and for every element its parent, the outermost article around it (0: none) and its tag.

    Script, style, markup and comments are gone, references decoded.
    """
    stack = [Element("", 0, 0, FREE, False)]
    parents, articles, tags = [0], [0], [""]
    paths: dict[tuple[int, str], int] = {}
    opened: dict[str, int] = {}
    found: list[Block] = []
    held: list[str] = []
    linked, links, at = 0, 0, 0

    def close_block() -> None:
        nonlocal held, linked
        if held:
            text = " ".join(html.unescape("".join(held)).split())
            if text:
                found.append(Block(stack[-1].path, stack[-1].number, text, min(linked, len(text)), stack[-1].aside))
        held, linked = [], 0

    def add(text: str) -> None:
        nonlocal linked
        held.append(text)
        if links:
            linked += len(text)

    def close(depth: int) -> None:
        for element in stack[depth:]:
            opened[element.tag] -= 1
        del stack[depth:]

    while at < len(page):
        tag = TAG.search(page, at)
        if not tag:
            add(page[at:])
            break
        if tag.start() > at:
            add(page[at: tag.start()])
        at = tag.end()
        closing, name = tag.group(1), (tag.group(2) or "").lower()
        if not name:
            if tag.group().startswith("<![CDATA["):
                add(html.escape(tag.group()[9:].removesuffix("]]>"), quote=False))
            continue
        if name in RAW:
            if not closing:
                end = re.compile(rf"</{re.escape(name)}\b[^>]*>?", re.I).search(page, at)
                at = end.end() if end else len(page)
            continue
        if name in INLINE:
            if name == "a":
                links = 0 if closing else 1
            continue
        close_block()
        if name in VOID:
            continue
        if closing:
            if opened.get(name):
                close(next(d for d in range(len(stack) - 1, 0, -1) if stack[d].tag == name))
            links = 0
            continue
        if stack[-1].tag == "p":
            close(len(stack) - 1)
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].tag in CLOSES.get(name, ()):
                close(depth)
            elif stack[depth].tag in SCOPE:
                break
        around = stack[-1]
        label, aside = _part_names(tag.group(3)) if tag.group(3).strip() else ("", FREE)
        article = name in ("article", "main")
        if aside != HIDDEN and (article or name in ("html", "body")):
            aside = FREE
        if name in ASIDE or name == "header" and not around.article:
            aside = max(aside, SET_ASIDE)
        path = paths.setdefault((around.path, f"{name}.{label}"), len(paths) + 1)
        parents.append(around.number)
        tags.append(name)
        articles.append(articles[around.number] or (len(parents) - 1 if article else 0))
        opened[name] = opened.get(name, 0) + 1
        stack.append(Element(name, len(parents) - 1, path, max(around.aside, aside), around.article or article))
    close_block()
    return found, parents, articles, tags


def path_ratios(own: list[Block]) -> np.ndarray:
    """Per block the text length of its tag path a block, smoothed over neighbours and fused with that of punctuation."""
    sums: dict[int, list[float]] = {}
    for block in own:
        total = sums.setdefault(block.path, [0.0, 0.0, 0.0])
        total[0] += len(block.text) - block.linked
        total[1] += len(PUNCTUATION.findall(block.text)) * (1 - block.linked / len(block.text))
        total[2] += 1
    ratios = np.array([[sums[b.path][0] / sums[b.path][2], sums[b.path][1] / sums[b.path][2]] for b in own])
    padded = np.pad(ratios, ((1, 1), (0, 0)), mode="edge")
    smooth = (padded[:-2] + 2 * padded[1:-1] + padded[2:]) / 4
    fused, alone = (r[:, 0] * (1 + r[:, 1]) for r in (smooth, ratios))
    # neighbours lend nothing to a part that its name sets aside
    return np.where([b.aside > FREE for b in own], np.minimum(fused, alone), fused)


def _prose(block: Block) -> bool:
    return 2 * block.linked < len(block.text) and PUNCTUATION.search(block.text) is not None


def _replies(own: list[Block], core: list[bool], fused: np.ndarray, parents: list[int], tags: list[str]) -> set[int]:
    """Containers that look like readers' comments: two or more of one kind side by side, without a heading, behind
    everything else that is core, each with a small part of the ratio that the largest container has."""
    holder = list(range(len(parents)))
    for element in range(1, len(parents)):
        if tags[element] in TEXT_TAGS:
            holder[element] = holder[parents[element]]
    values: dict[int, float] = {}
    kinds: dict[tuple[int, int], set[int]] = {}
    headed = {holder[b.element] for b in own if tags[b.element] in HEADINGS}
    for block, value in zip(own, fused):
        values[holder[block.element]] = values.get(holder[block.element], 0.0) + value
        if _prose(block):  # equal paths inside equal parents are of one kind
            kinds.setdefault((parents[holder[block.element]], block.path), set()).add(holder[block.element])
    most = max(values.values(), default=0.0)
    suspects = {c for group in kinds.values() if len(group) > 1 for c in group if values[c] < CORE_SHARE * most and c not in headed}
    behind: set[int] = set()
    for block, high in zip(reversed(own), reversed(core)):
        if high and holder[block.element] not in suspects:
            break
        if holder[block.element] in suspects:
            behind.add(holder[block.element])
    return {e for e in range(len(parents)) if holder[e] in behind}


def main_text(page: str | None) -> str:
    """The article's blocks joined by one space; empty for null and for pages without one.

    What a page calls its parts only weighs the ratios: a part whose name sets it aside needs far more text to be core.
    """
    found, parents, articles, tags = blocks(page or "")
    own = [b for b in found if b.aside < HIDDEN]
    if not own:
        return ""
    fused = path_ratios(own) * [WEIGHT[b.aside] for b in own]
    # the median of prose, so that one long block doesn't hide the others; what stands aside weighs as little here
    prose = sorted((f, WEIGHT[b.aside]) for b, f in zip(own, fused) if _prose(b))
    if fused.max() <= 0:
        return ""
    if prose:
        values, weights = np.array(prose).T
        usual = values[np.searchsorted(np.cumsum(weights), weights.sum() / 2)]
    else:
        usual = fused.max()
    core = [f > 0 and f >= CORE_SHARE * usual and (b.aside < SET_ASIDE or _prose(b)) for b, f in zip(own, fused)]
    replies = _replies(own, core, fused, parents, tags)
    core = [high and b.element not in replies for b, high in zip(own, core)]
    held = [0] * len(parents)
    for block, high in zip(own, core):
        held[block.element] += len(block.text) * high
    for element in range(len(parents) - 1, 0, -1):  # children have higher numbers than their parents
        held[parents[element]] += held[element]
    if not held[0]:
        return ""
    leaves = {b.element for b in own}
    # a marked article with most of the core bounds the text; else the deepest element with all of the core: going down,
    # at most one child has it. A paragraph alone is no container, its parent holds it with its headings
    article = next((e for e in range(1, len(parents)) if articles[e] == e and held[e] >= HELD_SHARE * held[0]), 0)
    if not article:
        for element in range(1, len(parents)):
            if parents[element] == article and held[element] == held[0] and element not in leaves:
                article = element
        article = articles[article] or article
    inside = [article == 0] * len(parents)
    for element in range(1, len(parents)):
        inside[element] = element == article or inside[parents[element]]
    # short blocks of the article stay with it, unless their part is named as one beside it or reads like comments
    level = min(b.aside for b, high in zip(own, core) if high)
    return " ".join(b.text for b, high in zip(own, core) if inside[b.element] and (high or b.aside <= level and b.element not in replies))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars (code points) per row of ``pages`` (page_id, url, html).

    Null, empty and textless pages have an empty text. Whole pages are read, of any length; broken markup is read as
    browsers do as far as blocks are concerned. Rows are independent, so repeated rows, null ids and empty tables
    pass through; other columns are ignored.
    """
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = [main_text(page) for page in frame["html"]]
            yield pd.DataFrame({"page_id": frame["page_id"], "url": frame["url"], "text": texts, "n_chars": [len(t) for t in texts]})

    return small_batches(pages).select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")).mapInPandas(
        run, "page_id long, url string, text string, n_chars long")
