"""Main text of web pages by tag-path ratios.

A page becomes blocks of text in page order, each with its root-to-leaf path of block-level tags and
class names. Text length and punctuation are summed per path and divided by the path's blocks; the two
ratios, read in page order, are smoothed by a Gaussian, fused into one score, damped by the share of
link text and raised in <article> and <main> by the share of the page's text that the outermost one holds. Paths
whose mean score passes a threshold set by the page's own spread and its best path are content. What lies
in the content's container and isn't furniture goes with it: a short paragraph or a heading has the
same container as the long ones. So does what comes before the content's end in the <article> or <main> around it.

Furniture is what the page itself names so: tags (nav, header, footer, aside ...), roles, forms, and class or id words
(ad, cookie, sidebar, comments ...; an <article> by words of comments only). It is scored like all
text, its score times DAMPED, so that the threshold decides; text with such a name is never added for its container
alone, and a page of nothing else has no main text. A <header> in an <article> or <main> is no furniture, as it
holds the title; nor is a form, or an element named by a word, that has elements of text and most of the
page's text (of comments: nearly all). Not read at all is what no text is: scripts, styles, hidden elements, form controls, graphics.

Cases: null and empty html, and pages without text, give an empty text; unclosed, stray and unknown tags,
and tags cut off by the end, are read as browsers do, roughly; one pass over a page takes time in
proportion to its length, whatever its depth; repeated rows give repeated results; an empty table gives
an empty result; further columns are ignored.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from claimweave.llm.common import map_batches

# Tag names of HTML by their role.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr br".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title noembed noframes xmp".split())
UNREAD = frozenset(
    "button select option fieldset datalist svg math canvas object audio video applet map head frameset".split()
)
FURNITURE = frozenset("nav header footer aside menu dialog".split())
FURNITURE_ROLES = frozenset(
    "navigation banner contentinfo complementary search alert alertdialog dialog menu menubar toolbar".split()
)
FURNITURE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo promos promotion banner "
    "banners cookie cookies consent gdpr notice notices sidebar sidebars sidenav menu menus nav navbar navigation "
    "breadcrumb breadcrumbs footer footers header masthead topbar comment comments commentlist respond discussion "
    "disqus replies share sharing social related recommended newsletter subscribe subscription signup login popup "
    "modal overlay widget widgets toolbar pagination pager copyright disclaimer outbrain taboola alert".split()
)
COMMENT_WORDS = frozenset("comment comments commentlist respond discussion disqus replies".split())
#: What the score of named furniture is multiplied by, and the share of the best path's score that content has.
DAMPED, LEAST = 0.01, 0.1
#: A start tag of the key ends an open element of these names.
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
    "th": ("td", "th"), "option": ("option",),
}
#: Elements that an implied end does not reach beyond.
HOLDERS = frozenset("html body table ul ol dl article main section div td th".split())
CLOSABLE = frozenset(["p", *(tag for closed in CLOSES.values() for tag in closed)])

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^\"'>]|\"[^\"]*\"|'[^']*')*+)>?|<[!?][^>]*>?", re.DOTALL
)
_ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_WORD = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]*")
_PUNCTUATION = re.compile(r"[.,;:!?。，、！？…]")
_HEADING = re.compile(r"h[1-6]\Z")


@dataclass
class Block:
    text: str
    path: int
    linked: int
    article: int  # number of the innermost <article> or <main>, 0 for none
    named: int  # number of the innermost element that a name makes furniture, 0 for none
    deep: bool  # whether the text lies in an element within that one
    furniture: bool  # whether it lies in a tag or role of furniture
    damped: bool = False  # whether it counts as furniture, by tag, role or name


@dataclass
class _Open:
    tag: str
    path: int
    unread: bool
    furniture: bool
    linked: bool
    article: int
    named: int
    names: bool = False
    block: _Open | None = None  # the innermost open element that is none of a line, or this one
    reach: frozenset[str] = frozenset()  # open tags that an implied end reaches


@dataclass
class Page:
    """Blocks of a page, its paths as (parent, label), and the parents of its articles and named elements, by number."""

    blocks: list[Block] = field(default_factory=list)
    paths: list[tuple[int, str]] = field(default_factory=lambda: [(-1, "")])
    articles: list[int] = field(default_factory=lambda: [0])
    named: list[int] = field(default_factory=lambda: [0])
    discussions: list[bool] = field(default_factory=lambda: [False])  # which named elements have a word of comments


def _attributes(raw: str) -> dict[str, str]:
    return {k.lower(): (v or "").strip("\"'") for k, v in _ATTRIBUTE.findall(raw)} if raw.strip(" /") else {}


def _is_unread(tag: str, attributes: dict[str, str]) -> bool:
    """Whether an element holds no text of the page: graphics, form controls, hidden ones."""
    if tag in UNREAD:
        return True
    if not attributes or tag in ("html", "body", "article", "main"):
        return False
    if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true":
        return True
    return bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attributes.get("style", ""), re.I))


def _is_furniture(tag: str, attributes: dict[str, str], article: int) -> bool:
    """Whether a tag or role makes an element furniture; `article` is the number of the <article> or <main> around it."""
    if tag in FURNITURE:
        return not (tag == "header" and article)
    return tag not in ("html", "body", "article", "main") and attributes.get("role", "").lower() in FURNITURE_ROLES


def _is_named(tag: str, attributes: dict[str, str]) -> bool:
    """Whether an element is furniture by a word, or as a form, unless it holds most of the page's text."""
    if tag == "form" or attributes.get("role", "").lower() == "form":
        return True
    if not attributes or tag in ("html", "body", "main"):
        return False
    return not _words(attributes).isdisjoint(COMMENT_WORDS if tag == "article" else FURNITURE_WORDS)


def _words(attributes: dict[str, str]) -> set[str]:
    return {w.lower() for w in _WORD.findall(f"{attributes.get('class', '')} {attributes.get('id', '')}")}


def _damp(page: Page) -> None:
    """Mark the blocks of furniture: those of its tags and roles, and those in a named element.

    A named element that has elements of text and most of the text outside those tags and roles is none; one
    with a word of comments only if it has nearly all of it, as readers may write more than the author.
    Furniture gets paths of its own, as an id makes a name but no path.
    """
    held = [0] * len(page.named)
    deep = [False] * len(page.named)
    for b in page.blocks:
        if not b.furniture:
            held[b.named] += len(b.text)
            deep[b.named] |= b.deep
    total = sum(held)
    for e in range(len(held) - 1, 0, -1):
        held[page.named[e]] += held[e]
        deep[page.named[e]] = True
    gone = [False] * len(held)
    for e in range(1, len(held)):
        outside = (total - held[e]) * (50 if page.discussions[e] else 1)
        gone[e] = gone[page.named[e]] or not (deep[e] and held[e] > outside)
    own: dict[int, int] = {}
    for b in page.blocks:
        b.damped = b.furniture or gone[b.named]
        if b.damped:
            if b.path not in own:
                own[b.path] = len(page.paths)
                page.paths.append(page.paths[b.path])
            b.path = own[b.path]


def read_page(source: str) -> Page:
    """Blocks of text, furniture included."""
    page = Page()
    known: dict[tuple[int, str], int] = {}
    stack = [_Open("", 0, False, False, False, 0, 0)]
    stack[0].block = stack[0]
    count: Counter[str] = Counter()
    pieces: list[str] = []
    linked = 0
    at = 0
    end = len(source)

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                block = stack[-1].block
                deep = block.named > 0 and not block.names
                page.blocks.append(Block(text, block.path, linked, block.article, block.named, deep, block.furniture))
            pieces.clear()
        linked = 0

    def add(raw: str) -> None:
        nonlocal linked
        top = stack[-1]
        if raw and not top.unread:
            text = html.unescape(raw) if "&" in raw else raw
            pieces.append(text)
            if top.linked:
                linked += len(text.strip())

    def close(tag: str) -> None:
        if tag not in INLINE:
            flush()
        while True:
            element = stack.pop()
            count[element.tag] -= 1
            if element.tag not in INLINE and element.tag != tag:
                flush()
            if element.tag == tag:
                return

    while at < end:
        found = _TAG.search(source, at)
        if not found:
            add(source[at:])
            break
        add(source[at : found.start()])
        at = found.end()
        tag = (found[2] or "").lower()
        if not tag:
            continue
        if found[1]:
            if count[tag] > 0:
                close(tag)
            elif tag == "p":
                flush()
            continue
        if tag in RAW:
            stop = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)", re.I).search(source, at)
            at = source.find(">", stop.start()) + 1 if stop else end
            at = at or end
            continue
        if tag == "br":
            pieces.append(" ")
            continue
        if tag not in INLINE:
            flush()
            for ends in CLOSES.get(tag, ()):
                if ends in stack[-1].reach:
                    close(ends)
            if "p" in stack[-1].reach:
                close("p")
        if tag in VOID:
            continue
        top = stack[-1]
        attributes = _attributes(found[3])
        path = top.path
        if tag not in INLINE:
            label = " ".join([tag, *sorted(re.sub(r"\d+", "", attributes.get("class", "")).split())])
            key = (path, label)
            path = known.get(key, 0)
            if not path:
                path = known[key] = len(page.paths)
                page.paths.append(key)
        article, named, names = top.article, top.named, False
        if tag in ("article", "main"):
            article = len(page.articles)
            page.articles.append(top.article)
        if _is_named(tag, attributes):
            named, names = len(page.named), True
            page.named.append(top.named)
            page.discussions.append(not _words(attributes).isdisjoint(COMMENT_WORDS))
        reach = frozenset() if tag in HOLDERS else top.reach
        if tag in CLOSABLE:
            reach |= {tag}
        element = _Open(
            tag,
            path,
            top.unread or _is_unread(tag, attributes),
            top.furniture or _is_furniture(tag, attributes, top.article),
            top.linked or tag == "a",
            article,
            named,
            names,
            top.block,
            reach,
        )
        if tag not in INLINE:
            element.block = element
        stack.append(element)
        count[tag] += 1
    flush()
    return page


def _smoothed(values: list[float], sigma: float = 1.0) -> list[float]:
    """Gaussian mean over the two values on either side."""
    weights = [math.exp(-(d * d) / (2 * sigma * sigma)) for d in range(-2, 3)]
    out = []
    for i in range(len(values)):
        total = weight = 0.0
        for d, w in zip(range(-2, 3), weights, strict=True):
            if 0 <= i + d < len(values):
                total += w * values[i + d]
                weight += w
        out.append(total / weight)
    return out


def _outermost(page: Page) -> list[int]:
    """For every <article> or <main> the outermost one around it, which may be itself."""
    outer = [0] * len(page.articles)
    for a in range(1, len(outer)):
        outer[a] = outer[page.articles[a]] or a
    return outer


def content_paths(page: Page, blocks: list[Block], strictness: float = 0.5) -> set[int]:
    """Paths whose fused ratio passes the threshold."""
    n: Counter[int] = Counter()
    chars: Counter[int] = Counter()
    marks: Counter[int] = Counter()
    links: Counter[int] = Counter()
    for b in blocks:
        n[b.path] += 1
        chars[b.path] += len(b.text)
        marks[b.path] += len(_PUNCTUATION.findall(b.text))
        links[b.path] += b.linked
    lengths = _smoothed([chars[b.path] / n[b.path] for b in blocks])
    stops = _smoothed([marks[b.path] / n[b.path] for b in blocks])
    outer = _outermost(page)
    held: Counter[int] = Counter()
    for b in blocks:
        if not b.damped:
            held[outer[b.article]] += len(b.text)
    total = sum(held.values())
    held[0] = 0
    score: Counter[int] = Counter()
    for b, length, stop in zip(blocks, lengths, stops, strict=True):
        share = min(1.0, links[b.path] / max(1, chars[b.path]))
        known = DAMPED if b.damped else 1 + held[outer[b.article]] / total
        score[b.path] += known * math.sqrt(length * (stop + 0.1)) * (1 - share) / n[b.path]
    mean = sum(score[b.path] for b in blocks) / len(blocks)
    spread = math.sqrt(sum((score[b.path] - mean) ** 2 for b in blocks) / len(blocks))
    best = max(score.values())
    threshold = min(best, max(strictness * mean, mean - spread, LEAST * best))
    return {p for p in score if score[p] >= threshold and links[p] < 0.5 * chars[p]}


def _container(page: Page, weight: Counter[int]) -> tuple[int, list[bool]]:
    """The deepest path above nine tenths of the chosen text, and for every path whether it lies inside.

    Paths are numbered parents first, so one pass up and one pass down the numbers suffice.
    """
    total = sum(weight.values())
    above = [0] * len(page.paths)
    depth = [0] * len(page.paths)
    for p in range(len(page.paths) - 1, 0, -1):
        above[page.paths[p][0]] += above[p] + weight[p]
    for p in range(1, len(page.paths)):
        depth[p] = depth[page.paths[p][0]] + 1
    holder = max((p for p in range(len(above)) if above[p] * 10 >= total * 9), key=depth.__getitem__, default=0)
    inside = [False] * len(page.paths)
    for p in range(len(page.paths)):
        inside[p] = p == holder or (p > 0 and inside[page.paths[p][0]])
    return holder, inside


def main_text(source: str | None) -> str:
    """The article's text, blocks joined by one space; empty if there is none."""
    page = read_page(source or "")
    _damp(page)
    blocks = page.blocks
    if all(b.damped for b in blocks):
        return ""
    chosen = content_paths(page, blocks)
    if not chosen:
        return ""
    weight: Counter[int] = Counter()
    for b in blocks:
        if b.path in chosen:
            weight[b.path] += len(b.text)
    holder, inside = _container(page, weight)
    links: Counter[int] = Counter()
    chars: Counter[int] = Counter()
    for b in blocks:
        links[b.path] += b.linked
        chars[b.path] += len(b.text)
    narrow = page.paths[holder][1].split(" ")[0] not in ("", "html", "body")
    first = min(i for i, b in enumerate(blocks) if b.path in chosen)
    last = max(i for i, b in enumerate(blocks) if b.path in chosen)
    # The articles that hold chosen text, and those around them.
    around = {0}
    for b in blocks:
        at = b.article if b.path in chosen else 0
        while at not in around:
            around.add(at)
            at = page.articles[at]

    def belongs(i: int, b: Block) -> bool:
        if b.path in chosen:
            return True
        if b.damped or 2 * links[b.path] > chars[b.path]:
            return False
        if not inside[b.path]:
            return b.article > 0 and b.article in around and i < last
        heading = bool(_HEADING.match(page.paths[b.path][1].split(" ")[0]))
        return narrow or first <= i <= last or heading

    return " ".join(b.text for i, b in enumerate(blocks) if belongs(i, b))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""

    def make():
        def apply(rows):
            texts = [main_text(h) for h in rows["html"]]
            return {"page_id": rows["page_id"], "url": rows["url"], "text": texts, "n_chars": list(map(len, texts))}

        return apply

    kind = pages.schema["page_id"].dataType.simpleString()
    return map_batches(
        pages.select("page_id", "url", "html"), make, f"page_id {kind}, url string, text string, n_chars long", rows=64
    )
