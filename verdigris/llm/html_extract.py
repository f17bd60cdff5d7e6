"""Main text of HTML pages by scoring the element tree.

Text is gathered in blocks. Each block passes points, one plus its commas plus a point for
each hundred characters up to three, to its container in full, to the next ancestor by half,
to the one above by a sixth and on upwards by two thirds of the step below, so that one pass
from the leaves to the root scores all elements. Points are discounted by link density, the share of a container's
characters inside links. The best container is kept, widened to the article element around
it if there is one, together with siblings that score near it or look like paragraphs.

Menus, page headers, footers, sidebars, notices, adverts, forms and reader comments are
left out by element, role, class or id before any scoring; scripts, styles and comments are
never text. A class or id has to name such a part as a whole (``comments``,
``cookie-notice``, ``share-buttons``): names made of headings (``search-algorithms``,
``football-report``) only begin like one. A form outside any article that holds an article,
or most of the page's text with a paragraph of 80 characters, is a page's frame and no form.

Time and memory are linear in the page, however elements nest and whatever is left open.

Defined cases: null or empty HTML gives an empty text; unclosed and misnested elements are
closed where their block ends; an unclosed script or comment runs to the end of the page;
a page without elements is one block of text.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from verdigris.llm.common import without

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s "
    "samp small span strike strong sub sup time tt u var wbr br "
    "math semantics mrow mi mn mo ms mtext mspace mfrac msqrt mroot mstyle merror mpadded mphantom msub msup msubsup "
    "munder mover munderover mmultiscripts mprescripts mtable mtr mtd menclose maction annotation annotation-xml".split()
)
CLOSES_ITSELF = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "option": {"select"}}
LEFT_OUT = frozenset(
    "head nav footer aside button select menu dialog iframe object canvas fieldset annotation annotation-xml".split()
)
LEFT_OUT_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
BONUS = {"article": 25, "main": 15, "div": 5, "section": 3, "td": 3, "blockquote": 3, "pre": 3, "ul": -3, "ol": -3, "dl": -3, "li": -3, "table": 0}

_OPEN = "<(/?)([a-z][^\\s/>]*)"
# A tag that meets no other angle bracket; whatever else starts a tag is measured by ``_Tags``.
_PLAIN_TAG = re.compile(_OPEN + "((?:[^<>\"']++|\"[^\"<>]*+\"|'[^'<>]*+')*+)>", re.I)
_TAG_START = re.compile(_OPEN, re.I)
_SPECIAL = re.compile("[>\"']")
_RAW = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in ("script", "style", "template", "svg", "textarea")}
_TELLING = re.compile("class|id|role|style|hidden", re.I)
_ATTRIBUTE = re.compile("([^\\s\"'<>/=]++)(?:\\s*+=\\s*+(\"[^\"]*\"|'[^']*'|[^\\s\"'>]++))?")
_NOT_SHOWN = re.compile(r"display\s*:\s*none", re.I)
_PART = (
    r"(?:ads?|advert(?:s|isements?|ising)?|adsense|banners?|sponsor(?:s|ed)?|promo(?:s|tions?)?|side-?bar|nav(?:igation)?|"
    r"menus?|breadcrumbs?|footer|header|masthead|cookies?|consent|gdpr|notices?|popup|modal|overlay|shar(?:e|ing)|sharedaddy|"
    r"social|related|recommend(?:ed|ations?)|newsletter|subscribe|login|signup|search|pager|pagination|widgets?|toolbar|"
    r"comments?|respond|replies|disqus|skip-?link)"
)
_AROUND = (
    r"(?:site|page|post|entry|main|article|top|bottom|left|right|inner|outer|mobile|box|bar|block|list|section|container|"
    r"wrap(?:per)?|area|links?|buttons?|icons?|form|thread|posts|articles|content|title|widget|unit|slot|[0-9]+|"
    r"global|primary|secondary|sub|sticky|fixed|floating|desktop|policy|readers?|users?|visitors?|media)"
)
_WHOLE_NAME = re.compile(rf"(?:{_AROUND}[_-]?){{0,3}}{_PART}(?:[_-]?(?:{_PART}|{_AROUND})){{0,4}}")
# Names reader comments on any element but a section, where papers discuss their results.
_DISCUSSION = re.compile(rf"(?:{_AROUND}[_-]?){{0,2}}discussions?(?:[_-]?{_AROUND}){{0,2}}")
_LIKELY_TOKENS = frozenset("article content main post entry story".split())
_COMMAS = re.compile("[,،、，]")
_CONTAINERS_ANYWAY = frozenset("html body article main".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_PARAGRAPHS = frozenset("p pre blockquote td th li dd dt h1 h2 h3 h4 h5 h6 figure caption summary".split())
# Opening a key concerns the open elements of the tags in its value.
_ITEMS_OF = {
    tag: tuple(item for item, lists in CLOSES_ITSELF.items() if tag == item or tag in lists)
    for tag in set(CLOSES_ITSELF).union(*CLOSES_ITSELF.values())
}
FORM_PARAGRAPH = 80  # characters without a link that a form around a page's text holds in one block


class _Node:
    """An open or closed element; ``own`` is the nearest block element, itself included."""

    __slots__ = ("tag", "parent", "kept", "own", "form", "depth", "inline", "first", "direct", "near", "far", "chars", "linked", "mark")

    def __init__(self, tag: str, parent: _Node | None, kept: bool, depth: int):
        self.tag, self.parent, self.kept, self.depth = tag, parent, kept, depth
        self.own: _Node = parent.own if parent is not None and tag in INLINE else self
        self.form: _Form | None = parent.form if parent is not None else None
        self.inline: dict[str, int] | None = None  # open inline elements directly under this block
        self.first = -1  # first block that this node is a container of
        self.direct = self.near = self.far = 0.0
        self.chars = self.linked = 0
        self.mark: object = None

    def final(self) -> float:
        density = self.linked / self.chars if self.chars else 0.0
        return (self.direct + self.near / 2 + self.far + BONUS.get(self.tag, 0)) * (1 - density)


class _Form:
    """What a form outside any article holds: a form around the page's text is no form of the page."""

    __slots__ = ("chars", "longest", "around")

    def __init__(self):
        self.chars, self.longest, self.around = 0, 0, False

    def wraps(self, total: int) -> bool:
        return self.around or (2 * self.chars > total and self.longest >= FORM_PARAGRAPH)


class _Tags:
    """Ends of tags, all of a page in linear time.

    A tag ends at the first ``>`` outside quotes or, where there is none, at the first ``>``.
    Opening quotes from which no end was found are remembered: a later tag that meets one
    fails as well. A position that was looked up serves all later starts before it.
    """

    def __init__(self, html: str):
        self.html, self.dead = html, set()
        self.special = self.closing = -1

    def _special(self, at: int) -> int:
        if self.special < at:
            found = _SPECIAL.search(self.html, at)
            self.special = found.start() if found else len(self.html)
        return self.special

    def first(self, at: int) -> int:
        """The next ``>``, or the length of the page."""
        if self.closing < at:
            found = self.html.find(">", at)
            self.closing = found if found >= 0 else len(self.html)
        return self.closing

    def end(self, at: int) -> int:
        html, met = self.html, []
        here = self._special(at)
        while here < len(html):
            quote = html[here]
            if quote == ">":
                return here
            if here in self.dead:
                break
            met.append(here)
            close = html.find(quote, here + 1)
            if close < 0:
                break
            found = _SPECIAL.search(html, close + 1)
            here = found.start() if found else len(html)
        self.dead.update(met)
        return self.first(at)


def _tokens(html: str) -> Iterator[tuple[str | None, bool, str, str]]:
    """(tag or none, whether it ends, attributes, text before it); the last one has the rest."""
    tags, at, after = _Tags(html), 0, 0
    while True:
        start = html.find("<", after)
        if start < 0:
            break
        plain = _PLAIN_TAG.match(html, start)
        opened = plain or _TAG_START.match(html, start)
        if opened:
            if plain:
                end, attributes = plain.end(), plain[3]
            else:
                close = tags.end(opened.end())
                if close == len(html):
                    break  # no tag ends any more
                end, attributes = close + 1, html[opened.end() : close]
            tag, ends = opened[2].lower(), opened[1] == "/"
            text = html[at:start]
            raw = None if ends or attributes.endswith("/") else _RAW.get(tag)
            if raw:
                found = raw.search(html, end)
                at = after = found.end() if found else len(html)
                yield None, False, "", text
                continue
            yield (None if tag in _RAW else tag), ends, attributes, text
        elif html.startswith("<!--", start):
            close = html.find("-->", start + 4)
            end = close + 3 if close >= 0 else len(html)
            yield None, False, "", html[at:start]
        elif html[start + 1 : start + 2] in ("!", "?", "/") and start + 1 < len(html):
            close = tags.first(start)
            if close == len(html):
                break
            end = close + 1
            yield None, False, "", html[at:start]
        else:
            after = start + 1
            continue
        at = after = end
    yield None, False, "", html[at:]


def _names_other_part(value: str, tag: str) -> bool:
    """Whether a class or id names, as a whole, a part that is not main text."""
    return any(_WHOLE_NAME.fullmatch(name) or (tag != "section" and _DISCUSSION.fullmatch(name)) for name in value.split())


def _left_out(tag: str, attributes: str, inside_article: bool) -> bool:
    if tag in LEFT_OUT or (tag in ("header", "noscript") and not inside_article):
        return True
    if tag in _CONTAINERS_ANYWAY or not _TELLING.search(attributes):
        return False
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or (name == "style" and _NOT_SHOWN.search(value)):
            return True
        if (name == "role" and value in LEFT_OUT_ROLES) or (name == "aria-hidden" and value == "true"):
            return True
        if name in ("class", "id") and _names_other_part(value, tag) and not _LIKELY_TOKENS.intersection(value.split()):
            # An article's own heading may call itself a header.
            if not (inside_article and (tag in _HEADINGS or tag == "header")):
                return True
    return False


class _Page:
    """The element tree of a page: ``nodes`` in page order and ``blocks`` (block element, linked characters, text).

    Every step costs a constant or is paid by the elements that it closes.
    """

    def __init__(self, html: str):
        root = _Node("", None, True, 0)
        self.stack, self.nodes = [root], [root]
        self.blocks: list[tuple[_Node, int, str]] = []
        self.open: defaultdict[str, int] = defaultdict(int)
        # For each tag that ends its like: the open elements of that tag and of its lists.
        self.items: dict[str, list[_Node]] = {tag: [] for tag in CLOSES_ITSELF}
        self.text: list[str] = []
        self.linked = 0
        for tag, ends, attributes, text in _tokens(html):
            if text:
                self._add(text)
            if tag is None:
                continue
            if tag == "br":
                self.text.append(" ")
            elif tag in VOID:
                if tag not in INLINE:
                    self._flush()
            elif ends:
                self._end(tag)
            else:
                self._start(tag, attributes)
        self._flush()

    def _add(self, piece: str) -> None:
        if self.stack[-1].kept:
            piece = unescape(piece) if "&" in piece else piece
            self.text.append(piece)
            if self.open["a"]:
                self.linked += len(piece.strip())

    def _flush(self) -> None:
        if self.text:
            words = " ".join("".join(self.text).split())
            self.text.clear()
            own = self.stack[-1].own
            if words and own.kept:
                self.blocks.append((own, min(self.linked, len(words)), words))
                if own.form is not None:
                    own.form.chars += len(words)
                    if self.linked == 0:
                        own.form.longest = max(own.form.longest, len(words))
        self.linked = 0

    def _close(self, depth: int) -> None:
        stack = self.stack
        while len(stack) > depth:
            node = stack.pop()
            self.open[node.tag] -= 1
            if node.own is not node:
                node.own.inline[node.tag] -= 1
            for tag in _ITEMS_OF.get(node.tag, ()):
                self.items[tag].pop()

    def _end(self, tag: str) -> None:
        if tag in INLINE:
            # An inline end does not close blocks.
            among = self.stack[-1].own.inline
            if not among or not among.get(tag):
                return
        else:
            self._flush()
            if not self.open[tag]:
                return
        depth = len(self.stack) - 1
        while self.stack[depth].tag != tag:
            depth -= 1
        self._close(depth)

    def _start(self, tag: str, attributes: str) -> None:
        if tag not in INLINE:
            self._flush()
            # A block ends an open paragraph; an item also ends the item before it in its list.
            own = self.stack[-1].own
            ended = own.depth if own.tag == "p" else 0
            items = self.items.get(tag)
            if items and items[-1].tag == tag:
                ended = items[-1].depth
            if ended:
                self._close(ended)
        parent = self.stack[-1]
        in_article, in_main = self.open["article"] > 0, self.open["main"] > 0
        kept = parent.kept and not _left_out(tag, attributes, in_article)
        if tag == "form" and (in_article or in_main):
            kept = False
        node = _Node(tag, parent, kept, len(self.stack))
        if kept:
            self.nodes.append(node)
            if tag == "form" and node.form is None:
                node.form = _Form()
            elif tag in ("article", "main") and node.form is not None:
                node.form.around = True
        if node.own is not node:
            if node.own.inline is None:
                node.own.inline = {}
            node.own.inline[tag] = node.own.inline.get(tag, 0) + 1
        self.stack.append(node)
        self.open[tag] += 1
        for item in _ITEMS_OF.get(tag, ()):
            self.items[item].append(node)
        if attributes.endswith("/") and tag not in INLINE and tag not in ("p", "div", "section", "article", "body"):
            self._close(len(self.stack) - 1)


def _score(nodes: list[_Node], blocks: list[tuple[_Node, int, str]]) -> None:
    """Points, characters and linked characters of all nodes, children before parents."""
    for number, (own, linked, words) in enumerate(blocks):
        container = own.parent if own.tag in _PARAGRAPHS and own.parent is not None else own
        if container.first < 0:
            container.first = number
        own.chars += len(words)
        own.linked += linked
        if own.tag not in _HEADINGS:
            container.direct += 1 + len(_COMMAS.findall(words)) + min(len(words) / 100, 3)
    for node in reversed(nodes):
        up = node.parent
        if up is None:
            continue
        up.chars += node.chars
        up.linked += node.linked
        up.near += node.direct
        up.far += node.near / 6 + node.far * 2 / 3
        if node.first >= 0 and (up.first < 0 or node.first < up.first):
            up.first = node.first


def main_text(html: str | None) -> str:
    page = _Page(html) if html else None
    if page is None or not page.blocks:
        return ""
    nodes, blocks = page.nodes, page.blocks
    total = sum(len(words) for _, _, words in blocks)
    blocks = [b for b in blocks if b[0].form is None or b[0].form.wraps(total)]
    if not blocks:
        return ""
    _score(nodes, blocks)
    # Ties go to the node that the first block reaches first.
    best = max((n for n in nodes if n.first >= 0), key=lambda n: (n.final(), -n.first, n.depth))
    for wider in ("article", "main"):
        node = best
        while node is not None and node.tag != wider:
            node = node.parent
        if node is not None:
            best = node
            break
    kept = {best}
    if best.parent is not None and best.tag not in ("body", "html"):
        near = max(10.0, 0.2 * best.final())
        # The sibling that a node lies in, itself included.
        for node in nodes:
            if node.parent is not None:
                node.mark = node if node.parent is best.parent else node.parent.mark
        siblings: dict[_Node, tuple[int, str]] = {}
        for own, _, words in blocks:
            if own.mark is not None and own.mark is not best:
                siblings[own.mark] = (2 if own.mark in siblings else 1, words)
        for node, (count, words) in siblings.items():
            density = node.linked / node.chars if node.chars else 0.0
            paragraph = node.tag == "p" and count == 1 and density < 0.25 and (len(words) > 80 or (density == 0 and words.endswith((".", "!", "?"))))
            if node.final() >= near or paragraph or node.tag in ("h1", "h2"):
                kept.add(node)
    for node in nodes:
        node.mark = node in kept or (node.parent is not None and node.parent.mark is True)
    return "\n\n".join(words for own, _, words in blocks if own.mark)


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """Add ``text`` and ``n_chars`` (replacing columns of that name)."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([main_text(h) for h in batch], dtype=object)

    found = F.pandas_udf(run, "string").asNondeterministic()(F.col(html))
    kept = without(pages, ("text", "n_chars"))
    return pages.select(*kept, found.alias("text")).select("*", F.length("text").cast("long").alias("n_chars"))
