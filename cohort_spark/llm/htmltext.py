"""Operator 8: main text of web pages by tag-path ratios.

Every text node has a root-to-leaf path of element names.  Per page and path the
text length, punctuation and linked text of all its nodes are added up; a path's ratio is its
unlinked text per node, its punctuation ratio the marks per node.  Both are
fused (a product), smoothed by a Gaussian over the paths in page order, and paths above a
share of the mean are content.  The content's container is the ``article`` or ``main``
that holds most of it, or else the longest path prefix that holds it all; every
block in it is kept but those under elements that are no article text by name
(menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles, comments).

A name is a word of a class or id, unless another word there takes it back (``no-comments``,
``has-sidebar``, ``content-with-menu``), a form, a fieldset or a header.  It only proposes: where the
element holds more than half of the page's content by the path scores it is the page's wrapper
and stays (on a page with an article: if it holds one, or is part of one and holds nearly all of
it; elements named for comments must hold an article), and a section of an
article named for related work or discussion stays if it is text and not a list of links.

Results for odd input: null or empty html, and pages without content, give the empty
text; a null page_id or url comes back null; repeated rows are kept; an empty table gives no rows;
unclosed and stray tags are closed and dropped as browsers do; further columns are ignored.
"""
from __future__ import annotations

import html as htmllib
import math
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

# ---- fixed values: element names of HTML, and names that mark what is no article text
BLOCKS = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section
    select summary table tbody td tfoot th thead title tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea iframe svg object xmp title".split())
SWALLOWS = frozenset("script style textarea title".split())  # without an end tag they take the rest of the page
OFF_TAGS = frozenset("nav footer aside button select dialog menu head option".split())
NAMED_TAGS = frozenset("form fieldset header".split())
OFF_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar".split())
OFF_NAMES = frozenset("""ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies
    consent gdpr notice notices notification popup modal overlay newsletter subscribe subscription signup login sidebar sidebars
    aside rail menu menus nav navbar navigation breadcrumb breadcrumbs pagination pager footer masthead topbar toolbar
    comment comments commentlist reply replies respond disqus discussion share sharing social related recommended widget
    widgets""".split())
ENDS_P = BLOCKS - {"body", "html", "head", "button", "option", "select", "caption", "td", "th", "tr", "tbody", "thead", "tfoot"}
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
            "option": {"option"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"},
          "option": {"select"}}
MARKUP = re.compile(r"""<!---?>|<!--.*?(?:--!?>|\Z)|<[!?][^>]*+>?|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""([^\s/>=][^\s/>=]*+)(?:\s*+=\s*+("[^"]*"|'[^']*'|[^\s>]*+))?""")
WORD = re.compile(r"[a-z]+")
MARKS = re.compile(r"[.,;:!?…。，、！？；：]")


def not_displayed(style: str) -> bool:
    """Whether the declaration of ``display`` that counts (the last, ``!important`` first) is none."""
    display, forced = "", False
    for declaration in style.split(";"):
        name, _, value = declaration.partition(":")
        if name.strip() == "display":
            value, mark, _ = value.partition("!")
            if mark or not forced:
                display, forced = value.strip(), bool(mark)
    return display == "none"


#: Words that take back the next one of a name, and names of readers' remarks.
WITHOUT = frozenset("no not non has with without hide hides show shows toggle".split())
REMARKS = frozenset("comment comments commentlist reply replies respond disqus".split())
#: Headings of papers too.
SECTIONS = frozenset("related discussion".split())
OFF, NAMED, REMARK, SECTION = "off", "named", "remark", "section"


def proposal(tag: str, attributes: str, in_article: bool) -> str | None:
    """What an element's name, role, class or id says about it: OFF for certain, or one of the
    kinds that the content decides on."""
    if tag in OFF_TAGS:
        return OFF
    kind = NAMED if tag in NAMED_TAGS and not (tag == "header" and in_article) else None
    seen = set()
    for name, value in ATTRIBUTE.findall(attributes) if attributes else ():
        name, value = name.lower(), value.strip("\"'").lower()
        if name in seen:
            continue  # the first of a name counts
        seen.add(name)
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and not_displayed(value)):
            return OFF
        if name == "role" and value in OFF_ROLES:
            kind = kind or NAMED
        if name in ("class", "id") and tag not in ("body", "html", "article", "main"):
            for token in value.split():
                words = WORD.findall(token)
                words = {w for k, w in enumerate(words) if not k or words[k - 1] not in WITHOUT}
                if words & REMARKS:
                    kind = REMARK
                elif words & SECTIONS and in_article:
                    kind = kind or SECTION
                elif words & OFF_NAMES or ("header" in words and not in_article):
                    kind = NAMED if kind in (None, SECTION) else kind
    return kind


class Element:
    """An open or closed element: its parent's place, path number, proposal and, after reading,
    the unlinked and linked text and the content below it."""

    __slots__ = ("parent", "tag", "path", "kind", "plain", "linked", "content", "holds", "off")

    def __init__(self, parent: int, tag: str, path: int, kind: str | None):
        self.parent, self.tag, self.path, self.kind = parent, tag, path, kind
        self.plain = self.linked = self.content = 0
        self.holds = tag in ("article", "main")
        self.off = False


class Block:
    """Text between block boundaries, in one element and on one path."""

    __slots__ = ("element", "path", "parts", "linked")

    def __init__(self, element: int, path: int):
        self.element, self.path, self.parts, self.linked = element, path, [], 0

    def text(self) -> str:
        return " ".join("".join(self.parts).split())


def read(page: str) -> tuple[list[Element], list[Block]]:
    """The page's elements and its text blocks outside what is off for certain, in page order.
    Work and memory grow with the page, whatever its nesting."""
    tree = [Element(-1, "", 0, None)]
    paths: dict[tuple[int, str], int] = {}
    stack: list[tuple[str, int, bool]] = []  # name, element, off for certain
    opened: dict[str, int] = {}
    out: list[Block] = []
    current: Block | None = None
    at = 0

    def add(text: str) -> None:
        nonlocal current
        if not text or (stack and stack[-1][2]):
            return
        if current is None:
            if text.isspace():
                return
            own = stack[-1][1] if stack else 0
            current = Block(own, tree[own].path)
            out.append(current)
        text = htmllib.unescape(text)
        current.parts.append(text)
        if opened.get("a"):
            current.linked += len(text)

    def close(k: int) -> None:
        for name, _, _ in stack[k:]:
            opened[name] -= 1
        del stack[k:]

    def close_sibling(names: set[str], scope: set[str]) -> None:
        if not any(opened.get(name) for name in names):
            return
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in names:
                close(k)
                return
            if stack[k][0] in scope:
                return

    while m := MARKUP.search(page, at):
        add(page[at:m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[1] or m[4]:
            if tag in BLOCKS:
                current = None
            if opened.get(tag):
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == tag:
                        close(k)
                        break
                    if tag not in BLOCKS and stack[k][0] in BLOCKS:
                        break  # a stray inline end tag closes no block
            continue
        attributes = m[3] or m[6] or ""
        if tag in RAW:
            if tag == "svg" and attributes.endswith("/"):
                continue  # foreign elements may close themselves
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.I).search(page, at)
            at = end.end() if end else len(page) if tag in SWALLOWS else at
            current = None if tag in BLOCKS else current
            continue
        if tag == "br":
            add(" ") if current is not None else None
            continue
        if tag in BLOCKS:
            current = None
        if tag == "body":
            close_sibling({"head"}, set())
        if tag in ENDS_P:
            close_sibling({"p"}, BLOCKS - {"p"})
        if tag in SIBLINGS:
            close_sibling(SIBLINGS[tag], SCOPES[tag])
        if tag in VOID or attributes.endswith("/"):
            continue
        parent, off = (stack[-1][1], stack[-1][2]) if stack else (0, False)
        kind = None if off else proposal(tag, attributes, bool(opened.get("article") or opened.get("main")))
        own = tree[parent].path
        if tag in BLOCKS:
            own = paths.setdefault((own, tag), len(paths) + 1)
        tree.append(Element(parent, tag, own, kind))
        stack.append((tag, len(tree) - 1, off or kind == OFF))
        opened[tag] = opened.get(tag, 0) + 1
    add(page[at:])
    return tree, out


def decide(tree: list[Element], found: list[Block], texts: list[str], share: float) -> None:
    """Adds up what every element holds and switches proposed ones off, unless they hold the page."""
    scores = path_scores(found, texts)
    least = share * sum(scores.values()) / len(scores)
    for block, text in zip(found, texts):
        own = tree[block.element]
        linked = min(block.linked, len(text))
        own.plain, own.linked = own.plain + len(text) - linked, own.linked + linked
        own.content += (len(text) - linked) * (scores[block.path] >= least)
    for own in reversed(tree[1:]):  # children stand behind their parents
        up = tree[own.parent]
        up.plain, up.linked, up.content, up.holds = up.plain + own.plain, up.linked + own.linked, up.content + own.content, up.holds or own.holds
    total = tree[0].content
    articles = any(own.holds and own.plain for own in tree[1:])
    inside = [False] * len(tree)
    for n, own in enumerate(tree[1:], 1):
        inside[n] = inside[own.parent] or tree[own.parent].tag in ("article", "main")
        # of a page with an article, only what holds it or stands in it can be the wrapper
        most = 10 * own.content > 9 * total if inside[n] else 2 * own.content > total
        wraps = most and (own.holds or (own.kind != REMARK and (inside[n] or not articles)))
        text = own.kind == SECTION and own.plain >= 200 and own.linked <= 0.3 * own.plain
        own.off = tree[own.parent].off or (own.kind is not None and not wraps and not text)


def path_scores(found: list[Block], texts: list[str], width: float = 1.0) -> dict[int, float]:
    """Fused and smoothed ratio of every path of a page."""
    order: dict[int, int] = {}
    sums: list[list[float]] = []
    for block, text in zip(found, texts):
        k = order.setdefault(block.path, len(order))
        if k == len(sums):
            sums.append([0, 0, 0])
        sums[k][0] += 1
        sums[k][1] += max(0, len(text) - block.linked)
        sums[k][2] += len(MARKS.findall(text))
    raw = [chars / n * (1 + marks / n) for n, chars, marks in sums]
    smooth = []
    reach = int(3 * width)
    for k in range(len(raw)):
        near = range(max(0, k - reach), min(len(raw), k + reach + 1))
        weights = [math.exp(-((j - k) ** 2) / (2 * width * width)) for j in near]
        smooth.append(sum(w * raw[j] for w, j in zip(weights, near)) / sum(weights))
    return {path: smooth[k] for path, k in order.items()}


def main_text(page: str | None, share: float = 0.5) -> str:
    """The article's blocks joined by line feeds."""
    if not page:
        return ""
    tree, blocks = read(page)
    pairs = [(b, t) for b, t in ((b, b.text()) for b in blocks) if t]
    if not pairs:
        return ""
    decide(tree, [b for b, _ in pairs], [t for _, t in pairs], share)
    pairs = [(b, t) for b, t in pairs if not tree[b.element].off]
    if not pairs:
        return ""
    found, texts = [b for b, _ in pairs], [t for _, t in pairs]
    scores = path_scores(found, texts)
    mean = sum(scores.values()) / len(scores)
    content = [k for k, b in enumerate(found) if scores[b.path] >= share * mean]
    held, below = [0] * len(tree), [0] * len(tree)  # characters and blocks of content in an element
    for k in content:
        held[found[k].element] += len(texts[k])
        below[found[k].element] += 1
    for n in range(len(tree) - 1, 0, -1):
        held[tree[n].parent] += held[n]
        below[tree[n].parent] += below[n]
    # the article or main element with most of the content, else the deepest that holds it all
    best = max((n for n in range(1, len(tree)) if tree[n].tag in ("article", "main") and held[n]), key=lambda n: (held[n], n), default=None)
    if best is None or 2 * held[best] < held[0]:
        best = max(n for n in range(len(tree)) if below[n] == len(content))
        while best and tree[best].tag not in BLOCKS:
            best = tree[best].parent
        if len(content) == 1 and tree[best].tag not in ("", "body", "html"):
            best = tree[best].parent  # one block alone is no container: its parent holds its heading and siblings
            while best and tree[best].tag not in BLOCKS:
                best = tree[best].parent
    inside = [False] * len(tree)
    for n in range(len(tree)):
        inside[n] = n == best or (n > 0 and inside[tree[n].parent])
    return "\n".join(t for b, t in zip(found, texts) if inside[b.element])


def extract(pages: DataFrame, column: str = "html", share: float = 0.5) -> DataFrame:
    """``pages`` with ``text``, the main text of ``column``, and ``n_chars``, its code points
    (an earlier column of either name is replaced)."""

    @F.pandas_udf("string")
    def text_of(values):
        return values.map(lambda page: main_text(page, share))

    out = pages.withColumn("text", text_of(F.col(column).cast("string")))
    return out.withColumn("n_chars", F.char_length("text").cast("long"))


def op8_htmltext(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")
