"""Text blocks of web pages, and which of them are the article.

A page is read once, tag by tag, and cut into flat blocks of text at block-level tags. Each
block has its number of words, its share of linked characters, those of the blocks before and
after it, and what its surroundings say of themselves. A decision tree, grown from the small
table ``LABELLED`` below, tells article from boilerplate.
"""

from __future__ import annotations

import html as entities
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import small_batches

# --- fixed values of the markup language ------------------------------------------------
# Elements whose text is no text of the page.
HIDDEN = {"script", "style", "head", "title", "noscript", "template", "svg", "iframe", "object", "select",
          "datalist", "textarea", "button", "canvas", "audio", "video", "map", "annotation", "annotation-xml"}
IN_HEAD = {"head", "title", "meta", "link", "base", "style", "script", "noscript", "template"}
NESTED = {"object", "svg", "template"}
# Formulas are text of their paragraph.
MATH = {"math", "semantics", "mrow", "mi", "mo", "mn", "ms", "mtext", "mspace", "mfrac", "msqrt", "mroot", "mstyle",
        "merror", "mpadded", "mphantom", "menclose", "msub", "msup", "msubsup", "munder", "mover", "munderover",
        "mmultiscripts", "mprescripts", "mtable", "mtr", "mtd"}
# Tags of text that end a hidden element whose end tag is missing.
FLOW = {"address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dl", "dt", "div", "fieldset",
        "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "li", "main", "nav", "ol", "p", "pre",
        "section", "table", "td", "th", "tr", "ul"}
RAW = {"script", "style", "title", "textarea", "iframe"}   # their content is no markup
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font",
          "i", "img", "input", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span",
          "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"} | MATH
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
CLOSED_BY_NEXT = {"p", "li", "dt", "dd", "tr", "td", "th", "option"}   # their end tags are often left out
# Words of names, classes and roles that say what a part of a page is.
AROUND = {"nav", "navbar", "navigation", "menu", "menubar", "header", "masthead", "topbar", "footer", "foot", "bottom",
          "aside", "sidebar", "side", "complementary", "ad", "ads", "adv", "advert", "adverts", "advertisement",
          "banner", "sponsor", "sponsored", "promo", "promotion", "form", "search", "login", "signup", "subscribe",
          "newsletter", "comment", "comments", "disqus", "respond", "reply", "replies", "discussion", "cookie",
          "cookies", "consent", "gdpr", "notice", "notices", "alert", "popup", "modal", "overlay", "breadcrumb",
          "breadcrumbs", "pagination", "pager", "related", "recommended", "share", "sharing", "social", "widget",
          "toolbar", "copyright", "legal", "contentinfo", "dialog", "skip", "tags"}
# Those of them that never hold an article, and words that may stand beside these in a name.
NEVER = {"ad", "ads", "adv", "advert", "adverts", "advertisement", "sponsor", "sponsored", "promo", "promotion", "login",
         "signup", "subscribe", "newsletter", "comment", "comments", "commentlist", "disqus", "respond", "reply", "replies",
         "discussion", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "alert", "popup", "modal"}
BESIDE = {"area", "bar", "block", "body", "box", "container", "content", "group", "inner", "item", "list", "panel", "section",
          "slot", "text", "thread", "unit", "wrap", "wrapper"}
ARTICLE = {"article", "main", "content", "post", "entry", "story", "articlebody", "maincontent"}
# Whole names of the text itself, which outweigh what a part around them is called.
BODY = {"article-body", "article-content", "article-text", "articlebody", "entry-content", "maincontent", "main-content",
        "post-body", "post-content", "story-body"}
SURROUNDING = {"nav", "footer", "aside", "dialog", "menu"}   # tags that say it themselves
# ----------------------------------------------------------------------------------------

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)|<(/?)([a-zA-Z]"
    r"[^\s/>]*)([^>]*)(?:>|\Z)", re.S)
_NAMES = re.compile(r"""\b(?:class|id|role|itemprop)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)


def _zone(tag: str, attributes: str, outer: int) -> int:
    """1 in an article, -1 in what lies around it by name or in a form, -2 by tag, -3 in what never
    is part of an article, such as comments and adverts, 0 where nothing is said.

    Names count whole, or where each of their parts is such a word: no-sidebar is not a sidebar.
    """
    names: set[str] = set()
    if attributes and "=" in attributes:
        names = {name for value in _NAMES.findall(attributes) for name in value.strip("\"'").lower().split()}
    parts = [re.split("[-_]+", name) for name in names]
    if outer == -3 or tag not in ("html", "body") and any(
            any(part in NEVER for part in p) and all(part in AROUND or part in NEVER or part in BESIDE for part in p)
            for p in parts):
        return -3
    if tag in ("article", "main"):
        return 1
    if tag in SURROUNDING:
        return -2
    if tag == "header":   # of the page, unless it heads an article
        return outer if outer == 1 else -2
    if tag == "form":   # may hold a whole page
        outer = -2 if outer == 1 else min(outer, -1)
    if names:
        around = any(all(part in AROUND for part in p) for p in parts)
        if names & BODY and outer >= -1:
            return 1
        if names & ARTICLE and outer >= 0 and not around:
            return 1
        if around and tag not in ("html", "body") and not (names & ARTICLE and outer >= 0):
            return min(outer, -1)
    return outer


def _is_closed(page: str, tag: str, at: int) -> bool:
    """Whether an end tag comes before the next start tag of the name, if elements of the name cannot hold each other."""
    nested = tag in NESTED
    found = re.compile(f"<{'/' if nested else '(/?)'}{tag}(?=[\\s/>])", re.I).search(page, at)
    return bool(found) and (nested or found[1] == "/")


def blocks(page: str) -> list[tuple[str, float, int, int]]:
    """(text, share of linked characters, zone, box) of the text blocks in page order; the box is the
    place of the outermost element of zone -1 that holds the block, else 0."""
    out: list[tuple[str, float, int, int]] = []
    texts: list[str] = []
    linked = links = 0
    open_tags: list[tuple[str, int, bool, int]] = []   # tag, zone, hidden, box
    zone, hidden, box, at = 0, False, 0, 0
    missing: set[str] = set()
    unclosed = 0   # hidden elements open now whose end tag is missing

    def flush() -> None:
        nonlocal linked
        if texts:
            text = " ".join("".join(texts).split())
            texts.clear()
            if text:
                out.append((text, min(1.0, linked / len(text)), zone, box))
        linked = 0

    def leave() -> None:
        """Close the innermost open element."""
        nonlocal zone, hidden, box, unclosed
        name, zone, hidden, box = open_tags.pop()
        unclosed -= name.startswith("!")

    def add(raw: str) -> None:
        nonlocal linked
        if hidden and open_tags and open_tags[-1][0] == "head" and raw.strip():
            leave()   # text ends a head
        if raw and not hidden:
            text = entities.unescape(raw) if "&" in raw else raw
            texts.append(text)
            if links:
                linked += len(text)

    length = len(page)
    while at < length:
        found = _TOKEN.search(page, at)
        if not found:
            rest = page[at:]
            cut = rest.find("<") if rest.rstrip().endswith("<") else -1
            add(rest[:cut] if cut >= 0 else rest)
            break
        add(page[at:found.start()])
        at = found.end()
        closing, tag, attributes = found.group(1), found.group(2), found.group(3)
        if tag is None:
            closing, tag, attributes = found.group(4), found.group(5), found.group(6)
        if tag is None:
            continue   # a comment or declaration
        tag = tag.lower()
        if hidden and not closing:
            if open_tags[-1][0] == "head" and tag not in IN_HEAD:
                leave()   # the end tag of the head is often left out
            while unclosed and tag in FLOW:
                leave()
        if tag == "br":
            if not hidden:
                texts.append(" ")
            continue
        if tag in INLINE:
            if tag == "a":
                links = max(0, links - 1) if closing else links + 1
            if closing or tag in VOID or not attributes or "class" not in attributes:
                continue
        if closing:
            flush()
            links = 0
            if any(t == tag for t, *_ in open_tags):
                while open_tags[-1][0] != tag:
                    leave()
                leave()
            continue
        if tag in INLINE:
            continue
        flush()
        links = 0
        if tag in VOID:
            continue
        if tag in CLOSED_BY_NEXT and open_tags and open_tags[-1][0] == tag:
            leave()
        closed = tag not in HIDDEN or tag in RAW or tag == "head" or hidden or (
            tag not in missing and _is_closed(page, tag, at))
        if not closed:
            unclosed += 1
            if tag in NESTED:
                missing.add(tag)   # there is no end tag on the rest of the page
        open_tags.append((tag if closed else "!" + tag, zone, hidden, box))   # no end tag has such a name
        if tag in HIDDEN:
            hidden = True
            if tag in RAW:
                end = re.compile(f"</{tag}", re.I).search(page, at)
                at = end.start() if end else length
            continue
        zone = _zone(tag, attributes, zone)
        if zone == -1 and not box:
            box = at
    flush()
    return out


FEATURES = ("words", "linked", "words_before", "linked_before", "words_after", "linked_after", "zone")
# A small labelled table of blocks: the features above, then 1 for article and 0 for the rest.
LABELLED = (
    (1, 1.0, 0, 0.0, 1, 1.0, -1, 0), (1, 1.0, 1, 1.0, 2, 1.0, -1, 0), (2, 1.0, 1, 1.0, 7, 0.0, -1, 0),
    (7, 0.0, 2, 1.0, 9, 0.0, -1, 0), (14, 0.0, 1, 1.0, 8, 0.0, -1, 0), (40, 0.0, 60, 0.0, 0, 0.0, -1, 0),
    (8, 0.0, 55, 0.0, 0, 0.0, -1, 0), (25, 0.1, 80, 0.0, 12, 0.0, -1, 0), (120, 0.0, 40, 0.0, 35, 0.0, -2, 0),
    (3, 0.0, 1, 1.0, 1, 1.0, -1, 0), (30, 0.4, 20, 0.3, 90, 0.0, -1, 0), (60, 0.02, 15, 0.0, 70, 0.0, -1, 0),
    (6, 0.0, 7, 0.0, 60, 0.0, 1, 1), (1, 0.0, 50, 0.0, 44, 0.0, 1, 1), (2, 0.0, 30, 0.0, 8, 0.0, 1, 1),
    (50, 0.0, 6, 0.0, 70, 0.0, 1, 1), (90, 0.05, 50, 0.0, 20, 0.0, 1, 1), (15, 0.3, 60, 0.0, 33, 0.1, 1, 1),
    (4, 0.0, 80, 0.0, 9, 0.0, 1, 1), (9, 0.0, 0, 0.0, 12, 0.0, 1, 1), (5, 1.0, 30, 0.1, 41, 0.0, 1, 1),
    (3, 0.0, 5, 0.0, 3, 0.0, 1, 1), (200, 0.0, 10, 0.0, 150, 0.0, 1, 1), (12, 0.0, 14, 0.0, 8, 0.0, 1, 1),
    (1, 1.0, 0, 0.0, 1, 1.0, 0, 0), (2, 1.0, 2, 1.0, 2, 1.0, 0, 0), (3, 0.9, 2, 1.0, 4, 0.0, 0, 0),
    (6, 0.0, 3, 1.0, 2, 1.0, 0, 0), (4, 0.0, 2, 1.0, 5, 0.2, 0, 0), (12, 0.6, 4, 1.0, 3, 1.0, 0, 0),
    (8, 0.0, 2, 1.0, 6, 0.0, 0, 0), (5, 0.0, 6, 0.0, 3, 0.8, 0, 0), (35, 0.7, 5, 1.0, 4, 1.0, 0, 0),
    (1, 1.0, 30, 0.0, 1, 1.0, 0, 0), (2, 1.0, 45, 0.0, 3, 0.0, 0, 0), (4, 1.0, 60, 0.0, 2, 1.0, 0, 0),
    (9, 0.9, 25, 0.0, 30, 0.0, 0, 0), (2, 0.0, 1, 1.0, 1, 1.0, 0, 0), (3, 1.0, 22, 0.0, 0, 0.0, 0, 0),
    (45, 0.0, 8, 0.0, 60, 0.0, 0, 1), (70, 0.1, 50, 0.0, 30, 0.0, 0, 1), (30, 0.0, 2, 1.0, 45, 0.0, 0, 1),
    (9, 0.0, 60, 0.0, 55, 0.0, 0, 1), (6, 0.0, 40, 0.0, 80, 0.0, 0, 1), (22, 0.2, 33, 0.0, 41, 0.1, 0, 1),
    (150, 0.02, 1, 1.0, 6, 0.0, 0, 1), (18, 0.0, 25, 0.0, 30, 0.0, 0, 1), (28, 0.0, 0, 0.0, 0, 0.0, 0, 1),
    (12, 0.0, 40, 0.0, 2, 1.0, 1, 1), (5, 0.0, 30, 0.0, 1, 1.0, 1, 1), (3, 0.0, 1, 1.0, 20, 0.0, 1, 1),
    (2, 0.0, 0, 0.0, 1, 1.0, 1, 1), (1, 0.0, 1, 1.0, 0, 0.0, 1, 1), (6, 0.5, 1, 1.0, 1, 1.0, 1, 1),
    (22, 0.0, 0, 0.0, 1, 1.0, 0, 1), (30, 0.0, 20, 0.0, 2, 1.0, 0, 1), (18, 0.0, 1, 1.0, 2, 1.0, 0, 1),
    (3, 0.0, 30, 0.0, 50, 0.0, 0, 1), (16, 0.0, 12, 0.0, 45, 0.0, 0, 1), (60, 0.0, 4, 0.0, 2, 1.0, 0, 1),
    (1, 1.0, 1, 1.0, 1, 1.0, -2, 0), (30, 0.0, 20, 0.0, 60, 0.0, -2, 0), (300, 0.02, 90, 0.0, 80, 0.0, -2, 0),
    (110, 0.0, 40, 0.0, 35, 0.0, -1, 1), (160, 0.05, 6, 0.0, 90, 0.0, -1, 1), (85, 0.0, 60, 0.0, 110, 0.0, -1, 1),
    (240, 0.02, 2, 1.0, 1, 1.0, -1, 1), (90, 0.8, 3, 1.0, 70, 0.0, -1, 0), (150, 0.9, 120, 0.0, 1, 1.0, -1, 0),
    (3, 0.0, 2, 1.0, 90, 0.0, -2, 0), (6, 0.0, 10, 0.0, 120, 0.0, -2, 0), (2, 0.0, 0, 0.0, 160, 0.0, -1, 0),
    (8, 0.0, 60, 0.0, 45, 0.0, -1, 0), (5, 0.0, 2, 0.0, 55, 0.0, -1, 0), (1, 0.0, 12, 0.0, 40, 0.0, -2, 0),
    (6, 0.0, 2, 1.0, 90, 0.0, 0, 1), (4, 0.0, 0, 0.0, 120, 0.0, 0, 1), (8, 0.0, 1, 1.0, 60, 0.0, 0, 1),
)


def grow(rows: tuple = LABELLED, least: int = 1) -> tuple:
    """A decision tree by Gini impurity: (feature, threshold, left, right) or a label."""
    labels = [row[-1] for row in rows]
    if len(set(labels)) == 1 or len(rows) <= least:
        return (max(set(labels), key=labels.count),)
    best = None
    for f in range(len(FEATURES)):
        values = sorted({row[f] for row in rows})
        for low, high in zip(values, values[1:]):
            at = (low + high) / 2
            parts = [[r for r in rows if r[f] <= at], [r for r in rows if r[f] > at]]
            impurity = sum(2 * sum(r[-1] for r in p) * (1 - sum(r[-1] for r in p) / len(p)) for p in parts)
            if best is None or impurity < best[0] - 1e-12:
                best = impurity, f, at, parts
    if best is None:
        return (max(set(labels), key=labels.count),)
    return best[1], best[2], grow(tuple(best[3][0]), least), grow(tuple(best[3][1]), least)


def label(tree: tuple, features: tuple) -> int:
    while len(tree) > 1:
        tree = tree[2] if features[tree[0]] <= tree[1] else tree[3]
    return tree[0]


def unwrapped(found: list[tuple[str, float, int, int]]) -> list[tuple[str, float, int]]:
    """The blocks with their zone, which is -1 only in a name or form that wraps the page, else -2.

    A box does so if it holds the article, and, where no article is told apart, if such boxes
    hold most of the words.
    """
    wrappers = {box for _, _, zone, box in found if zone == 1 and box}
    if not any(zone == 1 for _, _, zone, _ in found):
        words = {-1: 0, 0: 0}
        for text, _, zone, _ in found:
            if zone in words:
                words[zone] += text.count(" ") + 1
        if words[-1] > words[0]:
            wrappers = {box for _, _, zone, box in found if zone == -1}
    return [(text, linked, -2 if zone == -1 and box not in wrappers else zone) for text, linked, zone, box in found]


def main_text(page: str, tree: tuple) -> str:
    """The blocks that the tree takes for the article, in page order, one space between."""
    found = unwrapped(blocks(page))
    sizes = [(text.count(" ") + 1, linked) for text, linked, _ in found]
    edged = [(0, 0.0), *sizes, (0, 0.0)]
    kept = [text for i, (text, _, zone) in enumerate(found)
            if label(tree, (*edged[i + 1], *edged[i], *edged[i + 2], max(zone, -2)))]
    return " ".join(kept)


def extracted(pages: DataFrame, html_column: str = "html", tree: tuple | None = None) -> DataFrame:
    """``pages`` with a column ``text``, the article of each page; the html is dropped.

    Null, empty and text-free pages give an empty text. Cut-off pages are read as far as they
    go. Every page is classified by itself, so repeated rows give equal texts; other columns
    are kept, but for one already named text, which is replaced. An empty table gives an empty
    one.
    """
    tree = tree or grow()

    def of(series):
        import pandas as pd

        return pd.Series([main_text(page, tree) for page in series], dtype=object)

    extract = F.pandas_udf(of, "string", F.PandasUDFType.SCALAR)
    whole = F.coalesce(F.col(html_column).cast("string"), F.lit(""))
    return small_batches(pages).withColumn("text", extract(whole)).drop(html_column)
