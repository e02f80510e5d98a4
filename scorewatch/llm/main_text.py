"""Main text of web pages by line-block distribution.

Markup is stripped to lines (the page's text blocks, in page order). A line's weight is the length of its text outside
links, and 0 in boilerplate: menus, headers, footers, sidebars, notices, adverts, forms, comments, by element, class, role or id of a block. An article element is
a weight: a line inside one counts MARKED times, its links too; a main element is one unless the articles inside it have
more text than the rest of it, then only its h1 titles stay with them. Weights are summed over sliding windows of lines that do
not cross an article's border; a stretch runs from where the sums leave 0 to its dive, where they fall back, and surges
where they reach SURGE. The stretch with the most weight, surging ones first, names the main container: the articles, if
it lies in one, else the innermost element around its lines. Every stretch of that container is kept; where the container
is the whole body, every one that surges. Lines without weight are kept inside a stretch, and beside it in a container
smaller than the body, unless WINDOW or more follow each other: those are link lists.

Defined cases: a null or empty page gives an empty text; a page without any weighted line too; unclosed or stray tags
never fail; omitted end tags are implied; character references are decoded once; very long pages are parsed whole in time
that grows with their length (once a quoted attribute runs to the end of the page, later ones are followed over QUOTED
characters only); repeated rows and null ids are rows of their own; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import html
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WINDOW = 3
# A stretch without a window of this weight is no main text, unless the page has no better one or it is in its container.
SURGE = 80
# Weight of a character inside an article element.
MARKED = 10

TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
QUOTING = re.compile(r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+""")
OTHER = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<[a-zA-Z/!?][^>]*+\Z|[^<]++|<", re.S)
# Characters of a tag within which quotes are followed, after the quotes of another tag have run to the end of the page.
QUOTED = 256
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
FOREIGN = ("svg", "math")  # a slash at the end of their start tag closes them
RAW = ("script", "style", "noscript", "template", "textarea", "svg", "iframe", "object", "math", "canvas", "title")
DROPPED = {"head", "nav", "footer", "aside", "form", "button", "select", "dialog", "menu", "fieldset", "header", "audio", "video"}
VOID = {"br", "hr", "img", "input", "meta", "link", "wbr", "source", "track", "area", "base", "col", "embed", "param"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins",
    "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
}
BOILERPLATE = {
    "ad", "ads", "advert", "adverts", "advertisement", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "cookie",
    "cookies", "consent", "disqus", "footer", "header", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter",
    "notice", "popup", "promo", "promoted", "related", "share", "sharing", "sidebar", "social", "sponsor", "sponsored",
    "subscribe", "toolbar", "widget", "contentinfo", "complementary", "search", "alert", "login", "signup", "reply", "replies",
}
# Words of BOILERPLATE that have no other meaning: they make a clear name beside any word.
CLEAR = {
    "advert", "adverts", "advertisement", "advertisements", "breadcrumb", "breadcrumbs", "comment", "comments", "cookie",
    "cookies", "disqus", "footer", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "popup", "promo",
    "promoted", "sidebar", "sponsor", "sponsored", "subscribe", "toolbar", "widget", "widgets",
}
BOILERPLATE |= CLEAR
# The others make a clear name with words of BOILERPLATE and these: related-posts, left-sidebar, ad-slot, social-media-links.
BESIDE = {
    "area", "articles", "bar", "block", "bottom", "box", "button", "buttons", "container", "content", "entries", "field", "form",
    "global", "icons", "inner", "input", "items", "leaderboard", "left", "link", "links", "list", "media", "news", "outer", "page",
    "pages", "placement", "posts", "products", "reading", "right", "section", "site", "slot", "space", "stories", "topics", "top",
    "unit", "videos", "wrap", "wrapper", "zone",
}
# A header is boilerplate inside an article only where it is the site's.
SITE = {"site", "global"}
# What a name says of its block's surroundings or state (has-sidebar, comments-open) does not name the block.
STATE = {"no", "has", "with", "without", "is", "open", "closed", "enabled", "disabled", "none"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
ARTICLE = {"article", "main"}
WHOLE = {None, "html", "body"}
# An open element that the start of another one ends, where its end tag was left out.
ENDS_P = {
    "address", "article", "aside", "blockquote", "center", "details", "dialog", "div", "dl", "fieldset", "figcaption", "figure",
    "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "menu", "nav", "ol", "p", "pre", "section",
    "table", "ul",
}
IMPLIED = {t: {"p"} for t in ENDS_P} | {
    "li": {"p", "li"}, "dt": {"p", "dt", "dd"}, "dd": {"p", "dt", "dd"}, "option": {"option"}, "optgroup": {"option", "optgroup"},
    "td": {"p", "td", "th"}, "th": {"p", "td", "th"}, "tr": {"p", "td", "th", "tr"}, "tbody": {"p", "td", "th", "tr", "tbody", "thead"},
}


def _boilerplate_token(token: str, inside: bool) -> bool:
    words = {w.lower() for w in WORDS.findall(token)}
    if words & STATE:
        return False
    if not inside:  # any word will do; an entry's or article's header is its title
        return bool(words & BOILERPLATE) and not (
            words & BOILERPLATE == {"header"} and words & {"entry", "post", "article", "content", "section", "title"}
        )
    if words & CLEAR:
        return True
    return bool(words & BOILERPLATE) and words <= BOILERPLATE | BESIDE and ("header" not in words or bool(words & SITE))


def _named_boilerplate(tag: str, attributes: str, inside: bool) -> bool:
    """Hidden, or boilerplate by class, id or role; inside an article by clear names only.

    Inline elements and headings are never named so; ids of others than div and ul may be the slug of a title.
    """
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), a or b or c
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return True
        if tag in INLINE or tag in HEADINGS:
            continue
        if name in ("class", "role") or (name == "id" and tag in ("div", "ul")):
            if any(_boilerplate_token(t, inside) for t in value.split()):
                return True
    return False


class _Tree:
    """The open elements of a page: blocks, and inside a dropped element all. Elements are numbered in page order."""

    def __init__(self):
        self.open: list[int] = []  # numbers, outermost first
        self.tags: list[str] = []
        self.parents: list[int | None] = []
        self.ends: list[int] = []  # first number after the element
        self.where: dict[str, list[int]] = {}  # tag -> depths at which it is open
        self.blocks: list[int] = []  # depths of the open elements that are not inline
        self.articles: list[int] = []  # depths of the open articles
        self.dropped: int | None = None  # depth of the dropped element

    def push(self, tag: str, article: bool = False, dropped: bool = False) -> None:
        depth = len(self.open)
        self.parents.append(self.open[-1] if self.open else None)
        self.open.append(len(self.tags))
        self.tags.append(tag)
        self.ends.append(0)
        self.where.setdefault(tag, []).append(depth)
        if tag not in INLINE:
            self.blocks.append(depth)
        if article:
            self.articles.append(depth)
        if dropped:
            self.dropped = depth

    def cut(self, depth: int) -> None:
        """Close all elements from this depth on."""
        while len(self.open) > depth:
            number = self.open.pop()
            self.where[self.tags[number]].pop()
            self.ends[number] = len(self.tags)
        for depths in (self.blocks, self.articles):
            while depths and depths[-1] >= depth:
                depths.pop()
        if self.dropped is not None and self.dropped >= depth:
            self.dropped = None

    def end(self, tag: str) -> None:
        """An end tag. A stray one is ignored; only its own, body and html close an article."""
        at = self.where.get(tag)
        if at and (tag in ARTICLE or tag in WHOLE or not self.articles or at[-1] > self.articles[-1]):
            self.cut(at[-1])

    def imply(self, tag: str) -> None:
        """A start tag ends what it cannot be inside of."""
        ended = IMPLIED.get(tag)
        while ended and self.blocks and self.tags[self.open[self.blocks[-1]]] in ended:
            self.cut(self.blocks[-1])

    def article(self) -> int | None:
        """Number of the innermost open article."""
        return self.open[self.articles[-1]] if self.articles else None


def _token(page: str, at: int, reach: int | None):
    """(whole token, tag name or None, whether it closes, attributes, place after it, reach) of the token at a place.

    reach: None while quotes may be followed to the end of the page, else the number of characters they are followed.
    """
    m = TAG.match(page, at) if page[at] == "<" else None
    if m is not None:
        stop = QUOTING.match(page, m.end(), len(page) if reach is None else m.end() + reach).end()
        if not page.startswith(">", stop):  # quotes that do not close: the tag ends at the first >
            stop, reach = page.find(">", m.end()), QUOTED
        if stop >= 0:
            return page[at : stop + 1], m[2].lower(), bool(m[1]), page[m.end() : stop], stop + 1, reach
    m = OTHER.match(page, at)
    return m[0], None, False, "", m.end(), reach


def _lines(page: str):
    """Lines (text, weight, in article, number of the innermost block) in page order, and the tree of the page's blocks.

    A dropped element is one line without text and weight.
    """
    out, parts, weight, linked = [], [], 0, 0
    tree, links = _Tree(), 0

    def flush():
        nonlocal parts, weight, linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append((text, weight, linked, tree.article(), tree.open[-1] if tree.open else None))
            parts, weight, linked = [], 0, 0

    at, end, folded, reach = 0, len(page), None, None
    while at < end:
        piece, tag, closing, attributes, at, reach = _token(page, at, reach)
        if tag is None:
            if piece[0] != "<" or piece == "<":  # else a comment, a declaration or a tag cut off by the end
                if tree.dropped is None:
                    text = html.unescape(piece)
                    parts.append(text)
                    if links:
                        linked += len(text.strip())
                    else:
                        weight += len(text.strip())
            continue
        if not closing and tag in RAW and not (tag in FOREIGN and attributes.endswith("/")):
            folded = page.lower() if folded is None else folded
            if len(folded) != end:  # a letter whose lower case is longer: search as written
                folded = page
            close = folded.find(f"</{tag}", at)
            at = end if close < 0 else (page.find(">", close) + 1 or end)
            continue
        if tag in FOREIGN and tree.dropped is None:
            continue
        if tree.dropped is not None:
            if closing:
                tree.end(tag)
                continue
            tree.imply(tag)
            if tree.dropped is not None:
                if tag not in VOID and not attributes.rstrip().endswith("/"):
                    tree.push(tag)
                continue
        if tag in INLINE:
            if tag not in VOID and not closing and attributes and _named_boilerplate(tag, attributes, False):
                tree.push(tag, dropped=True)  # hidden; its paragraph goes on
            elif tag == "a":
                links = 0 if closing else 1
            continue
        flush()
        links = 0
        if closing:
            tree.end(tag)
            continue
        tree.imply(tag)
        if tag in VOID:
            pass
        elif tag in ARTICLE and not _named_boilerplate(tag, attributes, True):
            tree.push(tag, article=True)
        elif (tag in DROPPED and not (tag == "header" and tree.articles)) or (
            tag not in ("html", "body") and attributes and _named_boilerplate(tag, attributes, bool(tree.articles))
        ):
            out.append(("", 0, 0, tree.article(), tree.open[-1] if tree.open else None))
            if not attributes.rstrip().endswith("/"):
                tree.push(tag, dropped=True)
        else:
            tree.push(tag)
    flush()
    tree.cut(0)
    return _marked(out, tree), tree


def _marked(lines, tree: _Tree):
    """Lines as (text, weight, in article, innermost block)."""
    main_of: list[int | None] = []  # per element the main element around it, itself included
    in_article: list[bool] = []
    for n, (tag, parent) in enumerate(zip(tree.tags, tree.parents)):
        main_of.append(n if tag == "main" else None if parent is None else main_of[parent])
        in_article.append(parent is not None and (in_article[parent] or tree.tags[parent] == "article"))
    balance = dict.fromkeys(main_of, 0)  # text of a main element's articles less the rest of its text
    for _, weight, linked, n, _ in lines:
        if n is not None:
            balance[main_of[n]] = balance.get(main_of[n], 0) + (weight + linked) * (-1 if tree.tags[n] == "main" else 1)
    out = []
    for text, weight, linked, n, block in lines:
        inside = n is not None and (
            tree.tags[n] != "main" or in_article[n] or balance[n] <= 0 or (block is not None and tree.tags[block] == "h1")
        )
        out.append((text, MARKED * (weight + linked) if inside else weight, inside, block))
    return out


def _stretches(lines) -> list[tuple[bool, int, int, int]]:
    """(surges, weight, first, last) of each stretch; first and last are its outer lines with weight."""
    weights = [line[1] for line in lines]
    found, begin = [], 0
    while begin < len(lines):
        border = begin
        while border < len(lines) and lines[border][2] == lines[begin][2]:
            border += 1
        start = None
        for i in range(begin, border + 1):
            ahead = sum(weights[i : min(i + WINDOW, border)]) if i < border else 0
            if ahead and start is None:
                start, peak = i, 0
            if ahead:
                peak = max(peak, ahead)
            elif start is not None:  # dive
                first = next(k for k in range(start, i) if weights[k])
                found.append((peak >= SURGE, sum(weights[start:i]), first, i - 1))
                start = None
        begin = border
    return found


def _container(lines, tree: _Tree, first: int, last: int) -> int | None:
    """The innermost element around the lines with weight; around a single line's block its parent."""
    inner = [n for _, w, _, n in lines[first : last + 1] if w]
    if None in inner:
        return None
    low, high = min(inner), max(inner)
    at = tree.parents[low] if low == high and tree.tags[low] not in WHOLE else low
    while at is not None and tree.ends[at] <= high:
        at = tree.parents[at]
    return at


def main_text(page: str | None) -> str:
    lines, tree = _lines(page or "")
    stretches = _stretches(lines)
    if not stretches:
        return ""
    _, _, first, last = max(stretches, key=lambda s: (s[0], s[1], -s[2]))
    marked = lines[first][2]
    at = None if marked else _container(lines, tree, first, last)
    whole = not marked and (at is None or tree.tags[at] in WHOLE)

    def belongs(i: int) -> bool:
        _, _, inside, n = lines[i]
        if marked or inside:
            return marked and inside
        return at is None or (n is not None and at <= n < tree.ends[at])

    kept = [False] * len(lines)
    for surges, _, a, b in stretches:
        if (surges or not whole or a == first) and belongs(a):
            for i in range(a, b + 1):
                kept[i] = belongs(i)
    if not whole:  # lines without weight beside a stretch
        i = 0
        while i < len(lines):
            j = i
            while j < len(lines) and belongs(j) and not lines[j][1]:
                j += 1
            if j - i < WINDOW:
                kept[i:j] = [True] * (j - i)
            i = max(j, i + 1)
    return "\n".join(line[0] for line, keep in zip(lines, kept) if keep and line[0])


@F.pandas_udf(T.StringType())
def _main_texts(pages: pd.Series) -> pd.Series:
    return pages.map(main_text, na_action=None).astype(object)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars: one row per page. One pass, no shuffle."""
    return pages.select("page_id", "url", _main_texts("html").alias("text")).withColumn(
        "n_chars", F.length("text").cast("long")
    )
