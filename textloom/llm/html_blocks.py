"""Pages as sequences of leaf blocks, and labelled pages to learn from.

A leaf block is the text between two borders of block elements, with the element it stands in. Tags and attributes are
read by the rules of HTML: a quote inside an unquoted value is part of it, a quote that nothing closes opens nothing,
and an unfinished tag at the end of a page is no text. Comments, declarations and raw-text elements are skipped, the
latter to the end of the page where nothing closes them. Elements that show no text of their own (``HIDDEN``) hide what
they hold only if they are closed; where their parent or the page ends first, their text stays. Formulas and drawing
surfaces are part of the text around them. Other missing end tags close as the next block starts.

A page is read once, from front to back, whatever its markup: elements are linked nodes, and the elements around a
block are never copied.
"""

from __future__ import annotations

import random
import re
from html import unescape
from typing import NamedTuple

MARKUP = re.compile(r"<(?:!--|[!?]|/?[A-Za-z]|/)")
TAG = re.compile(
    r"""(/?)([A-Za-z][^\s/>]*+)((?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]++)?+)?+)*+)>"""
)
#: Elements whose content is characters up to their end tag, none of them text of the page.
RAW = frozenset("script style title textarea iframe".split())
#: Elements that show nothing, or controls, when they are closed.
HIDDEN = frozenset("noscript template select svg".split())
#: Elements that do not interrupt a block.
INLINE = frozenset(
    "a abbr b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr math mi mn mo ms mtext mrow mfrac msqrt mroot msub msup msubsup munder mover "
    "munderover mspace mstyle semantics object canvas".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that a new one of the same group closes.
CLOSED_BY_ITSELF = {"li": "li", "dt": "d", "dd": "d", "tr": "tr", "td": "c", "th": "c", "option": "o"}
SCOPES = frozenset("ul ol dl table body html article section div main".split())
NAME = re.compile(r"""\b(?:class|id|role|itemprop)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
GOLD = re.compile(r"""\bdata-gold=["']?([01])""")
NAME_PARTS = re.compile(r"[a-z]+")


class Element(NamedTuple):
    tag: str
    names: tuple[str, ...]
    gold: int


class Node:
    """An element with the one around it; ``depth`` counts elements, the root has none."""

    __slots__ = ("parent", "element", "depth", "gold", "hides", "hider")

    def __init__(self, parent: Node | None, element: Element | None) -> None:
        self.parent, self.element = parent, element
        self.depth = parent.depth + 1 if parent else 0
        self.gold = element.gold if element and (element.gold or element.tag == "gold") else parent.gold if parent else 0
        #: The nearest element around, or this one, that may hide its text; and whether this one is closed and does.
        self.hides = False
        self.hider = self if element and element.tag in HIDDEN else parent.hider if parent else None

    def path(self) -> tuple[Element, ...]:
        """Elements from the root down to this one."""
        out, node = [], self
        while node.parent:
            out.append(node.element)
            node = node.parent
        return tuple(reversed(out))


class Block(NamedTuple):
    text: str
    path: Node | tuple[Element, ...]
    link_chars: int
    marks: int  # inline elements inside
    fields: int  # form fields inside
    gold: int


def _element(tag: str, attributes: str) -> Element:
    names: tuple[str, ...] = ()
    gold = 0
    if attributes:
        names = tuple(dict.fromkeys(p for v in NAME.findall(attributes) for p in NAME_PARTS.findall(v.lower())))
        found = GOLD.search(attributes)
        gold = int(found.group(1)) if found else 0
    return Element(tag, names, gold)


class Reader:
    """State of one pass over a page."""

    def __init__(self) -> None:
        self.blocks: list[Block] = []
        self.hiders: list[Node] = []
        self.here = Node(None, None)
        self.open: dict[str, int] = {}  # open elements by tag, and by group of those that close each other
        self.text: list[str] = []
        self.in_link = self.link_chars = self.marks = self.fields = 0

    def finish(self) -> None:
        """End the block."""
        if self.text:
            words = " ".join(unescape("".join(self.text)).split())
            if words:
                self.blocks.append(Block(words, self.here, self.link_chars, self.marks, self.fields, self.here.gold))
            self.text.clear()
        self.link_chars = self.marks = self.fields = 0

    def push(self, element: Element) -> None:
        self.here = Node(self.here, element)
        if self.here.hider is self.here:
            self.hiders.append(self.here)
        for name in (element.tag, CLOSED_BY_ITSELF.get(element.tag)):
            if name:
                self.open[name] = self.open.get(name, 0) + 1

    def pop(self) -> Node:
        node = self.here
        for name in (node.element.tag, CLOSED_BY_ITSELF.get(node.element.tag)):
            if name:
                self.open[name] -= 1
        self.here = node.parent
        return node

    def close(self, tag: str) -> None:
        if self.open.get(tag):
            while (node := self.pop()).element.tag != tag:
                pass
            node.hides = True

    def start(self, tag: str, attributes: str) -> None:
        above = self.here.element.tag if self.here.element else ""
        if above == "p" or above in HEADINGS and tag[0] == "h":
            self.pop()
        group = CLOSED_BY_ITSELF.get(tag)
        if group and self.open.get(group):
            node = self.here
            while node.element.tag not in SCOPES and CLOSED_BY_ITSELF.get(node.element.tag) != group:
                node = node.parent
            if CLOSED_BY_ITSELF.get(node.element.tag) == group:
                while self.here is not node.parent:
                    self.pop()
        self.push(_element(tag, attributes))
        self.in_link = 0


HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())


def leaf_blocks(html: str) -> list[Block]:
    """Leaf blocks of a page in order; blank ones are left out."""
    r, at, end = Reader(), 0, len(html)
    while at < end:
        found = MARKUP.search(html, at)
        piece = html[at : found.start()] if found else html[at:]
        if piece:
            r.text.append(piece)
            if r.in_link:
                r.link_chars += len(piece)
        if not found:
            break
        mark = found.group()
        if not mark[-1].isalpha():
            close = html.find("-->" if mark == "<!--" else ">", found.end())
            at = end if close < 0 else close + (3 if mark == "<!--" else 1)
            continue
        read = TAG.match(html, found.start() + 1)
        if not read:
            break
        at = read.end()
        tag, closing, attributes = read.group(2).lower(), bool(read.group(1)), read.group(3)
        if tag in INLINE:
            if tag == "a":
                r.in_link = 0 if closing else 1
            r.marks += not closing
        elif tag == "br":
            r.text.append(" ")
        elif tag in RAW:
            if not closing and not attributes.endswith("/"):
                r.fields += tag == "textarea"
                close = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(html, at)
                shut = html.find(">", close.end()) if close else -1
                at = end if shut < 0 else shut + 1
                r.text.append(" ")
        elif tag == "input":
            r.fields += 1
        else:
            r.fields += tag in ("button", "select")
            r.finish()
            if tag not in VOID:
                if closing:
                    r.close(tag)
                elif not (tag in HIDDEN and attributes.endswith("/")):
                    r.start(tag, attributes)
    r.finish()
    for node in r.hiders:  # outer ones first
        around = node.parent.hider
        node.hides = node.hides or bool(around and around.hides)
    return [b for b in r.blocks if not (b.path.hider and b.path.hider.hides)]


# --- labelled pages --------------------------------------------------------------------------------------------

SOUNDS = "ka lo mi ten sur ver al no pra dis el on qui ra ber sto vin che mor da fli gru os pe".split()
SHORT = "the of and to in is on der die und le la et de que y en el".split()
NOTICES = ("cookie", "consent", "notice", "banner", "gdpr", "alert", "warning", "message", "popup", "modal", "paywall")
ADVERTS = ("ad", "ads", "advert", "advertisement", "sponsor", "sponsored", "promo", "promotion", "adsense", "teaser")
SIDES = ("sidebar", "side", "aside", "widget", "related", "recommended", "trending", "popular", "more", "rail")
REMARKS = ("comments", "comment", "replies", "reply", "discussion", "disqus", "respond", "feedback", "reader")
MENUS = ("nav", "menu", "navbar", "navigation", "breadcrumb", "breadcrumbs", "topbar", "links", "tabs", "pagination")
HEADS = ("header", "masthead", "site", "branding", "logo", "top", "tagline")
FOOTS = ("footer", "foot", "bottom", "copyright", "legal", "colophon", "imprint")
FORMS = ("newsletter", "subscribe", "signup", "search", "login", "contact", "form")
SHARES = ("share", "social", "tags", "meta", "byline", "author", "tools")
BODIES = ("content", "article", "post", "entry", "story", "text", "body", "main", "page", "single")


class PageMaker:
    """Invented pages of many layouts whose article parts carry ``data-gold="1"``."""

    def __init__(self, seed: int) -> None:
        self.r = random.Random(seed)

    def word(self) -> str:
        r = self.r
        return r.choice(SHORT) if r.random() < 0.35 else "".join(r.choice(SOUNDS) for _ in range(r.randint(1, 4)))

    def words(self, low: int, high: int) -> str:
        junk = self.junk
        return " ".join(self.word() + (self.r.choice(junk) if junk else "") for _ in range(self.r.randint(low, high)))

    def sentence(self) -> str:
        said = self.words(3, 22)
        said = said.upper() if self.loud else said.capitalize()
        return said + self.r.choice((".", ".", ".", ".", "!", "?", ""))

    def prose(self, low: int = 1, high: int = 8) -> str:
        r = self.r
        said = [self.sentence() for _ in range(r.randint(low, high))]
        if r.random() < 0.15:
            said[0] = f"<{r.choice(('b', 'strong', 'em', 'i'))}>{said[0]}</b>"
        if r.random() < 0.15:
            said.append(f'<a href="/{self.word()}">{self.words(1, 4)}</a> {self.words(1, 6)}.')
        if r.random() < 0.2:
            said.insert(0, r.choice(("&amp;", "&copy;", "&quot;", "&nbsp;", "5 &lt; 6", "&mdash;")))
        return r.choice((" ", " ", "\n", "<br>")).join(said)

    def named(self, tag: str, names: tuple[str, ...], inner: str) -> str:
        r = self.r
        how = r.random()
        name = r.choice(names)
        if how < 0.3 and len(names) > 1:
            name += r.choice((" ", "-", "_")) + r.choice((r.choice(names), "box", "wrap", "inner", "block", "area"))
        attribute = f' {"id" if how > 0.8 else "class"}="{name}"'
        return f"<{tag}{attribute}>{inner}</{tag}>"

    def links(self) -> str:
        r, n = self.r, self.r.randint(2, 9)
        link = [f'<a href="/{self.word()}">{self.words(1, 3).capitalize()}</a>' for _ in range(n)]
        if r.random() < 0.7:
            return "<ul>" + "".join(f"<li>{x}</li>" for x in link) + "</ul>"
        return r.choice((" | ", " ", " &middot; ")).join(link)

    def around(self, kind: str) -> str:
        """A part of a page that is not its article."""
        r = self.r
        if kind == "menu":
            return f"<nav>{self.links()}</nav>" if r.random() < 0.5 else self.named(r.choice(("div", "nav", "ul")), MENUS, self.links())
        if kind == "head":
            inner = r.choice((f"<h1>{self.words(1, 4)}</h1>", f"<div>{self.words(1, 6)}</div>", f"<p>{self.words(2, 9)}</p>", self.links()))
            inner += self.around("menu") if r.random() < 0.3 else ""
            return f"<header>{inner}</header>" if r.random() < 0.6 else self.named("div", HEADS, inner)
        if kind == "foot":
            inner = f"{r.choice(('&copy; ', '&copy; 2020 ', 'Copyright ', ''))}{self.word()}.example {r.choice(('&middot; ', '| ', ''))}{self.prose(1, 2)}"
            inner = r.choice((inner, f"<p>{inner}</p>", f"<div>{inner}</div>{self.links()}"))
            return f"<footer>{inner}</footer>" if r.random() < 0.6 else self.named("div", FOOTS, inner)
        if kind == "ad":
            inner = r.choice((self.prose(1, 3), f"<p>{self.prose(1, 2)}</p>", f'<a href="/x">{self.words(2, 8)}</a>'))
            return self.named(r.choice(("div", "div", "aside", "section", "p")), ADVERTS, inner)
        if kind == "notice":
            inner = r.choice((self.prose(1, 3), f"<p>{self.prose(1, 3)}</p><button>{self.words(1, 2)}</button>"))
            return self.named(r.choice(("div", "section", "p", "aside")), NOTICES, inner)
        if kind == "side":
            inner = r.choice((f"<h3>{self.words(1, 3)}</h3>{self.links()}", f"<p>{self.prose(1, 3)}</p>", f"<h4>{self.words(1, 3)}</h4><p>{self.prose(1, 2)}</p>"))
            return f"<aside>{inner}</aside>" if r.random() < 0.5 else self.named(r.choice(("div", "section", "aside")), SIDES, inner)
        if kind == "form":
            inner = f"<label>{self.words(1, 3)}</label><input name=q><button>{self.words(1, 2)}</button>"
            inner = r.choice((inner, f"<p>{self.words(3, 12)}</p>{inner}"))
            return f"<form>{inner}</form>" if r.random() < 0.6 else self.named("div", FORMS, f"<form>{inner}</form>" if r.random() < 0.7 else inner)
        if kind == "share":
            return self.named(r.choice(("div", "ul", "p")), SHARES, self.words(1, 4) if r.random() < 0.5 else self.links())
        tag = r.choice(("li", "div", "article", "p"))
        said = [self.prose(1, 4) for _ in range(r.randint(1, 5))]
        inner = "".join(
            f'<{tag}{r.choice(("", " class=comment"))}>' + r.choice((x, f"<p>{x}</p>", f"<b>{self.word()}</b> {x}")) + f"</{tag}>" for x in said
        )
        inner = (f"<h3>{self.words(1, 3)}</h3>" if r.random() < 0.6 else "") + (f"<ol>{inner}</ol>" if tag == "li" else inner)
        return self.named(r.choice(("section", "div")), REMARKS, inner)

    def piece(self) -> str:
        """One block of an article."""
        r = self.r
        how = r.random()
        if how < 0.68:
            return r.choice(("<p>{}</p>", "<p>{}</p>", "<p>{}", "<div>{}</div>")).format(self.prose())
        if how < 0.78:
            return "<h{0}>{1}</h{0}>".format(r.randint(2, 4), self.words(1, 8).capitalize())
        if how < 0.86:
            rows = "".join(f"<li>{self.prose(1, 2)}</li>" for _ in range(r.randint(1, 5)))
            return r.choice(("<ul>{}</ul>", "<ol>{}</ol>")).format(rows)
        if how < 0.91:
            return f"<blockquote>{self.prose(1, 3)}</blockquote>"
        if how < 0.95:
            cells = "".join(f"<tr><td>{self.words(1, 3)}</td><td>{self.words(1, 3)}</td></tr>" for _ in range(r.randint(1, 4)))
            return f"<table>{cells}</table>"
        return f"<figure><img src=x.png><figcaption>{self.prose(1, 1)}</figcaption></figure>" if how < 0.98 else f"<pre>{self.words(2, 20)}</pre>"

    def page(self) -> str:
        r = self.r
        self.junk = r.choice(((), (), (), ("***", "###", "%%%"), ("!!",), (" |",)))
        self.loud = r.random() < 0.1
        title = self.words(2, 9).capitalize()
        head = f"<h1>{title}</h1>" if r.random() < 0.8 else f"<h2>{title}</h2>"
        if r.random() < 0.3:
            head = f"<header>{head}</header>"
        pieces = [self.piece() for _ in range(r.choice((1, 2, 3, 5, 8, 12, 20)))]
        if r.random() < 0.1:
            pieces = [self.prose(2, 9)]
        if r.random() < 0.1:  # very short articles
            head, pieces = r.choice((head, "")), [f"<p>{self.words(1, 4).capitalize()}.</p>" for _ in range(r.randint(1, 3))]
        for kind in ("ad", "share", "side", "notice"):
            if r.random() < 0.2:
                part = self.around(kind).replace("<", '<gold data-gold="0"><', 1) + "</gold>"
                pieces.insert(r.randint(0, len(pieces)), part)
        if r.random() < 0.15:
            pieces.append('<gold data-gold="0">' + self.around("comments") + "</gold>")
        body = head + "".join(pieces)
        how = r.random()
        if how < 0.6:
            body = f'<article data-gold="1">{body}</article>'
        elif how < 0.75:
            body = f'<main data-gold="1">{body}</main>'
        else:
            tag, name = r.choice(("div", "section", "td")), r.choice(BODIES)
            name += r.choice(("", "", "-body", "-text", " main", "-inner"))
            named = f' class="{name}"' if r.random() < 0.75 else ""
            body = f'<{tag}{named} data-gold="1">{body}</{tag}>'
        if r.random() < 0.3:
            body = self.named("div", BODIES + ("wrap", "container", "row"), body)
        before = [k for k in ("notice", "head", "menu", "ad", "side", "form", "share") if r.random() < 0.4]
        after = [k for k in ("share", "ad", "comments", "form", "side", "foot", "notice") if r.random() < 0.4]
        bare = r.random()  # some pages begin or end with their article
        before, after = ([] if bare < 0.35 else before), ([] if 0.15 < bare < 0.5 else after)
        inner = "".join(self.around(k) for k in before) + body + "".join(self.around(k) for k in after)
        ends = "</body></html>" if r.random() < 0.8 else ""
        return f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{margin:0}}</style></head><body>{inner}{ends}"


def labelled_pages(n: int, seed: int = 5) -> list[list[Block]]:
    """Blocks with labels of ``n`` invented pages; the label marks are in no feature."""
    maker = PageMaker(seed)
    pages = [leaf_blocks(maker.page()) for _ in range(n)]
    return [[b._replace(path=tuple(e for e in b.path.path() if e.tag != "gold")) for b in page] for page in pages if page]
