"""A page as a tree of block elements and the texts of its blocks.

Tags are found by one expression, so the work goes with a page's length. Inline
elements are no nodes: they are part of a block's text. Unclosed elements end
where a browser would end them.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

#: Fixed values of HTML: elements by how they are read.
VOID = frozenset("area base basefont bgsound br col embed frame hr img input keygen link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe xmp noembed noframes plaintext".split())
INLINE = frozenset("a abbr acronym b bdi bdo big blink br cite code data del dfn em font i ins kbd label mark nobr q rb rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
IN_HEAD = frozenset("title style script noscript template base basefont bgsound link meta".split())
#: Fixed values of HTML: which open elements a start tag ends, and the elements beyond which it does not look.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "optgroup": ("option", "optgroup"), "tbody": ("tr", "td", "th", "thead", "tbody"), "tfoot": ("tr", "td", "th", "thead", "tbody"), "thead": ("tr", "td", "th")}
FENCES = frozenset("ul ol dl table select menu html body article section div".split())
#: Elements and roles that hold no main text.
ASIDE = frozenset("script style noscript template nav aside footer form button select option textarea iframe object svg canvas audio video map dialog menu head title noembed noframes".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar tablist".split())
#: Words of a class or an id that name what is beside the main text.
ASIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertisements advertising banner breadcrumb breadcrumbs byline comment comments commentlist consent cookie cookies copyright discussion disqus footer gdpr header legal login masthead menu menus modal nav navbar navigation newsletter notice notices notification overlay pager pagination popup promo promoted promotion related replies reply respond share sharing sidebar signup social sponsor sponsored sponsors subscribe subscription tagcloud toolbar widget widgets".split()
)
HEADER_WORDS = frozenset(["header", "masthead"])
#: Of these, words of what may hold articles of its own; the others may also tell what is around the main text (``with-sidebar``).
APART_WORDS = frozenset("ad ads advert adverts advertisement advertisements comment comments commentlist discussion disqus related replies reply respond sponsored".split())

_TAG = re.compile(r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*+)>", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_DIGITS = re.compile(r"[0-9]+")
#: Levels below which elements stand beside each other, so that no page nests without end.
DEPTH = 200


@dataclass
class Block:
    """Text of one block, its node, and how many of its characters are a link's."""

    text: str
    node: int
    linked: int


@dataclass
class Page:
    """Nodes by number, parents first: tag, label, parent, and whether a node stands beside the main text."""

    tags: list[str] = field(default_factory=list)
    labels: list[str] = field(default_factory=list)
    parents: list[int] = field(default_factory=list)
    #: None for main text, else "aside", "named" (by a class only) or "header".
    kinds: list[str | None] = field(default_factory=list)
    mains: list[str | None] = field(default_factory=list)
    blocks: list[Block] = field(default_factory=list)


def _attributes(raw: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(raw):
        value = m[2] if m[2] is not None else m[3] if m[3] is not None else m[4] or ""
        found.setdefault(m[1].lower(), unescape(value) if "&" in value else value)
    return found


def _kind(tag: str, own: dict[str, str]) -> str | None:
    if tag in ASIDE or own.get("role", "").lower() in ASIDE_ROLES or "hidden" in own or own.get("aria-hidden", "").lower() == "true" or "display:none" in own.get("style", "").replace(" ", "").lower():
        return "aside"
    if tag == "header":
        return "header"
    named = own.get("class", "") + " " + own.get("id", "")
    words = {w.lower() for w in _WORD.findall(named)} & ASIDE_WORDS if named != " " else ()
    if not words:
        return None
    return "aside" if words & APART_WORDS and tag not in ("article", "main") else "header" if words <= HEADER_WORDS else "named"


def parse(html: str) -> Page:
    """The nodes and blocks of a page."""
    page = Page(["#"], ["#"], [-1], [None], [None])
    #: Open elements: (tag, node, dropped, linked).
    stack: list[tuple[str, int, bool, bool]] = [("#", 0, False, False)]
    opened: dict[str, int] = {}
    pieces: list[str] = []
    linked, at, n = 0, 0, len(html)

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                page.blocks.append(Block(text, node(), linked))
            pieces.clear()
            linked = 0

    def node() -> int:
        return stack[-1][1]

    def pop() -> None:
        tag = stack.pop()[0]
        opened[tag] -= 1

    def push(tag: str, number: int, dropped: bool, link: bool) -> None:
        stack.append((tag, number, dropped, link))
        opened[tag] = opened.get(tag, 0) + 1

    def add(raw: str) -> None:
        nonlocal linked
        _, _, dropped, link = stack[-1]
        if dropped:
            return
        text = unescape(raw) if "&" in raw else raw
        pieces.append(text)
        if link:
            linked += len(text)

    while at < n:
        m = _TAG.search(html, at)
        if not m:
            add(html[at:])
            break
        if m.start() > at:
            add(html[at : m.start()])
        at = m.end()
        close, name, raw = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not name:
            continue
        tag = name.lower()
        if close:
            if tag == "p" and not opened.get("p"):
                flush()
            if not opened.get(tag):
                continue
            if tag in INLINE:
                for k in range(len(stack) - 1, max(len(stack) - 64, 0), -1):
                    if stack[k][0] not in INLINE:
                        break
                    if stack[k][0] == tag:
                        while len(stack) > k:
                            pop()
                        break
                continue
            flush()
            while stack[-1][0] != tag:
                pop()
            pop()
            continue
        own = _attributes(raw) if raw and not raw.isspace() else {}
        _, _, dropped, link = stack[-1]
        if tag in INLINE:
            if tag == "br":
                add(" ")
            elif tag not in VOID and not raw.endswith("/"):
                push(tag, node(), dropped or bool(own and _kind(tag, own)), link or tag == "a")
            continue
        flush()
        if opened.get("head") and tag not in IN_HEAD:
            while opened["head"]:
                pop()
        if opened.get("p") and not (tag in VOID and tag != "hr"):
            while stack[-1][0] != "p":
                pop()
            pop()
        ended = ENDS.get(tag, ())
        if any(opened.get(t) for t in ended):
            for k in range(len(stack) - 1, max(len(stack) - 64, 0), -1):
                if stack[k][0] in ended:
                    while len(stack) > k:
                        pop()
                    break
                if stack[k][0] in FENCES:
                    break
        while len(stack) > 1 and stack[-1][0] in INLINE and stack[-1][0] != "a" and not stack[-1][2]:
            pop()
        if tag in VOID:
            continue
        _, _, dropped, link = stack[-1]
        named = f".{own.get('class', '')}#{own.get('id', '')}" if own.get("class") or own.get("id") else ""
        label = tag + " ".join(_DIGITS.sub("", named).split())
        page.tags.append(tag)
        page.labels.append(label)
        page.parents.append(node())
        page.kinds.append(_kind(tag, own) if tag not in ("html", "body") else None)
        page.mains.append("article" if tag == "article" or own.get("role") == "article" or own.get("itemprop") == "articleBody" else "main" if tag == "main" or own.get("role") == "main" else None)
        number = len(page.tags) - 1
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(html, at)
            at = end.end() if end else n
            continue
        if raw.endswith("/") and tag in ("svg", "path", "use", "circle", "rect"):
            continue
        if len(stack) < DEPTH:
            push(tag, number, dropped, link)
    flush()
    return page
