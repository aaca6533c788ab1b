"""Blocks of text of one HTML page, each with the part of the page that it stands in."""

from __future__ import annotations

import re
from html import unescape

# Element names by what they do to the text.
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split())
#: Cells and line breaks part words but not blocks.
SPACED = frozenset("br td th".split())
#: Elements that hold no part of an article.
APART = frozenset("nav aside footer form head script style noscript template iframe object svg math canvas button select textarea dialog menu audio video map applet datalist".split())
ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar toolbar form".split())
#: Words of class and id that mark an element as something beside the article.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adbox adsense sponsor sponsored sponsors promo promos promoted promotion banner cookie cookies consent gdpr notice notices notification alert popup modal overlay "
    "newsletter subscribe subscription signup paywall sidebar related recommended recommendations share sharing social breadcrumb breadcrumbs menu nav navbar navigation topbar masthead header footer toolbar pagination pager "
    "search login copyright legal disclaimer skip".split()
)
#: Words that mark what readers wrote; an article element inside is theirs.
READERS = frozenset("comment comments commentlist reply replies respond disqus discussion feedback reviews".split())
#: Elements that an opening one closes when they are still open, though nothing closed them.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "article": {"p"}, "body": {"head"}}

_TOKEN = re.compile(
    r"""<!--(?:.*?-->|.*\Z)|<[!?][^>]*>?|<(/?)([A-Za-z][^\s/>]*)((?:[^'">]|"[^"]*"|'[^']*')*+)>|<(/?)([A-Za-z][^\s/>]*)([^>]*)>|<""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")


class Block:
    """Text of a block, its element, how deep in the article it is (2 article, 1 main, 0 elsewhere) and its linked characters."""

    __slots__ = ("text", "tag", "level", "linked")

    def __init__(self, text: str, tag: str, level: int, linked: int) -> None:
        self.text, self.tag, self.level, self.linked = text, tag, level, linked


def _attributes(source: str) -> dict[str, str]:
    return {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(source)} if source.strip("/ \t\r\n") else {}


def _kind(tag: str, source: str, level: int) -> str:
    """``readers``, ``apart`` (by name or role), ``marked`` (by class or id), ``head`` (a header in the article) or nothing."""
    if tag in APART:
        return "apart"
    held = _attributes(source)
    if not held:
        return ("head" if level == 2 else "apart") if tag == "header" else ""
    words = {w.lower() for w in _NAME_WORD.findall(f"{held.get('class', '')} {held.get('id', '')}")}
    if words & READERS:
        return "readers"
    if tag == "header":
        return "head" if level == 2 else "apart"
    if held.get("role", "").lower() in ROLES or "hidden" in held or held.get("aria-hidden", "").lower() == "true" or "display:none" in held.get("style", "").replace(" ", "").lower():
        return "apart"
    if tag in ("html", "body", "main", "article") or tag in INLINE and tag != "span" or re.fullmatch("h[1-6]", tag):
        return ""
    if "header" in words and level == 2 and not words & (MARKS - {"header"}):
        return "head"
    return "marked" if words & MARKS else ""


def blocks(html: str) -> list[Block]:
    """Blocks outside menus, headers, footers, sidebars, notices, adverts, forms, scripts and comments, in page order.

    Markup may be broken: an end tag closes what is open inside its element, one without a
    start is left out, and what is open at the end ends there. An article or main element that
    opens inside an element set aside by its class alone shows that this one was left open.
    """
    out: list[Block] = []
    #: Open elements: name, kind, level before it.
    stack: list[tuple[str, str, int]] = []
    level, shut, links, head, tag = 0, 0, 0, 0, ""
    parts: list[str] = []
    linked = 0
    at, size = 0, len(html)

    def flush() -> None:
        nonlocal parts, linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append(Block(text, tag, level, min(linked, len(text))))
        parts, linked = [], 0

    def close(k: int) -> None:
        """Close the open elements from the k-th on."""
        nonlocal level, shut, links, head
        for _ in range(len(stack) - k):
            name, kind, before = stack.pop()
            shut -= kind in ("apart", "marked", "readers")
            head -= kind == "head"
            links -= name == "a"
            level = before

    while at < size:
        m = _TOKEN.search(html, at)
        end = m.start() if m else size
        if end > at and not shut and (not head or re.fullmatch("h[1-6]", tag)):
            piece = unescape(html[at:end])
            parts.append(piece)
            linked += len(piece) if links else 0
        if not m:
            break
        at = m.end()
        name = m[2] or m[5]
        if not name:
            if m[0] == "<" and not shut:
                parts.append("<")
            continue
        name, closing, source = name.lower(), (m[1] or m[4]) == "/", m[3] or m[6] or ""
        if name in SPACED:
            parts.append(" ")
        elif name not in INLINE:
            flush()
        if closing:
            k = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), -1)
            if k >= 0 and (name not in INLINE or all(x[0] in INLINE for x in stack[k:])):
                close(k)
            if name not in INLINE:
                tag = stack[-1][0] if stack else ""
            continue
        if name in RAW and not source.endswith("/"):
            stop = re.compile(rf"</{name}[\s/>]", re.I).search(html, at)
            at = stop.start() if stop else size
        if name in VOID:
            continue
        if name not in INLINE:
            tag = name
        if name in CLOSES or name not in INLINE:
            closes = CLOSES.get(name, set()) | ({"p"} if name not in INLINE else set())
            k = len(stack)
            while k and (stack[k - 1][0] in INLINE or stack[k - 1][0] in closes):
                k -= 1
            if any(x[0] in closes for x in stack[k:]):
                close(k)
        if source.endswith("/") and name in ("svg", "math", "path"):
            continue
        kind = _kind(name, source, level)
        if name in ("main", "article") and not kind and shut:
            k = next(i for i, x in enumerate(stack) if x[1] in ("apart", "marked", "readers"))
            if stack[k][1] == "marked" and not any(x[1] in ("apart", "readers") for x in stack[k:]):
                close(k)
        stack.append((name, kind, level))
        shut += kind in ("apart", "marked", "readers")
        head += kind == "head"
        links += name == "a"
        level = max(level, 2 if name == "article" and not shut else 1 if name == "main" or "role=\"main\"" in source else 0)
    flush()
    return out


def article_blocks(html: str) -> list[Block]:
    """Blocks of the article element, else of the main element, else those of the page that are not mostly links."""
    found = blocks(html)
    top = max((b.level for b in found), default=0)
    if top:
        return [b for b in found if b.level == top]
    return [b for b in found if 2 * b.linked < len(b.text) or not b.linked]
