"""Reading an HTML page as a sequence of text blocks with their place on the page."""

from __future__ import annotations

import re
from html import unescape
from typing import NamedTuple

# Elements by what they mean for the text of a page.
_RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noscript"}
_FOREIGN = {"svg", "math"}
_FURNITURE = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "button", "select", "head", "object", "canvas", "audio", "video", "datalist", "template"}
_CONTAINER = {"article", "main"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_BLOCK = {
    "address", "article", "aside", "blockquote", "body", "br", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset",
    "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav",
    "ol", "optgroup", "option", "p", "pre", "search", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alertdialog", "alert", "menu", "menubar", "toolbar"}
# Class and id names of parts that do not belong to an article, alone or as the first part of a name. Inside an article
# such a first part is only a hint: share-price and header-2 may well be the article's.
_NAMES = re.compile(
    r"^(ads?|adverts?|advertisement|advertising|adsbygoogle|sponsor(ed)?|promo(tion)?|banner|cookies?|consent|gdpr|notice|notification|alert|popup|modal|overlay|"
    r"sidebar|side-?bar|nav|navbar|navigation|menu|breadcrumbs?|footer|header|masthead|topbar|comments?|commentlist|disqus|respond|replies|newsletter|subscribe|"
    r"signup|login|share|sharing|social|related|recommended|widget|pagination|skip-link)([-_].*)?$",
    re.I,
)
_COMMENTS = re.compile(r"^(comments?|commentlist|disqus|respond|replies|sidebar|related|recommended)([-_].*)?$", re.I)
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_REST = re.compile(r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+>""")
_ATTRIBUTE = re.compile(r"""(?<![^\s"'/])(class|id|role|itemprop|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)


class Block(NamedTuple):
    """White-space-normalised text; whether it stands in an article; whether markup says it is page furniture, or hints at it."""

    text: str
    inside: bool
    furniture: bool
    hint: bool = False


def _named(names: list[str], pattern: re.Pattern) -> tuple[bool, bool]:
    """Whether a name is one of the pattern's, and whether one only begins with it."""
    found = [m for m in map(pattern.match, names) if m]
    whole = any(m[m.lastindex] is None or not m[m.lastindex].startswith(("-", "_")) for m in found)
    return whole, bool(found) and not whole


def _kind(name: str, rest: str, inside: bool) -> tuple[bool, bool, bool, bool]:
    """Whether an element is furniture, whether that includes articles inside it, whether it holds the article, and whether its name hints at furniture."""
    found = {m[1].lower(): (m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(rest)} if rest else {}
    names = f"{found.get('class', '')} {found.get('id', '')}".split()
    role = found.get("role", "").lower()
    named, begins = _named(names, _NAMES)
    commented, hinted = _named(names, _COMMENTS)
    if not inside:
        named, commented = named or begins, commented or hinted
    deep = name in ("aside", "footer", "template") or commented or "hidden" in found or found.get("aria-hidden") == "true"
    container = name in _CONTAINER or role == "main" or found.get("itemprop", "").lower() == "articlebody"
    if name in ("body", "html"):
        return False, False, False, False
    if container:
        return deep, deep, not deep, False
    furniture = name in _FURNITURE or named or deep or role in _ROLES
    return furniture, deep, False, inside and begins and not furniture


def blocks_of(html: str) -> list[Block]:
    """The text blocks of a page in order, without those that are empty.

    An element that markup leaves open ends with the page or with the element around it; an open svg or math
    element also ends at the next block. A script, style, textarea, title or xmp element without an end takes the rest of
    the page, as in browsers; an iframe or noscript element without one is passed over. An article
    inside furniture counts as article, but not inside comments, asides, footers and hidden parts.
    A header inside an article belongs to it.
    """
    out: list[Block] = []
    parts: list[str] = []
    stack: list[tuple[str, bool, bool, bool, bool]] = []  # open elements that matter, with the state before them
    inside = furniture = deep = hint = False
    linked, link_at = 0, -1  # letters of the block in links, and the parts before an open link
    drawing, level, kept = "", 0, 0  # an open svg or math element, how many are nested, and the parts before it
    at, n = 0, len(html)

    def flush() -> None:
        nonlocal linked, link_at
        if parts:
            if link_at >= 0:
                linked += sum(map(len, parts[link_at:]))
                link_at = 0
            size = sum(map(len, parts))
            text = " ".join(unescape("".join(parts)).split())
            parts.clear()
            if text:
                # A part that is named like furniture and consists of links is furniture.
                links = hint and 2 * linked > size
                out.append(Block(text, inside, furniture or links, hint and not (furniture or links)))
        linked = 0

    while at < n:
        mark = html.find("<", at)
        if mark < 0:
            parts.append(html[at:])
            break
        if mark > at:
            parts.append(html[at:mark])
        if html.startswith("<!--", mark):
            end = html.find("-->", mark + 4)
            at = n if end < 0 else end + 3
            continue
        close = html.startswith("</", mark)
        name_at = _NAME.match(html, mark + 1 + close)
        if not name_at:
            if html.startswith(("<!", "<?", "</"), mark):
                end = html.find(">", mark)
                at = n if end < 0 else end + 1
            else:  # a plain less-than sign
                parts.append("<")
                at = mark + 1
            continue
        name = name_at[0].lower()
        rest = _REST.match(html, name_at.end())
        end = rest.end() if rest else html.find(">", name_at.end()) + 1
        if not end:  # the page ends inside a tag
            break
        attributes = html[name_at.end() : end - 1]
        at = end
        if name in _FOREIGN and not attributes.endswith("/") and drawing in ("", name):
            # Drawings and formulas hold no text of the page; they stand inside a line, so they end no block.
            level += -1 if close else 1
            if not close and level == 1:
                drawing, kept = name, len(parts)
            elif close and level <= 0:
                if drawing:
                    del parts[kept:]
                drawing, level = "", 0
            continue
        if drawing and name in _BLOCK:
            del parts[kept:]
            drawing, level = "", 0
        if name in _BLOCK:
            flush()
            while stack and stack[-1][0] == "p" and (not close or name != "p"):  # a block ends an open paragraph
                inside, furniture, deep, hint = stack.pop()[1:]
        if name == "a" and not drawing:
            if link_at >= 0:
                linked += sum(map(len, parts[link_at:]))
            link_at = -1 if close else len(parts)
        if close:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    if drawing:
                        del parts[kept:]
                        drawing, level = "", 0
                    flush()
                    inside, furniture, deep, hint = stack[i][1:]
                    del stack[i:]
                    break
            continue
        if name in _RAW:
            shut = re.compile(f"</{re.escape(name)}(?=[\\s/>])", re.I).search(html, at)
            if shut is None and name in ("iframe", "noscript"):
                continue
            if shut is None:
                break
            at = html.find(">", shut.end()) + 1 or n
            continue
        if drawing or name in _VOID or attributes.endswith("/"):
            continue
        if name in _BLOCK or name in _FURNITURE or "=" in attributes or "hidden" in attributes:
            is_furniture, is_deep, holds, hints = _kind(name, attributes, inside)
            if not (is_furniture or holds or hints or stack and name in {s[0] for s in stack}):
                continue
            flush()
            stack.append((name, inside, furniture, deep, hint))
            if is_furniture and not (inside and name == "header" and not is_deep):
                furniture, deep = True, deep or is_deep
            elif holds and not deep:
                inside, furniture = True, False
            hint = hint or hints
    if drawing:
        del parts[kept:]
    flush()
    return out
