"""HTML as a run of tags and text, and its lines of text by zone."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

OPEN, MAIN, ASIDE = 0, 1, 2           # zones: unmarked, the article, what stands around it
NAMED, CLOSED, CARD = 3, 4, 5         # while reading: around it by its whole name, without an article in it, an article in a named one

#: Elements whose content is not text, elements that end a line, elements that nest, zones by element,
#: by role, and by a part of a class or id.
RAW = ("script", "style", "noscript", "template", "svg", "math", "iframe", "object", "textarea", "select", "title", "head")
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup option p pre
section summary table tbody td tfoot th thead tr ul""".split())
NESTING = frozenset("article aside button details dialog div fieldset figure footer form header main menu nav ol section table ul".split())
ASIDE_ELEMENTS = frozenset("aside button dialog footer form menu nav".split())
ASIDE_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
ASIDE_NAMES = frozenset("""ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent
cookie cookies copyright disqus footer gdpr header masthead menu modal nav navbar navigation newsletter notice notices pagination
pager popup promo promoted recommended related respond share sharing sidebar social sponsor sponsored subscribe toolbar widget
widgets""".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|svg|math|iframe|object|textarea|select|title)\b[^>]*>(?P<inner>.*?)(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<[!?/][^>]*>", re.S | re.I)
_ATTR = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_PART = re.compile(r"[\s_-]+")


def attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTR.finditer(text)}


def events(page: str) -> Iterator[tuple[str, str, str]]:
    """("text", "", text), ("open", name, attributes), ("close", name, ""),
    ("raw", name, content); character references in text are decoded."""
    at = 0
    for m in _TAG.finditer(page):
        if m.start() > at:
            yield "text", "", page[at:m.start()]
        at = m.end()
        if m["raw"]:
            yield "raw", m["raw"].lower(), m["inner"]
        elif m["name"]:
            name = m["name"].lower()
            yield ("close", name, "") if m["close"] else ("open", name, m["attrs"])
    if at < len(page):
        yield "text", "", page[at:]


def _marked(a: dict[str, str]) -> int:
    """How attributes mark surroundings: 3 by role or as hidden, 2 by a whole
    class or id, 1 by a part of one (as in no-sidebar) or as a form, 0 not."""
    role, names = a.get("role", "").lower(), f"{a.get('class', '')} {a.get('id', '')}".lower()
    if role in ASIDE_ROLES and role != "form" or "hidden" in a or a.get("aria-hidden") == "true":
        return 3
    if any(name in ASIDE_NAMES for name in names.split()):
        return 2
    return int(role == "form" or any(part in ASIDE_NAMES for part in _PART.split(names)))


def _zone_of(name: str, attrs: str, outer: int) -> int:
    if outer == CLOSED:
        return CLOSED
    inside = outer in (MAIN, CARD)
    a = attributes(attrs) if attrs else {}
    marked = _marked(a)
    if name in ("article", "main") or a.get("role", "").lower() in ("main", "article"):
        if outer == ASIDE and marked > 1 or outer == NAMED and marked and name != "main":
            return outer
        return CARD if outer in (NAMED, CARD) and name != "main" else MAIN
    if name in ASIDE_ELEMENTS and name != "form" or name == "header" and not inside or marked == 3:
        return CLOSED
    marked = max(marked, int(name == "form"))
    if not marked:
        return outer
    if inside:
        return CLOSED
    return NAMED if marked == 2 or outer == NAMED else ASIDE


def lines(page: str, break_ends_line: bool = False) -> list[tuple[str, int]]:
    """The text of each block that has any, white space as one space, and its
    zone.  Markup that is cut off or left open ends with the page.

    An article or main element opens the article's zone also inside a form or
    what a part of its class marks as surroundings; inside what its whole class
    or id marks so, an article does if the page has no other.  Inside menus,
    footers and the like, and inside an article's own surroundings, none does."""
    out: list[tuple[str, int]] = []
    stack: list[tuple[str, int]] = []
    text: list[str] = []
    zone = OPEN

    def flush() -> None:
        joined = "".join(text)
        text.clear()
        line = " ".join((html.unescape(joined) if "&" in joined else joined).split())
        if line:
            out.append((line, zone))

    for kind, name, content in events(page):
        if kind == "text":
            text.append(content)
        elif kind != "raw":
            if name == "br":
                if break_ends_line:
                    flush()
                else:
                    text.append(" ")
            elif name in BLOCKS or name in NESTING or content and kind == "open":
                if name in BLOCKS or name in NESTING:
                    flush()
                if name in NESTING:
                    if kind == "open":
                        if not content.endswith("/"):
                            stack.append((name, zone := _zone_of(name, content, zone)))
                    else:
                        for i in range(len(stack) - 1, -1, -1):
                            if stack[i][0] == name:
                                del stack[i:]
                                break
                            if stack[i][0] in ("article", "main"):
                                break
                        zone = stack[-1][1] if stack else OPEN
    flush()
    card = ASIDE if any(z == MAIN for _, z in out) else MAIN
    return [(line, z if z <= ASIDE else card if z == CARD else ASIDE) for line, z in out]
