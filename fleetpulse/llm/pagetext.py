"""The blocks of one web page: text, and the containers that hold it."""

from __future__ import annotations

import html
import re
from collections import Counter

# Element names of HTML by role.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody "
    "td tfoot th thead tr ul".split()
)
CONTAINERS = set("html body main article section div td center details".split())
DROPPED = set(
    "head script style noscript template textarea title xmp iframe noembed noframes nav header footer aside form button select "
    "menu dialog svg math canvas object audio video map".split()
)
# Class and id words of what is not the article, and page roles.
BOILERPLATE = set(
    "nav navbar navigation menu menus submenu breadcrumb breadcrumbs header masthead topbar footer foot sidebar aside rail ad ads adv advert "
    "adverts advertisement advertisements advertising sponsor sponsored sponsors promo promotion banner cookie cookies consent "
    "gdpr notice notices notification notifications alert alerts disclaimer copyright popup modal overlay newsletter subscribe subscription signup "
    "login share sharing social comment comments commentlist respond reply replies disqus discussion related recommended recommendations "
    "widget widgets pagination pager paging toolbar search form hidden skip".split()
)
# Of these, what holds readers' words, however much of the page that is.
READERS = set("comment comments commentlist respond reply replies disqus discussion".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
# Elements that a start tag of the same group ends when they are still open inside the nearest holder.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
HOLDERS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
# What still encloses an open paragraph, so that a new block does not end it.
SCOPES = {"button", "td", "th", "caption", "object", "html"}
KEEPS_PARAGRAPH = BLOCK - {"body", "head", "html", "tbody", "td", "tfoot", "th", "thead", "tr", "caption", "option", "optgroup", "legend"}

TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))"
    r"|<(?:[!?]|/(?![a-zA-Z]))[^>]*(?:>|\Z)"
    r"|</(?P<end>[a-zA-Z][^\s/>]*)[^>]*>"
    r"|<(?P<start>[a-zA-Z][^\s/>]*)(?P<rest>(?>[^<>\"']|\"[^\"]*\"|'[^']*')*+|[^<>]*)>",
    re.S,
)
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`]+)))?""")
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")


def attributes(text: str) -> dict[str, str]:
    if not text or text.isspace():
        return {}
    found: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(text):
        found.setdefault(m[1].lower(), html.unescape(m[2] or m[3] or m[4] or ""))
    return found


def named_boilerplate(tag: str, attrs: dict[str, str]) -> set[str]:
    """The words in an element's class and id that say it is not the article."""
    found: set[str] = set()
    if tag not in ("html", "body", "main"):
        for name in f"{attrs.get('class', '')} {attrs.get('id', '')}".split():
            words = [p for p in (p.lower() for p in PART.findall(name)) if not p.isdigit()]
            if words and not {"has", "with", "no", "without"} & set(words):
                found |= {words[0], words[-1]} & BOILERPLATE
    return found


def is_boilerplate(tag: str, attrs: dict[str, str]) -> bool:
    """Is the element a menu, script, form and the like by its tag or role, or hidden?"""
    if tag in DROPPED or "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true" or attrs.get("role", "").lower() in ROLES:
        return True
    style = attrs.get("style", "").lower() if tag not in ("html", "body", "main") else ""
    return re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", style) is not None


def general_step(tag: str, attrs: dict[str, str]) -> str:
    """Tag and classes with what differs from page to page (digits) left out."""
    classes = sorted({re.sub(r"\d+", "#", c) for c in attrs.get("class", "").split()})
    return ".".join([tag, *classes])


# How much of an open element is text of the page.
INSIDE, HEADINGS_ONLY, NAMED, OUTSIDE = range(4)


class Page:
    """``blocks``: (container, text, characters inside links); ``steps``, ``parents`` and ``tags`` by container.

    Markup errors are forgiven: a close tag without its element is skipped, an open element ends
    with the one around it, and a block's start tag ends an open paragraph. Nesting may be of any depth.

    An element whose class or id names something else than an article is left out, unless it has the page's main
    heading (h1) and more than half of its text outside links; readers' comments are left out in any case. Of a
    header inside an article only the headings are text.
    """

    def __init__(self, source: str):
        self._read(source, frozenset())
        trusted = frozenset(k for k, (chars, titled) in self._named.items() if titled and 2 * chars > self._sums[0][0])
        if trusted:
            self._read(source, trusted)

    def _read(self, source: str, trusted: frozenset[int]) -> None:
        self.steps: list[str] = [""]
        self.parents: list[int] = [-1]
        self.tags: list[str] = [""]
        self.blocks: list[tuple[int, str, int]] = []
        self._trusted = trusted
        self._named: dict[int, tuple[int, bool]] = {}  # by number: characters outside links, and is there an h1?
        self._numbers = 0
        self._parts: list[str] = []
        self._linked = 0
        self._stack: list[tuple[str, int, bool, int, int]] = [("", INSIDE, False, 0, 0)]
        self._sums: list[list] = [[0, False]]  # of each open element, as in _named
        self._open_tags: Counter[str] = Counter()
        at = 0
        while m := TOKEN.search(source, at):
            self._text(source[at : m.start()])
            at = m.end()
            if m["start"]:
                tag = m["start"].lower()
                self._open(tag, m["rest"])
                if tag in RAW and not m["rest"].endswith("/"):
                    close = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(source, at)
                    at = close.end() if close else len(source)
                    self._close(tag)
            elif m["end"]:
                self._close(m["end"].lower())
        self._text(source[at:])
        self._flush()
        self._shrink(1)

    def _text(self, raw: str) -> None:
        _, out, linked, _, _ = self._stack[-1]
        if not raw or out == OUTSIDE:
            return
        if out != HEADINGS_ONLY and not linked:
            self._sums[-1][0] += len(raw) - raw.count(" ")
        if out != INSIDE:
            return
        text = html.unescape(raw) if "&" in raw else raw
        self._parts.append(text)
        if linked:
            self._linked += len("".join(text.split()))

    def _flush(self) -> None:
        if self._parts:
            text = " ".join("".join(self._parts).split())
            if text:
                self.blocks.append((self._stack[-1][3], text, self._linked))
            self._parts, self._linked = [], 0

    def _shrink(self, size: int) -> None:
        """Close elements until ``size`` are open; what they hold counts for the ones around them."""
        while len(self._stack) > size:
            tag, _, _, _, number = self._stack.pop()
            chars, titled = self._sums.pop()
            self._open_tags[tag] -= 1
            self._sums[-1][0] += chars
            self._sums[-1][1] |= titled
            if number:
                self._named[number] = (chars, titled)

    def _pop(self, tags: set[str], holders: set[str]) -> None:
        if not any(self._open_tags[tag] for tag in tags):
            return
        for k in range(len(self._stack) - 1, 0, -1):
            if self._stack[k][0] in holders:
                return
            if self._stack[k][0] in tags:
                self._shrink(k)
                return

    def _open(self, tag: str, rest: str) -> None:
        if tag == "br":
            self._parts.append(" ")
            return
        if tag in BLOCK:
            self._flush()
            if tag in KEEPS_PARAGRAPH:
                self._pop({"p"}, SCOPES)
            if tag in ENDS:
                self._pop(ENDS[tag], HOLDERS[tag])
        if tag in VOID:
            return
        attrs = attributes(rest)
        _, out, linked, container, _ = self._stack[-1]
        number = 0
        if out != OUTSIDE:
            if tag == "header" and (self._open_tags["article"] or self._open_tags["main"]) and not is_boilerplate("div", attrs):
                out = max(out, HEADINGS_ONLY)
            elif is_boilerplate(tag, attrs):
                out = OUTSIDE
            elif named := named_boilerplate(tag, attrs):
                self._numbers = number = self._numbers + 1
                out = OUTSIDE if named & READERS else out if number in self._trusted else NAMED
            elif out == HEADINGS_ONLY and tag in HEADINGS:
                out = INSIDE
        if tag in CONTAINERS and out == INSIDE:
            self.steps.append(general_step(tag, attrs))
            self.parents.append(container)
            self.tags.append(tag)
            container = len(self.steps) - 1
        self._stack.append((tag, out, linked or tag == "a", container, number))
        self._sums.append([0, tag == "h1" and out != OUTSIDE])
        self._open_tags[tag] += 1
        if rest.endswith("/") and tag in ("svg", "math", "path", "use"):
            self._shrink(len(self._stack) - 1)

    def _close(self, tag: str) -> None:
        if tag in BLOCK:
            self._flush()
        if tag == "br":
            self._parts.append(" ")
            return
        if self._open_tags[tag]:
            at = len(self._stack) - 1
            while self._stack[at][0] != tag:
                at -= 1
            self._shrink(at)

    def path(self, container: int) -> str:
        """A container's path from the root: the general steps of those around it and its own."""
        steps = []
        while container > 0:
            steps.append(self.steps[container])
            container = self.parents[container]
        return "".join(f"/{step}" for step in reversed(steps))

    def best(self, share: float = 0.8) -> tuple[str, int]:
        """The path of the container that holds the article, and its characters of text; the empty path is
        the whole page.

        That is the innermost article or main that holds ``share`` of all text outside links, but none that
        leaves such text of another one outside. Without one it is the deepest container outside of which no
        text but links is left, so headings and leads stay with the body they stand beside.
        """
        held = [0] * len(self.steps)
        for container, text, linked in self.blocks:
            held[container] += max(0, len(text) - 2 * linked)
        for k in range(len(held) - 1, 0, -1):
            held[self.parents[k]] += held[k]
        marked, k = -1, 0
        for j in range(1, len(held)):  # children follow their parents
            if self.tags[j] in ("article", "main") and held[j] and held[j] >= (share * held[0] if marked < 0 else held[marked]):
                marked = j
            if self.parents[j] == k and held[j] == held[k] and held[j]:
                k = j
        k = marked if marked >= 0 else k
        return self.path(k), held[k]

    def text(self, path: str) -> str | None:
        """The blocks inside containers of this path, or nothing if the page has none."""
        inside = [path == ""] * len(self.steps)
        reached = [0] + [-1] * (len(self.steps) - 1)  # how much of the path leads to a container
        for k in range(1, len(self.steps)):
            parent, step = self.parents[k], "/" + self.steps[k]
            if reached[parent] >= 0 and path.startswith(step, reached[parent]):
                reached[k] = reached[parent] + len(step)
            inside[k] = inside[parent] or reached[k] == len(path)
        if not any(inside):
            return None
        return "\n\n".join(text for container, text, _ in self.blocks if inside[container])
