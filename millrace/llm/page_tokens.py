"""A page of HTML as a stream of tokens, put down as the nodes of its key paths and its blocks of text."""

from __future__ import annotations

import re
from html import unescape

# --- fixed values: elements by what they do -----------------------------------------------------------
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())  # no tags inside
UNSEEN = frozenset(
    "head script style textarea title iframe noembed noframes template noscript svg canvas object audio video "
    "select button option datalist optgroup label input".split()
)
BLOCK = frozenset(
    "html body address article aside blockquote center caption dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup legend li main menu nav ol p pre section summary table tbody "
    "td tfoot th thead tr ul head frameset search".split()
)
APART = frozenset("nav footer aside form dialog menu search".split())  # never the article's own text
MAIN = frozenset("article main".split())
LEVELS = frozenset("html head body".split())
_P, _NONE = frozenset(["p"]), frozenset()
_CELLS = frozenset("td th".split())
_ROWS = frozenset("tbody thead tfoot".split())
# a start tag ends open elements of these names, looked for across those blocks
CLOSES: dict[str, tuple[frozenset[str], frozenset[str]]] = {
    "li": (frozenset(["li"]), frozenset("div p address".split())),
    "dt": (frozenset("dt dd".split()), frozenset("div p address".split())),
    "dd": (frozenset("dt dd".split()), frozenset("div p address".split())),
    "td": (_CELLS, BLOCK - _ROWS - {"table", "tr"}),
    "th": (_CELLS, BLOCK - _ROWS - {"table", "tr"}),
    "tr": (_CELLS | {"tr"}, BLOCK - _ROWS - {"table"}),
    "tbody": (_CELLS | _ROWS | {"tr"}, BLOCK - {"table"}),
    "tfoot": (_CELLS | _ROWS | {"tr"}, BLOCK - {"table"}),
}
ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert status menu menubar toolbar form "
    "note log".split()
)
MARKS = frozenset(
    "nav navbar topnav subnav navigation menu submenu breadcrumb breadcrumbs footer sidebar aside ad ads adv advert adverts "
    "advertisement advertisements advertising adsense sponsor sponsored sponsors promo promos promotion cookie cookies "
    "consent gdpr notice notices notification notifications popup modal overlay newsletter subscribe subscription "
    "signup login share sharing social comment comments respond disqus reply replies related recommended "
    "recommendations pagination pager toolbar skip copyright banner masthead".split()
)
HEADERS = frozenset("header topbar".split())  # apart unless they stand in the article
STATES = frozenset("has no with without is not hide show open closed enabled disabled".split())

_TAG = re.compile(
    r"<(?:!--(?:-?>|.*?(?:--!?>|\Z))"
    r"|(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)(?:>|\Z)"
    r"|[!?/][^>]*+(?:>|\Z))",
    re.S,
)
_ENDS = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I) for name in RAW}
_MARKED = re.compile(r"\b(?:class|id|role|hidden|style|itemprop|aria-hidden)\b", re.I)
_ATTR = re.compile(
    r"""(?<![\w-])(class|id|role|hidden|style|itemprop|aria-hidden)(?![\w-])(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""",
    re.I,
)
_UNSEEN_STYLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_WORD = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]*")


def _apart(name: str, words: frozenset[str]) -> bool:
    """Whether a class or id says that an element is not the article's text: 'site-footer', 'ad', but
    not 'with-sidebar' or 'comments-open', which say what the page has elsewhere."""
    parts = [w.lower() for w in _WORD.findall(name)]
    return any(p in words for p in parts) and not any(p in STATES for p in parts)


def key_of(tag: str, attributes: str) -> str | None:
    """The token of a start tag: its name, its class names without digits, and what it is.

    '!' at the end: apart from the text; '^': a header; '@': holds the main text. None: not shown.
    """
    found: dict[str, str] = {}
    if _MARKED.search(attributes):
        for name, *values in _ATTR.findall(attributes):
            found.setdefault(name.lower(), unescape("".join(values)))
    style = found.get("style", "")
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true" or _UNSEEN_STYLE.search(style):
        return None
    role = found.get("role", "").lower().strip()
    classes = found.get("class", "").split()
    names = [*classes, *found.get("id", "").split()]
    key = ".".join([tag, *sorted(c for c in {*classes} if not any(x.isdigit() for x in c))])
    if tag in ("html", "body"):
        return tag
    if tag in MAIN or role == "main" or found.get("itemprop") == "articleBody":
        # 'post comments-open' is an article, 'comment' is not
        return key + ("!" if any(_apart(c, MARKS) for c in names) else "@")
    if tag in APART or role in ROLES or any(_apart(c, MARKS) for c in names):
        return key + "!"
    if tag == "header" or any(_apart(c, HEADERS) for c in names):
        return key + "^"
    return key


_KEYS: dict[tuple[str, str], str | None] = {}


def _key(tag: str, attributes: str) -> str | None:
    if not attributes or attributes.isspace():
        attributes = ""
    known = _KEYS.get((tag, attributes), "")
    if known == "":
        if len(_KEYS) > 20_000:
            _KEYS.clear()
        known = _KEYS[tag, attributes] = key_of(tag, attributes)
    return known


class Page:
    """The token stream of one page.

    ``parents`` and ``keys``: the nodes, one for each path of keys, a parent before its children; node
    0 is the root. ``streams``: of each node, its children in the order they begin, equal neighbours
    once. ``times``: how often a node begins. ``blocks``: (node, text, characters in links, place of
    the main element it stands in) in page order, with one blank for white space and no empty ones.
    Inline markup belongs to the text. Elements that are not shown have no text.
    """

    __slots__ = ("parents", "keys", "streams", "times", "blocks", "_nodes", "_stack", "_open", "_text", "_links", "_at", "_main")

    def __init__(self, html: str):
        self.parents, self.keys, self.streams, self.times, self.blocks = [-1], [""], [[]], [1], []
        self._nodes: dict[tuple[int, str], int] = {}
        # (tag, node, place of the main element); node -1: not shown
        self._stack: list[tuple[str, int, int]] = [("", 0, 0)]
        self._open: dict[str, int] = {}
        self._text, self._links, self._at, self._main = [], 0, (0, 0), 0
        self._read(html)

    def place(self, parent: int, key: str) -> int | None:
        return self._nodes.get((parent, key))

    def _read(self, html: str) -> None:
        at, size, link = 0, len(html), False
        search = _TAG.search
        while at < size:
            m = search(html, at)
            begin = m.start() if m else size
            if begin > at:
                self._add(html[at:begin], link)
            if not m:
                break
            at = m.end()
            tag = m.group(2)
            if tag is None:
                continue
            tag = tag.lower()
            if m.group(1):
                if tag == "a":
                    link = False
                elif tag == "br":
                    self._add(" ", False)
                elif tag in BLOCK or tag in UNSEEN or self._stack[-1][1] < 0:
                    self._end(tag)
                continue
            if tag in RAW:
                end = _ENDS[tag].search(html, at)
                at = end.start() if end else size
                close = search(html, at)
                at = close.end() if close else size
            elif tag in VOID:
                if tag == "br":
                    self._add(" ", False)
                elif tag == "hr":
                    self._flush()
                    self._end("p")
            elif tag in BLOCK:
                link = False
                self._begin(tag, m.group(3))
            else:
                self._inline(tag, m.group(3))
                link = link or tag == "a"
        self._flush()

    # ---- text ---------------------------------------------------------------------------------

    def _add(self, text: str, link: bool) -> None:
        _, node, main = self._stack[-1]
        if node < 0:
            return
        if not self._text:
            self._at, self._links = (node, main), 0
        self._text.append(text)
        if link:
            self._links += len(text)

    def _flush(self) -> None:
        if self._text:
            text = "".join(self._text)
            text = " ".join((unescape(text) if "&" in text else text).split())
            if text:
                self.blocks.append((self._at[0], text, min(self._links, len(text)), self._at[1]))
            self._text = []

    # ---- elements -----------------------------------------------------------------------------

    def _push(self, tag: str, node: int, main: int) -> None:
        self._stack.append((tag, node, main))
        self._open[tag] = self._open.get(tag, 0) + 1

    def _cut(self, k: int) -> None:
        for tag, _, _ in self._stack[k:]:
            self._open[tag] -= 1
        del self._stack[k:]

    def _begin(self, tag: str, attributes: str) -> None:
        self._flush()
        stack = self._stack
        if stack[-1][0] == "head":
            self._cut(len(stack) - 1)  # what stands in a body ends the head
        if tag not in LEVELS:
            self._close(_P, _NONE)
            if tag in CLOSES:
                self._close(*CLOSES[tag])
        if tag == "head" or stack[-1][1] < 0:
            self._push(tag, -1, 0)
            return
        if tag in LEVELS and any(t == tag for t, _, _ in stack):
            return  # a second html or body is none
        key = _key(tag, attributes)
        if key is None:
            self._push(tag, -1, 0)
            return
        _, parent, main = stack[-1]
        node = self._nodes.get((parent, key))
        if node is None:
            node = self._nodes[parent, key] = len(self.keys)
            self.parents.append(parent)
            self.keys.append(key)
            self.streams.append([])
            self.times.append(0)
        self.times[node] += 1
        stream = self.streams[parent]
        if not stream or stream[-1] != node:
            stream.append(node)
        if key[-1] == "@":
            self._main += 1
            main = self._main
        self._push(tag, node, main)

    def _inline(self, tag: str, attributes: str) -> None:
        if self._stack[-1][1] < 0 or tag in UNSEEN:
            self._push(tag, -1, 0)
        elif _MARKED.search(attributes):
            key = _key(tag, attributes)
            if key is None or key[-1] == "!":
                self._push(tag, -1, 0)

    def _close(self, tags: frozenset[str], across: frozenset[str]) -> None:
        stack, cut = self._stack, 0
        for k in range(len(stack) - 1, 0, -1):
            tag = stack[k][0]
            if tag in tags:
                cut = k
            elif tag in BLOCK and tag not in across:
                break
        if cut:
            self._cut(cut)

    def _end(self, tag: str) -> None:
        stack = self._stack
        for k in range(len(stack) - 1 if self._open.get(tag) else 0, 0, -1):
            if stack[k][0] == tag:
                if tag in BLOCK:
                    self._flush()
                if tag not in ("html", "body"):
                    self._cut(k)
                return
            if stack[k][0] in ("td", "th", "table") and tag not in ("table", "tbody", "thead", "tfoot", "tr", "td", "th"):
                return
            if stack[k][1] >= 0 and tag not in BLOCK:
                return  # the end of an inline element does not end a block
        if tag in BLOCK:
            self._flush()
