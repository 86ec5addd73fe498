"""Wrappers of web pages by union-free expression inference, and the main text they lead to."""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.page_tokens import Page
from millrace.sources.shared import materialize

VALUES = 8  # distinct texts from which on a place is a text slot
VARIANTS = 32  # class names of one element at one place from which on the class is a slot, too
TEMPLATE = 0.5  # share of the pages with a place that must have the same text there
SHARE = 0.7  # of a node's text that a child must hold to be gone into
_CONTAINERS = frozenset("html body div section center table tbody tr td form fieldset dl ul ol".split())
_NODES = 200_000  # nodes a task holds before it hands its wrappers on
_SALTS = 1024  # first folds of a host


def tag_of(key: str) -> str:
    return key.split(".", 1)[0].rstrip("@!^")


def _class_slot(key: str) -> str:
    return f"{tag_of(key)}.*{key[-1] if key[-1] in '@!^' else ''}"


def apart(parents: list[int], keys: list[str], top: int = 0) -> list[bool]:
    """Which nodes are no text of the article, by their own tokens or those above them below ``top``."""
    out, main = [False] * len(keys), [False] * len(keys)
    for i in range(1, len(keys)):
        p, kind = parents[i], keys[i][-1]
        main[i] = main[p] or kind == "@"
        out[i] = i != top and (out[p] or kind == "!" or (kind == "^" and not main[p]))
    return out


def _crc_paths(parents: list[int], keys: list[str]) -> list[int]:
    """A number for each node's path of element names."""
    out = [0] * len(keys)
    for i in range(1, len(keys)):
        out[i] = zlib.crc32(tag_of(keys[i]).encode(), out[parents[i]])
    return out


class Wrapper:
    """A union-free expression that all pages seen so far match, and what stood in its places.

    Every level is a list of tokens (see ``Page``) in order, each once. A new page's stream is walked
    along it: tokens that one side lacks become optional; a token that comes again, or before one it
    followed, makes what lies between a repeated group of optional tokens, ``(a? b?)+``. Texts that
    differ become text slots, class names that differ too often class slots (``div.*``). So a wrapper
    grows with the kinds of places on a host, not with its pages. Two wrappers are aligned alike.
    """

    LISTS = ("parents", "keys", "levels", "spans", "pages", "times", "mass", "values")

    def __init__(self):
        self.parents, self.keys, self.levels = [-1], [""], [[]]
        self.spans: list[set[tuple[int, int]]] = [set()]  # first and last child of repeated groups
        self.pages, self.times, self.mass = [0], [0], [0]
        self.values: list[dict[int, int] | None] = [{}]  # distinct texts with their counts; None: a slot
        self.index: dict[tuple[int, str], int] = {}
        self.variants: dict[tuple[int, str], int] = {}
        self.known: set[tuple] = set()

    def _child(self, parent: int, key: str) -> int:
        node = self.index.get((parent, key))
        if node is None:
            slot = _class_slot(key)
            node = self.index.get((parent, slot))
            if node is None:
                node = self.index[parent, key] = len(self.keys)
                for column, value in zip(self.LISTS, (parent, key, [], set(), 0, 0, 0, {})):
                    getattr(self, column).append(value)
                self.variants[parent, slot] = self.variants.get((parent, slot), 0) + (key != slot)
        return node

    def _align(self, node: int, stream: list[int]) -> None:
        """Walk a level's stream of children along its list, resolving mismatches."""
        if (node, *stream) in self.known:
            return
        if len(self.known) < 10_000:
            self.known.add((node, *stream))
        level, at = self.levels[node], -1
        place = {child: k for k, child in enumerate(level)}
        for child in stream:
            k = place.get(child)
            if k is None:  # the wrapper lacks it: an optional token, right here
                at += 1
                level.insert(at, child)
                place = {c: i for i, c in enumerate(level)}
            else:
                if k <= at:  # it comes again: what lies between is a repeated group
                    self.spans[node].add((child, level[at]))
                at = k

    def _text(self, node: int, value: int, count: int) -> None:
        values = self.values[node]
        if values is not None:
            values[value] = values.get(value, 0) + count
            if len(values) > VALUES:
                self.values[node] = None

    def absorb(self, page: Page) -> None:
        ids = [0]
        for parent, key in zip(page.parents[1:], page.keys[1:]):
            ids.append(self._child(ids[parent], key))
        for i, node in enumerate(ids):
            self.pages[node] += 1
            self.times[node] += page.times[i]
            if page.streams[i]:
                self._align(node, [ids[c] for c in page.streams[i]])
        for i, text, links, _ in page.blocks:
            node = ids[i]
            self.mass[node] += len(text) - links
            if self.values[node] is not None:
                self._text(node, zlib.crc32(text.encode("utf-8", "replace")), 1)
        self._make_slots()

    def merge(self, other: Wrapper, slots: frozenset[tuple[int, str]] = frozenset()) -> None:
        ids = [0]
        for parent, key in zip(other.parents[1:], other.keys[1:]):
            slot = _class_slot(key)
            ids.append(self._child(ids[parent], slot if (parent, slot) in slots else key))
        for i, node in enumerate(ids):
            self.pages[node] += other.pages[i]
            self.times[node] += other.times[i]
            self.mass[node] += other.mass[i]
            self._align(node, [ids[c] for c in other.levels[i]])
            self.spans[node] |= {(ids[a], ids[b]) for a, b in other.spans[i]}
            if other.values[i] is None:
                self.values[node] = None
            else:
                for value, count in other.values[i].items():
                    self._text(node, value, count)
        self._make_slots()

    def _make_slots(self) -> None:
        """Where too many class names stand for one element, make the class a slot."""
        while due := frozenset(k for k, n in self.variants.items() if n > VARIANTS or (n and k in self.index)):
            new = Wrapper()
            new.merge(self, due)
            self.__dict__ = new.__dict__

    def dump(self) -> bytes:
        spans = [sorted(s) for s in self.spans]
        values = [None if v is None else list(v.items()) for v in self.values]
        lists = [self.parents, self.keys, self.levels, spans, self.pages, self.times, self.mass, values]
        return json.dumps(lists, separators=(",", ":")).encode()

    @classmethod
    def load(cls, data: bytes) -> Wrapper:
        out = cls()
        for name, column in zip(cls.LISTS, json.loads(data)):
            setattr(out, name, column)
        out.spans = [{tuple(x) for x in s} for s in out.spans]
        out.values = [None if v is None else {int(k): n for k, n in v} for v in out.values]
        for i in range(1, len(out.keys)):
            slot = _class_slot(out.keys[i])
            out.index[out.parents[i], out.keys[i]] = i
            out.variants[out.parents[i], slot] = out.variants.get((out.parents[i], slot), 0) + (out.keys[i] != slot)
        return out

    def repeated(self, node: int) -> bool:
        """Whether a place stands several times in most pages that have it."""
        return self.times[node] > 1.5 * self.pages[node]

    def expression(self) -> str:
        """The wrapper as text: ``a(...)`` an element, ``#`` a text slot, ``"`` one text, ? and + as usual."""
        texts = [""] * len(self.keys)
        for i in range(len(self.keys) - 1, -1, -1):  # children come after their parents
            level, place = self.levels[i], {c: k for k, c in enumerate(self.levels[i])}
            parts = [texts[c] for c in level]
            groups = sorted((min(place[a], place[b]), max(place[a], place[b])) for a, b in self.spans[i])
            joined: list[list[int]] = []
            for a, b in groups:
                if joined and a <= joined[-1][1]:
                    joined[-1][1] = max(joined[-1][1], b)
                else:
                    joined.append([a, b])
            for a, b in reversed(joined):
                parts[a : b + 1] = [f"({' '.join(parts[a : b + 1])})+"]
            values = self.values[i]
            own = "#" if values is None or len(values) > 1 else '"' if values else ""
            inner = " ".join(filter(None, [own, *parts]))
            key = self.keys[i]
            body = f"{key}({inner})" if i else inner
            if i:
                parent = self.parents[i]
                many, some = self.times[i] > self.times[parent], self.pages[i] < self.pages[parent]
                body = f"({body})+" if many else body
                body += "?" if some else ""
            texts[i] = body
        return texts[0]

    # ---- where the text is ----------------------------------------------------------------------

    def _masses(self, out: list[bool]) -> list[int]:
        mass = [0 if gone else m for gone, m in zip(out, self.mass)]
        for i in range(len(mass) - 1, 0, -1):
            if not out[i]:
                mass[self.parents[i]] += mass[i]
        return mass

    def path(self, node: int) -> list[str]:
        path = []
        while node > 0:
            path.append(self.keys[node])
            node = self.parents[node]
        return path[::-1]

    def rule(self) -> dict:
        """Where the article stands: ``paths`` of tokens, the likeliest first, and ``drop``, the texts
        there that belong to the template (numbers of path and text).

        Elements that say they hold the main text count by their text. On hosts without any, the way
        down from the root to the varying text is followed as long as one child holds most of it.
        """
        out = apart(self.parents, self.keys)
        mass = self._masses(out)
        mains = [i for i, k in enumerate(self.keys) if k[-1:] == "@" and not out[i] and mass[i]]
        if not mains:  # all of them inside something apart, a form around the page for instance
            inner = {i: self._masses(apart(self.parents, self.keys, i))[i] for i, k in enumerate(self.keys) if k[-1:] == "@"}
            mains = [i for i, m in inner.items() if m]
            mass = [inner.get(i, m) for i, m in enumerate(mass)]

        def weight(i: int) -> float:
            if tag_of(self.keys[i]) == "main":
                return mass[i]
            return mass[i] * (0.5 if self.repeated(i) else 2)

        paths = [self.path(i) for i in sorted(mains, key=lambda i: (-weight(i), i))]
        return {"paths": paths, "drop": []} if paths else self._densest(out, mass)

    def _densest(self, out: list[bool], mass: list[int]) -> dict:
        if not mass[0]:  # nothing but what is apart: a form may hold the whole page
            out = apart(self.parents, [k.rstrip("!") if tag_of(k) == "form" else k for k in self.keys])
            mass = self._masses(out)
        if not mass[0]:
            return {"paths": [], "drop": []}
        node = 0
        while True:
            children = [c for c in self.levels[node] if not out[c]]
            if not children or any(tag_of(self.keys[c]) in ("h1", "h2") and mass[c] for c in children):
                break
            best = max(children, key=lambda c: (mass[c], -c))
            if mass[best] < SHARE * mass[node] or self.repeated(best) or tag_of(self.keys[best]) not in _CONTAINERS:
                break
            node = best
        inside = [False] * len(self.keys)
        inside[node] = True
        for i in range(node + 1, len(self.keys)):
            inside[i] = inside[self.parents[i]] and not out[i]
        here = [i for i, yes in enumerate(inside) if yes]
        drop = []
        if any(self.values[i] is None for i in here):  # its pages differ, so what they share is template
            crc = _crc_paths(self.parents, self.keys)
            drop = [
                [crc[i], value]
                for i in here
                for value, n in (self.values[i] or {}).items()
                if n >= max(3, TEMPLATE * self.pages[i])
            ]
        return {"paths": [self.path(node)], "drop": sorted(drop)}


# ---- one page ---------------------------------------------------------------------------------------


def _places(page: Page, path: list[str]) -> list[int]:
    """The nodes of a page that a path of a wrapper leads to."""
    at = {0}
    for key in path:
        if ".*" in key:
            at = {i for i, k in enumerate(page.keys) if i and page.parents[i] in at and _class_slot(k) == key}
        else:
            at = {n for i in at if (n := page.place(i, key))}
    return sorted(at)


def _texts(page: Page, node: int, drop: set[tuple[int, int]]) -> list[str]:
    out = apart(page.parents, page.keys, node)
    inside = [i == node for i in range(len(page.keys))]
    for i in range(node + 1, len(page.keys)):
        inside[i] = inside[page.parents[i]] and not out[i]
    crc = _crc_paths(page.parents, page.keys) if drop else []
    found = [b for b in page.blocks if inside[b[0]]]
    if drop:
        found = [b for b in found if (crc[b[0]], zlib.crc32(b[1].encode("utf-8", "replace"))) not in drop]
    if page.keys[node][-1:] == "@" and page.times[node] > 1:
        titled = {b[3] for b in found if tag_of(page.keys[b[0]]) == "h1"}
        if len(titled) == 1:  # of several elements the one with the title
            found = [b for b in found if b[3] in titled]
    return [b[1] for b in found]


def main_text(html: str | None, rule: dict | None) -> str:
    """The article's blocks, joined by line ends; without a rule that fits, by the page's own wrapper."""
    if not html:
        return ""
    page = Page(html)
    for given in (rule, None):
        if given is None:
            own = Wrapper()
            own.absorb(page)
            given = own.rule()
        drop = {tuple(x) for x in given["drop"]}
        for path in given["paths"]:
            found = [t for node in _places(page, path) for t in _texts(page, node, drop)]
            if found:
                return "\n".join(found)
    return ""


# ---- tables -----------------------------------------------------------------------------------------


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))


def _rows(batches: Iterator[pa.RecordBatch], *columns: str, step: int = 64):
    for batch in batches:
        for start in range(0, batch.num_rows, step):
            piece = batch.slice(start, step)
            yield from zip(*[piece.column(c).to_pylist() for c in columns])


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One wrapper for each host among a task's pages, or several where it meets very many places."""
    part, found, nodes = TaskContext.get().partitionId() << 32, {}, 0

    def handed_on() -> pa.RecordBatch:
        n = len(found)
        return pa.RecordBatch.from_pydict(
            {
                "host": list(found),
                "salt": pa.array([part % _SALTS if part < _SALTS else (part >> 32) % _SALTS] * n, pa.int32()),
                "part": [part] * n,
                "wrapper": pa.array([w.dump() for w in found.values()], pa.binary()),
            }
        )

    for host, html in _rows(batches, "host", "html"):
        wrapper = found.get(host)
        if wrapper is None:
            wrapper = found[host] = Wrapper()
        nodes -= len(wrapper.keys)
        wrapper.absorb(Page(html or ""))
        nodes += len(wrapper.keys)
        if nodes > _NODES:
            yield handed_on()
            part, found, nodes = part + 1, {}, 0
    if found:
        yield handed_on()


def _folded(rows: DataFrame, last: bool) -> DataFrame:
    """Wrappers of the same host (and salt) aligned into one, in the order of their parts."""
    columns = "host string, pages bigint, expression string, rule string"
    schema = columns if last else "host string, salt int, part bigint, wrapper binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first, wrapper = None, 0, None

        def done() -> pa.RecordBatch:
            if last:
                values = (key[0], wrapper.pages[0], wrapper.expression(), json.dumps(wrapper.rule()))
                return pa.RecordBatch.from_pydict(dict(zip(("host", "pages", "expression", "rule"), map(lambda v: [v], values))))
            return pa.RecordBatch.from_pydict(
                {
                    "host": [key[0]],
                    "salt": pa.array([0], pa.int32()),
                    "part": [first],
                    "wrapper": pa.array([wrapper.dump()], pa.binary()),
                }
            )

        for host, salt, part, data in _rows(batches, "host", "salt", "part", "wrapper"):
            if (host, salt) != key:
                if wrapper:
                    yield done()
                key, first, wrapper = (host, salt), part, Wrapper()
            wrapper.merge(Wrapper.load(data))
        if wrapper:
            yield done()

    return rows.repartition("host", "salt").sortWithinPartitions("host", "salt", "part").mapInArrow(run, schema)


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """``host, pages, expression, rule``: one wrapper for each host of ``url``, from all its pages.

    Tasks align the pages they read; only wrappers are shuffled, first by host and salt, then by host,
    so that a host with any share of the pages is spread. Pages without a host have no wrapper.
    """
    rows = pages.select(host_of(F.col("`url`")).alias("host"), F.col("`html`").alias("html")).where("host != ''")
    parts = rows.mapInArrow(_partial, "host string, salt int, part bigint, wrapper binary")
    return _folded(_folded(parts, last=False), last=True)


def extract_text(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """``page_id, url, text`` of every page by the rules of its host.

    The rules come to the pages; Spark broadcasts them if they are small, else it joins by host and
    splits large hosts. A null or empty page has an empty text, and so has one without an article.
    """
    kinds = {c: pages.schema[c].dataType.simpleString() for c in ("page_id", "url")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules: dict[str | None, dict | None] = {None: None}
        for batch in batches:
            texts = []
            for html, rule in _rows([batch], "html", "rule"):
                if rule not in rules:
                    if len(rules) > 10_000:
                        rules.clear()
                        rules[None] = None
                    rules[rule] = json.loads(rule)
                texts.append(main_text(html, rules[rule]))
            columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text"])

    rows = pages.select(*[F.col(f"`{c}`").alias(c) for c in ("page_id", "url", "html")])
    rows = rows.withColumn("host", host_of(F.col("url")))
    joined = rows.join(rules.select("host", "rule"), "host", "left").select("page_id", "url", "html", "rule")
    return joined.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string")


def main_texts(pages: DataFrame) -> DataFrame:
    """``page_id, url, text`` of every row of ``page_id, url, html``: the article alone.

    Character references are decoded, white space inside a block is one blank, blocks are joined by
    one line end in page order. Null and empty pages have an empty text. Long pages are read whole.
    Repeated rows, equal urls and null ids are rows like others; a page with a null url, or one
    without a host, is judged by itself. An empty table gives no rows. Extra columns are not read.
    """
    return extract_text(pages, materialize(infer_wrappers(pages), "page-wrappers"))
