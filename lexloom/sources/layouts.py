"""Documents of any registered source as rows of the version model.

XML, HTML, JSON and plain text become the same kind of tree, and a ``Layout`` says, in paths over that
tree, what the units of a document are, which versions they have and where its metadata stand.  So a
source is a table row and a further one needs no parser.  The tree builder is tolerant: a broken document
gives the units that can be read, together with what is wrong with it.

Paths: steps separated by ``/``, each found among all descendants of the one before; a step is
``tag``, ``.class``, ``tag.class`` or ``*``, with ``[attribute=value]``, ``[attribute]`` or ``~regex`` on
the text; ``@attribute`` at the end reads an attribute, ``.`` is the node itself, and of alternatives
between `` | `` the first that finds something counts; in a heading ``+`` joins parts.  Names are compared in lower case and without
their namespace.

A document of no layout's form, an empty or a null one has no units and says why under ``error``.
"""

from __future__ import annotations

import base64
import binascii
import datetime
import functools
import json
import re
import unicodedata
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial
from html.parser import HTMLParser
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from lexloom.session import importable

#: Fixed values of HTML: elements without an end, and those whose end may be left out before their like.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
SELF_ENDING = frozenset("p li td th tr dt dd option".split())
LINES = SELF_ENDING | frozenset("blockquote div dl h1 h2 h3 h4 h5 h6 ol section table ul".split())


class Node:
    __slots__ = ("tag", "attrs", "items", "index", "start", "end")

    def __init__(self, tag: str, attrs: dict[str, str] | None = None):
        self.tag, self.attrs, self.items, self.index = tag, attrs or {}, [], None

    def nodes(self) -> list[Node]:
        """All descendants in reading order; a tree is not changed once they have been asked for."""
        index = self.index or _index(self)
        return index.nodes[self.start : self.end]

    def named(self, tag: str) -> list[Node]:
        """The descendants of one name in reading order."""
        index = self.index or _index(self)
        places = index.places.get(tag)
        if places is None:
            return []
        return [index.nodes[i] for i in places[bisect_left(places, self.start) : bisect_left(places, self.end)]]

    def pieces(self, skip=lambda node: False) -> Iterator[str]:
        stack: list = list(reversed(self.items))
        while stack:
            item = stack.pop()
            if isinstance(item, str):
                yield item
            elif item.tag == "br":
                yield "\n"
            elif not skip(item):
                if item.tag in LINES:
                    stack.append("\n")
                    yield "\n"
                stack += reversed(item.items)

    def text(self, skip=lambda node: False) -> str:
        return " ".join("".join(self.pieces(skip)).split())


class _Index:
    """The descendants of a root in reading order, and the places of each name; every node knows its own stretch."""

    __slots__ = ("nodes", "places")

    def __init__(self):
        self.nodes, self.places = [], {}


def _index(root: Node) -> _Index:
    index = _Index()
    nodes, places = index.nodes, index.places
    root.index, root.start = index, 0
    stack: list[tuple[Node, Iterator]] = [(root, iter(root.items))]
    while stack:
        node, rest = stack[-1]
        for item in rest:
            if item.__class__ is Node:
                places.setdefault(item.tag, []).append(len(nodes))
                nodes.append(item)
                item.index, item.start = index, len(nodes)
                if item.items:
                    stack.append((item, iter(item.items)))
                    break
                item.end = item.start
        else:
            node.end = len(nodes)
            stack.pop()
    return index


def _release(root: Node) -> None:
    """Forget the index of a tree that is done with: nodes and index hold each other, and would wait for the collector."""
    if root.index:
        root.index.nodes.clear()
        root.index.places.clear()


@functools.cache
def _local(name: str) -> str:
    return name.rpartition(":")[2].lower()


class _Builder(HTMLParser):
    CDATA_CONTENT_ELEMENTS = ()
    RCDATA_CONTENT_ELEMENTS = ()

    def __init__(self, html: bool):
        super().__init__(convert_charrefs=True)
        self.html, self.root = html, Node("")
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        tag = _local(tag)
        if self.html and tag in SELF_ENDING and self.open[-1].tag == tag:
            self.open.pop()
        node = Node(tag, {_local(k): v or "" for k, v in attrs})
        self.open[-1].items.append(node)
        if not (self.html and tag in VOID):
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        tag = _local(tag)
        self.open[-1].items.append(Node(tag, {_local(k): v or "" for k, v in attrs}))

    def handle_endtag(self, tag):
        tag = _local(tag)
        if any(x.tag == tag for x in self.open[1:]):
            while self.open.pop().tag != tag:
                pass

    def handle_data(self, data):
        self.open[-1].items.append(data)

    def unknown_decl(self, data):
        if data.startswith("CDATA["):
            self.open[-1].items.append(data[6:])


_DECLARED = re.compile(r"""<\?xml version=["']1.0["'](?: encoding=["']utf-8["'])?(?: standalone=["'](?:yes|no)["'])? ?\?>""", re.IGNORECASE)
#: Where well-formed XML might be read in two ways: other markup than elements, references by number, breaks in attributes.
_UNLIKE = re.compile(r"""<(?!/?[A-Za-z])|&#|\r|=\s*(?:"[^"]*[\t\n]|'[^']*[\t\n])""")


def _well_formed(text: str) -> Node | None:
    """The tree that the tolerant builder would give, made by expat; none where a document is broken or the two might differ."""
    declared = _DECLARED.match(text)
    at = declared.end() if declared else 0
    if _UNLIKE.search(text, at):
        return None
    body = text[at:].strip(" \t\n")
    lead = text.find("<", at)
    root = Node("")
    items, open_items = root.items, []

    def start(tag, attrs):
        nonlocal items
        node = Node(_local(tag), {_local(k): v for k, v in zip(attrs[::2], attrs[1::2], strict=True)} if attrs else None)
        items.append(node)
        open_items.append(items)
        items = node.items

    def end(tag):
        nonlocal items
        items = open_items.pop()

    parser = expat.ParserCreate("utf-8")
    parser.ordered_attributes = parser.buffer_text = True
    parser.StartElementHandler, parser.EndElementHandler = start, end
    parser.CharacterDataHandler = lambda data: items.append(data)
    if lead > at:
        items.append(text[at:lead])
    try:
        parser.Parse(body.encode(), True)
    except (expat.ExpatError, ValueError):
        return None
    if rest := text[lead + len(body) :]:
        items.append(rest)
    return root


def _of_json(tag: str, value, into: Node) -> None:
    """Members of objects and elements of lists are nodes under the member's name."""
    if isinstance(value, list):
        for x in value:
            _of_json(tag, x, into)
        return
    node = Node(tag.lower())
    into.items.append(node)
    if isinstance(value, dict):
        for k, v in value.items():
            _of_json(k, v, node)
    elif value is not None:
        node.items.append({True: "true", False: "false"}[value] if isinstance(value, bool) else str(value))


def tree(text: str, form: str) -> tuple[Node, str | None]:
    """The tree of a document, and what is wrong with it."""
    error = None
    if form == "json":
        root = Node("")
        try:
            _of_json("", json.loads(text), root)
        except ValueError as wrong:
            error = f"json: {wrong}"
        return root, error
    if form == "text":
        root = Node("")
        for line in text.splitlines():
            node = Node("line")
            node.items.append(line)
            root.items.append(node)
        return root, None
    if form == "xml":
        if (root := _well_formed(text)) is not None:
            return root, None
        try:
            expat.ParserCreate().Parse(text.encode("utf-8", "replace"), True)
        except (expat.ExpatError, ValueError) as wrong:
            error = f"xml: {wrong}"
    builder = _Builder(form == "html")
    builder.feed(text)
    builder.close()
    return builder.root, error


_STEP = re.compile(r"(?P<tag>[^.\[~@/]*)(?P<classes>(?:\.[^.\[~@/]+)*)(?P<tests>(?:\[[^\]]+\])*)(?:~(?P<like>.+))?$")


@functools.cache
def _step(text: str):
    found = _STEP.match(text)
    tests = [x.partition("=")[::2] if "=" in x else (x, None) for x in re.findall(r"\[([^\]]+)\]", found["tests"])]
    tag, classes, like = found["tag"].lower(), [x for x in found["classes"].split(".") if x], found["like"] and re.compile(found["like"])

    def test(node: Node):
        """True, or the match of the text."""
        if tag not in ("", "*") and node.tag != tag:
            return False
        if classes:
            own = node.attrs.get("class", "").split()
            if not all(any(x == c or c.endswith("*") and x.startswith(c[:-1]) for x in own) for c in classes):
                return False
        for name, value in tests:
            if name.lower() not in node.attrs or value is not None and not re.fullmatch(value.replace("*", ".*"), node.attrs[name.lower()]):
                return False
        return like.search(node.text()) if like else True

    #: The one name that can match, and whether nothing else is asked.
    test.tag, test.bare = "" if tag == "*" else tag, not (classes or tests or like)
    return test


@functools.cache
def _alternatives(path: str) -> list[str]:
    return path.split(" | ")


@functools.cache
def _steps(way: str) -> tuple:
    return () if way in (".", "") else tuple(_step(x) for x in way.split("/"))


@functools.cache
def _ways(path: str) -> list[tuple]:
    """The steps of each alternative."""
    return [_steps(way) for way in _alternatives(path) if way]


@functools.cache
def _readers(path: str) -> list[tuple[tuple, str]]:
    """Of a path that reads values, for each alternative: the steps to where they stand, and the attribute."""
    out = []
    for way in _alternatives(path):
        where, _, attribute = way.partition("@")
        out.append((_steps(where.rstrip("/") or "."), attribute.lower()))
    return out


def _matching(node: Node, test) -> list[Node]:
    found = node.named(test.tag) if test.tag else node.nodes()
    return found if test.bare else [x for x in found if test(x)]


def _at(node: Node, steps: tuple) -> list[Node]:
    found = [node]
    for test in steps:
        found = _matching(found[0], test) if len(found) == 1 else [x for f in found for x in _matching(f, test)]
    return found


def find(node: Node, path: str) -> list[Node]:
    """The nodes of the first alternative that finds any."""
    for steps in _ways(path):
        if found := _at(node, steps):
            return found
    return []


def values(node: Node, path: str) -> list[str]:
    """The texts or attributes of the first alternative that has any."""
    for steps, attribute in _readers(path):
        texts = [x.attrs.get(attribute, "").strip() if attribute else x.text() for x in _at(node, steps)]
        if texts := [x for x in texts if x]:
            return texts
    return []


def first(node: Node, path: str) -> str | None:
    """The first of the values."""
    if path:
        for steps, attribute in _readers(path):
            for x in _at(node, steps) if steps else (node,):
                if text := x.attrs.get(attribute, "").strip() if attribute else x.text():
                    return text
    return None


_DATES = [(re.compile(r"(\d{4})-(\d{1,2})-(\d{1,2})"), "ymd"), (re.compile(r"\b(\d{4})(\d{2})(\d{2})\b"), "ymd"), (re.compile(r"\b(\d{1,2})[./](\d{1,2})[./](\d{4})"), "dmy")]


@functools.lru_cache(maxsize=1 << 14)  # the same days stand in many documents
def day(text: str | None, month_first: bool = False) -> str | None:
    """An ISO day; null for none, for days that do not exist and for those beyond 2100, which stand for never."""
    for pattern, order in _DATES:
        if text and (found := pattern.search(text)):
            year, month, dom = (int(found[i]) for i in ((1, 2, 3) if order == "ymd" else (3, 1, 2) if month_first else (3, 2, 1)))
            try:
                return datetime.date(year, month, dom).isoformat() if year <= 2100 else None
            except ValueError:
                return None
    return None


@dataclass(frozen=True)
class Layout:
    """Where things stand in the documents of one source; every value but code and form is a path.

    ``rules`` (step, role) are tried in order on each node in reading order: skip; para (text of the unit
    before); head:kind and unit:kind (a unit of its own, of the kind that an attribute says after ``@``);
    with a ``+`` after head or unit, its inside is looked through as well; of a step's ``~regex`` the first
    group is the unit's id and the second its text.  ``envelope`` holds several
    dated versions of the whole document, ``nested`` the versions inside a unit; with ``group`` units of
    one id are versions of one.  ``inner`` is a form and a path: where a document holds its text as another
    form, which may be ``packed`` as base64.  ``dead`` (path = values) ends a unit at ``ends``.
    """

    code: str
    form: str
    rules: tuple[tuple[str, str], ...]
    body: str = "."
    uid: str = ""
    heading: str = ""
    paras: str = ""
    src: str = ""
    pub: str = ""
    eff: str = ""
    expiry: str = ""
    envelope: str = ""
    nested: str = ""
    group: str = ""
    inner: str = ""
    packed: bool = False
    dead: str = ""
    ends: str = ""
    title: str = ""
    rank: str = ""
    department: str = ""
    ranks: dict = field(default_factory=dict)
    rank_is: str = "exact"
    rank_key: str = "(.*)"
    rank_else: str = "other"
    states: tuple[tuple[str, str], ...] = ()
    encoding: str = "utf-8-sig"
    month_first: bool = False


def folded(text: str) -> str:
    """Lower case, without accents."""
    plain = unicodedata.normalize("NFKD", text.lower().replace("ł", "l"))
    return "".join(c for c in plain if not unicodedata.combining(c))


def rank_of(value: str | None, layout: Layout) -> str:
    """The rank that the layout's table gives.

    The key is what ``rank_key`` finds in the value.  exact: the key, whatever its case; contains: the
    first entry that stands in it; folded: the key without accents; slug: the key itself as a name.
    """
    found = value and re.search(layout.rank_key, value)
    if not found or not found[1].strip():
        return layout.rank_else
    key = found[1].strip()
    if layout.rank_is == "contains":
        return next((rank for needle, rank in layout.ranks.items() if needle.lower() in key.lower()), layout.rank_else)
    if layout.rank_is == "slug":
        return re.sub(r"[^a-z0-9]+", "_", folded(key)).strip("_") or layout.rank_else
    change = folded if layout.rank_is == "folded" else str.lower
    return {change(k): v for k, v in layout.ranks.items()}.get(change(key), layout.rank_else)


def _unpacked(text: str) -> str:
    try:
        return base64.b64decode(text, validate=True).decode("utf-8")
    except (binascii.Error, UnicodeDecodeError):
        return text


@functools.cache
def _rules(rules: tuple[tuple[str, str], ...]):
    """For a name, the rules that may hold for a node of it, in their order: test, role, what and kind."""
    every = [(_step(way), role, *role.partition(":")[::2]) for way, role in rules]

    @functools.cache
    def of(tag: str) -> list[tuple]:
        return [x for x in every if x[0].tag in ("", tag)]

    return of


def _outermost(node: Node, path: str) -> list[Node]:
    found, inside = [], set()
    for x in find(node, path):
        if id(x) not in inside:
            found.append(x)
            inside.update(map(id, x.nodes()))
    return found


def _paragraphs(node: Node, layout: Layout, headings: set[int]) -> list[str]:
    skip = lambda x: id(x) in headings
    nodes = _outermost(node, layout.paras) if layout.paras else [node]
    return [t for t in (x.text(skip) for x in nodes if id(x) not in headings) if t]


def _nested(node: Node, layout: Layout) -> Iterator[Node]:
    """The outermost units inside a node."""
    rules = _rules(layout.rules)
    stack = [x for x in reversed(node.items) if isinstance(x, Node)]
    while stack:
        item = stack.pop()
        role = next((role for test, role, _, _ in rules(item.tag) if test(item)), "")
        if role.startswith(("unit", "head")):
            yield item
        else:
            stack += [x for x in reversed(item.items) if isinstance(x, Node)]


def _named(node: Node, layout: Layout) -> list[Node]:
    """The nodes of a unit's own heading: the first of each part (joined by +) of the first alternative that has any."""
    if not layout.heading or "@" in layout.heading:
        return []
    inside = {id(x) for unit in _nested(node, layout) for x in (unit, *unit.nodes())}
    for way in _alternatives(layout.heading):
        parts = (next((x for x in find(node, part) if id(x) not in inside and x.text()), None) for part in way.split(" + "))
        if named := [x for x in parts if x is not None]:
            return named
    return []


@dataclass
class Unit:
    unit: str
    kind: str
    heading: str
    src: str | None = None
    pub: str | None = None
    eff: str | None = None
    expiry: str | None = None
    paras: list = field(default_factory=list)


def _dated(node: Node, layout: Layout, unit: Unit, default: Unit) -> None:
    at = partial(day, month_first=layout.month_first)
    unit.src = first(node, layout.src) or default.src
    unit.pub = at(first(node, layout.pub)) or default.pub
    unit.eff = at(first(node, layout.eff)) or (unit.pub if layout.nested or layout.group else default.eff)


def units(root: Node, layout: Layout, default: Unit) -> list[Unit]:
    """The units of one version of a document."""
    out: list[Unit] = []
    count: dict[str, int] = {}

    def enter(node: Node, kind: str, found, alone: bool) -> Unit:
        count[kind] = count.get(kind, 0) + 1
        named = _named(node, layout)
        heading = " ".join(x.text() for x in named) or (first(node, layout.heading) if "@" in layout.heading else None) or (node.text() if alone and not list(_nested(node, layout)) else "")
        own = first(node, layout.uid) or (found[1] if hasattr(found, "groups") and found.re.groups and found[1] else None)
        unit = Unit(own or f"{kind}-{count[kind]}", kind, heading, expiry=day(first(node, layout.expiry), layout.month_first))
        _dated(node, layout, unit, default)
        headings = {id(x) for x in named} | {id(y) for x in named for y in x.nodes()}
        if layout.nested and find(node, layout.nested):
            for version in find(node, layout.nested):
                one = Unit(unit.unit, kind, heading, expiry=unit.expiry)
                _dated(version, layout, one, default)
                one.paras = _paragraphs(version, layout, headings)
                out.append(one)
            return out[-1]
        if not alone:
            unit.paras = _paragraphs(node, layout, headings)
        elif hasattr(found, "groups") and found.re.groups > 1:
            unit.heading, unit.paras = found.string[: found.start(2)].strip(" -–—."), [found[2]] if found[2] else []
        out.append(unit)
        if layout.dead and (state := first(node, layout.dead.partition(" = ")[0])) and state in layout.dead.partition(" = ")[2].split(",") and (end := day(first(node, layout.ends))):
            out.append(Unit(unit.unit, kind, heading, unit.src, end, end, unit.expiry))
        return unit

    rules = _rules(layout.rules)

    def walk(node: Node) -> None:
        for item in node.items:
            if not isinstance(item, Node):
                continue
            for test, _, what, kind in rules(item.tag):
                found = test(item)
                if found:
                    break
            else:
                walk(item)
                continue
            kind = item.attrs.get(kind[1:], "") if kind.startswith("@") else kind
            if what == "para":
                if out and (text := item.text()):
                    out[-1].paras.append(text)
            elif what != "skip":
                alone = what.startswith("head") or layout.paras == "" and layout.nested == ""
                enter(item, kind, found, alone)
                if what.endswith("+"):
                    walk(item)

    for body in find(root, layout.body):
        walk(body)
    return out


def _default(node: Node, layout: Layout, outer: Unit | None = None) -> Unit:
    at = partial(day, month_first=layout.month_first)
    pub = at(first(node, layout.pub)) or (outer.pub if outer else None)
    return Unit("", "", "", first(node, layout.src) or (outer.src if outer else None), pub, at(first(node, layout.eff)) or pub)


def document(layout: Layout, text: str) -> tuple[dict, list[Unit], str | None]:
    """Metadata, units with their versions, and what is wrong with the document."""
    root, error = tree(text, layout.form)
    meta = {x: first(root, getattr(layout, x)) for x in ("title", "department")}
    meta["rank"] = rank_of(first(root, layout.rank), layout)
    meta["status"] = next((state for path, state in layout.states if find(root, path)), "in_force")
    whole = _default(root, layout)
    meta["published"] = whole.pub
    found = []
    for version in find(root, layout.envelope) if layout.envelope else [root]:
        default = _default(version, layout, whole) if layout.envelope else whole
        inner = _inner(version, layout)
        for one in units(inner, layout, default):
            if layout.envelope:
                one.pub, one.eff = default.pub, default.eff
            found.append(one)
        if inner is not version:
            _release(inner)
    _release(root)
    return meta, found, error


def _inner(node: Node, layout: Layout) -> Node:
    """Text held inside another form, such as HTML in a member of JSON, as a tree of its own."""
    if not layout.inner:
        return node
    form, _, path = layout.inner.partition(" ")
    root = Node("")
    for text in ["".join(x.pieces()) for x in find(node, path)]:
        root.items += tree(_unpacked(text) if layout.packed else text, form)[0].items
    return root


ROWS = "norm string, pos int, unit string, kind string, heading string, src string, pub string, eff string, expiry string, text string, title string, rank string, status string, department string, published string, error string"
_NAMES = [x.split()[0] for x in ROWS.split(", ")]


def _read(batches, layout: Layout):
    for batch in batches:
        rows = []
        for norm, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if not content:
                rows.append((norm, *[None] * 14, "empty document"))
                continue
            meta, found, error = document(layout, content.decode(layout.encoding, "replace"))
            about = (meta["title"], meta["rank"], meta["status"], meta["department"], meta["published"], error)
            for pos, u in enumerate(found):
                rows.append((norm, pos, u.unit, u.kind, u.heading, u.src, u.pub, u.eff, u.expiry, "\n\n".join(u.paras), *about))
            if not found:
                rows.append((norm, *[None] * 9, *about[:-1], error or "no units"))
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int32() if n == "pos" else pa.string()) for i, n in enumerate(_NAMES)], _NAMES)


def read(docs: DataFrame, layout: Layout, key: str = "norm", content: str = "content") -> DataFrame:
    """Unit versions of documents (key, bytes), ranks and states in the library's terms.

    Of dated versions of a whole document a unit's version is kept where its text differs from the one
    before.  A document without units has one row, which says why.
    """
    importable(docs.sparkSession)
    rows = docs.select(F.col(key).cast("string").alias("norm"), F.col(content).cast("binary").alias("content")).mapInArrow(partial(_call, layout), ROWS)
    if layout.envelope:
        before = F.lag("text").over(Window.partitionBy("norm", "unit").orderBy("eff", "pos"))
        rows = rows.withColumn("_before", before).where("unit IS NULL OR _before IS NULL OR _before <> text").drop("_before")
    if layout.group:
        ended = F.lead("text").over(Window.partitionBy("norm", "unit").orderBy("eff", "pos"))
        rows = rows.withColumn("_after", ended).where("text <> '' OR _after IS NULL").drop("_after")
    return rows


def _call(layout: Layout, batches):
    return _read(batches, layout)
