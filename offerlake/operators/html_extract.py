"""HTML field extraction as a distributed job over a pages DataFrame.

Each page is parsed exactly once inside ``mapInPandas``, and every requested field is read
from that one parse; Spark partitions the pages and moves them through Arrow batches, of which
only the values of a slice of bounded bytes are held at any time.  Regular markup is cut by one
pattern into a flat list of elements and texts (:func:`_flat`); any other page goes to the
stdlib ``html.parser``, which builds a small element tree.  Field semantics:

* an element is the first one in document order matching (tag, attribute, value);
  ``class`` matches any of its whitespace-separated names;
* text is every descendant text node stripped (Python whitespace), empty ones
  skipped, concatenated without separator; character references are decoded (known
  entity names, numeric references); comments and script/style bodies are not text;
* a missing element gives NULL (scalar) or ``[]`` (list); a page that fails to
  parse gives NULLs / empty lists and never fails the job.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from html import unescape
from html.entities import html5
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Elements that never have children, and elements whose text is not text.
VOID_TAGS = frozenset({
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
    "source", "track", "wbr", "basefont", "bgsound", "frame", "keygen", "menuitem", "spacer",
})
NON_TEXT_TAGS = frozenset({"script", "style"})
MULTI_VALUED_ATTRS = frozenset({"class", "rel", "rev", "accept-charset", "headers", "accesskey"})


class Element:
    """A parsed element.  ``pre``/``post`` are pre-order numbers of the element and of
    its last descendant, so "x is inside e" is ``e.pre < x.pre <= e.post``; ``doc`` is
    the per-document index (tag -> elements and their ``pre`` in document order)."""
    __slots__ = ("tag", "attrs", "children", "parent", "pre", "post", "doc")

    def __init__(self, tag: str, attrs: dict, parent: Element | None):
        self.tag, self.attrs, self.children, self.parent = tag, attrs, [], parent
        self.pre = self.post = 0
        self.doc = None


def entity_text(name: str) -> str:
    """A named reference: the character when the whole name is a known entity,
    otherwise the literal text ('&ampx' stays as written)."""
    return html5.get(name + ";", "&" + name)


def charref_text(name: str) -> str:
    """A numeric reference; values below 256 are read as Windows-1252 bytes first
    (pages often mean '&#147;' as a curly quote), then as a code point."""
    try:
        cp = int(name[1:], 16) if name[:1] in ("x", "X") else int(name)
    except ValueError:
        cp = -1
    text = None
    if 0 <= cp < 256:
        try:
            text = bytes([cp]).decode("cp1252")
        except UnicodeDecodeError:
            text = None
    if text is None:
        try:
            text = chr(cp)
        except (ValueError, OverflowError):
            text = "\ufffd"
    return text


class _TreeBuilder(HTMLParser):
    def __init__(self):
        # references are resolved by handle_entityref/handle_charref below
        super().__init__(convert_charrefs=False)
        self.root = Element("[document]", {}, None)
        self.cur = self.root
        self._text_open = False  # consecutive data events form one text node

    def _new(self, tag, attrs):
        self._text_open = False
        a = {}
        for k, v in attrs:
            a[k] = "" if v is None else v  # a repeated attribute keeps its last value
        el = Element(tag, a, self.cur)
        self.cur.children.append(el)
        return el

    def handle_starttag(self, tag, attrs):
        el = self._new(tag, attrs)
        if tag not in VOID_TAGS:
            self.cur = el

    def handle_startendtag(self, tag, attrs):
        self._new(tag, attrs)

    def handle_endtag(self, tag):
        self._text_open = False
        node = self.cur
        while node is not self.root and node.tag != tag:
            node = node.parent
        if node is not self.root:  # close up to the matching open element; else ignore
            self.cur = node.parent

    def handle_data(self, data):
        if self.cur.tag in NON_TEXT_TAGS:
            return
        if self._text_open:
            self.cur.children[-1] += data
        else:
            self.cur.children.append(data)
            self._text_open = True

    def handle_entityref(self, name):
        self.handle_data(entity_text(name))

    def handle_charref(self, name):
        self.handle_data(charref_text(name))

    def _boundary(self, *_):
        """Comments, declarations and processing instructions end a text node."""
        self._text_open = False

    handle_comment = handle_decl = handle_pi = unknown_decl = _boundary


def parse_html(html: str) -> Element:
    b = _TreeBuilder()
    b.feed(html or "")
    b.close()
    _number(b.root)
    return b.root


def _number(root: Element) -> None:
    """Pre-order numbering plus a tag index shared by every element of the document."""
    index: dict[str, tuple[list[int], list[Element]]] = {}
    counter = 0
    stack: list[tuple[Element, bool]] = [(root, False)]
    while stack:
        el, done = stack.pop()
        if done:
            el.post = counter
            continue
        el.pre = counter
        el.doc = index
        if el is not root:
            pres, els = index.setdefault(el.tag, ([], []))
            pres.append(counter)
            els.append(el)
        counter += 1
        stack.append((el, True))
        for c in reversed(el.children):
            if isinstance(c, Element):
                stack.append((c, False))


# --- regular markup ----------------------------------------------------------------------------
# Only forms that ``html.parser`` reads the same way in all its versions; the last group takes
# whatever is left from the first other place on, so every character belongs to some token.

_WS = r"[ \t\n\r\f]"
_NAME = r"[a-zA-Z][-a-zA-Z0-9_:.]*+"
_VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\s"'<>=`/&]++(?=[ \t\n\r\f>]|\Z))"""
_ATTRS = rf"(?:{_WS}++{_NAME}(?:={_VALUE})?)*+{_WS}*+"
_RAW = r"(?:[^<]|<(?!/\s*(?i:script|style)))*+"  # a script's or style's body, up to its first end tag
#: Text, then: a whole script or style (its start tag, its name), another tag, a comment or doctype,
#: the end of the page, or anything else.
_TOKEN = re.compile(
    rf"([^<]*+)(?:<(?:(((?i:script|style)){_ATTRS})>{_RAW}</(?i:\3)|(/{_NAME}|{_NAME}{_ATTRS}/?)"
    rf"|!--(?!-?>)(?:[^-]|-(?!-))*+--|!(?i:doctype)[^>]*+)>|\Z|(.+))", re.S)
_ATTR = re.compile(rf"({_NAME})(?:=({_VALUE}))?")
_REF = re.compile(r"&(?:([a-zA-Z][a-zA-Z0-9]*+)(?:;|(?=[^-.;]))|#([0-9]++|[xX][0-9a-fA-F]++);|(?=[^a-zA-Z#]))|(&)")


class _Irregular(Exception):
    """The page has markup that only ``html.parser`` reads."""


def _reference(m: re.Match) -> str:
    name, number, other = m.groups()
    if other:
        raise _Irregular
    return entity_text(name) if name else charref_text(number) if number else "&"


def _read_tag(tag: str) -> tuple[str, dict[str, str] | None, bool]:
    """(name, attributes: None for an end tag, has it no children?) of a tag's text between
    the angle brackets; a repeated attribute keeps its last value."""
    if tag[0] == "/":
        return tag[1:].lower(), None, False
    (name, _), *found = _ATTR.findall(tag)
    attrs = {}
    for key, value in found:
        if value[:1] in ("'", '"'):
            value = value[1:-1]
        attrs[key.lower()] = unescape(value) if "&" in value else value
    name = name.lower()
    return name, attrs, tag[-1] == "/" or name in VOID_TAGS


_read_short_tag = lru_cache(4096)(_read_tag)  # pages repeat their tags; the result is never changed
_SHORT_TAG = 256


class _Page:
    """A flat page: its texts (stripped, not empty) and, by pre-order number, the elements'
    attributes, ``post`` and texts' run ``first`` to ``last``; ``index`` has the numbers of
    each tag in document order."""
    __slots__ = ("texts", "attrs", "post", "first", "last", "index")

    def __init__(self):
        self.texts, self.attrs, self.post, self.first, self.last, self.index = [], [{}], [0], [0], [0], {}


class Node:
    """An element of a flat page."""
    __slots__ = ("page", "n")

    def __init__(self, page: _Page, n: int):
        self.page, self.n = page, n

    @property
    def attrs(self) -> dict[str, str]:
        return self.page.attrs[self.n]


def _flat(html: str) -> Node:
    """The root of a page of regular markup, else :class:`_Irregular`."""
    tokens = _TOKEN.findall(html)
    if any(t[-1] for t in tokens[-2:]):  # behind the rest comes the empty match at the end
        raise _Irregular
    page = _Page()
    texts, attributes, post, first, last, index = page.texts, page.attrs, page.post, page.first, page.last, page.index
    names, numbers, counter = ["[document]"], [0], 1

    def close(down_to: int) -> None:
        end = len(texts)
        for n in numbers[down_to:]:
            post[n], last[n] = counter, end
        del numbers[down_to:], names[down_to:]

    for text, raw, _, tag, _ in tokens:
        if text:
            text = (_REF.sub(_reference, text) if "&" in text else text).strip()
            if text:
                texts.append(text)
        if not tag and not raw:
            continue
        tag = tag or raw
        name, attrs, leaf = _read_short_tag(tag) if len(tag) <= _SHORT_TAG else _read_tag(tag)
        if attrs is None:
            at = len(names) - 1
            while at and names[at] != name:
                at -= 1
            if at:  # close up to the matching open element; else ignore
                close(at)
            continue
        if name in NON_TEXT_TAGS and not raw and not leaf:
            raise _Irregular
        if name in index:
            index[name].append(counter)
        else:
            index[name] = [counter]
        if not (leaf or raw):
            names.append(name)
            numbers.append(counter)
        counter += 1
        attributes.append(attrs)
        post.append(counter)
        first.append(len(texts))
        last.append(len(texts))
    close(0)
    return Node(page, 0)


def parse_page(html: str) -> Node | Element:
    """Root of the page for :func:`find`, :func:`find_all` and :func:`text_of`."""
    try:
        return _flat(html)
    except _Irregular:
        return parse_html(html)


@dataclass(frozen=True)
class Sel:
    """One selector step: tag name plus an optional attribute test."""
    tag: str
    attr: str | None = None
    value: str | None = None

    def matches(self, el: Element) -> bool:
        return el.tag == self.tag and self.accepts(el.attrs)

    def accepts(self, attrs: dict[str, str]) -> bool:
        if self.attr is None:
            return True
        v = attrs.get(self.attr)
        if v is None or v == self.value:
            return v is not None
        return self.attr in MULTI_VALUED_ATTRS and self.value in v.split()


def _candidates(el: Element, tag: str) -> Iterator[Element]:
    """Descendants of ``el`` named ``tag``, in document order (index bisect + scan)."""
    entry = el.doc.get(tag) if el.doc is not None else None
    if not entry:
        return
    pres, els = entry
    i = bisect_right(pres, el.pre)
    while i < len(pres) and pres[i] <= el.post:
        yield els[i]
        i += 1


def _accepted(el: Node, sel: Sel, most: int | None = None) -> list[Node]:
    """Descendants of ``el`` that ``sel`` matches, in document order; the first ``most``."""
    page, found = el.page, []
    ns, post, attrs = page.index.get(sel.tag, ()), page.post[el.n], page.attrs
    for i in range(bisect_right(ns, el.n), len(ns)):
        n = ns[i]
        if n > post:
            break
        if sel.accepts(attrs[n]):
            found.append(Node(page, n))
            if len(found) == most:
                break
    return found


def find(el: Node | Element, sel: Sel) -> Node | Element | None:
    if isinstance(el, Node):
        return next(iter(_accepted(el, sel, 1)), None)
    for d in _candidates(el, sel.tag):
        if sel.matches(d):
            return d
    return None


def find_all(el: Node | Element, sel: Sel) -> list[Node | Element]:
    if isinstance(el, Node):
        return _accepted(el, sel)
    return [d for d in _candidates(el, sel.tag) if sel.matches(d)]


def text_of(el: Node | Element) -> str:
    if isinstance(el, Node):
        return "".join(el.page.texts[el.page.first[el.n]:el.page.last[el.n]])
    parts = []
    stack = [el]
    while stack:
        node = stack.pop()
        if isinstance(node, str):
            s = node.strip()
            if s:
                parts.append(s)
        elif node.tag not in NON_TEXT_TAGS:
            stack.extend(reversed(node.children))
    return "".join(parts)


@dataclass(frozen=True)
class Field:
    """A value read from a scope element.

    ``path`` steps are applied with ``find`` (first match); with ``many`` the last step
    uses ``find_all``.  ``attr`` returns an attribute instead of text; ``prefer_attr``
    takes that attribute when non-empty, else the non-empty text (list items only).
    """
    name: str
    path: tuple[Sel, ...]
    many: bool = False
    attr: str | None = None
    prefer_attr: str | None = None

    def spark_type(self) -> T.DataType:
        return T.ArrayType(T.StringType()) if self.many else T.StringType()

    def read(self, scope: Element):
        node = scope
        steps = self.path[:-1] if self.many else self.path
        for s in steps:
            node = find(node, s)
            if node is None:
                return [] if self.many else None
        if not self.many:
            return node.attrs.get(self.attr) if self.attr else text_of(node)
        out = []
        for item in find_all(node, self.path[-1]):
            pref = item.attrs.get(self.prefer_attr) if self.prefer_attr else None
            value = pref if pref else text_of(item)
            if value:
                out.append(value)
        return out

    def empty(self):
        return [] if self.many else None


@dataclass(frozen=True)
class Records:
    """Repeated records: every element matching ``item``; a record needs its ``body``
    element (records without it are skipped); ``own`` fields read the item element,
    ``fields`` read the body."""
    name: str
    item: Sel
    body: Sel
    own: tuple[Field, ...] = field(default_factory=tuple)
    fields: tuple[Field, ...] = field(default_factory=tuple)

    def spark_type(self) -> T.DataType:
        return T.ArrayType(T.StructType(
            [T.StructField(f.name, f.spark_type(), True) for f in self.own + self.fields]))

    def read(self, scope: Element):
        out = []
        for it in find_all(scope, self.item):
            body = find(it, self.body)
            if body is None:
                continue
            rec = {f.name: f.read(it) for f in self.own}
            rec.update({f.name: f.read(body) for f in self.fields})
            out.append(rec)
        return out

    def empty(self):
        return []


def extract_one(html, specs) -> dict:
    """All spec values of one page; a spec that fails, or a page that cannot be parsed,
    yields empty values for itself only."""
    try:
        root = parse_page(html if isinstance(html, str) else "")
    except Exception:  # noqa: BLE001 - a bad page must never fail the job
        return {s.name: s.empty() for s in specs}
    out = {}
    for s in specs:
        try:
            out[s.name] = s.read(root)
        except Exception:  # noqa: BLE001 - nor one bad field the others
            out[s.name] = s.empty()
    return out


def output_schema(df: DataFrame, keep: list[str], specs) -> T.StructType:
    kept = [df.schema[c] for c in keep]
    return T.StructType(kept + [T.StructField(s.name, s.spark_type(), True) for s in specs])


#: Bytes of files per core from which a plain scan of pages is split finely enough.
SCAN_BYTES_PER_CORE = 32 * 1024 * 1024
_NARROW = {"Project", "Filter", "LogicalRelation", "LocalRelation", "LogicalRDD"}


def spread_for_parsing(pages: DataFrame) -> DataFrame:
    """Pages in partitions of about equal work, at least one a core.

    Parsing costs far more a byte than what Spark sizes partitions by, and pages that a
    shuffle or a render step made may lie in few partitions.  By the bytes of the files read:
    little is dealt evenly, one partition a core; much that a plain scan reads is split by
    bytes already and stays where it is; any other plan over much gets a rebalance, whose
    shuffle holds the pages themselves, so adaptive execution cuts it by their bytes
    (``spark.sql.adaptive.advisoryPartitionSizeInBytes``)."""
    plan = pages._jdf.queryExecution().optimizedPlan()
    nodes, narrow, scanned = [plan], True, 0
    while nodes:
        node = nodes.pop()
        narrow &= node.nodeName() in _NARROW
        children = [node.children().apply(i) for i in range(node.children().size())]
        if not children:
            scanned += int(str(node.stats().sizeInBytes()))
        nodes += children
    cores = pages.sparkSession.sparkContext.defaultParallelism
    if scanned < cores * SCAN_BYTES_PER_CORE:
        return pages.repartition(cores)
    return pages if narrow else pages.hint("rebalance")


#: Bytes (characters) and rows of pages whose values are held at a time; a longer page is alone.
SLICE_BYTES, SLICE_ROWS = 4 * 1024 * 1024, 1024


def _slices(pdf: pd.DataFrame, html_col: str) -> Iterator[pd.DataFrame]:
    """The batch in slices of bounded pages."""
    start = held = 0
    for i, html in enumerate(pdf[html_col]):
        size = len(html) if isinstance(html, str) else 0
        if i > start and (held + size > SLICE_BYTES or i - start == SLICE_ROWS):
            yield pdf.iloc[start:i]
            start, held = i, 0
        held += size
    if len(pdf):
        yield pdf.iloc[start:]


def extract(pages: DataFrame, specs, html_col: str = "html", keep: list[str] | None = None,
            partitions: int | None = None) -> DataFrame:
    """Parse each page once and add one column per spec; ``keep`` columns pass through.
    Pages are spread by their bytes first (:func:`spread_for_parsing`), or over the number
    of ``partitions`` that the caller asks for."""
    if partitions:
        pages = pages.repartition(partitions)
    keep = list(keep if keep is not None else [c for c in pages.columns if c != html_col])
    schema = output_schema(pages, keep, specs)
    specs = tuple(specs)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for part in _slices(pdf, html_col):
                values = [extract_one(h, specs) for h in part[html_col]]
                out = part[keep].reset_index(drop=True).copy()
                for s in specs:
                    out[s.name] = [v[s.name] for v in values]
                yield out

    pages = pages.select(*keep, html_col)
    return (pages if partitions else spread_for_parsing(pages)).mapInPandas(run, schema)
