"""One scan of a page into its tags and text blocks.

``scan`` cuts a page by a single regular expression into comments, whole script and style elements,
declarations, tags and text. Links, robots directives, redirects and metadata read the table it gives
(``table``), segmentation the pieces between its block tags (``pieces``): a link in a script, a comment
or another attribute's value is no link, attribute values may be quoted, unquoted or missing, and
character references are decoded as the HTML standard says.

Both are Arrow functions over a batch of pages; a page of any length is one pass of compiled patterns.
What they return is joined, filtered and grouped by Spark.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"  # comment
    r"|<(?P<raw>script|style)(?=[\s/>])[^>]*+>.*?(?:</(?P=raw)\s*+>|\Z)"  # kept whole
    r"|<[!?][^>]*+>"  # declaration
    r"""|<(?P<tag>/?[a-z][^\s/>]*+)(?P<attrs>(?:"[^"]*+"|'[^']*+'|[^'">]++)*+)>"""
    r"|<(?P<loose>/?[a-z][^\s/>]*+)(?P<rest>[^>]*+)>",  # with a stray quote
    re.IGNORECASE | re.DOTALL)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>][^\s>]*)))?""")
#: Elements whose text the table gives.
TEXT_OF = ("a", "title", "h1")
#: Pages of a batch that are scanned before what was found goes into Arrow arrays.
RUN = 128

TABLE = "array<struct<name:string,attrs:map<string,string>,text:string>>"
PIECES = "array<struct<text:string,w:int,lw:int,hrefs:array<string>>>"


def scan(page: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name, content): ("open", name, attribute text), ("close", name, ""), ("text", "", decoded text)."""
    at = 0
    for m in _MARKUP.finditer(page):
        if m.start() > at:
            yield "text", "", unescape(page[at:m.start()])
        at = m.end()
        name = m["tag"] or m["loose"]
        if name:
            name = name.lower()
            if name[0] == "/":
                yield "close", name[1:], ""
            else:
                yield "open", name, m["attrs"] or m["rest"] or ""
    if at < len(page):
        yield "text", "", unescape(page[at:])


def attributes(text: str) -> dict[str, str]:
    """Attributes by lower-case name, values decoded; of equal names the first counts."""
    out: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(text):
        out.setdefault(name.lower(), unescape("".join(values)))
    return out


def squeeze(text: str) -> str:
    return " ".join(text.split())


def tags_of(page: str, names: frozenset[str] | None) -> list[tuple[str, dict[str, str], str]]:
    """(name, attributes, text) of the opening tags of ``names`` (None: all), in order. The text is that of
    the element for TEXT_OF, up to its closing tag (for ``a`` also to the next one), else empty."""
    out: list[list] = []
    open_: dict[str, tuple[int, list[str]]] = {}

    def close(name):
        at, parts = open_.pop(name)
        out[at][2] = squeeze(" ".join(parts))

    for kind, name, content in scan(page):
        if kind == "text":
            for _, parts in open_.values():
                parts.append(content)
        elif name in open_ and (kind == "close" or name == "a"):
            close(name)
        if kind == "open" and (names is None or name in names):
            out.append([name, attributes(content), ""])
            if name in TEXT_OF and name not in open_:
                open_[name] = (len(out) - 1, [])
    for name in list(open_):
        close(name)
    return [tuple(x) for x in out]


def pieces_of(page: str, boundaries: frozenset[str]) -> list[tuple[str, int, int, list[str]]]:
    """(text, words, words inside links, link targets) of the page's runs of text between boundary tags,
    without the head; runs without text are left out."""
    out, parts, linked, hrefs = [], [], [], []
    in_head = in_link = False

    def flush():
        text = squeeze(" ".join(parts))
        if text:
            out.append((text, text.count(" ") + 1, sum(len(x.split()) for x in linked), list(hrefs)))
        parts.clear()
        linked.clear()
        hrefs.clear()

    for kind, name, content in scan(page):
        if name == "head":
            in_head = kind == "open"
        elif name == "body" and kind == "open":
            in_head = False
        if in_head:
            continue
        if kind == "text":
            parts.append(content)
            if in_link:
                linked.append(content)
            continue
        if name in boundaries:
            flush()
        elif name == "a":
            in_link = kind == "open"
            if in_link:
                href = attributes(content).get("href")
                if href is not None:
                    hrefs.append(href)
    flush()
    return out


def annotated_of(page: str, boundaries: frozenset[str]) -> tuple[list[str], list[tuple[str, str]]]:
    """Texts of the page's runs between boundary tags with ``|LINK_n|`` in place of the n-th link's content,
    and (target, anchor text) of each link. A link ends at its closing tag or the next link; boundaries
    inside it are part of it."""
    texts, parts, links, anchor = [], [], [], None
    in_head = False

    def flush():
        text = squeeze(" ".join(parts))
        if text:
            texts.append(text)
        parts.clear()

    def close():
        links[-1] = (links[-1][0], squeeze(" ".join(anchor)))

    for kind, name, content in scan(page):
        if name == "head":
            in_head = kind == "open"
        elif name == "body" and kind == "open":
            in_head = False
        if in_head:
            continue
        if kind == "text":
            (parts if anchor is None else anchor).append(content)
            continue
        if name == "a" and anchor is not None:
            close()
            anchor = None
        if name == "a" and kind == "open":
            href = attributes(content).get("href")
            if href is not None:
                parts.append(f"|LINK_{len(links)}|")
                links.append((href, ""))
                anchor = []
        elif name in boundaries and anchor is None:
            flush()
    if anchor is not None:
        close()
    flush()
    return texts, links


def _offsets(lengths: list[int]) -> pa.Array:
    ends, at = [0], 0
    for n in lengths:
        at += n
        ends.append(at)
    return pa.array(ends, pa.int32())


def _strings(values) -> pa.Array:
    return pa.array(values, pa.string())


def _table_array(pages: list[list[tuple]]) -> pa.Array:
    rows = [r for p in pages for r in p]
    items = [kv for _, attrs, _ in rows for kv in attrs.items()]
    maps = pa.MapArray.from_arrays(_offsets([len(a) for _, a, _ in rows]), _strings([k for k, _ in items]),
                                   _strings([v for _, v in items]))
    found = pa.StructArray.from_arrays([_strings([n for n, _, _ in rows]), maps, _strings([t for _, _, t in rows])],
                                       ["name", "attrs", "text"])
    return pa.ListArray.from_arrays(_offsets([len(p) for p in pages]), found)


def _pieces_array(pages: list[list[tuple]]) -> pa.Array:
    rows = [r for p in pages for r in p]
    hrefs = pa.ListArray.from_arrays(_offsets([len(r[3]) for r in rows]), _strings([h for r in rows for h in r[3]]))
    found = pa.StructArray.from_arrays([_strings([r[0] for r in rows]), pa.array([r[1] for r in rows], pa.int32()),
                                        pa.array([r[2] for r in rows], pa.int32()), hrefs], ["text", "w", "lw", "hrefs"])
    return pa.ListArray.from_arrays(_offsets([len(p) for p in pages]), found)


def _in_runs(build, pages: pa.Array) -> pa.Array:
    """``build`` of a list of pages, RUN pages at a time: what was found in them is only held as Arrow arrays."""
    runs = range(0, max(1, len(pages)), RUN)
    return pa.concat_arrays([build([p or "" for p in pages.slice(i, RUN).to_pylist()]) for i in runs])


def table(page: Column | str, *names: str) -> Column:
    """The page's opening tags of ``names`` (all if none given), in order: ``name``, ``attrs``, ``text``.
    A null page has none."""
    wanted = frozenset(names) or None

    @F.arrow_udf(TABLE)
    def of(pages: pa.Array) -> pa.Array:
        return _in_runs(lambda run: _table_array([tags_of(p, wanted) for p in run]), pages)

    return of(page)


def pieces(page: Column | str, boundaries: list[str]) -> Column:
    """The page's runs of text between ``boundaries``: ``text``, ``w`` words, ``lw`` of them in links, ``hrefs``."""
    tags = frozenset(boundaries)

    @F.arrow_udf(PIECES)
    def of(pages: pa.Array) -> pa.Array:
        return _in_runs(lambda run: _pieces_array([pieces_of(p, tags) for p in run]), pages)

    return of(page)


ANNOTATED = "struct<texts:array<string>,links:array<struct<href:string,anchor:string>>>"


def annotated(page: Column | str, boundaries: list[str]) -> Column:
    """``texts`` of the page's runs with link placeholders and the ``links`` (``href``, ``anchor``) they number."""
    tags = frozenset(boundaries)

    def build(run: list[str]) -> pa.Array:
        found = [annotated_of(p, tags) for p in run]
        links = [x for _, ls in found for x in ls]
        texts = pa.ListArray.from_arrays(_offsets([len(t) for t, _ in found]), _strings([x for t, _ in found for x in t]))
        pairs = pa.StructArray.from_arrays([_strings([h for h, _ in links]), _strings([a for _, a in links])], ["href", "anchor"])
        return pa.StructArray.from_arrays([texts, pa.ListArray.from_arrays(_offsets([len(ls) for _, ls in found]), pairs)],
                                          ["texts", "links"])

    @F.arrow_udf(ANNOTATED)
    def of(pages: pa.Array) -> pa.Array:
        return _in_runs(build, pages)

    return of(page)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def get(attrs, name: str) -> Column:
    return F.try_element_at(attrs, F.lit(name))


def first_tag(tags, name: str, condition) -> Column:
    """Attributes of the first tag of a name for which ``condition`` (of its attributes) holds."""
    hits = F.filter(_c(tags), lambda t: (t["name"] == name) & F.coalesce(condition(t["attrs"]), F.lit(False)))
    return F.try_element_at(hits, F.lit(1))["attrs"]


def elements(tags, name: str) -> Column:
    """Text of every element of a name (one of TEXT_OF)."""
    return F.transform(F.filter(_c(tags), lambda t: t["name"] == name), lambda t: t["text"])
