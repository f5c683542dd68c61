"""Elements out of a table of HTML pages.

Real pages are not well-formed XML, so the built-in XPath functions fail on them.
Each page is parsed once, inside its task, by the standard library's parser; pages
stay where Spark put them, so there is no shuffle.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Ship this module's code with each task, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Elements that never have content (HTML standard, fixed values).
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
# Elements that end an open paragraph, and elements that an opening tag ends unless one of
# the second set lies between (HTML standard, fixed values).
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
ENDED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr"}, {"table"}),
}
# Where an open paragraph cannot be seen from inside.
PARAGRAPH_SCOPE = frozenset("button caption td th table template object marquee svg".split())


@dataclass
class Node:
    """An element with its texts and child elements in page order."""

    tag: str
    attrs: dict[str, str]
    content: list["Node | str"] = field(default_factory=list)

    @property
    def children(self) -> list["Node"]:
        return [c for c in self.content if isinstance(c, Node)]

    @property
    def texts(self) -> list[str]:
        return [c for c in self.content if isinstance(c, str)]

    def walk(self) -> Iterator["Node"]:
        stack = [self]
        while stack:
            node = stack.pop()
            yield node
            stack.extend(reversed(node.children))

    def titles(self) -> Iterator["Node"]:
        """Page titles, without the titles of inline drawings."""
        stack = [self]
        while stack:
            node = stack.pop()
            if node.tag == "title":
                yield node
            elif node.tag not in ("svg", "math"):
                stack.extend(reversed(node.children))

    def kids(self, tag: str) -> list["Node"]:
        return [c for c in self.children if c.tag == tag]

    def has_class(self, word: str) -> bool:
        return word in self.attrs.get("class", "").split()

    def all_text(self) -> str:
        out, stack = [], [self]
        while stack:
            item = stack.pop()
            if isinstance(item, str):
                out.append(item)
            else:
                stack.extend(reversed(item.content))
        return "".join(out)


class _Open(HTMLParser):
    """Follows which elements are open. Subclasses are told of each element (``opened``, with
    its depth), of the depth below which all are closed (``closed``), and of texts."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tags = [""]
        self._drawings = 0

    def opened(self, tag: str, attrs: list[tuple[str, str | None]], depth: int) -> None:
        raise NotImplementedError

    def closed(self, depth: int) -> None:
        raise NotImplementedError

    def _cut(self, depth: int) -> None:
        self._drawings -= sum(t in ("svg", "math") for t in self.tags[depth:])
        del self.tags[depth:]
        self.closed(depth)

    def _end_before(self, ended, within) -> None:
        """End the nearest open element of ``ended``, unless one of ``within`` is nearer."""
        for depth in range(len(self.tags) - 1, 0, -1):
            if self.tags[depth] in ended:
                self._cut(depth)
                return
            if self.tags[depth] in within:
                return

    def _start(self, tag, attrs, alone: bool) -> None:
        if tag in ENDS_PARAGRAPH:
            self._end_before({"p"}, PARAGRAPH_SCOPE)
        if tag in ENDED_BY:
            self._end_before(*ENDED_BY[tag])
        self.opened(tag, attrs, len(self.tags))
        if tag in VOID or alone:
            self.closed(len(self.tags))
        else:
            self.tags.append(tag)
            self._drawings += tag in ("svg", "math")

    def handle_starttag(self, tag, attrs):
        self._start(tag, attrs, False)

    def handle_startendtag(self, tag, attrs):
        # Only void elements and those of an inline drawing end at a slash.
        self._start(tag, attrs, self._drawings > 0 or tag in ("svg", "math"))

    def handle_endtag(self, tag):
        for depth in range(len(self.tags) - 1, 0, -1):
            if self.tags[depth] == tag:
                self._cut(depth)
                return


class _Tree(_Open):
    def __init__(self) -> None:
        super().__init__()
        self.root = Node("", {})
        self.open = [self.root]

    def opened(self, tag, attrs, depth):
        node = Node(tag, {k: v or "" for k, v in attrs})
        self.open[-1].content.append(node)
        self.open.append(node)

    def closed(self, depth):
        del self.open[depth:]

    def handle_data(self, data):
        self.open[-1].content.append(data)


class _Elements(_Open):
    """Titles and links of a page as they go by, without a tree: what is kept is their texts.
    Titles of inline drawings are none, and a title within a title is part of it."""

    def __init__(self) -> None:
        super().__init__()
        self.found: list[tuple[str, str | None, list[str]]] = []
        self._listening: list[tuple[int, list[str]]] = []
        self._in_title = 0

    def opened(self, tag, attrs, depth):
        if tag == "a":
            href = next((v or "" for k, v in reversed(attrs) if k == "href"), None)
            if href is None:
                return
            entry = ("link", href, [])
        elif tag == "title" and not self._drawings and not self._in_title:
            entry = ("title", None, [])
            self._in_title = depth
        else:
            return
        self.found.append(entry)
        self._listening.append((depth, entry[2]))

    def closed(self, depth):
        if self._in_title >= depth:
            self._in_title = 0
        while self._listening and self._listening[-1][0] >= depth:
            self._listening.pop()

    def handle_data(self, data):
        for _, texts in self._listening:
            texts.append(data)


def parse_html(html: str) -> Node:
    tree = _Tree()
    tree.feed(html)
    tree.close()
    return tree.root


def extract_rows(
    pages: DataFrame, id_col: str, html_col: str, rows_of: Callable[[Node], list[tuple]], fields: str
) -> DataFrame:
    """One output row per tuple ``rows_of`` finds in a page, with the page's id and
    the position in the page in front. ``fields`` is a DDL list of the tuple's columns."""
    names = [part.strip().split()[0] for part in fields.split(",")]
    id_type = pages.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [
                (page_id, pos, *row)
                for page_id, html in zip(batch[id_col], batch[html_col])
                if html is not None
                for pos, row in enumerate(rows_of(parse_html(html)))
            ]
            yield pd.DataFrame(out, columns=[id_col, "pos", *names])

    return pages.select(id_col, html_col).mapInPandas(run, f"{id_col} {id_type}, pos int, {fields}")


def page_elements(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Titles and links of every page from one parse: the page's id, ``kind`` (title or link),
    ``pos`` among those of its kind, ``href`` (null for titles) and ``text``. Arrow batches,
    without a tree of the page. A null page has none."""
    kind = pages.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                ids, kinds, places, hrefs, texts = [], [], [], [], []
                for page_id, html in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                    if not html.is_valid:
                        continue
                    parser, seen = _Elements(), {"title": 0, "link": 0}
                    parser.feed(html.as_py())
                    parser.close()
                    for what, href, heard in parser.found:
                        ids.append(page_id)
                        kinds.append(what)
                        places.append(seen[what])
                        hrefs.append(href)
                        texts.append("".join(heard))
                        seen[what] += 1
                columns = [pa.array(ids, part.schema.field(0).type), pa.array(kinds, pa.string()), pa.array(places, pa.int32()), pa.array(hrefs, pa.string()), pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, [id_col, "kind", "pos", "href", "text"])

    return pages.select(id_col, html_col).mapInArrow(run, f"`{id_col}` {kind.simpleString()}, kind string, pos int, href string, text string")


def page_titles(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """The text of each ``<title>``."""
    found = page_elements(pages, id_col, html_col).where("kind = 'title'")
    return found.select(id_col, "pos", F.col("text").alias("title"))


def page_links(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Every ``<a href>`` with its link text, in page order."""
    found = page_elements(pages, id_col, html_col).where("kind = 'link'")
    return found.select(id_col, "pos", "href", F.col("text").alias("link_text"))


def _product(card: Node) -> tuple:
    divs = card.kids("div")
    image_links = [a for d in divs for a in d.kids("a")]
    alt = next((i.attrs.get("alt") for a in image_links for i in a.kids("img")), None)
    price = next((t for d in divs for p in d.kids("p") if p.has_class("price_color") for t in p.texts), None)
    stock = "".join(
        t for d in divs for p in d.kids("p") if p.has_class("instock") and p.has_class("availability") for t in p.texts
    )
    rating = next((p.attrs["class"] for p in card.kids("p") if p.has_class("star-rating")), None)
    url = next((a.attrs.get("href") for d in divs if d.has_class("image_container") for a in d.kids("a")), None)
    return (
        alt,
        price,
        stock.strip(),
        None if rating is None else " ".join(w for w in rating.split() if w != "star-rating"),
        url,
    )


def product_items(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Title, price, stock note, rating word and link of every product card. A card
    that lacks a field keeps its row, with null there."""
    return extract_rows(
        pages,
        id_col,
        html_col,
        lambda root: [_product(n) for n in root.walk() if n.tag == "article" and n.has_class("product_pod")],
        "title string, price string, in_stock string, rating string, url string",
    )
