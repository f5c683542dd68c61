"""Main text of web pages by container paths on which the pages of a host agree.

A page's containers are scored: the text in them that is neither boilerplate nor a link,
times its share of all their text. Every page votes for its best containers' paths, made of
tags and classes with digits generalised, and Spark adds the votes of each host. A second
pass takes the text below the host's winning paths; a page that has none of them, or whose
own best container is not among them and holds far more, uses its own best container.

Elements for menus, notices, adverts, forms, comments and the like are left out by tag,
role, class or id, hidden ones and paragraphs too; what is left out only for being a form or for
its class is kept after all where it holds the article. Pages need not be well-formed.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.operators.layout import many_to_one, replicate_counted

#: Paths of a host that count as winning: those with this share of the best one's votes.
WINNING_SHARE = 0.05
#: An element left out only for being a form or for its class is kept after all if it holds
#: this share of a page's text and a main heading, or the second on a page without one.
MOSTLY, NEARLY_ALL = 0.5, 0.9

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|<[!?/][^>]*>""", re.S)
_ATTRIBUTE = re.compile(r"""(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?(?=[\s/]|$)""", re.I)
_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe object svg annotation textarea select canvas audio video title".split())
INLINE = frozenset("math mi mn mo ms mtext mrow msup msub msubsup mfrac msqrt mroot mover munder mstyle mspace semantics a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var".split())
CONTAINERS = frozenset("body div section article main td blockquote".split())
LEFT_OUT = frozenset("nav footer aside form button dialog menu head fieldset".split())
LEFT_OUT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
#: Words of a class or id that mark an element as no part of the article, whatever else it is.
SURELY_OUT = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion comment comments commentlist disqus reply replies respond cookie cookies consent gdpr".split()
)
#: The same, unless a word of ``CONTENT`` stands beside it.
LIKELY_OUT = frozenset(
    "banner notice alert newsletter subscribe subscription signup sidebar menu nav navbar navigation breadcrumb breadcrumbs share sharing social related recommended "
    "recommendations widget widgets footer header masthead popup modal overlay login search pagination pager toolbar skip".split()
)
CONTENT = frozenset("content article post entry story main text with without no has body".split())
# An opening tag ends an open element of the first kind that is not outside one of the second.
_ENDS = {
    "li": (frozenset({"li"}), frozenset({"ul", "ol"})),
    "dt": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "dd": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "td": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
    "th": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
    "tr": (frozenset({"tr"}), frozenset({"table"})),
}


KEPT, SOFT, HARD = 0, 1, 2


@lru_cache(maxsize=20_000)
def _about(tag: str, rest: str, inside_article: bool) -> tuple[int, str]:
    """Whether an element is kept, left out for being a form or for its class (soft) or for
    what it is (hard), and its step of a path."""
    found = {name.lower(): (value or "").strip("\"'") for name, value in _ATTRIBUTE.findall(rest)}
    classes = sorted({re.sub(r"\d+", "#", c) for c in found.get("class", "").lower().split()})
    step = ".".join([tag, *classes])
    if tag == "form":
        return SOFT, step
    if tag in LEFT_OUT or tag == "header" and not inside_article:
        return HARD, step
    if tag in ("html", "body", "article", "main"):
        return KEPT, step
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", found.get("style", ""), re.I):
        return HARD, step
    if found.get("role", "").lower() in LEFT_OUT_ROLES:
        return HARD, step
    words = set(_WORD.findall(_CAMEL.sub(" ", found.get("class", "") + " " + found.get("id", "")).lower()))
    out = bool(words & SURELY_OUT) or bool(words & (LIKELY_OUT - {"header"} if inside_article else LIKELY_OUT)) and not words & CONTENT
    return SOFT if out else KEPT, step


class Page:
    """Blocks of a page in order, each below its chain of elements.

    A path is a number for its parent's path and a step, so a deep page takes no more memory
    than it has elements; it is spelt out where it is voted for."""

    def __init__(self, source: str):
        self._steps: dict[tuple[int, str], int] = {}
        self._spelt: list[tuple[int, str]] = [(-1, "")]
        self._begin()
        self._read(source, frozenset())
        exempt = self._holding_most()
        if exempt:
            self._begin()
            self._read(source, exempt)

    def _begin(self) -> None:
        # Of each element: its parent, its path and whether it may be a container.
        self.parent, self.path, self.container = [-1], [0], [False]
        # Of each kept block: its element, its text, and the characters of it in links.
        self.blocks: list[tuple[int, str, int]] = []
        # Characters of text that is left out, by element.
        self.other: dict[int, int] = {}
        # Elements left out softly, and those that are or hold a main heading.
        self._soft: list[int] = []
        self._heads: list[int] = []

    def _step(self, above: int, step: str) -> int:
        number = self._steps.get((above, step))
        if number is None:
            number = self._steps[above, step] = len(self._spelt)
            self._spelt.append((above, step))
        return number

    def spelt(self, path: int) -> str:
        steps = []
        while path > 0:
            path, step = self._spelt[path]
            steps.append(step)
        return "".join(">" + s for s in reversed(steps))

    def known(self, spelt: str) -> int | None:
        """The number of a path, if the page has it."""
        path = 0
        for step in spelt.split(">")[1:]:
            path = self._steps.get((path, step), -1)
            if path < 0:
                return None
        return path

    def _holding_most(self) -> frozenset[int]:
        """Elements left out softly that hold most of the page's text."""
        if not self._soft:
            return frozenset()
        total, heads = [0] * len(self.parent), [0] * len(self.parent)
        for element, text, _ in self.blocks:
            total[element] += len(text)
        for element, chars in self.other.items():
            total[element] += chars
        for element in self._heads:
            heads[element] += 1
        for element in range(len(self.parent) - 1, 0, -1):
            total[self.parent[element]] += total[element]
            heads[self.parent[element]] += heads[element]
        page = total[0]
        return frozenset(e for e in self._soft if page and (total[e] >= MOSTLY * page and heads[e] or total[e] >= NEARLY_ALL * page and not heads[0]))

    def _read(self, source: str, exempt: frozenset[int]) -> None:
        stack: list[tuple[str, int, bool]] = [("", 0, False)]  # tag, element, left out
        pieces: list[str] = []
        link_chars = links = articles = at = 0
        raw_end = 0

        def end_block() -> None:
            nonlocal link_chars
            text = " ".join("".join(pieces).split())
            pieces.clear()
            if text:
                _, element, out = stack[-1]
                if out:
                    self.other[element] = self.other.get(element, 0) + len(text)
                else:
                    self.blocks.append((element, text, min(link_chars, len(text))))
            link_chars = 0

        def text_at(start: int, stop: int) -> None:
            nonlocal link_chars
            if start < stop:
                text = source[start:stop]
                if "&" in text:
                    text = html.unescape(text)
                pieces.append(text)
                if links:
                    link_chars += len(text)

        def pop_to(place: int) -> None:
            nonlocal links, articles
            for tag, _, _ in stack[place:]:
                links -= tag == "a"
                articles -= tag == "article"
            del stack[place:]

        def end_paragraph() -> None:
            """An open paragraph ends where the next block begins."""
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == "p":
                    pop_to(i)
                    return
                if stack[i][0] not in INLINE:
                    return

        for found in _TAG.finditer(source):
            if found.start() < raw_end:
                continue
            text_at(at, found.start())
            at = found.end()
            tag = found[2]
            if tag is None:
                continue
            tag = tag.lower()
            if found[1]:
                if tag == "p" or tag not in INLINE:
                    end_block()
                place = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == tag), 0)
                if place and (tag not in INLINE or all(s[0] in INLINE or s[0] == "p" for s in stack[place:])):
                    if any(s[2] != stack[place - 1][2] for s in stack[place:]):
                        end_block()
                    pop_to(place)
                continue
            if tag in RAW:
                close = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(source, at)
                at = raw_end = close.end() if close else (len(source) if tag in ("script", "style") else at)
                continue
            if tag in VOID:
                if tag in ("br", "hr"):
                    pieces.append(" ")
                if tag == "hr":
                    end_block()
                    end_paragraph()
                continue
            if tag not in INLINE:
                end_block()
                end_paragraph()
            if tag == "p":
                _, above, above_out = stack[-1]
                stack.append(("p", above, above_out or bool(found[3].strip()) and _about("p", found[3], articles > 0)[0] != KEPT))
                continue
            if tag in _ENDS:
                ended, within = _ENDS[tag]
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] in ended:
                        end_block()
                        pop_to(i)
                        break
                    if stack[i][0] in within:
                        break
            if found[3].endswith("/") and tag in INLINE:
                continue
            state, step = _about(tag, found[3], articles > 0)
            _, above, above_out = stack[-1]
            out = state == HARD or state == SOFT and len(self.parent) not in exempt
            if tag in INLINE:
                if out and not above_out:
                    end_block()
                element = above
            else:
                element = len(self.parent)
                self.parent.append(above)
                self.path.append(self._step(self.path[above], step) if tag != "html" else 0)
                self.container.append(tag in CONTAINERS)
                if state == SOFT:
                    self._soft.append(element)
                if tag in ("h1", "main"):
                    self._heads.append(element)
            stack.append((tag, element, out or above_out))
            links += tag == "a"
            articles += tag == "article"
        text_at(at, len(source))
        end_block()

    def scores(self) -> dict[int, float]:
        """Score of each container path, the best of equal paths counting. A container that
        adds nothing to one inside it leaves the word to that one."""
        clean, total, depth = [0.0] * len(self.parent), [0.0] * len(self.parent), [0] * len(self.parent)
        for element, text, link_chars in self.blocks:
            total[element] += len(text)
            clean[element] += len(text) - link_chars if link_chars < 0.8 * len(text) else 0
        for element, chars in self.other.items():
            total[element] += chars
        for element in range(1, len(self.parent)):
            depth[element] = depth[self.parent[element]] + 1 if self.path[element] else 0
        for element in range(len(self.parent) - 1, 0, -1):
            clean[self.parent[element]] += clean[element]
            total[self.parent[element]] += total[element]
        inner = [False] * len(self.parent)
        for element in range(len(self.parent) - 1, 0, -1):
            above = self.parent[element]
            if (self.container[element] or inner[element]) and clean[element] == clean[above] and total[element] == total[above]:
                inner[above] = True
        out: dict[int, float] = {}
        for element in range(len(self.parent)):
            if clean[element] > 0 and not inner[element] and (self.container[element] or element == 0):
                last = self._spelt[self.path[element]][1].split(".")[0]
                bonus = 1.3 if last in ("article", "main") else 1.0
                bonus += 0.002 * min(depth[element], 20)  # of equals, the inner one
                score = bonus * clean[element] ** 2 / total[element]
                out[self.path[element]] = max(out.get(self.path[element], 0.0), score)
        return out

    def text_below(self, path: int) -> str | None:
        """Kept blocks below the elements of a path, in page order, or None without one."""
        inside = [False] * len(self.parent)
        for element in range(len(self.parent)):
            inside[element] = self.path[element] == path and (self.container[element] or element == 0) or element > 0 and inside[self.parent[element]]
        if not any(inside):
            return None
        return " ".join(text for element, text, _ in self.blocks if inside[element])


def _best(page: Page, scores: dict[int, float]) -> int:
    """The path with the highest score; of equal ones the last as spelt."""
    top = max(scores.values())
    equal = [p for p, score in scores.items() if score == top]
    return equal[0] if len(equal) == 1 else max(equal, key=page.spelt)


def votes(source: str | None) -> dict[str, float]:
    """A page's votes: one for its best container, and for those of half its score or more
    half of their share of it."""
    page = Page(source or "")
    scores = page.scores()
    if not scores:
        return {}
    best = _best(page, scores)
    return {page.spelt(path): 1.0 if path == best else score / scores[best] / 2 for path, score in scores.items() if score >= scores[best] / 2}


def main_text(source: str | None, winning: Sequence[str] = ()) -> str:
    """The main text of a page, given its host's winning paths, best first."""
    page = Page(source or "")
    scores = page.scores()
    if not scores:
        return ""
    own = _best(page, scores)
    agreed = next((p for p in map(page.known, winning) if p in scores), None)
    chosen = agreed if agreed is not None and scores[agreed] >= 0.4 * scores[own] else own
    return page.text_below(chosen) or ""


def _host(url: str):
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#:]+)", 1)), F.lit(""))


def winning_paths(pages: DataFrame, url: str = "url", source: str = "html") -> DataFrame:
    """``host`` and ``paths``, best first. Votes are added within each task before they are
    shuffled. Pages without a host in their url do not vote."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            added: dict[tuple[str, str], float] = {}
            for host, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for path, share in votes(text).items():
                    added[host, path] = added.get((host, path), 0.0) + share
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in added], pa.string()), pa.array([k[1] for k in added], pa.string()), pa.array([round(v * 1000) for v in added.values()], pa.int64())],
                ["host", "path", "votes"],
            )

    voted = pages.select(_host(url).alias("host"), source).where("host != ''").mapInArrow(run, "host string, path string, votes bigint")
    counted = voted.groupBy("host", "path").agg(F.sum("votes").alias("votes"))
    # The best first, then those within reach of it: no more than all votes divided by that share.
    best = counted.groupBy("host").agg(F.max("votes").alias("best"))
    won = many_to_one(counted, best, ["host"]).where(F.col("votes") >= WINNING_SHARE * F.col("best"))
    placed = F.array_sort(F.collect_list(F.struct((-F.col("votes")).alias("votes"), "path")))
    return won.groupBy("host").agg(F.transform(placed, lambda x: x["path"]).alias("paths"))


def extract(pages: DataFrame, keep: Sequence[str] = ("page_id", "url"), url: str = "url", source: str = "html", name: str = "text", winners: DataFrame | None = None) -> DataFrame:
    """The columns ``keep`` and each page's main text.

    A null page counts as empty and gives an empty text; repeated pages stay; a null url has
    no host, so the page's own best container counts. Other columns are not read."""
    winners = winning_paths(pages, url, source) if winners is None else winners
    fields = [pages.schema[c] for c in keep]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + [f"`{name}` string"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(t, p or ()) for t, p in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[2:], pa.array(texts, pa.string())], [*keep, name])

    rows = pages.select(F.col(source).alias("_html"), _host(url).alias("host"), *[F.col(c).alias(f"_{i}") for i, c in enumerate(keep)])
    placed = replicate_counted(winners)
    joined = many_to_one(rows, placed, ["host"])
    return joined.select("_html", "paths", *[F.col(f"_{i}").alias(c) for i, c in enumerate(keep)]).mapInArrow(run, schema)
