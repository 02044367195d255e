"""Main text of web pages by consensus paths of each host.

First each page's containers are scored by the text they hold, and the best one's path of tags and classes
(digits generalised) is emitted. The paths are put to the vote per host in Spark. Then every page is read
again and its text taken from the containers on the winning path; a page without such a container uses
its own best one.

Nulls: a null html is empty and gives an empty text; pages without a url share the null host. Rows that are
alike get the same text each. An empty table gives no rows; other columns are not read. Very long pages are read
whole, in one pass, also where tags or quotes never close or are nested deeply.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import broadcast_if_small, small_batches, stage

#: A tag's name and the rest of the tag; a quote counts only as the start of a value, and nothing is read twice.
OPEN = re.compile(r"<(/?)([a-zA-Z][^\s/><]*+)")
REST = re.compile(r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')|=)*+>""")
ATTRIBUTE = re.compile(r"""([^\s=/>"']++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]++)))?""")
SPACE = re.compile(r"\s+")
#: Tags whose content is raw text or never shown. Without an end tag, those of TO_THE_END take the rest of the page.
RAW = frozenset("script style noscript template iframe object textarea title svg math canvas select".split())
TO_THE_END = frozenset("script style textarea title".split())
RAW_END = {t: re.compile(rf"</{t}\s*+>", re.I) for t in RAW}
#: Tags that hold no main text.
ASIDE = frozenset("nav header footer aside form button menu dialog head".split())
#: Tags that may stand in a head; any other one ends it, as </head> may be left out.
IN_HEAD = frozenset("html head title base link meta style script noscript template noframes basefont bgsound".split())
#: Words of class, id and role that mark what is no main text.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar side rail nav navbar navigation menu menubar breadcrumb breadcrumbs "
    "header masthead footer comment comments disqus reply replies notice notices cookie cookies consent gdpr popup modal overlay newsletter subscribe subscription signup "
    "share sharing social related recommended toolbar pagination pager login search widget complementary contentinfo".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
#: Blocks of text: they are not containers, and end an open one of their kind.
TEXT = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre blockquote td th tr caption address".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
CONTAINERS_PREFERRED = frozenset(("article", "main"))


def _name(tag: str, attributes: str) -> tuple[str, bool]:
    """The generalised step of a path, and whether the element is set apart from main text.

    A block of text is set apart by a whole class or role only, a container by any word of one.
    """
    words: list[str] = []
    marked = False
    if attributes:
        for kind, a, b, c in ATTRIBUTE.findall(attributes):
            kind = kind.lower()
            if kind in ("class", "id", "role"):
                value = (a or b or c).lower()
                marked = marked or not MARKS.isdisjoint(value.split() if tag in TEXT else re.split(r"[\s_-]+", value))
                if kind == "class":
                    words = sorted({re.sub(r"\d+", "#", w) for w in value.replace("/", "_").split()})
    return ".".join([tag, *words]), marked


def tokens(source: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name or text, attributes) in page order; kind is text, open or close. One pass over the page.

    A tag whose quotes never close ends at its first `>`; one without any `>` ends at the next `<`. Comments and
    raw content are skipped.
    """
    at, n = 0, len(source)
    last_end = source.rfind(">")
    quotes_hold = True  # until a quoted value runs to the end of the page
    endless: set[str] = set()  # raw tags that have no end tag from here on
    while at < n:
        start = source.find("<", at)
        if start < 0:
            start = n
        if start > at:
            yield "text", source[at:start], ""
        if start == n:
            return
        m = OPEN.match(source, start)
        if m is None:
            if source.startswith("<!--", start):
                end = source.find("-->", start + 4)
                at = end + 3 if end >= 0 else n
            elif source[start + 1 : start + 2] in ("!", "?", "/") and start < last_end:
                at = source.index(">", start) + 1
            else:
                yield "text", "<", ""
                at = start + 1
            continue
        name = m[2].lower()
        if m.end() > last_end:
            end = source.find("<", m.end())
            at = end if end >= 0 else n
            attributes = source[m.end() : at]
        else:
            rest = REST.match(source, m.end()) if quotes_hold else None
            quotes_hold = rest is not None
            at = rest.end() if rest else source.index(">", m.end()) + 1
            attributes = source[m.end() : at - 1]
        if m[1]:
            yield "close", name, ""
            continue
        yield "open", name, attributes
        if name in RAW and not (name in ("svg", "math") and attributes.endswith("/")):
            end = None if name in endless else RAW_END[name].search(source, at)
            if end:
                at = end.end()
            else:
                endless.add(name)
                at = n if name in TO_THE_END else at


class Page:
    """The blocks of a page, each with its container: (container number, text, link characters).

    Containers that have the same path of steps share a path number; a path knows its parent, its last step, its
    depth and how long it is when written out, but is written out only when asked for.
    """

    def __init__(self, source: str):
        self.parents, self.path_of = [-1], [0]  # by container
        self.path_parent, self.step, self.depth, self.length = [-1], [""], [0], [0]  # by path
        self.path_number: dict[tuple[int, str], int] = {}
        self.blocks: list[tuple[int, str, int]] = []
        self._read(source)

    def _path(self, parent: int, step: str) -> int:
        found = self.path_number.get((parent, step))
        if found is None:
            found = self.path_number[parent, step] = len(self.step)
            self.path_parent.append(parent)
            self.step.append(step)
            self.depth.append(self.depth[parent] + 1)
            self.length.append(self.length[parent] + 1 + len(step))
        return found

    def _written(self, path: int) -> str:
        steps = []
        while path > 0:
            steps.append(self.step[path])
            path = self.path_parent[path]
        return "".join(f"/{s}" for s in reversed(steps))

    def _read(self, source: str) -> None:
        stack: list[tuple[str, int, bool]] = []  # tag, container, set apart
        open_tags: dict[str, int] = defaultdict(int)  # how many of a tag are on the stack
        inline_tags: list[dict[str, int]] = [defaultdict(int)]  # the same of inline tags, for each open block
        apart, links, linked = 0, 0, 0
        pieces: list[str] = []
        opened_containers, articles = [0], 0

        def flush() -> None:
            nonlocal linked
            if pieces:
                text = SPACE.sub(" ", html.unescape("".join(pieces))).strip()
                if text:
                    self.blocks.append((opened_containers[-1], text, linked))
                pieces.clear()
            linked = 0

        def push(tag: str, own: int, marked: bool) -> None:
            nonlocal apart, links, articles
            stack.append((tag, own, marked))
            open_tags[tag] += 1
            if tag in INLINE:
                inline_tags[-1][tag] += 1
                links += tag == "a"
            else:
                inline_tags.append(defaultdict(int))
                articles += tag == "article"
            apart += marked

        def pop() -> None:
            nonlocal apart, links, articles
            tag, own, was_apart = stack.pop()
            open_tags[tag] -= 1
            if tag in INLINE:
                inline_tags[-1][tag] -= 1
                links -= tag == "a"
            else:
                inline_tags.pop()
                articles -= tag == "article"
            apart -= was_apart
            if own:
                opened_containers.pop()

        for kind, tag, attributes in tokens(source):
            if kind == "text":
                if stack and stack[-1][0] == "head" and tag.strip():
                    pop()
                if not apart:
                    pieces.append(tag)
                    if links:
                        linked += len(tag)
                continue
            if kind == "close":
                if tag not in INLINE and not apart:
                    flush()
                if (inline_tags[-1] if tag in INLINE else open_tags).get(tag):
                    while stack[-1][0] != tag:
                        pop()
                    pop()
                continue
            if stack and stack[-1][0] == "head" and tag not in IN_HEAD:
                pop()
            if tag in RAW:
                if tag not in ("svg", "math", "canvas") and not apart:
                    flush()
                continue
            if tag in VOID:
                if tag == "br" and not apart:
                    pieces.append(" ")
                elif tag == "hr" and not apart:
                    flush()
                continue
            if tag in INLINE:
                push(tag, 0, bool(attributes) and _name(tag, attributes)[1])
                continue
            if not apart:
                flush()
            while stack and stack[-1][0] in INLINE:  # what a block interrupts
                pop()
            if stack and stack[-1][0] == "p":
                pop()
            closes = CLOSES.get(tag)
            if closes:
                while stack and stack[-1][0] in closes:
                    pop()
            step, marked = _name(tag, attributes)
            if tag == "header" and articles:  # an article's own header has its heading
                marked = False
            else:
                marked = (marked and tag not in ("body", "html", "main", "article")) or tag in ASIDE
            own = 0
            if tag not in TEXT:
                parent = opened_containers[-1]
                self.parents.append(parent)
                self.path_of.append(self._path(self.path_of[parent], step))
                own = len(self.parents) - 1
                opened_containers.append(own)
            push(tag, own, marked)
        if not apart:
            flush()

    def best(self) -> tuple[str, float]:
        """The path of the best container, and its score; empty for a page without text."""
        if not self.blocks:
            return "", 0.0
        text, links = [0] * len(self.parents), [0] * len(self.parents)
        for c, block, linked in self.blocks:
            text[c] += len(block)
            links[c] += min(linked, len(block))
        score: dict[int, float] = defaultdict(float)
        for c in range(len(self.parents) - 1, -1, -1):
            if not text[c]:
                continue
            if c:
                text[self.parents[c]] += text[c]
                links[self.parents[c]] += links[c]
            path = self.path_of[c]
            kind = self.step[path].partition(".")[0]
            score[path] += (text[c] - 1.5 * links[c]) * (1.6 if kind in CONTAINERS_PREFERRED else 1.0) * (1 + 0.01 * min(self.depth[path], 20)) * (0.5 if kind in ("", "html", "body") else 1.0)
        most, length = max((v, -self.length[k]) for k, v in score.items())
        path = max(self._written(k) for k, v in score.items() if v == most and self.length[k] == -length)
        return path, most

    def text(self, path: str) -> str:
        """The text of the containers on the path, in page order; empty if the page has none."""
        number = 0
        for step in path.split("/")[1:]:
            number = self.path_number.get((number, step), -1)
            if number < 0:
                return ""
        inside = [False] * len(self.parents)
        for c, own in enumerate(self.path_of):
            inside[c] = own == number or (c > 0 and inside[self.parents[c]])
        return " ".join(t for c, t, _ in self.blocks if inside[c])


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def votes(pages: DataFrame) -> DataFrame:
    """host, path, votes, score: what the pages' best containers say."""
    small_batches(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best = [Page(x or "").best() for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([p for p, _ in best], pa.string()), pa.array([s for _, s in best], pa.float64())], ["host", "path", "score"])

    each = pages.select(host(F.col("url")).alias("host"), "html").mapInArrow(run, "host string, path string, score double").where("path <> ''")
    return each.groupBy("host", "path").agg(F.count("*").alias("votes"), F.sum(F.round("score")).alias("score"))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars and path (the host's, or null) for each row of pages(page_id, url, html)."""
    winners = votes(pages).groupBy("host").agg(F.max_by("path", F.struct("votes", "score", "path")).alias("path"))
    winners = broadcast_if_small(stage(winners, "host-paths"))
    small_batches(pages.sparkSession)
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for source, path in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                page = Page(source or "")
                text = page.text(path) if path is not None else ""
                texts.append(text or page.text(page.best()[0]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64()), batch.column(3)], ["page_id", "url", "text", "n_chars", "path"])

    keyed = pages.select("page_id", "url", "html", host(F.col("url")).alias("host")).join(winners, "host", "left")
    return keyed.select("page_id", "url", "html", "path").mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars bigint, path string")
