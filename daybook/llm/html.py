"""Main text of web pages: differencing against the nearest URL, and a check of structure."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from html import unescape
from typing import NamedTuple

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import slices, stored
from daybook.operators.bloom import bloom_filter, maybe_in

SEPARATOR = "\n\n"

# Names in the HTML standard, and words that mark furniture in class, id
# and role.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
RAW = {"script", "style", "noscript", "template", "iframe", "svg", "textarea", "title", "xmp"}
BLOCK = {
    "address", "article", "blockquote", "body", "dd", "details", "div", "dl", "dt", "fieldset", "figcaption", "figure",
    "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hr", "html", "li", "main", "nav", "ol", "p",
    "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul", "aside",
}
#: Elements that never hold the article, and those that may.
FURNITURE = {"nav", "header", "footer", "aside", "menu", "head", "button", "select", "dialog"}
MAYBE = {"form"}
MARKS = {
    "ad", "ads", "adv", "advert", "adverts", "advertisement", "advertisements", "advertising", "banner", "banners", "breadcrumb", "breadcrumbs",
    "complementary", "consent", "contentinfo", "cookie", "cookies", "footer", "gdpr", "header", "masthead", "menu", "menus", "nav", "navbar",
    "navigation", "newsletter", "notice", "notices", "popup", "promo", "promotion", "related", "search", "share", "sharing", "sidebar", "sidebars",
    "social", "sponsor", "sponsored", "sponsors", "subscribe", "subscription", "toolbar", "widget", "widgets",
}
COMMENTS = {"comment", "comments", "disqus"}
#: Words that say nothing by themselves beside a mark: site-header, ad-slot, sidebar-left.
NEUTRAL = {
    "area", "bar", "bottom", "box", "block", "button", "buttons", "container", "content", "form", "global", "icons", "inner", "item", "items", "left",
    "link", "links", "list", "main", "outer", "page", "panel", "primary", "right", "row", "secondary", "section", "site", "slot", "space", "sticky",
    "top", "unit", "wrap", "wrapper", "posts", "stories", "articles", "form", "signup", "menu", "media", "text", "message",
}
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_PLAIN = re.compile(r"[^>\"']*")
_ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
_CELLS = {"td", "th"}
_ENDS = dict.fromkeys(BLOCK - {"li", "tr", "td", "th", "dt", "dd"}, {"p"}) | {
    "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", *_CELLS}, "td": _CELLS, "th": _CELLS,
}


@lru_cache(maxsize=4096)
def mark_of(value: str) -> str:
    """What a class, id or role says of its element: comments, furniture or nothing.

    Whole names count: each of a name's words must be a mark or neutral, so
    article-header and social-policy say nothing. Comments may be those of anything.
    """
    for name in value.split():
        words = [w.lower() for w in _WORD.findall(name) if not w.isdigit()]
        if words and (words[-1] in COMMENTS or words[0] in COMMENTS and set(words[1:]) <= NEUTRAL):
            return "comments"
        if set(words) & MARKS and set(words) <= MARKS | NEUTRAL:
            return "furniture"
    return ""


class Block(NamedTuple):
    text: str
    #: Whether it stands in an article or main element, and in a main heading.
    inside: bool
    heading: bool


def _tags(html: str) -> Iterator[tuple[int, int, str, bool, str]]:
    """start, end, name, whether it closes, attributes of each tag; no name for comments
    and the like. A tag that never ends goes to the end. Each character is read a bounded
    number of times."""
    at = html.find("<")
    while at >= 0:
        follows = html[at + 1 : at + 2]
        if html.startswith("<!--", at):
            end = html.find("-->", at + 4)
            end = len(html) if end < 0 else end + 3
            yield at, end, "", False, ""
        elif follows in ("!", "?"):
            end = html.find(">", at)
            end = len(html) if end < 0 else end + 1
            yield at, end, "", False, ""
        else:
            closes = follows == "/"
            name = _NAME.match(html, at + 1 + closes)
            if not name:
                at = html.find("<", at + 1)
                continue
            i = name.end()
            while True:
                i = _PLAIN.match(html, i).end()
                if html[i : i + 1] in ("", ">"):
                    break
                quote = html.find(html[i], i + 1)
                if quote < 0:
                    # A quote that never ends is one character; the tag ends at the next bracket.
                    i = html.find(">", i)
                    i = len(html) if i < 0 else i
                    break
                i = quote + 1
            end = min(len(html), i + 1)
            yield at, end, name[0].lower(), closes, html[name.end() : i]
            if not closes and name[0].lower() in RAW:
                close = re.compile(rf"</{re.escape(name[0])}\s*>", re.I).search(html, end)
                end = close.end() if close else len(html)
                yield end, end, "", False, ""
        at = html.find("<", end)


class _Page:
    """Blocks of a page as its tags are read."""

    def __init__(self) -> None:
        self.found: list[tuple[Block, int]] = []
        self.text: list[str] = []
        # Open elements: name, whether furniture, whether an article, the element that may be furniture around it.
        self.open: list[tuple[str, bool, bool, int]] = []
        self.places: dict[str, list[int]] = {}
        self.boxes: list[int] = []
        self.hidden = self.inside = self.headings = 0
        # Elements that may be furniture: the one around, whether in an article, kind, whether the heading is in it.
        self.maybe: list[list] = [[-1, False, "", False]]

    def add(self, text: str) -> None:
        if not self.hidden:
            self.text.append(text)

    def end_block(self) -> None:
        line = " ".join(unescape("".join(self.text)).split())
        self.text.clear()
        if line:
            self.found.append((Block(line, self.inside > 0, self.headings > 0), self.open[-1][3] if self.open else 0))

    def pop(self) -> None:
        name, furniture, article, _ = self.open.pop()
        self.places[name].pop()
        if name in BLOCK:
            self.boxes.pop()
        self.hidden -= furniture
        self.inside -= article
        self.headings -= name == "h1"

    def close(self, name: str) -> None:
        at = self.places.get(name)
        if at and (name in BLOCK or not self.boxes or at[-1] > self.boxes[-1]):
            for _ in range(len(self.open) - at[-1]):
                self.pop()

    def enter(self, name: str, attributes: str) -> None:
        # A new item or paragraph ends an open one of its kind, with what is open in it.
        if self.boxes and self.open[self.boxes[-1]][0] in _ENDS.get(name, ()):
            self.close(self.open[self.boxes[-1]][0])
        if attributes.rstrip().endswith("/") and name not in BLOCK:
            return
        article = name in ("article", "main")
        marks = {mark_of(a or b or c or "") for _, a, b, c in _ATTRIBUTE.findall(attributes)} if attributes else set()
        around = self.open[-1][3] if self.open else 0
        kind = "comments" if "comments" in marks else "furniture" if "furniture" in marks else "form" if name in MAYBE else ""
        furniture = name in FURNITURE and not (name == "header" and self.inside)
        if kind and name not in BLOCK:
            kind, furniture = "", True
        if kind and name not in ("html", "body", "main") and not (article and kind != "comments"):
            self.maybe.append([around, self.inside > 0, kind, False])
            around = len(self.maybe) - 1
        if name in ("main", "h1") or article and not kind and self.maybe[around][2] == "form":
            self.maybe[around][3] = True
        self.places.setdefault(name, []).append(len(self.open))
        if name in BLOCK:
            self.boxes.append(len(self.open))
        self.open.append((name, furniture, article, around))
        self.hidden += furniture
        self.inside += article
        self.headings += name == "h1"

    def blocks(self) -> list[Block]:
        """The blocks outside furniture. An element that may be furniture is not if the
        main heading or the main element is in it (of a form, an article too), or most of
        the text of its article, or of a page without one; comments are furniture however long."""
        mass = [0] * len(self.maybe)
        for block, around in self.found:
            mass[around] += len(block.text)
        comments = [False] * len(self.maybe)
        for i, (around, _, kind, heading) in enumerate(self.maybe):
            comments[i] = i > 0 and (comments[around] or kind == "comments" and not heading)
        inside = sum(len(b.text) for b, i in self.found if b.inside and not comments[i])
        whole = sum(len(b.text) for b, i in self.found if not comments[i])
        for i in range(len(self.maybe) - 1, 0, -1):
            mass[self.maybe[i][0]] += mass[i]
            self.maybe[self.maybe[i][0]][3] |= self.maybe[i][3]
        gone = [False] * len(self.maybe)
        for i, (around, within, kind, heading) in enumerate(self.maybe[1:], 1):
            # Beside an article, no mass makes an element outside it the article.
            most = kind != "comments" and 2 * mass[i] > (inside if within else whole) and (within or not inside)
            gone[i] = gone[around] or not (heading or most)
        return [b for b, i in self.found if not gone[i]]


def blocks(html: str | None) -> list[Block]:
    """The page's blocks of text outside furniture, in order. White space runs are one
    space, character references are decoded."""
    html, page, at = html or "", _Page(), 0
    for start, end, name, closes, attributes in _tags(html):
        if name or start < end:
            page.add(html[at:start])
        at = end
        if name == "br":
            page.add(" ")
        if name in BLOCK:
            page.end_block()
        if not name or name == "br" or name in VOID or name in RAW:
            continue
        if closes:
            page.close(name)
        else:
            page.enter(name, attributes)
    page.add(html[at:])
    page.end_block()
    return page.blocks()


def main_blocks(found: list[Block]) -> list[str] | None:
    """The texts of the articles, if they hold at least half of all text, with the main
    heading where that stands outside; None if structure does not tell the article."""
    inside = sum(len(b.text) for b in found if b.inside)
    if not inside or 2 * inside < sum(len(b.text) for b in found):
        return None
    titled = any(b.inside and b.heading for b in found)
    return [b.text for b in found if b.inside or b.heading and not titled]


def _lengths(x: list, y: list) -> list[int]:
    """For every j the length of a longest common subsequence of x and the first j of y.

    One bit per line of y: a step over a line of x takes a few operations on one number.
    """
    places: dict = {}
    for j, line in enumerate(y):
        places[line] = places.get(line, 0) | 1 << j
    whole = (1 << len(y)) - 1
    row = whole
    for line in x:
        hit = row & places.get(line, 0)
        row = ((row + hit) | (row - hit)) & whole
    out = [0]
    for bit in reversed(bin(row | 1 << len(y))[3:]):
        out.append(out[-1] + (bit == "0"))
    return out


def common_lines(x: list, y: list) -> list[int]:
    """Places in x of a longest common subsequence of both.

    Equal ends are taken off and lines that the other lacks left out; x is then halved, and y
    where the halves have most in common, so memory follows the lines, not their pairs.
    """
    out: list[int] = []
    both = set(x) & set(y)
    jobs = [([i for i, line in enumerate(x) if line in both], [line for line in y if line in both])]
    while jobs:
        own, near = jobs.pop()
        head, least = 0, min(len(own), len(near))
        while head < least and x[own[head]] == near[head]:
            head += 1
        tail = 0
        while tail < least - head and x[own[-1 - tail]] == near[-1 - tail]:
            tail += 1
        out += own[:head] + own[len(own) - tail :]
        own, near = own[head : len(own) - tail], near[head : len(near) - tail]
        if len(own) == 1 and x[own[0]] in near:
            out.append(own[0])
        if len(own) < 2 or not near:
            continue
        half = len(own) // 2
        left = _lengths([x[i] for i in own[:half]], near)
        right = _lengths([x[i] for i in reversed(own[half:])], near[::-1])
        cut = max(range(len(near) + 1), key=lambda j: left[j] + right[len(near) - j])
        jobs += [(own[:half], near[:cut]), (own[half:], near[cut:])]
    return sorted(out)


def main_lines(found: list[Block], shared: set[int]) -> list[str]:
    """The texts of a page's blocks that differencing leaves, checked by structure: blocks of
    articles that hold at least half of what is left are the text, whatever of them is
    shared, as copies share them too; shared holds places of blocks."""
    main = main_blocks([b for i, b in enumerate(found) if b.inside or i not in shared])
    return [b.text for i, b in enumerate(found) if i not in shared] if main is None else main


def line_hashes(lines: list[str]) -> list[int]:
    return [xxhash.xxh3_64_intdigest(x.encode("utf-8", "surrogatepass")) - (1 << 63) for x in lines]


def _hashed(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The hashes of pages' lines and, for what they are about, that of their longest one."""
    for part in slices(batches):
        rows = []
        for html in part["html"]:
            lines = [b.text for b in blocks(html)]
            hashes = line_hashes(lines)
            rows.append((hashes, max(zip(map(len, lines), hashes, strict=True), default=(0, 0))[1]))
        made = pd.DataFrame(rows, columns=["hashes", "about"], index=part.index)
        yield pd.concat([part.drop(columns="html"), made], axis=1)


def _common(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The places of pages' lines on a longest common subsequence with their nearest page."""
    for part in slices(batches):
        places = [common_lines(list(x.hashes), list(x.near)) for x in part.itertuples(index=False)]
        lines = [[own[i] for i in at] for own, at in zip(part["hashes"], places, strict=True)]
        yield part[["row", "site"]].assign(places=places, lines=lines)


def _blocks(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in slices(batches):
        found = [blocks(html) for html in part["html"]]
        made = {name: [[getattr(b, name) for b in page] for page in found] for name in ("text", "inside", "heading")}
        yield part[["row", "page_id", "url"]].assign(**made)


def _checked(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in slices(batches):
        texts = []
        for x in part.itertuples(index=False):
            found = [Block(*b) for b in zip(x.text, x.inside, x.heading, strict=True)]
            texts.append(SEPARATOR.join(main_lines(found, set() if x.shared is None else set(x.shared))))
        yield part[["page_id", "url"]].assign(text=texts)


def _nearest(pages: DataFrame) -> DataFrame:
    """row, near: the line hashes of the nearest page about something else.

    Nearest is the page of the host that shares most leading parts of the path, in a tie
    one with the least or largest hash of what it is about. For every folder of every
    path just these two hashes are kept, in each task before rows move, so a host with a
    third of all pages is no hot key; only hashes of lines meet.
    """
    folders = F.expr(
        "transform(sequence(0, size(parts)), n -> struct(n as depth, xxhash64(site, array_join(slice(parts, 1, n), '/')) as folder))"
    )
    at = pages.withColumn("parts", F.filter(F.split("path", "/"), lambda x: x != ""))
    at = at.select("row", "site", "about", F.inline(folders))
    ends = at.groupBy("folder").agg(F.min("about").alias("least"), F.max("about").alias("most"))
    other = F.when(F.col("least") != F.col("about"), F.col("least")).otherwise(F.col("most"))
    nearest = (
        at.join(ends.where("least <> most"), "folder")
        .groupBy("row")
        .agg(F.max_by(F.struct("site", other.alias("about")), "depth").alias("other"))
        .select("row", "other.*")
    )
    # Of several pages about one thing, any will do; the same one each time.
    shown = pages.groupBy("site", "about").agg(F.min("hashes").alias("near"))
    return nearest.join(shown, ["site", "about"]).select("row", "near")


def _shared(pages: DataFrame) -> DataFrame:
    """row, shared: the places of a page's lines that it shares with its nearest page, if
    they stand on pages about three things or more of the host.

    Every page meets its nearest. Of all lines only those move that some page shares with
    its nearest; a filter of bounded size tells them where they are read.
    """
    # Equal rows share the same lines, so one row stands for them.
    own = pages.select("row", "site", "hashes").dropDuplicates(["row"])
    common = stored(
        own.join(_nearest(pages), "row").mapInPandas(_common, "row long, site long, places array<int>, lines array<long>"), "common"
    )
    common = common.select("row", "site", F.inline(F.arrays_zip("places", "lines"))).withColumn("line", F.xxhash64("site", "lines"))
    lines = pages.select("about", F.explode("hashes").alias("lines"), "site").select("about", F.xxhash64("site", "lines").alias("line"))
    asked = maybe_in(lines, "line", bloom_filter(common, "line")).distinct()
    often = asked.groupBy("line").count().where("count > 2").select("line")
    return common.join(often, "line").groupBy("row").agg(F.collect_set("places").alias("shared"))


def main_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars per row of pages.

    Each page is parsed into blocks outside menus, headers, footers, sidebars, notices,
    adverts, forms, comments, scripts and styles, and loses the lines on a longest common
    subsequence with the page's nearest, the one of its host whose path begins most
    alike. Pages about the same, by their longest line, are copies and passed over, and a
    shared line goes only if it stands on a third page of the host, about a third thing.
    A check of the structure follows: if article and main elements hold half or more of
    the text that differencing leaves, all of their text is the page's, and no other:
    copies at the next URLs must not delete it.

    Only hashes of lines meet; pages are read twice, so that texts move once. Null html and
    pages without text give an empty text; pages without a host meet nothing. Repeated
    rows and null ids are kept; other columns are ignored. Parsing takes time in
    proportion to the page.
    """
    url = F.coalesce("url", F.lit(""))
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:www\.)?([^/?#]+)", 1))
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+([^?#]*)", 1)
    rows = pages.select(F.xxhash64("page_id", "url", "html").alias("row"), F.col("page_id").cast("string"), "url", "html")
    hashed = stored(
        rows.where(host != "")
        .select("row", F.xxhash64(host).alias("site"), path.alias("path"), "html")
        .mapInPandas(_hashed, "row long, site long, path string, hashes array<long>, about long"),
        "hashed",
    )
    parsed = rows.mapInPandas(
        _blocks, "row long, page_id string, url string, text array<string>, inside array<boolean>, heading array<boolean>"
    )
    texts = parsed.join(_shared(hashed), "row", "left").mapInPandas(_checked, "page_id string, url string, text string")
    return texts.select(
        F.col("page_id").cast(pages.schema["page_id"].dataType), "url", "text", F.length("text").cast("long").alias("n_chars")
    )
