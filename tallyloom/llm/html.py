"""Main text of web pages by site template removal.

**Pass 1** parses each page once and writes its text blocks. Every element gets a hash of its whole subtree (tag, attributes,
text, children), and so does every text block by itself. A block remembers the hashes of the elements it lies in, inside an
article as elsewhere.
**Templates.** Spark counts on how many different pages of its host each subtree occurs, combined on the map side; pages with the
same main text are one. Subtrees on at least ``LEAST_PAGES`` pages and ``LEAST_SHARE`` of a host's pages are its template.
Passages that fewer articles share, and articles that stand on many pages, are not.
**Pass 2** deletes blocks that lie in such a subtree. If a page marks an article or main part and any of its text is left, the
text is taken from there alone.

Counts cannot see what differs from page to page (menus of related pages, comments, adverts), nor anything on a small host.
There, elements that say what they are by tag, role, class or id go on every host. A class or id counts only if the
listed word is what it names ("user-comments"), not where it describes something else ("has-sidebar", "header-image").

Character references are decoded, white space inside a block becomes one space (a line break too), blocks are trimmed
and joined by line feeds. Null and empty pages give an empty text. Pages are rows: repeated ids and urls are kept apart.
A page without a host is counted under the empty host. Unclosed and stray tags are read as browsers do
in the common cases: a block closes an open paragraph, a list item the one before it, an end tag what it contains.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.sources.workspace import stage

LEAST_PAGES, LEAST_SHARE = 8, 0.5

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)(?=[a-zA-Z])", re.S)
NAME_END, SPECIAL = re.compile(r"[\s/>]"), re.compile(r"""[>"']""")
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
SPACE = re.compile(r"\s+")

# Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section summary table"
    " tbody td tfoot th thead title tr ul caption".split()
)
CLOSES_PARAGRAPH = BLOCK - frozenset("body caption dd dt head html legend li option tbody td tfoot th thead title tr".split()) | {"li", "dd", "dt"}
CLOSED_BY_SAME = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select", "datalist"}),
}

# What never is main text, and what names it in roles, classes and ids.
OTHER_TAGS = frozenset(
    "nav footer aside form script style noscript template iframe head title button select textarea svg canvas object"
    " audio video dialog map menu xmp noembed noframes".split()
)
OTHER_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
OTHER_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr"
    " notice notices alert popup modal overlay sidebar side rail menu menus nav navbar navigation breadcrumb breadcrumbs"
    " header footer masthead topbar comment comments respond reply replies disqus discussion share sharing social related"
    " recommended newsletter subscribe subscription signup login search widget pagination pager skip toolbar".split()
)
CONTAINERS = frozenset(("html", "body", "main", "article"))
# First words of classes that describe a page or box by what it has or lacks.
STATES = frozenset("has have no not with without is hide show shows after before under above below".split())


def _names_other(value: str) -> bool:
    """Whether a class or id names one of ``OTHER_NAMES``: its last word, or the one before a number."""
    for name in value.split():
        words = [w for w in re.split(r"[^a-z0-9]+", name) if w]
        while len(words) > 1 and words[-1].isdigit():
            words.pop()
        if words and words[-1] in OTHER_NAMES and words[0] not in STATES:
            return True
    return False


def _says_other(tag: str, attributes: str, in_article: bool) -> bool:
    if tag in OTHER_TAGS or tag == "header" and not in_article:
        return True
    if not attributes or attributes.isspace():
        return False
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "role" and value in OTHER_ROLES:
            return True
        if name in ("class", "id") and tag not in CONTAINERS and _names_other(value):
            return True
    return False


class _TagEnds:
    """Ends of tags, quoted values skipped. Tags are asked for in page order; all calls together take linear time."""

    def __init__(self, page: str):
        self.page = page
        self.next: dict[re.Pattern, tuple[int, int]] = {}
        # Quotes outside values from which no end is reached.
        self.dead: set[int] = set()

    def after(self, pattern: re.Pattern, at: int) -> int:
        """First match from ``at`` on, -1 for none; remembered for later places before it."""
        low, found = self.next.get(pattern, (0, -2))
        if not low <= at <= found and found != -1:
            match = pattern.search(self.page, at)
            found = match.start() if match else -1
            self.next[pattern] = at, found
        return found

    def find(self, at: int) -> tuple[int, int] | None:
        """Ends of the name that starts at ``at`` and of its tag; None for a tag without an end."""
        name = self.after(NAME_END, at)
        place = self.after(SPECIAL, name) if name >= 0 else -1
        seen = []
        while place >= 0 and place not in self.dead:
            if self.page[place] == ">":
                return name, place
            seen.append(place)
            close = self.page.find(self.page[place], place + 1)
            match = SPECIAL.search(self.page, close + 1) if close >= 0 else None
            place = match.start() if match else -1
        self.dead.update(seen)
        return None


class _Element:
    __slots__ = ("tag", "other", "article", "hash", "number", "countable")

    def __init__(self, tag: str, attributes: str, parent: _Element | None, number: int):
        import xxhash

        inside = parent is not None and parent.article
        self.tag, self.number = tag, number
        self.other = (parent is not None and parent.other) or _says_other(tag, attributes, inside)
        self.article = inside or (tag in ("article", "main") and not self.other)
        self.hash = xxhash.xxh64(f"{tag}{attributes}")
        self.countable = tag not in CONTAINERS


def parse(page: str | None) -> tuple[list[tuple[str, list[int], bool]], list[int]]:
    """Text blocks in page order as (text, hashes of itself and the elements around it, in an article), and all hashes."""
    import xxhash

    page = page or ""
    blocks: list[tuple[str, list[int], bool]] = []
    done: dict[int, int] = {}
    stack: list[_Element] = []
    opened: Counter = Counter()
    words: list[str] = []
    ends, number = _TagEnds(page), 0

    def text(raw: str) -> None:
        data = html.unescape(raw) if "&" in raw else raw
        if stack:
            stack[-1].hash.update(data.encode("utf-8", "surrogatepass"))
        if not (stack and stack[-1].other):
            words.append(data)

    def end_block() -> None:
        if words:
            found = SPACE.sub(" ", "".join(words)).strip()
            words.clear()
            if found:
                around = [e.number for e in stack if e.countable]
                blocks.append((found, around, bool(stack) and stack[-1].article))

    def close() -> None:
        element = stack.pop()
        opened[element.tag] -= 1
        value = element.hash.intdigest()
        if element.countable:
            done[element.number] = value - (1 << 63)
        if stack:
            stack[-1].hash.update(value.to_bytes(8, "little"))

    def close_to(names: set[str], stops: set[str] | frozenset[str]) -> None:
        if not any(opened[name] for name in names):
            return
        for depth in range(len(stack) - 1, -1, -1):
            if stack[depth].tag in names:
                while len(stack) > depth:
                    close()
                return
            if stack[depth].tag in stops:
                return

    # ``begin`` is where text not handed on yet starts.
    at, begin, size = 0, 0, len(page)
    while at < size:
        match = TAG.search(page, at)
        if match is None:
            break
        found = ends.find(match.end()) if match[1] is not None else (0, match.end() - 1)
        if found is None:
            at = match.start() + 1
            continue
        if match.start() > begin:
            text(page[begin : match.start()])
        at = begin = found[1] + 1
        if match[1] is None:
            continue
        tag = page[match.end() : found[0]]
        tag = tag.lower()
        if match[1]:
            if opened[tag]:
                if tag in BLOCK:
                    end_block()
                close_to({tag}, frozenset())
            continue
        if tag in BLOCK:
            end_block()
            if tag in CLOSES_PARAGRAPH:
                close_to({"p"}, {"button", "td", "th", "table", "body", "html"})
        if tag in CLOSED_BY_SAME:
            close_to(*CLOSED_BY_SAME[tag])
        if tag in VOID:
            if tag == "br" or tag == "img":
                text(" ")
            continue
        attributes = page[found[0] : found[1]]
        element = _Element(tag, attributes, stack[-1] if stack else None, number)
        number += 1
        stack.append(element)
        opened[tag] += 1
        if attributes.endswith("/") and tag in ("svg", "path"):
            close()
        elif tag in RAW:
            stop = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            body = page[at : stop.start() if stop else size]
            element.hash.update(body.encode("utf-8", "surrogatepass"))
            at = begin = stop.end() if stop else size
            close()
    if begin < size:
        text(page[begin:])
    end_block()
    while stack:
        close()
    found = []
    for t, around, article in blocks:
        own = xxhash.xxh64_intdigest(b"#text " + t.encode("utf-8", "surrogatepass")) - (1 << 63)
        found.append((t, [own, *(done[n] for n in around)], article))
    return found, list(dict.fromkeys(h for _, around, _ in found for h in around))


def parsed_pages(pages: DataFrame, page: str, host: str) -> DataFrame:
    """``pages`` without the markup, with ``__blocks`` and ``__print``, a hash of the text that tags and names leave."""
    rest = [name for name in pages.columns if name != page]
    given = ", ".join(f"`{name}` {pages.schema[name].dataType.simpleString()}" for name in rest)
    block = pa.struct([("text", pa.string()), ("around", pa.list_(pa.int64())), ("article", pa.bool_())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            for start in range(0, batch.num_rows, 128):
                part = batch.slice(start, 128)
                blocks, prints = [], []
                for raw in part.column(0).to_pylist():
                    found = parse(raw)[0]
                    marked = any(article for _, _, article in found)
                    main = "\n".join(text for text, _, article in found if article or not marked)
                    prints.append(xxhash.xxh64_intdigest(main.encode("utf-8", "surrogatepass")) - (1 << 63))
                    blocks.append([{"text": text, "around": around, "article": article} for text, around, article in found])
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[1:], pa.array(blocks, pa.list_(block)), pa.array(prints, pa.int64())],
                    names=[*rest, "__blocks", "__print"],
                )

    schema = f"{given}, __blocks array<struct<text: string, around: array<long>, article: boolean>>, __print long"
    return pages.select(page, *rest).mapInArrow(work, schema)


def _around() -> Column:
    return F.array_distinct(F.flatten(F.transform("__blocks", lambda b: b["around"])))


def site_templates(parsed: DataFrame, least_pages: int = LEAST_PAGES, least_share: float = LEAST_SHARE) -> DataFrame:
    """``__host, hash``: subtrees on many different pages of their host."""
    firsts = stage(parsed.groupBy("__host", "__print").agg(F.min("__page").alias("__page")), "templates")
    totals = firsts.groupBy("__host").agg(F.count("*").alias("pages")).where(F.col("pages") >= least_pages)
    # Hashes alone go through the join, never texts.
    hashes = parsed.select("__host", "__page", _around().alias("around")).join(firsts.select("__page"), "__page", "left_semi")
    counts = hashes.select("__host", F.explode("around").alias("hash")).groupBy("__host", "hash").agg(F.count("*").alias("n"))
    often = counts.where(F.col("n") >= least_pages).join(totals, "__host")
    return often.where(F.col("n") >= F.col("pages") * least_share).select("__host", "hash")


def extract(
    pages: DataFrame,
    page: str = "html",
    url: str = "url",
    text: str = "text",
    least_pages: int = LEAST_PAGES,
    least_share: float = LEAST_SHARE,
) -> DataFrame:
    """``pages`` with the markup replaced by the main text."""
    host = F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))
    kept = [name for name in pages.columns if name not in (page, text)]
    hosted = pages.select(page, *kept).withColumn("__host", host)
    parsed = stage(parsed_pages(hosted, page, "__host").withColumn("__page", F.monotonically_increasing_id()), "pages")
    templates = stage(site_templates(parsed, least_pages, least_share), "templates")
    inside = parsed.select("__page", "__host", F.explode(_around()).alias("hash"))
    marks = inside.join(templates, ["__host", "hash"]).groupBy("__page").agg(F.collect_set("hash").alias("__template"))
    # Written first: while few pages hold a template, the texts are not shuffled for them.
    marked = parsed.join(stage(marks, "templates"), "__page", "left")
    left = F.filter("__blocks", lambda b: ~F.coalesce(F.arrays_overlap(b["around"], F.col("__template")), F.lit(False)))
    left = marked.select(*kept, left.alias("__blocks"))
    bare = ~F.exists("__blocks", lambda b: b["article"])
    main = F.filter("__blocks", lambda b: b["article"] | bare)
    return left.select(*kept, F.array_join(F.transform(main, lambda b: b["text"]), "\n").alias(text))
