"""HTML extraction: templates deduced from equivalence classes of tokens across pages of a host.

Tokens are opening and closing tags told apart by their path (element names with classes from
the root), and runs of text between two tags told apart by path and words. The occurrence
vector of a token says how often it stands in each page of its host. Tokens with equal vectors
form an equivalence class; a class is valid if it holds at least ``CLASS_SIZE`` elements or
words and occurs in at least ``SUPPORT`` of the host's pages. The two tags of one element count
once, a run of text as often as it has words. Text is template only if at least ``TEXT_PAGES``
pages of different content hold it, so that copies of a page are no template of each other.
The valid classes of a host, in page order and nested along the paths, are its template. What
stands between template tokens are slots; the main slot is an article element of the template,
else a main element, both if they hold ``NAMED_SHARE`` of the text, else the deepest element
that occurs once a page and holds nearly all text outside menus, links and the like. Pages are
then cut by the template of their host: the blocks in the main slot are the text, without blocks
that are template throughout (a block with text of its own stays whole, so that no sentence
loses words) and without nested slots whose element or class names navigation, adverts,
notices, forms, comments and so on. Names remove parts beside or inside the main text, never the
whole of it: an article, main or form that holds more than ``MOST`` of a page's text outside
links is no such part, whatever its wrappers are called. A page whose host has no template, or that lacks
its main slot, is its own template; a page of which nothing would be left keeps its text.

Vectors are never gathered: a token's vector is told by its number of pages, its total and the
sum of a hash per (page, count), which add up in partial aggregates. A host with a third of all
pages is a few rows per task for tags, and one row per different text. What few pages hold is
dropped before anything is gathered by host, so that a template is one row of at most
``1 / SUPPORT`` times the tokens of a page.

Defined results: null or empty html gives the empty text; a null or odd url belongs to the
empty host; a tag cut off by the end of the page is dropped, text and elements left open count
as they stand; repeated rows give repeated results; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nearkin.llm.common import chunks, texts_of, with_columns
from nearkin.session import materialize

SUPPORT = 0.2
CLASS_SIZE = 2
TEXT_PAGES = 3
MAIN_SHARE = 0.7
NAMED_SHARE = 0.3
MOST = 0.5
BROADCAST_ROWS = 200_000
TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<(script|style|noscript|template|textarea|svg|iframe|title)\b.*?(?:</\1\s*>|$)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>|<[/a-zA-Z!?][^>]*$", re.DOTALL | re.IGNORECASE)
ATTRIBUTE = re.compile(r"""\b(class|id|role|itemprop|hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.IGNORECASE)
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
OTHER_THING = re.compile(r"(?:^|[-_])(?:with|has|no|without|is|not)[-_]", re.IGNORECASE)  # "page-with-sidebar" is no sidebar
MAY_HOLD_ALL = re.compile(r"<(?:article|main|form)\b|articlebody|role\s*=\s*[\"']?main", re.IGNORECASE)
HOST = re.compile(r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr".split())
CLOSED_BY_BLOCK = frozenset(["p"])
SAME_CLOSES = frozenset("li dt dd tr td th option".split())
ASIDE_NAMES = frozenset("nav footer aside form button select dialog menu head input datalist audio video canvas object".split())
ASIDE_WORDS = frozenset(
    "nav navbar navigation menu menus header masthead footer sidebar aside ad ads advert adverts advertisement advertising banner "
    "sponsor sponsored promo promotion cookie cookies consent gdpr notice notices popup modal overlay comment comments disqus "
    "respond share sharing social breadcrumb breadcrumbs pagination pager related recommended newsletter subscribe signup login "
    "search form widget toolbar skip".split())
TITLE_WORDS = frozenset(["header", "masthead", "banner"])
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())


class Element:
    """An open element: its path, whether it is main text by name, and what surrounds it."""

    __slots__ = ("aside", "hidden", "inner", "kind", "link", "lost", "name", "path")

    def __init__(self, name: str, path: str, aside: bool, link: bool, kind: int, hidden: bool = False, inner: bool = False,
                 lost: bool = False) -> None:
        self.name, self.path, self.aside, self.link, self.kind = name, path, aside, link, kind
        # aside seen from the innermost article, main or form around it; whether it is such a one and aside by its surroundings
        self.hidden, self.inner, self.lost = hidden, inner, lost


ROOT = Element("", "", False, False, 0)


class Walker:
    """Turns pages into runs of tags and texts with their paths; remembers the elements seen."""

    def __init__(self) -> None:
        self.seen: dict[tuple, Element] = {}
        self.page: str | None = None
        self.whole: frozenset[str] = frozenset()

    def element(self, parent: Element, name: str, attributes: str) -> Element:
        key = (parent.path, parent.aside, parent.hidden, parent.inner, name, attributes, self.whole)
        found = self.seen.get(key)
        if found is None:
            if len(self.seen) > 50_000:
                self.seen.clear()
            values = {a.lower(): b or c or d for a, b, c, d in ATTRIBUTE.findall(attributes)}
            role = values.get("role", "").lower()
            label = f"{name}.{'.'.join(sorted(values.get('class', '').split()))}#{role}"
            labels = [x for x in f"{values.get('class', '')} {values.get('id', '')}".split() if not OTHER_THING.search(x)]
            words = {w.lower() for x in labels for w in NAME_PART.findall(x)}
            if parent.kind:
                words -= TITLE_WORDS  # the head of an article is part of it
            kind = (3 if name == "article" or values.get("itemprop", "").lower() == "articlebody" else
                    2 if name == "main" or role == "main" else 0)
            header = name == "header" and not parent.kind
            hidden = parent.hidden or "hidden" in values
            own = name in ASIDE_NAMES or role in ASIDE_ROLES or "hidden" in values or header or (
                not kind and name not in ("html", "body") and bool(words & ASIDE_WORDS))
            path = xxhash.xxh3_64_hexdigest(f"{parent.path}/{label}")
            # a form is aside by being one, an article or main only by what is around it
            lost = not hidden and (name == "form" or kind >= 2 and parent.aside and not own)
            inner = hidden if lost else own or (parent.inner and kind < 2)
            found = Element(name, path, (parent.aside or own) and path not in self.whole, parent.link or name == "a",
                            kind or (1 if parent.kind else 0), hidden, inner, lost)
            self.seen[key] = found
        return found

    def holding_all(self, html: str) -> frozenset[str]:
        """The paths of the articles, mains and forms that are aside although they hold most of the page's text."""
        if not MAY_HOLD_ALL.search(html):
            return frozenset()
        total, within = 0, {}
        for kind, what, stack in self._walk(html):
            if kind == "text" and not stack[-1].link and (size := len(what.strip())):
                total += size
                if not stack[-1].inner:
                    for path in {e.path for e in stack if e.lost}:
                        within[path] = within.get(path, 0) + size
        return frozenset(p for p, size in within.items() if size > MOST * total)

    def walk(self, html: str) -> Iterator[tuple[str, str | Element, tuple[Element, ...] | list[Element]]]:
        """("open" or "close", element, open elements) and ("text", text, open elements), in page order."""
        if html is not self.page:
            self.whole = frozenset()
            self.page, self.whole = html, self.holding_all(html)
        return self._walk(html)

    def _walk(self, html: str) -> Iterator[tuple[str, str | Element, tuple[Element, ...] | list[Element]]]:
        stack = [ROOT]
        at = 0
        for match in TOKEN.finditer(html):
            if match.start() > at:
                yield "text", html[at:match.start()], stack
            at = match.end()
            name = match[3]
            if not name:
                continue
            name = name.lower()
            if match[2]:
                if any(e.name == name for e in stack):
                    while True:
                        element = stack.pop()
                        yield "close", element, stack
                        if element.name == name:
                            break
                continue
            if name not in INLINE and stack[-1].name in INLINE | CLOSED_BY_BLOCK:
                # a block ends an open paragraph with all that is open in it
                for place in range(len(stack) - 1, 0, -1):
                    if stack[place].name in CLOSED_BY_BLOCK:
                        while len(stack) > place:
                            yield "close", stack.pop(), stack
                        break
                    if stack[place].name not in INLINE:
                        break
            if name in SAME_CLOSES and stack[-1].name == name:
                yield "close", stack.pop(), stack
            element = self.element(stack[-1], name, match[4])
            if name in VOID or match[4].endswith("/"):
                yield "open", element, stack
                continue
            stack.append(element)
            yield "open", element, stack
        if at < len(html):
            yield "text", html[at:], stack


def host_of(url: str | None) -> str:
    match = HOST.match(url or "")
    return match[1].lower() if match else ""


def text_path(parent: str, words: list[str]) -> str:
    """The path of a run of text within the element of a path."""
    return xxhash.xxh3_64_hexdigest(f"{parent}\0{' '.join(words)}")


def page_tokens(walker: Walker, html: str) -> dict[tuple[str, bool | None], list[int]]:
    """Per token of a page, keyed by path and whether it closes (null for text): occurrences, main kind, aside, characters
    within, elements or words that it counts for."""
    found: dict[tuple[str, bool | None], list[int]] = {}
    for kind, what, stack in walker.walk(html):
        if kind == "text":
            words = what.split()
            if not words or stack[-1].aside:
                continue
            if not stack[-1].link:
                size = len(what.strip())
                for element in stack[1:]:
                    found[element.path, False][3] += size
            key, new = (text_path(stack[-1].path, words), None), [0, -1, 0, 0, len(words)]
        else:
            key, new = (what.path, kind == "close"), [0, what.kind, int(what.aside), 0, int(kind == "open")]
        found.setdefault(key, new)[0] += 1
    return found


_COUNTS = ("host string, path string, closing boolean, kind int, aside int, members int, place int, pages long, once long, total long, "
           "vector decimal(20,0), chars long, contents long")


def occurrence_vectors(pages: DataFrame) -> DataFrame:
    """Per host and token: pages, total, told vector, characters within and a bit for each content of its pages.

    The set bits of ``contents`` are at most as many as different pages hold the token.
    """
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walker = Walker()
        for batch in chunks(batches, "html"):
            sums: dict[tuple[str, str, bool | None], list[int]] = {}
            urls, ids = batch.column(1).to_pylist(), batch.column(0).to_pylist()
            for page, url, html in zip(ids, urls, texts_of(batch, "html")):
                host = host_of(url)
                content = 1 << xxhash.xxh3_64_intdigest(html.encode("utf-8", "replace")) % 63
                for place, ((path, closing), (n, kind, aside, chars, members)) in enumerate(page_tokens(walker, html).items()):
                    mark = xxhash.xxh3_64_intdigest(f"{page}\0{url}\0{n}") >> 1
                    own = sums.get((host, path, closing))
                    if own is None:
                        sums[host, path, closing] = [kind, aside, members, place, 1, int(n == 1), n, mark, chars, content]
                    else:
                        own[3] = max(own[3], place)
                        own[4] += 1
                        own[5] += n == 1
                        own[6] += n
                        own[7] += mark
                        own[8] += chars
                        own[9] |= content
            rows = [(*key, *value) for key, value in sums.items()]
            columns = list(zip(*rows)) or [()] * 13
            kinds = (pa.string(), pa.string(), pa.bool_(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(),
                     pa.int64(), pa.string(), pa.int64(), pa.int64())
            columns[10] = [str(v) for v in columns[10]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["host", "path", "closing", "kind", "aside", "members", "place", "pages", "once", "total", "vector", "chars",
                       "contents"])

    counts = pages.mapInArrow(counted, _COUNTS.replace("vector decimal(20,0)", "vector string"))
    return counts.groupBy("host", "path", "closing").agg(
        F.max("kind").alias("kind"), F.max("aside").alias("aside"), F.max("members").alias("members"),
        F.max("place").alias("place"), F.sum("pages").alias("pages"),
        F.sum("once").alias("once"), F.sum("total").alias("total"),
        F.sum(F.col("vector").cast("decimal(28,0)")).alias("vector"), F.sum("chars").alias("chars"),
        F.bit_or("contents").alias("contents"))


def templates(vectors: DataFrame) -> DataFrame:
    """Per host the path of the main slot and, in page order, those of the texts of the valid equivalence classes."""
    host = Window.partitionBy("host")
    same = Window.partitionBy("host", "pages", "total", "vector")
    hosts = vectors.groupBy("host").agg(F.max("pages").alias("host_pages"), F.bit_or("contents").alias("host_contents"))
    # two numbers per host; tokens of few pages end here, not in the windows of their host
    few = hosts.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    held = vectors.filter("pages > 1").join(F.broadcast(hosts) if few else hosts, "host").filter(
        F.col("pages") >= F.greatest(F.lit(2), SUPPORT * F.col("host_pages")))
    # of them a host has at most as many as 1 / SUPPORT of its pages
    tokens = held.withColumn("class_size", F.sum("members").over(same)).filter(F.col("class_size") >= CLASS_SIZE)
    slots = tokens.filter("NOT closing AND aside = 0").withColumn("most", F.max("chars").over(host))
    fit = F.when((F.col("kind") >= 2) & (F.col("chars") >= NAMED_SHARE * F.col("most")), F.col("kind")).when(
        (F.col("once") == F.col("pages")) & (F.col("chars") >= MAIN_SHARE * F.col("most")), F.lit(1))
    # articles and mains by their text; without them the innermost of the elements that hold nearly all text
    best = Window.partitionBy("host").orderBy(
        F.col("fit").desc(), F.when(F.col("fit") > 1, F.col("chars")).desc(), F.col("place").desc(), "path")
    mains = (slots.withColumn("fit", fit).filter("fit IS NOT NULL").withColumn("n", F.row_number().over(best)).filter("n = 1")
             .select("host", F.col("path").alias("main")))
    different = F.bit_count("contents")
    texts = tokens.filter("closing IS NULL").filter(
        different >= F.greatest(F.lit(TEXT_PAGES), SUPPORT * F.bit_count("host_contents"))).groupBy("host").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("place", "path"))), lambda t: t["path"]).alias("texts"))
    return mains.join(texts, "host", "full")


def _blocks(walker: Walker, html: str, inside: str | None, template: frozenset[str]) -> list[str] | None:
    """Blocks of text within the elements of a path, or outside asides, without those that are template throughout; None if
    no element has the path."""
    parts: list[str] = []
    blocks: list[str] = []
    seen = inside is None
    depth = 0
    own = False

    def ended() -> None:
        nonlocal own
        text = " ".join(unescape("".join(parts)).split())
        if text and own:
            blocks.append(text)
        parts.clear()
        own = False

    for kind, what, stack in walker.walk(html):
        if kind == "text":
            if (inside is None or depth) and not stack[-1].aside:
                parts.append(what)
                if not own and (words := what.split()):
                    own = not template or text_path(stack[-1].path, words) not in template
            continue
        if what.name == "br":
            parts.append(" ")
        elif what.name not in INLINE:
            ended()
        if what.path == inside and what.name not in VOID:
            depth += 1 if kind == "open" else -1
            seen = True
    ended()
    return blocks if seen else None


def main_text(walker: Walker, html: str, main: str | None, template: frozenset[str] = frozenset()) -> str:
    """The text of a page by the main slot and the texts of its host's template, or by its own elements."""
    blocks = _blocks(walker, html, main, template) if main else None
    if blocks is None:
        best: dict[str, list[int]] = {}
        for kind, what, _ in walker.walk(html):
            if kind == "open" and what.kind >= 2 and not what.aside:
                best.setdefault(what.path, [what.kind])
        path = max(best, key=lambda p: best[p][0]) if best else None
        blocks = _blocks(walker, html, path, template)
    if not blocks and template:
        return main_text(walker, html, main)
    return "\n\n".join(blocks or ())


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Per page: id, url, main text and its length in code points."""
    rows = pages.select(page_id, url, html)
    vectors = materialize(occurrence_vectors(
        rows.select(F.col(page_id).cast("string").alias("page"), F.col(url).alias("url"), F.col(html).alias("html"))), "vectors")
    found = materialize(templates(vectors), "templates")
    # a host name and a digest per row, and one per text
    size = found.agg(F.count("*").alias("hosts"), F.sum(F.greatest(F.size("texts"), F.lit(0))).alias("texts")).first()
    small = size["hosts"] + (size["texts"] or 0) <= BROADCAST_ROWS
    host = F.lower(F.coalesce(F.regexp_extract(F.col(url), HOST.pattern, 1), F.lit("")))
    joined = rows.withColumn("_host", host).join(
        (F.broadcast(found) if small else found).select(F.col("host").alias("_host"), F.col("main").alias("_main"), F.col("texts").alias("_texts")),
        "_host", "left")
    joined = joined.select(page_id, url, html, "_main", "_texts")
    schema = T.StructType([rows.schema[page_id], rows.schema[url], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walker = Walker()
        for batch in chunks(batches, html):
            texts = [main_text(walker, h, m, frozenset(t or ())) for h, m, t in zip(
                texts_of(batch, html), batch.column(3).to_pylist(), batch.column(4).to_pylist())]
            yield with_columns(batch, [page_id, url], {
                "text": pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64())})

    return joined.mapInArrow(cut, schema)
