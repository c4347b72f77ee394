"""Main text of web pages: subtrees that recur across a site's pages go, then everything that is not the article."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airsight.llm.common import text_key, whole
from airsight.session import lookup, stage

#: A subtree is site template when so many pages of a host carry it, and this share of them: outside the article, and within it.
#: Pages with the same article count once. Within the article the bounds are high, as passages and headings recur on their own.
OUTSIDE, INSIDE = (5, 0.01), (20, 0.6)

# --- fixed values: element names, roles and name parts of HTML ---------------------------------
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
NEVER_TEXT = RAW | frozenset("head template noscript object svg math canvas audio video map".split())
PAGE_FURNITURE = frozenset("nav footer aside form button select datalist dialog menu search".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar tablist".split())
NAME_PARTS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adbox banner banners sponsor sponsored promo promos promoted promotion "
    "nav navbar navigation navigations menu menus submenu breadcrumb breadcrumbs sidebar sidebars aside widget widgets masthead topbar "
    "footer copyright notice notices cookie cookies consent gdpr alert alerts popup modal overlay newsletter subscribe subscription "
    "signup login share sharing social related recommended comment comments commentlist respond reply replies disqus pagination pager "
    "toolbar disclaimer".split()
)
COMMENT_PARTS = frozenset("comment comments commentlist respond reply replies disqus".split())
CONTENT_NAMES = frozenset("article articlebody post postbody postcontent entry entrycontent story content maincontent pagecontent bodycontent".split())
#: A start tag closes the open elements of the first group, unless one of the second stands between.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}), "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
}

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</(?P<end>[a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"""
    r"""|<(?P<start>[a-zA-Z][^\s/>]*)(?P<attrs>(?:"[^"]*"|'[^']*'|[^>"'])*+)(?:>|\Z)|<(?P<odd>[a-zA-Z][^\s/>]*)(?P<odd_attrs>[^>]*)(?:>|\Z)""",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_PARTS = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]+")
_INVISIBLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)", re.IGNORECASE) for name in RAW}


def host_of(url: Column) -> Column:
    """The host of a URL in small letters, without user and port; empty where there is none."""
    found = F.regexp_extract(F.lower(whole(url)), r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.rtrim(found, F.lit("."))


class Page:
    """The elements of a page, in page order, and its text runs.

    ``tag``, ``parent`` and ``drop`` have an entry per element; ``drop`` marks what never is the article by its name, role or class.
    ``digest`` has the subtree digests of block elements that hold text. A run is (element, text), or (element, None) where a block begins or ends.
    """

    def __init__(self, source: str):
        self.tag, self.parent, self.drop, self.names, self.role = ["#page"], [-1], [False], [frozenset()], [""]
        self.digest: dict[int, bytes] = {}
        self.runs: list[tuple[int, str | None]] = []
        # open elements, their number by name, and of the open blocks (place among the open elements, pieces of their text)
        self._open = [0]
        self._counts: Counter[str] = Counter()
        self._blocks: list[tuple[int, list[str]]] = [(0, [])]
        self._read(source)
        self._close_from(1)

    def _read(self, source: str) -> None:
        at = 0
        while True:
            token = _TOKEN.search(source, at)
            text = source[at : token.start() if token else len(source)]
            if text:
                self._text(text)
            if token is None:
                return
            at = token.end()
            name, attrs = token["start"] or token["odd"], token["attrs"] or token["odd_attrs"] or ""
            if token["end"]:
                self._end(token["end"].lower())
            elif name:
                name = name.lower()
                self._start(name, attrs)
                if name in RAW:
                    end = _RAW_END[name].search(source, at)
                    at = end.start() if end else len(source)

    def _text(self, text: str) -> None:
        if "&" in text:
            text = html.unescape(text)
        self.runs.append((self._open[-1], text))
        self._blocks[-1][1].append(text)

    def _start(self, tag: str, attrs: str) -> None:
        if tag in BLOCK:
            if self.tag[self._open[self._blocks[-1][0]]] == "p":  # a paragraph holds no block
                self._close_from(self._blocks[-1][0])
            for place, _ in reversed(self._blocks[1:]) if tag in CLOSES else ():
                open_tag = self.tag[self._open[place]]
                if open_tag in CLOSES[tag][0]:
                    self._close_from(place)
                if open_tag in CLOSES[tag][0] | CLOSES[tag][1]:
                    break
        here, element = self._open[-1], len(self.tag)
        self.tag.append(tag)
        self.parent.append(here)
        names, role, hidden = frozenset(), "", False
        if attrs:
            for m in _ATTRIBUTE.finditer(attrs):
                name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
                if name in ("class", "id", "itemprop"):
                    names |= frozenset(value.split())
                elif name == "role":
                    role = value.strip().lower()
                elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true") or (name == "style" and _INVISIBLE.search(value)):
                    hidden = True
        self.names.append(names)
        self.role.append(role)
        self.drop.append(self.drop[here] or hidden or tag in NEVER_TEXT or tag in PAGE_FURNITURE or role in ROLES)
        if tag in BLOCK:
            self.runs.append((here, None))
        elif tag == "br":
            self._text(" ")
        if tag not in VOID:
            if tag in BLOCK:
                self._blocks.append((len(self._open), []))
            self._open.append(element)
            self._counts[tag] += 1

    def _end(self, tag: str) -> None:
        if tag in ("body", "html") or not self._counts[tag]:
            return
        for place in range(len(self._open) - 1, 0, -1):
            open_tag = self.tag[self._open[place]]
            if open_tag == tag:
                self._close_from(place)
                return
            if tag not in BLOCK and open_tag in BLOCK:  # an inline end tag ends no block
                return

    def _close_from(self, place: int) -> None:
        while len(self._open) > place:
            element = self._open.pop()
            self._counts[self.tag[element]] -= 1
            if self.tag[element] not in BLOCK:
                continue
            _, parts = self._blocks.pop()
            self.runs.append((element, None))
            content = " ".join("".join(parts).split())
            if content:
                self.digest[element] = blake2b(f"{self.tag[element]}\0{content}".encode("utf-8", "surrogatepass"), digest_size=16).digest()
                self._blocks[-1][1].append(f" \1{self.digest[element].hex()}\1 ")

    def article(self) -> tuple[list[bool], list[bool]]:
        """For every element, whether it is in the article and whether it goes. The article is every article element; without one, every main
        element; without one, the elements named like content; without one, the page."""
        n = len(self.tag)
        goes = list(self.drop)
        parts = [frozenset(p.lower() for x in names for p in _PARTS.findall(x)) if names else names for names in self.names]
        joined = [frozenset(re.sub(r"[^a-z]", "", x.lower()) for x in names) if names else names for names in self.names]
        commented = [bool(p & COMMENT_PARTS) for p in parts]
        for e in range(1, n):
            commented[e] = commented[e] or commented[self.parent[e]]
        roots: set[int] = set()
        for is_root in (
            lambda e: self.tag[e] == "article", lambda e: self.tag[e] == "main" or self.role[e] == "main",
            lambda e: bool(joined[e] & CONTENT_NAMES) and self.tag[e] not in ("html", "body"),
        ):
            roots = {e for e in range(1, n) if not goes[e] and not commented[e] and is_root(e)}
            if roots:
                break
        holds = [False] * n  # a root is this element or below it
        for e in roots:
            while e >= 0 and not holds[e]:
                holds[e] = True
                e = self.parent[e]
        inside = [not roots] + [False] * (n - 1)
        for e in range(1, n):
            above = self.parent[e]
            inside[e] = inside[above] or e in roots
            named = bool((parts[e] | joined[e]) & NAME_PARTS) and not holds[e] and self.tag[e] not in ("html", "body", "h1")
            # the header of an article holds its title, the header of a page its name
            header = (self.tag[e] == "header" or "header" in parts[e]) and not (roots and inside[e]) and not holds[e]
            goes[e] = goes[e] or goes[above] or named or header
        return inside, goes

    def text(self, templates: frozenset[bytes] = frozenset()) -> str:
        inside, goes = self.article()
        if templates:
            for e in range(1, len(goes)):
                goes[e] = goes[e] or goes[self.parent[e]] or self.digest.get(e) in templates
        out, block = [], []
        for element, text in self.runs:
            if text is None:
                if block:
                    out.extend("".join(block).split())
                    block = []
            elif inside[element] and not goes[element]:
                block.append(text)
        out.extend("".join(block).split())
        return " ".join(out)

    def subtrees(self) -> tuple[bytes, set[bytes], set[bytes]]:
        """A digest of the article, and those of the subtrees in it and outside it. Below what goes by its name nothing is counted."""
        inside, goes = self.article()
        within, outside, article = set(), set(), blake2b(digest_size=8)
        for e in range(1, len(self.tag)):
            digest = self.digest.get(e)
            if digest is None or self.tag[e] in ("html", "body"):
                continue
            above = self.parent[e]
            if goes[above]:
                continue
            if inside[above]:
                within.add(digest)
                article.update(digest)
            elif inside[e]:
                article.update(digest)  # the article itself
            else:
                outside.add(digest)
        return article.digest(), within, outside


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, key, html) to a row per subtree of a page: (host, key, article, inside, subtree)."""
    for batch in batches:
        hosts, keys, articles, inside, digests = [], [], [], [], []
        for host, key, source in zip(batch.column("host").to_pylist(), batch.column("key").to_pylist(), batch.column("html")):
            article, within, outside = Page(source.as_py()).subtrees()
            for some, is_inside in ((within, True), (outside - within, False)):
                digests.extend(some)
                inside.extend([is_inside] * len(some))
            n = len(within | outside)
            hosts.extend([host] * n)
            keys.extend([key] * n)
            articles.extend([int.from_bytes(article, "big", signed=True)] * n)
        columns = [pa.array(hosts, pa.string()), pa.array(keys, pa.binary()), pa.array(articles, pa.int64()), pa.array(inside, pa.bool_()), pa.array(digests, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["host", "key", "article", "inside", "subtree"])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(page_id, url, html, templates) to (page_id, url, text)."""
    for batch in batches:
        texts = [
            Page(source.as_py()).text(frozenset(templates.as_py() or ())) for source, templates in zip(batch.column("html"), batch.column("templates"))
        ]
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"])


def site_templates(subtrees: DataFrame, outside: tuple[int, float] = OUTSIDE, within: tuple[int, float] = INSIDE) -> DataFrame:
    """(host, subtree) of what recurs across many pages of a host; rows as ``_subtrees`` returns them."""
    totals = subtrees.groupBy("host").agg(F.count_distinct("article").alias("pages"))
    counts = subtrees.groupBy("host", "subtree").agg(F.count_distinct("article").alias("n"), F.bool_or("inside").alias("inside"))
    counts = counts.filter(F.col("n") >= min(outside[0], within[0])).join(lookup(totals, "site-pages"), "host")
    enough = lambda least, share: (F.col("n") >= least) & (F.col("n") >= F.lit(share) * F.col("pages"))
    return counts.filter(F.when(F.col("inside"), enough(*within)).otherwise(enough(*outside))).select("host", "subtree")


def main_text(
    pages: DataFrame, id_col: str = "page_id", url: str = "url", source: str = "html", outside: tuple[int, float] = OUTSIDE, within: tuple[int, float] = INSIDE
) -> DataFrame:
    """(page_id, url, text, n_chars) of every page: the text of its article.

    1. Every block element that holds text is digested with all it holds; tags and texts count, attributes do not.
    2. Spark counts the digests per host, over pages with different articles. What recurs on many pages of the host is site template.
    3. The subtrees of a page that are template go, and so do menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader
       comments, told by element, role or class, for sites too small to count. The article elements stay; see ``Page.article`` for pages without.

    Character references are decoded, white space inside a block becomes one space, blocks are joined in page order by one space. Tags that are
    not closed or cut off are read as browsers do. A null or empty html gives an empty text, a null url belongs to the host of no name. Pages that
    repeat give a row each, and count once. A page is parsed whole, whatever its length, in memory that grows with the page alone. Other columns are
    ignored, whatever their names. Counts are added up before they are shuffled, so a host with a third of all pages is no hot key; pages
    are only joined with the templates that their own article holds, by a digest of the html.
    """
    mine = pages.select(F.col(id_col).alias("page_id"), F.col(url).alias("url"), whole(F.col(source)).alias("html"))
    keyed = mine.select("page_id", "url", "html", host_of(F.col("url")).alias("host"), text_key(F.col("html")).alias("key"))
    seen = keyed.select("host", "key", "html").mapInArrow(_subtrees, "host string, key binary, article long, inside boolean, subtree binary")
    seen = stage(seen, "subtrees")
    recurring = lookup(site_templates(seen, outside, within), "site-templates")
    held = seen.filter("inside").select("host", "key", "subtree").join(recurring, ["host", "subtree"])
    held = held.groupBy(F.col("host").alias("on"), F.col("key").alias("of")).agg(F.collect_set("subtree").alias("templates"))  # of one page
    joined = keyed.join(lookup(held, "page-templates"), (F.col("host") == F.col("on")) & (F.col("key") == F.col("of")), "left")
    texts = joined.select("page_id", "url", "html", "templates")
    schema = f"page_id {mine.schema['page_id'].dataType.simpleString()}, url string, text string"
    return texts.mapInArrow(_texts, schema).withColumn("n_chars", F.length("text").cast("long"))
