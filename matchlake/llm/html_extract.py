"""Main text of web pages by site template removal.

Every page is parsed into elements.  The subtree of an element is hashed from
its tag, its text and its children's hashes; Spark counts on how many
different pages of its host each hash stands (pages whose main elements have
the same blocks, but for the shortest that make up a tenth of the text at most,
count once, so copies and near copies of an article make no template).  Subtrees that recur on ``many`` pages of a host, however large it
is, or on at least ``few`` pages and half of a smaller host are the site's
template and are deleted.  Hosts with few pages have no counts to go by, so
elements whose tag, role or class says that they are no main text (menus,
footers, adverts, forms, comments) are deleted as well.

Main text is what stands in ``article`` or ``main`` elements, or in the body of
a page without them.  Inside a main element only containers (not paragraphs
or headings) can be template: a sentence that many articles quote stays.
Classes count by their words on block containers alone (``with-sidebar`` and the
like say what else the page has, and do not), ids and roles as a whole; neither
a template nor a class or id takes an element that holds most of the text (over
``MOST`` of it).  Character references are decoded, white space in a block
becomes one space, blocks are joined in page order by one space.

Defined cases: null html is empty and gives empty text.  Pages whose url has no
host (or is null) have no template counts.  Missing end tags are closed as
browsers do; what an unclosed script, style or comment swallows is no text, but
an element that browsers show instead of its content (video, svg, ...) loses it
only if it is closed.  Rows are independent apart from the counts; repeated
rows each give their row.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import append_columns, store, texts_of

MANY_PAGES, FEW_PAGES, MOST = 20, 5, 2 / 3

# HTML element names by role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe".split())
REPLACED = frozenset("svg math object canvas audio video select noscript template".split())      # their content is not shown
FOREIGN = frozenset("svg math".split())
NEVER = frozenset("nav footer aside form button dialog menu".split())   # no main text wherever they stand
MAIN = frozenset("article main".split())
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup "
                   "time tt u var".split())
CONTAINERS = frozenset("div section ul ol dl table details fieldset figure header".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main "
                     "menu nav ol p pre section table ul".split())
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
            "option": ("option",), "p": ("p",)}
LIMITS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table")}
# Words in class, id and role that mark what is no main text; the second list only outside main elements.
MARKS = frozenset("ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments complementary consent contentinfo "
                  "cookie cookies disqus footer gdpr menu modal nav navbar navigation newsletter notice pagination popup promo "
                  "respond search share sharing sidebar social sponsor sponsored subscribe toolbar".split())
OUTER_MARKS = frozenset("header masthead related widget".split())

TAG = re.compile(r"<(?:!--|(/?)([a-zA-Z][^\s/>]*)|[!?])")
# A class that begins so speaks of the page, not of the element.
ABOUT_PAGE = frozenset("with without has have no not is show hide".split())
MARKED = CONTAINERS | MAIN | frozenset("blockquote center".split())
ATTRIBUTE = re.compile(r"""(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
TAG_END = re.compile(r"""[^"'>]*(?:(?:"[^"]*"|'[^']*')[^"'>]*)*>""")
PIECE = re.compile(r"[a-z]+")


def marks_of(tag: str, attributes: str, known: frozenset) -> frozenset:
    """Which of the ``known`` words the class, id and role of a container say of it."""
    if tag not in MARKED or "=" not in attributes:
        return frozenset()
    found = set()
    for key, value in ATTRIBUTE.findall(attributes):
        value = value.strip("\"'").lower()
        if key.lower() == "class":
            words = [PIECE.findall(token) for token in value.split()]
            found.update(w for token in words if token and token[0] not in ABOUT_PAGE for w in token)
        elif key.lower() == "role" or tag != "section":
            found.add(value.strip())
    return frozenset(found & known)


@dataclass
class _Open:
    tag: str
    marks: frozenset
    in_main: bool
    at: int                     # where its text starts, in all pieces
    main_at: int                # and in the main elements' pieces
    known: int                  # entries of its descendants start here
    parts: list = field(default_factory=list)
    holds_main: bool = False


class Page:
    """One pass over a page: ``text`` without the subtrees in ``template``, and the hashes of its subtrees."""

    def __init__(self, html: str, template: frozenset = frozenset()):
        self.template = template
        self.pieces: list[str] = []
        self.main: list[str] = []
        self.entries: list[int] = []
        self.has_main = False
        self.main_hash = 0
        self.stack = [_Open("", frozenset(), False, 0, 0, 0)]
        self.where: dict[str, list[int]] = {}      # places of the open elements, by tag
        self.mains = 0
        self.blocks: list[str] = []         # of main elements
        self.later: list[tuple[bool, int, int, int, int]] = []      # to delete unless it is most of the text
        self._read(html)
        while len(self.stack) > 1:
            self._close(False)
        self.main_hash = self._gist() if self.blocks else self._hash(self.stack[0])
        self._delete_later()
        self.text = " ".join("".join(self.main if self.has_main else self.pieces).split())

    def _gist(self) -> int:
        """Hash of the main elements' blocks without the shortest that make up a tenth of the text at most."""
        left = sum(map(len, self.blocks)) / 10
        small = set()
        for n, i in sorted((len(b), i) for i, b in enumerate(self.blocks)):
            left -= n
            if left < 0:
                break
            small.add(i)
        kept = "\x00".join(b for i, b in enumerate(self.blocks) if i not in small)
        return self._signed(xxhash.xxh64_intdigest(kept.encode("utf-8", "surrogatepass")))

    def _delete_later(self) -> None:
        """Outer elements first; what is most of the text stays, and then as a copy: no template is taken out of it."""
        pieces = self.main if self.has_main else self.pieces
        at = [(ma, mb) if self.has_main else (a, b) for _, a, b, ma, mb in self.later]
        size = [0]
        for piece in pieces:
            size.append(size[-1] + len(piece.strip()))
        gone, copies = [], []
        for (template, *_), (a, b) in zip(reversed(self.later), reversed(at)):
            if size[b] - size[a] > MOST * size[-1]:
                copies += [(a, b)] if template else []
            elif not (template and any(x <= a and b <= y for x, y in copies)):
                gone.append((a, b))
        for a, b in gone:
            pieces[a:b] = [" "] * (b - a)

    @staticmethod
    def _signed(h: int) -> int:
        return h - (1 << 64) if h >> 63 else h

    def _hash(self, e: _Open) -> int:
        return self._signed(xxhash.xxh64_intdigest("\x00".join([e.tag, *e.parts]).encode("utf-8", "surrogatepass")))

    def _text(self, raw: str) -> None:
        text = unescape(raw) if "&" in raw else raw
        self.pieces.append(text)
        if self.mains:
            self.main.append(text)
        if words := text.split():
            block = " ".join(words)
            self.stack[-1].parts.append(block)
            if self.mains:
                self.blocks.append(block)

    def _space(self) -> None:
        self.pieces.append(" ")
        self.main.append(" ")

    def _read(self, html: str) -> None:
        at = 0
        while m := TAG.search(html, at):
            if m.start() > at:
                self._text(html[at:m.start()])
            start = m.start()
            if m[2] is None:
                at = self._skip(html, start)
                continue
            tag = m[2].lower()
            ended = TAG_END.match(html, m.end())
            stop = ended.end() if ended else html.find(">", m.end()) + 1
            if not stop:
                return
            at = stop
            if m[1]:
                self._end(tag)
            elif tag in RAW:
                close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(html, stop)
                at = html.find(">", close.end()) + 1 if close else 0
                if not at:
                    return
                self._space()
            else:
                self._start(tag, html[m.end():stop - 1])
        self._text(html[at:])

    @staticmethod
    def _skip(html: str, at: int) -> int:
        end = html.find("-->", at + 2) + 3 if html.startswith("<!--", at) else html.find(">", at) + 1
        return end if end > 2 else len(html) if html.startswith("<!--", at) or not end else end

    def _start(self, tag: str, attributes: str) -> None:
        if tag not in INLINE:
            self._space()
        if tag in VOID:
            return
        if tag in FOREIGN and attributes.rstrip().endswith("/"):
            return
        if tag in CLOSES_P and self.where.get("p"):
            self._close_to(("p",), ("table", "td", "button"))
        if tag in SIBLINGS:
            self._close_to(SIBLINGS[tag], LIMITS.get(tag, ("table", "td")))
        marks = marks_of(tag, attributes, MARKS if self.mains else MARKS | OUTER_MARKS)
        if tag == "header" and not self.mains:
            marks |= {tag}
        if tag in MAIN:
            self.mains += 1
        self.stack.append(_Open(tag, marks, self.mains > 0, len(self.pieces), len(self.main), len(self.entries)))
        self.where.setdefault(tag, []).append(len(self.stack) - 1)

    def _last(self, tags: tuple) -> int:
        return max((self.where[t][-1] for t in tags if self.where.get(t)), default=0)

    def _close_to(self, tags: tuple, limits: tuple) -> None:
        at = self._last(tags)
        if at > self._last(limits):
            while len(self.stack) > at:
                self._close(True)

    def _end(self, tag: str) -> None:
        if tag == "p" or tag not in INLINE:
            self._space()
        if self.where.get(tag):
            while self.stack[-1].tag != tag:
                self._close(False)
            self._close(True)

    def _close(self, explicit: bool) -> None:
        e = self.stack.pop()
        self.where[e.tag].pop()
        above = self.stack[-1]
        h = self._hash(e)
        above.parts.append(f"{h:x}")
        if e.tag in MAIN:
            self.mains -= 1
            if not self.mains and not e.marks:
                self.has_main = above.holds_main = True
        above.holds_main |= e.holds_main
        safe = e.tag in ("html", "body") or e.holds_main and not (explicit and e.tag in NEVER) or e.tag in MAIN and not e.in_main
        if e.tag in MAIN and not e.marks and not self.mains:
            safe = True
        if safe:
            return
        never = e.tag in NEVER or explicit and e.tag in REPLACED
        countable = e.tag not in INLINE and (e.tag in CONTAINERS or e.tag in NEVER or not e.in_main)
        if never:
            del self.entries[e.known:]      # what it holds goes with it
        if countable:
            self.entries.append(h)
        if never:
            del self.pieces[e.at:], self.main[e.main_at:]
            while self.later and self.later[-1][1] >= e.at:
                self.later.pop()
        elif e.marks or countable and h in self.template:
            self.later.append((not e.marks, e.at, len(self.pieces), e.main_at, len(self.main)))
        if e.tag not in INLINE:
            self._space()


def host_of(url):
    """Host of a url column in lower case; null where there is none."""
    host = F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(host != "", host)


def _page_key(url: str, html: str):
    return F.md5(F.concat(F.coalesce(F.col(url), F.lit("")), F.lit("\n"), F.coalesce(F.col(html), F.lit(""))))


def parsed_pages(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page, host, main, subtrees) of the pages that have a host: a hash of the row, and of its countable subtrees."""
    def start():
        def work(html):
            found = [Page(t) for t in texts_of(html)]
            return [pa.array([p.main_hash for p in found], pa.int64()),
                    pa.array([sorted(set(p.entries)) for p in found], pa.list_(pa.int64()))]
        return work

    rows = pages.select(_page_key(url_col, html_col).alias("page"), host_of(F.col(url_col)).alias("host"), F.col(html_col).alias("html")) \
        .where("host is not null")
    return append_columns(rows, ["html"], [("main", "bigint"), ("subtrees", "array<bigint>")], start, "html", keep=["page", "host"])


def templates(parsed: DataFrame, many: int = MANY_PAGES, few: int = FEW_PAGES) -> DataFrame:
    """(host, subtree): the subtrees that recur on ``many`` pages of the host, or on ``few`` and half of its pages;
    ``parsed`` as from ``parsed_pages``."""
    # a row for each subtree of a page, and one (null) for the page itself
    rows = parsed.select("host", "main", F.explode(F.array_append(F.col("subtrees"), F.lit(None).cast("bigint"))).alias("subtree"))
    counts = store(rows.distinct().groupBy("host", "subtree").agg(F.count("*").alias("n")).where((F.col("n") >= min(few, many))), "subtrees")
    total = counts.where("subtree is null").select("host", F.col("n").alias("pages"))
    return counts.where("subtree is not null").join(total, "host") \
        .where((F.col("n") >= many) | (F.col("n") >= few) & (2 * F.col("n") >= F.col("pages"))).select("host", "subtree")


def extract(pages: DataFrame, url_col: str = "url", html_col: str = "html", many: int = MANY_PAGES, few: int = FEW_PAGES,
            keep: list[str] | None = None) -> DataFrame:
    """``pages`` plus text string, n_chars bigint and n_templates (template subtrees found on the page).

    Templates meet the subtrees of pages on narrow rows; pages then meet their
    own template subtrees by a hash of the row, so a host with very many pages
    is spread like any other.
    """
    names = pages.columns
    inner = pages.toDF(*[f"c{i}" for i in range(len(names))])
    url, html = f"c{names.index(url_col)}", f"c{names.index(html_col)}"
    parsed = store(parsed_pages(inner, url, html), "parsed")
    found = parsed.select("page", "host", F.explode("subtrees").alias("subtree")) \
        .join(store(templates(parsed, many, few), "templates"), ["host", "subtree"]) \
        .groupBy("page").agg(F.collect_set("subtree").alias("template"))
    joined = inner.withColumn("page", _page_key(url, html)).join(store(found, "found"), "page", "left")

    def start():
        def work(html, template):
            hashes = template.to_pylist()
            out = [Page(t, frozenset(h or ())).text if t else "" for t, h in zip(texts_of(html), hashes)]
            return [pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64()),
                    pa.array([len(h or ()) for h in hashes], pa.int64())]
        return work

    new = ("text", "n_chars", "n_templates")
    take = [i for i, n in enumerate(names) if n.lower() not in new and (keep is None or n in keep)]
    out = append_columns(joined, [html, "template"], [("text", "string"), ("n_chars", "bigint"), ("n_templates", "bigint")],
                         start, html, keep=[f"c{i}" for i in take])
    return out.select(*[F.col(f"c{i}").alias(names[i]) for i in take], *new)
