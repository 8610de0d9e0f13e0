"""HTML extraction with site-template removal.

A page is read into a flat tree by a tolerant tokeniser that closes what authors leave open. Every
element that can hold boilerplate has a hash of its subtree (tags and texts). Spark counts, per host,
the pages on which a hash occurs; subtrees that recur on many pages of the host are its template and
are deleted. What the markup itself names as menu, header, footer, sidebar, notice, advert, form,
script, style or reader comment is deleted as well. Classes, ids and roles count as whole tokens, or
if all words of a token are such names or words of place (``site-footer``, not ``related-work``). In
an article an id names no heading, section or text, and a class names text only as an advert. html,
body and main, and what wraps the page's main text, are never deleted by their names. The main text is what is left of the article
elements, else of the main element, else of the body.

A subtree is a template if it occurs with ``min_pages`` different stories of the host, however large
the host, and holds less than half of the page's text. The story of a page is the hash of its three
longest blocks outside of what the markup names, so copies of a page, or of all but its date, count
once and don't make their own text a template. A subtree on ``min_pages`` pages and ``min_share`` of
the host's pages is a template too; inside an article this alone holds for lists and tables. Other
running text inside an article (paragraphs, headings, items) is never a candidate: it stays however
often it is repeated. The table of templates is broadcast while it has ``max_broadcast`` rows or
fewer (8 bytes each, and the hosts); of a larger one, each page gets by shuffles on host and subtree,
then on host and digest of the page, only the templates that it holds.

Character references are decoded, white space inside a block becomes one space, blocks are joined by
one line feed. Null html counts as empty, and an empty text is an empty string. A page of any length
is read whole. Pages with a null or odd url share one host. Repeated rows are pages of their own, but
tell one story. An empty table gives an empty result.
Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phasegrid.llm.shared import cut

_TAG = re.compile(
    r"""<!--(?:.*?--!?>|.*\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*>""",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""(class|id|role|style|hidden|aria-hidden)(?![\w-])(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.IGNORECASE)
_NAME = re.compile(r"[a-z]+")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset(("script", "style", "noscript", "template", "title", "textarea", "iframe", "xmp", "noembed", "noframes"))
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var".split()
)
_CELL = frozenset(("td", "th"))
#: Elements that the markup itself names as something other than the article.
_DROP = frozenset(
    "script style noscript template title textarea iframe xmp noembed noframes head nav footer aside form button select option input dialog menu "
    "svg canvas object audio video map".split()
)
#: Names in class, id and role that say the same.
_NAMED = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert newsletter "
    "subscribe popup modal overlay sidebar aside complementary menu nav navbar navigation breadcrumb breadcrumbs comment comments disqus reply replies "
    "share sharing social related footer contentinfo masthead login signup search toolbar pagination widget".split()
)
_ARTICLE_NAMES = frozenset(("header", "headers"))
#: The only names that text inside an article can have.
_ADVERTS = frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored".split())
#: Words that may stand beside a name in a token.
_PLACE = frozenset(
    "site page main top bottom left right upper lower inner outer primary secondary global mobile desktop sticky fixed x box bar list item items wrapper wrap "
    "container section area block slot unit panel region group inline links link posts post articles buttons button icons form text title heading header "
    "message center row column col content".split()
)
_WRAPPERS = frozenset(("html", "body", "main"))
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_TEXT = _HEADINGS | frozenset("p pre blockquote li ul ol dl dt dd table tr td th figure".split())
#: Elements whose subtrees are hashed and counted; the last are so only outside of articles.
_COUNTED = frozenset("div section ul ol dl table nav header footer aside form menu figure details center address".split())
_SHARED = frozenset("ul ol dl table".split())
_COUNTED_OUTSIDE = frozenset("p h1 h2 h3 h4 h5 h6 pre blockquote li".split())
_CLOSED_BY = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
    "tbody": (("tbody", "thead", "tfoot"), ("table",)),
}


@lru_cache(maxsize=4096)
def _named_by(value: str, names: frozenset[str]) -> bool:
    """A token of ``value`` is a name, or made of names and words of place only."""
    for token in value.split():
        words = _NAME.findall(token)
        if any(w in names for w in words) and all(w in names or w in _PLACE for w in words):
            return True
    return False


class Page:
    """Elements in page order: ``tag``, ``parent``, ``named`` (is boilerplate by its markup), ``hash``
    of the subtree, ``size`` of its text; ``runs``: (element, text), None for a break."""

    def __init__(self, html: str) -> None:
        self.tag, self.parent, self.named, self.hash, self.size = ["#page"], [-1], [False], [0], [0]
        self.runs: list[tuple[int, str | None]] = []
        self._parts: list[list[str]] = [["#page"]]
        self._stack = [0]
        self._by_name: set[int] = set()
        self._read(html)
        if self._by_name:
            self._keep_wrappers()

    def _text(self, text: str) -> None:
        if not text:
            return
        text = unescape(text)
        top = self._stack[-1]
        self.runs.append((top, text))
        words = text.split()
        if words:
            self._parts[top].append(" ".join(words))
            self.size[top] += sum(map(len, words))

    def _close(self, count: int) -> None:
        for _ in range(count):
            i = self._stack.pop()
            if self.tag[i] not in _INLINE:
                self.runs.append((i, " " if self.tag[i] in _CELL else None))
            self.hash[i] = xxhash.xxh3_64_intdigest("\x00".join(self._parts[i]).encode("utf-8", "surrogatepass")) - (1 << 63)
            up = self.parent[i]
            self._parts[up].append(f"\x01{self.hash[i]}")
            self._parts[i] = []
            self.size[up] += self.size[i]

    def _open(self, tag: str, attributes: str) -> int:
        named, by_name = tag in _DROP, False
        if attributes and not named:
            for name, a, b, c in _ATTRIBUTE.findall(attributes):
                name, value = name.lower(), (a or b or c).lower()
                if name == "hidden" or (name == "aria-hidden" and value == "true"):
                    named = True
                elif name == "style":
                    named = named or "display:none" in value.replace(" ", "")
                elif name in ("class", "id", "role"):
                    by_name = by_name or self._says(tag, name, value)
            by_name = by_name and not named
            named = named or by_name
        elif tag == "header":
            named = not self._inside("article")
        if tag == "article" and self._inside("article"):
            named = True  # an article in an article is a reader's comment
        i = len(self.tag)
        if by_name:
            self._by_name.add(i)
        self.tag.append(tag)
        self.parent.append(self._stack[-1])
        self.named.append(named)
        self.hash.append(0)
        self.size.append(0)
        self._parts.append([tag])
        if tag not in _INLINE:
            self.runs.append((i, " " if tag in _CELL else None))
        return i

    def _says(self, tag: str, attribute: str, value: str) -> bool:
        """The class, id or role names the element as boilerplate."""
        if tag in _WRAPPERS:
            return False
        article = self._inside("article") or self._inside("main")
        if attribute == "id" and (tag in _HEADINGS or (article and (tag in _TEXT or tag == "section"))):
            return False
        if article and tag in _TEXT:
            return _named_by(value, _ADVERTS)
        return _named_by(value, _NAMED) or (not self._inside("article") and tag not in _HEADINGS and _named_by(value, _ARTICLE_NAMES))

    def _keep_wrappers(self) -> None:
        """Undo the names of what holds the page's main text: at least half of all text and every
        article or main; without those a first heading, or all text."""
        n = len(self.tag)
        marks = [i for i in range(n) if self.tag[i] in ("article", "main") and not self.named[i]]
        marks = marks or [i for i in range(n) if self.tag[i] == "h1" and not self.named[i]][:1]
        held = [0] * n
        for i in marks:
            held[i] = 1
        for i in range(n - 1, 0, -1):
            held[self.parent[i]] += held[i]
        for i in self._by_name:
            if 2 * self.size[i] >= self.size[0] > 0 and (held[i] == len(marks) if marks else self.size[i] == self.size[0]):
                self.named[i] = False

    def _inside(self, tag: str) -> bool:
        return any(self.tag[i] == tag for i in self._stack)

    def _make_room(self, tag: str) -> None:
        """Close what a start tag closes by itself."""
        if tag in _CLOSED_BY:
            closed, stop = _CLOSED_BY[tag]
            deepest = 0
            for depth in range(len(self._stack) - 1, 0, -1):
                own = self.tag[self._stack[depth]]
                if own in stop:
                    break
                if own in closed:
                    deepest = depth
            if deepest:
                self._close(len(self._stack) - deepest)
        elif tag not in _INLINE:
            for depth in range(len(self._stack) - 1, 0, -1):
                own = self.tag[self._stack[depth]]
                if own == "p":
                    self._close(len(self._stack) - depth)
                    break
                if own not in _INLINE:
                    break
        if tag == "body" and self._inside("head"):
            at = next(d for d, i in enumerate(self._stack) if self.tag[i] == "head")
            self._close(len(self._stack) - at)

    def _read(self, html: str) -> None:
        at, lower = 0, None
        while match := _TAG.search(html, at):
            self._text(html[at : match.start()])
            at = match.end()
            slash, tag, attributes = (match[1], match[2], match[3]) if match[2] else (match[4], match[5], match[6])
            if not tag:
                continue
            tag = tag.lower()
            if slash:
                if tag in ("br", "p") and not self._inside(tag):
                    self.runs.append((self._stack[-1], None if tag == "p" else " "))
                    continue
                for depth in range(len(self._stack) - 1, 0, -1):
                    own = self.tag[self._stack[depth]]
                    if own == tag:
                        self._close(len(self._stack) - depth)
                        break
                    if tag in _INLINE and own not in _INLINE:
                        break
                continue
            if tag == "br" or tag == "wbr":
                if tag == "br":
                    self.runs.append((self._stack[-1], " "))
                continue
            self._make_room(tag)
            i = self._open(tag, attributes)
            if tag in _VOID or (attributes.endswith("/") and tag in ("svg", "path")):
                self._stack.append(i)
                self._close(1)
            elif tag in _RAW:
                if lower is None:
                    lower = html.lower() if len(html.lower()) == len(html) else html
                end = lower.find(f"</{tag}", at)
                at = len(html) if end < 0 else (html.find(">", end) + 1 or len(html))
                self._stack.append(i)
                self._close(1)
            else:
                self._stack.append(i)
        self._text(html[at:])
        self._close(len(self._stack) - 1)

    def candidates(self) -> dict[int, bool]:
        """Hashes of the subtrees that may be part of the host's template; false for those that only
        count by their share of the pages."""
        inside, out, half = [False], {}, self.size[0] / 2
        for i in range(1, len(self.tag)):
            tag = self.tag[i]
            within = inside[self.parent[i]] or tag in ("article", "main")
            inside.append(within)
            if self.size[i] and self.size[i] < half and (tag in _COUNTED or (not within and tag in _COUNTED_OUTSIDE)):
                out[self.hash[i]] = out.get(self.hash[i], True) and not (within and tag in _SHARED)
        return out

    def story(self) -> int:
        """The hash of the three longest blocks that the markup doesn't name as boilerplate."""
        gone = [False]
        for i in range(1, len(self.tag)):
            gone.append(gone[self.parent[i]] or self.named[i])
        blocks, now = set(), []
        for i, run in [*self.runs, (0, None)]:
            if run is not None:
                if not gone[i]:
                    now.append(run)
            elif now:
                blocks.add(" ".join("".join(now).split()))
                now = []
        longest = sorted(blocks, key=lambda x: (-len(x), x))[:3]
        return xxhash.xxh3_64_intdigest("\n".join(longest).encode("utf-8", "surrogatepass")) - (1 << 63)

    def text(self, template: set[int]) -> str:
        """The main text without the ``template`` subtrees; ``recurring`` is how many of them, not one
        within another, the page holds."""
        n = len(self.tag)
        half = self.size[0] / 2
        gone, inside = [False] * n, [False] * n
        self.recurring = 0
        for i in range(1, n):
            up, tag = self.parent[i], self.tag[i]
            inside[i] = inside[up] or tag in ("article", "main")
            listed = self.size[i] < half and self.hash[i] in template and (tag in _COUNTED or (not inside[i] and tag in _COUNTED_OUTSIDE))
            self.recurring += listed and not gone[up]
            gone[i] = gone[up] or listed or self.named[i]
        for root in ("article", "main", "#page"):
            roots = [i for i in range(n) if self.tag[i] == root and not gone[i]]
            if not roots and root == "article":
                # An article within something left open, say an advert, still is the article.
                roots = [i for i in range(n) if self.tag[i] == root and not self.named[i]]
                if roots:
                    for i in range(1, n):
                        gone[i] = self.named[i] or (i not in roots and gone[self.parent[i]])
            if roots:
                break
        chosen, kept = set(roots), [False] * n
        for i in range(n):
            kept[i] = not gone[i] and (i in chosen or (i > 0 and kept[self.parent[i]]))
        blocks, now = [], []
        for i, run in self.runs:
            if run is None:
                if now:
                    blocks.append(" ".join("".join(now).split()))
                    now = []
            elif kept[i]:
                now.append(run)
        if now:
            blocks.append(" ".join("".join(now).split()))
        return "\n".join(b for b in blocks if b)


def host_of(url: Column) -> Column:
    """The host of a url in lower case, without user and port; empty if there is none."""
    found = F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.lower(found)


def _subtrees(pages: DataFrame) -> DataFrame:
    """(host, digest, story, hash, always) of each candidate of ``pages(host, html)``."""
    pages = pages.select("host", "html", F.xxhash64("html", F.lit("digest")).alias("digest"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for host, html, digest in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                page = Page(html.as_py())
                found = page.candidates()
                size = len(found)
                for column, values in zip(out, ([host] * size, [digest] * size, [page.story()] * size, found.keys(), found.values()), strict=True):
                    column += values
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=["host", "digest", "story", "hash", "always"])

    return pages.mapInArrow(run, "host string, digest long, story long, hash long, always boolean")


def template_hashes(pages: DataFrame, min_pages: int, min_share: float) -> DataFrame:
    """(host, hash) of the template subtrees of ``pages(host, html)``."""
    # By story first, so a subtree of a hot host is counted by many tasks.
    stories = _subtrees(pages).groupBy("host", "hash", "story").agg(F.count("*").alias("n"), F.min("always").alias("always"))
    counted = stories.groupBy("host", "hash").agg(F.sum("n").alias("n"), F.count("*").alias("stories"), F.min("always").alias("always"))
    hosts = pages.groupBy("host").agg(F.count("*").alias("pages"))
    often = F.col("always") & (F.col("stories") >= min_pages)
    shared = (F.col("n") >= min_pages) & (F.col("n") >= F.col("pages") * min_share)
    return counted.where(F.col("n") >= min_pages).join(hosts, "host").where(often | shared).select("host", "hash")


def main_text(pages: DataFrame, min_pages: int = 5, min_share: float = 0.3, max_broadcast: int = 100_000) -> DataFrame:
    """One row per page of ``pages(page_id, url, html)``: page_id, url, text, n_chars and n_template, the
    number of template subtrees that were deleted from it."""
    base = pages.select(
        F.col("page_id"), F.col("url"), host_of(F.col("url")).alias("host"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html")
    )
    listed = cut(template_hashes(base.select("host", "html"), min_pages, min_share))
    known = None
    if listed.count() <= max_broadcast:
        per_host: dict[str, set[int]] = {}
        for host, found in listed.collect():
            per_host.setdefault(host, set()).add(found)
        known = pages.sparkSession.sparkContext.broadcast(per_host)
        joined = base.withColumn("template", F.lit(None).cast("array<long>"))
    else:
        held = _subtrees(base.select("host", "html")).select("host", "digest", "hash").distinct().join(listed, ["host", "hash"])
        held = held.groupBy("host", "digest").agg(F.collect_set("hash").alias("template"))
        joined = base.withColumn("digest", F.xxhash64("html", F.lit("digest"))).join(held, ["host", "digest"], "left")
    joined = joined.select("page_id", "url", "host", "html", "template")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts = [], []
            for host, html, template in zip(batch.column(2).to_pylist(), batch.column(3), batch.column(4), strict=True):
                own = known.value.get(host, set()) if known else set(template.as_py() or ())
                page = Page(html.as_py())
                texts.append(page.text(own).encode("utf-8", "replace").decode())
                counts.append(page.recurring)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(counts, pa.int64())], names=["page_id", "url", "text", "n_template"]
            )

    schema = f"page_id {base.schema['page_id'].dataType.simpleString()}, url {base.schema['url'].dataType.simpleString()}, text string, n_template long"
    out = joined.mapInArrow(run, schema)
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"), "n_template")
