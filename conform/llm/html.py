"""Main text of web pages."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from conform.llm.staging import check_columns, staged, text_or_empty

# Names of HTML elements and usual names of page parts.
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_RAW = set("script style textarea title xmp iframe noembed noframes noscript".split())
_INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr img picture source br".split()
)
_FLOW = _INLINE | set("p h1 h2 h3 h4 h5 h6 li dt dd td th tr tbody thead tfoot blockquote pre figcaption hgroup".split())
_PAGE = set("html body article main".split())
_NEVER_TEXT = _RAW | set(
    "head nav footer aside form button select option input dialog menu template svg math canvas object audio video "
    "applet map".split()
)
_NAMES = set(
    "ad ads adsense advert adverts advertisement advertising sponsor sponsored promo promotion nav navbar navigation menu "
    "sidebar footer header masthead breadcrumb breadcrumbs cookie cookies consent gdpr notice notices popup modal newsletter "
    "subscribe subscription share sharing social related recommended comment comments disqus respond replies "
    "pagination pager toolbar widget banner".split()
)
#: What a container of page parts may be called besides.
_FRAMES = set(
    "area bar block bottom box btn button buttons container content form group inner item items left link links list main "
    "module outer page panel placeholder right row section site slot small top unit wrap wrapper".split()
)
_ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
#: What a start tag ends, with the elements that this does not reach across.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}

_TAG = re.compile(
    r"<!--(?:.*?-->|.*)|<(/?)([a-zA-Z][^\s/>]*)((?>[^>=]+|=\s*\"[^\"]*\"|=\s*'[^']*'|=)*+)>?|<[!?/][^>]*>?", re.DOTALL
)
_NAMED = re.compile(r"""(?:^|\s|["'])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.IGNORECASE)
_PARTS = re.compile(r"[A-Za-z]+")
#: Ancestors of a block whose subtrees are looked at, and the part of a page's text that makes articles its main text.
_DEEP, _SMALL = 256, 4


class _Element:
    __slots__ = ("tag", "dropped", "inside", "parts", "counted", "parent", "digest")

    def __init__(self, tag: str, dropped: bool, inside: str, counted: bool, parent: _Element | None):
        self.tag, self.dropped, self.inside, self.counted, self.parent = tag, dropped, inside, counted, parent
        self.parts: list[str] = [tag]
        self.digest = 0


class PageReader:
    """The blocks of one page, and the hashes of its element subtrees.

    A block is a text and the subtrees that count it lies in, the innermost ``_DEEP`` of them. Elements that never hold main text are left out
    by tag, role or name; their subtrees are hashed all the same. Paragraphs and other running text of an article are
    never taken for a template, only the containers around them are.
    """

    def __init__(self, page: str):
        self.blocks: list[tuple[str, _Element]] = []
        self.hashes: set[int] = set()
        self.buffer: list[str] = []
        self.stack = [_Element("", False, "", False, None)]
        self.open: Counter[str] = Counter()
        self._read(page)
        while len(self.stack) > 1:
            self._close()
        self._flush()

    def _read(self, page: str) -> None:
        at, end = 0, len(page)
        while at < end:
            match = _TAG.search(page, at)
            if not match:
                self._text(page[at:])
                return
            if match.start() > at:
                self._text(page[at : match.start()])
            at = match.end()
            tag = match[2]
            if tag is None:
                continue
            tag = tag.lower()
            if match[1]:
                self._end(tag)
                continue
            self._start(tag, match[3])
            if tag in _RAW:
                close = re.compile(rf"</{tag}(?=[\s/>]|$)", re.IGNORECASE).search(page, at)
                stop = close.start() if close else end
                self._text(page[at:stop])
                at = stop

    def _text(self, text: str) -> None:
        top = self.stack[-1]
        top.parts.append(text)
        if not top.dropped:
            self.buffer.append(html.unescape(text) if "&" in text else text)

    def _start(self, tag: str, attributes: str) -> None:
        if tag not in _INLINE:
            self._end_implied(tag)
            self._flush()
        elif tag in ("br", "wbr", "img"):
            if tag == "br" and not self.stack[-1].dropped:
                self.buffer.append(" ")
            self.stack[-1].parts.append(tag)
            return
        if tag in _VOID:
            self.stack[-1].parts.append(tag)
            return
        parent = self.stack[-1]
        inside = parent.inside
        if tag in ("article", "main") and inside != "article":
            inside = tag
        dropped = parent.dropped or self._never_text(tag, attributes, inside)
        counted = (dropped or tag not in _PAGE) and not parent.dropped and (
            dropped or tag not in (_FLOW if inside else _INLINE)
        )
        self.stack.append(_Element(tag, dropped, inside, counted, parent))
        self.open[tag] += 1

    def _never_text(self, tag: str, attributes: str, inside: str) -> bool:
        if tag in _NEVER_TEXT or tag == "header" and not inside:
            return True
        if not attributes or tag in ("html", "body", "main"):
            return False
        for match in _NAMED.finditer(attributes):
            value = match[2] or match[3] or match[4] or ""
            if match[1].lower() == "role":
                if value.strip().lower() in _ROLES:
                    return True
                continue
            for name in value.split():
                parts = {part.lower() for part in _PARTS.findall(name)}
                named = parts & _NAMES
                if inside:
                    # Within an article the whole name must say so: its story-widget is a part of it, its ad-slot is not.
                    # A title's frame is no page header there.
                    if not parts <= _NAMES | _FRAMES or named <= {"header", "banner"}:
                        continue
                if tag == "article":
                    named &= {"comment", "comments", "ad", "ads"}
                if named:
                    return True
        return False

    def _end_implied(self, tag: str) -> None:
        closes, fence = _ENDS.get(tag, (set(), set()))
        depth = len(self.stack) - 1
        while depth > 0 and (self.open["p"] or any(self.open[other] for other in closes)):
            open_tag = self.stack[depth].tag
            if open_tag == "p" or open_tag in closes:
                while len(self.stack) > depth:
                    self._close()
                if open_tag != "p":
                    return
            elif open_tag in fence or open_tag not in _INLINE and open_tag not in closes and not closes:
                return
            depth -= 1

    def _end(self, tag: str) -> None:
        if not self.open[tag]:  # a stray end tag
            return
        for depth in range(len(self.stack) - 1, 0, -1):
            open_tag = self.stack[depth].tag
            if open_tag == tag:
                if tag not in _INLINE:
                    self._flush()
                while len(self.stack) > depth:
                    self._close()
                return
            if tag in _INLINE and open_tag not in _INLINE or open_tag in _PAGE and tag not in _PAGE:
                return
            if tag == "p" and open_tag not in _INLINE:
                return

    def _close(self) -> None:
        element = self.stack[-1]
        if element.tag not in _INLINE:
            self._flush()
        self.stack.pop()
        self.open[element.tag] -= 1
        digest = xxhash.xxh64_intdigest("\x1f".join(element.parts).encode("utf-8", "replace"), 0)
        self.stack[-1].parts.append(format(digest, "x"))
        element.parts = []
        if element.counted:
            element.digest = digest - ((digest >> 63) << 64)
            self.hashes.add(element.digest)

    def _flush(self) -> None:
        if self.buffer:
            text = " ".join("".join(self.buffer).split())
            self.buffer.clear()
            if text:
                self.blocks.append((text, self.stack[-1]))

    def main(self) -> list[tuple[str, list[int]]]:
        """The blocks of all articles, unless they hold a small part of the text only, like cards that lead to other
        pages; else those of the main element; without one, all. Each with the hashes of its subtrees."""
        for inside in ("article", "main"):
            found = [(text, element) for text, element in self.blocks if element.inside == inside]
            if _SMALL * sum(len(text) for text, _ in found) >= sum(len(text) for text, _ in self.blocks) and found:
                break
        else:
            found = self.blocks
        return [(text, self._within(element)) for text, element in found]

    @staticmethod
    def _within(element: _Element | None) -> list[int]:
        hashes = []
        for _ in range(_DEEP):
            if element is None:
                break
            if element.counted:
                hashes.append(element.digest)
            element = element.parent
        return hashes


def main_texts(
    df: DataFrame,
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
    many: int = 10,
) -> DataFrame:
    """One row per row of ``df``: id, url, text (blocks joined by an empty line) and n_chars.

    Every page is read once: its blocks of text, and the hash of each element subtree. Spark counts for every host on how
    many pages with different main text a subtree occurs; what occurs on ``many`` or more is the site's template and deleted, with
    all text in it. Pages with the same text, mirrored under many addresses, count once, so an article is not
    taken for a template because it was copied. A host may have any number of pages: the counts are spread over the
    hashes and combined before the shuffle, and text moves only from pages that keep blocks in countable subtrees.

    Parts with usual names and roles (navigation, adverts, comments and so on) are left out by these; inside an article
    only where the whole name of a class says so.

    Null and empty html give an empty text. A null or odd url belongs to the host ``''``. Rows that repeat
    an id are read each for itself, and repeated rows count as one page. A page is read in time that grows with its
    length, however deep its elements lie. An empty table gives an empty one; other columns are not touched.
    """
    check_columns(df, id_column, url_column, html_column)
    kind = df.schema[id_column].dataType.simpleString()

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, place = TaskContext.get().partitionId(), 0
        for batch in batches:
            rows = []
            for page in batch["html"]:
                reader = PageReader(page)
                blocks = reader.main()
                texts = [text for text, _ in blocks]
                signature = xxhash.xxh64_intdigest("\n".join(texts).encode("utf-8", "replace"), 1) >> 1
                within = [hashes for _, hashes in blocks]
                rows.append((part, place, texts, within, sorted(reader.hashes), signature))
                place += 1
            found = pd.DataFrame(
                rows, columns=["part", "place", "texts", "within", "hashes", "signature"], index=batch.index
            )
            yield pd.concat([batch[["id", "url", "host"]], found], axis=1)

    host = F.lower(F.regexp_extract(text_or_empty(url_column), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1))
    source = df.select(
        F.col(id_column).alias("id"), F.col(url_column).alias("url"), host.alias("host"), text_or_empty(html_column).alias("html")
    )
    pages = staged(
        source.mapInPandas(
            read,
            f"id {kind}, url string, host string, part int, place long, texts array<string>, "
            "within array<array<long>>, hashes array<long>, signature long",
        ),
        "pages",
    )
    subtrees = pages.select("host", "signature", F.explode("hashes").alias("hash")).distinct()
    counted = subtrees.groupBy("host", "hash").agg(F.count("*").alias("n"))
    templates = staged(counted.where(F.col("n") >= many).select("host", "hash"), "templates")
    framed = F.exists("within", lambda hashes: F.size(hashes) > 0)
    plain = pages.where(~framed).select("id", "url", "texts")
    rest = pages.where(framed)
    hits = (
        rest.select("part", "place", "host", F.explode(F.array_distinct(F.flatten("within"))).alias("hash"))
        .join(templates, ["host", "hash"])
        .groupBy("part", "place")
        .agg(F.collect_set("hash").alias("deleted"))
    )
    cleaned = rest.join(hits, ["part", "place"], "left").withColumn(
        "deleted", F.coalesce("deleted", F.array().cast("array<long>"))
    )
    left = F.filter(
        F.arrays_zip("texts", "within"), lambda block: ~F.arrays_overlap(block["within"], F.col("deleted"))
    )
    rows = plain.unionByName(cleaned.select("id", "url", left["texts"].alias("texts")))
    text = F.array_join("texts", "\n\n")
    return rows.select(F.col("id").alias(id_column), F.col("url").alias(url_column), text.alias("text")).withColumn(
        "n_chars", F.char_length("text").cast("long")
    )
