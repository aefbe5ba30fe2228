"""Main text of web pages by removing what a site repeats (operator 13).

Every element of a page is hashed with all that is in it (its tag, its texts, its parts). Spark counts
on how many different pages of a host each hash occurs; a subtree that recurs on many pages of its host
is the site's template and goes. A template that varies is not found so; therefore what HTML itself
marks as no article goes too: elements for menus, headers, footers, side columns, forms and scripts,
and those whose role, class or id names one of them, adverts, notices or reader comments. If a page
marks its article (``article``, else ``main``, role or ``itemprop``), only what is in there counts, and
there a recurring paragraph, heading or other plain text block stays: articles quote the same
passages, and copies of an article are on many pages.

A subtree recurs if at least ``MIN_PAGES`` pages of the host have it, with different contents, and at
least ``SHARE`` of the host's pages; ``PLAIN_SHARE`` if it is a plain text block of a page that marks no
article.

Text: character references are decoded; white space inside a block is one space, line breaks too;
blocks are joined in page order by a line feed, without empty ones.

Defined results: null and empty html give an empty text of 0 characters; a null or odd url belongs to
the host "" ; equal pages of a host are one page in the counts; repeated rows and ids are rows each;
pages of any length or depth are read whole; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dom import Page
from .shared import column, stored

MIN_PAGES = 4
SHARE = 0.005
PLAIN_SHARE = 0.2

# Elements that begin and end a block, those that hold plain text of an article, and
# those that are never part of one.
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer"
    " form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section"
    " summary table tbody td tfoot th thead tr ul".split()
)
_PLAIN = frozenset("b blockquote br code dd dt em h1 h2 h3 h4 h5 h6 hr i img li p pre span strong td th tr u".split())
_NEVER = frozenset(
    "applet aside audio button canvas datalist dialog embed footer form frame head iframe input label map menu meter nav"
    " noembed noframes noscript object optgroup option progress script search select style svg template textarea title video".split()
)
_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog directory form menu menubar navigation search status"
    " tablist toolbar tooltip".split()
)
# Words of class and id names that tell what an element is.
_NAMES = frozenset(
    "ad ads adsense advert adverts advertisement advertising advertorial announcement backlinks banner breadcrumb breadcrumbs"
    " captcha comment comments commentlist consent cookie cookies copyright dialog disclaimer discussion disqus"
    " donate dropdown footer gdpr hidden login masthead menu menubar modal nav navbar navigation navigator newsletter notice"
    " notices notification notifications outbrain overlay pager pagination paywall popover popup privacy promo promoted"
    " promotion promotions recommendations recommended related replies reply respond rss search share"
    " sharing sidebar signin signup skip skiplink skyscraper social sponsor sponsored sponsors subscribe subscription"
    " taboola tagcloud toolbar topbar widget widgets".split()
)
_NAME = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
_WITHOUT = frozenset("has no with without".split())
_SITE = frozenset("global site top".split())


def _names_template(name: str) -> bool:
    """If a class or id names a part of the site, as a whole or by one of its words."""
    if name.lower() in _NAMES:
        return True
    words = [w.lower() for w in _NAME.findall(name)]
    if any(w in _WITHOUT for w in words):
        return False
    return any(w in _NAMES or w == "header" and _SITE.intersection(words) for w in words) or words[:2] == ["side", "bar"]


def _is_template(page: Page, number: int) -> bool:
    """If the element's attributes say that it is no part of an article."""
    own = page.attributes(number)
    if not own:
        return False
    if own.get("role", "").strip().lower() in _ROLES or "hidden" in own or own.get("aria-hidden", "").strip().lower() == "true":
        return True
    if "display:none" in own.get("style", "").replace(" ", "").lower():
        return True
    if any(_names_template(n) for n in (*own.get("class", "").split(), *own.get("id", "").split())):
        # What holds the page's heading or main part is only named after something in it.
        return page.first("h1", inside=number) is None and page.first("main", inside=number) is None
    return False


def _marks(page: Page, number: int) -> str | None:
    """Which mark of an article an element has."""
    tag = page.tags[number]
    if tag in ("article", "main"):
        return tag
    own = page.attributes(number)
    if own.get("itemprop", "").lower() == "articlebody" or own.get("role", "").strip().lower() == "article":
        return "article"
    return "main" if own.get("role", "").strip().lower() == "main" else None


class Subtrees:
    """A page's elements: which of them are no part of an article, and which are in it."""

    def __init__(self, html: str | None):
        self.page = page = Page(html or "")
        n = len(page.tags)
        self.gone = gone = [False] * n
        marks: dict[int, str] = {}
        within = [False] * n  # an element that marks an article
        for i, tag in enumerate(page.tags):
            up = page.parents[i]
            within[i] = up >= 0 and within[up]
            if up >= 0 and gone[up]:
                gone[i] = True
            elif tag not in ("html", "body"):
                # The header of an article has its title; that of a page does not.
                gone[i] = tag in _NEVER or tag == "header" and not within[i] or _is_template(page, i)
                mark = None if gone[i] else _marks(page, i)
                if mark:
                    marks[i], within[i] = mark, True
        wanted = "article" if "article" in marks.values() else "main"
        self.articles = articles = {i for i, mark in marks.items() if mark == wanted}
        self.marked = bool(articles)
        self.inside = inside = [not articles] * n
        if articles:
            for i, up in enumerate(page.parents):
                inside[i] = i in articles or up >= 0 and inside[up]

    def hashes(self) -> dict[int, int]:
        """Hash of each subtree that has text and may be a template, by element; odd for plain text."""
        from xxhash import xxh3_64_intdigest

        page, gone = self.page, self.gone
        own: dict[int, list[bytes]] = {}
        for text, up in zip(page.texts, page.text_parents, strict=True):
            text = " ".join(text.split())
            if text and up >= 0:
                own.setdefault(up, []).append(text.encode("utf-8", "surrogatepass"))
        parts: dict[int, list[bytes]] = {}
        found = {}
        for i in range(len(page.tags) - 1, -1, -1):
            tag, up = page.tags[i], page.parents[i]
            if tag in ("html", "body", "script", "style") or i not in own and i not in parts:
                continue
            value = xxh3_64_intdigest(b"\0".join([tag.encode(), *own.get(i, ()), *parts.get(i, ())]))
            # What is no part of an article varies within others, and does not count there.
            if up >= 0 and gone[i] == gone[up]:
                parts.setdefault(up, []).append(value.to_bytes(8, "little"))
            plain = tag in _PLAIN
            # Parts of what is no part of an article go with it.
            if up >= 0 and gone[up] or i in self.articles or self.marked and self.inside[i] and not gone[i] and plain:
                continue
            value = value | 1 if plain and not gone[i] else value & ~1
            found[i] = value - (1 << 64) if value >> 63 else value
        return found

    def text(self, template: set[int]) -> str:
        """The text left without subtrees whose hash is in ``template``, block by block."""
        page, gone = self.page, self.gone
        if template:
            gone = gone.copy()
            for i, value in sorted(self.hashes().items()):
                if not gone[i] and value in template:
                    gone[i : page.lasts[i] + 1] = [True] * (page.lasts[i] + 1 - i)
        edges = set()  # places between texts where a block begins or ends
        spaces = set()
        for i, tag in enumerate(page.tags):
            if tag in _BLOCKS:
                edges.add(page.starts[i])
                edges.add(page.ends[i])
            elif tag == "br":
                spaces.add(page.starts[i])
        blocks, now = [], []
        for place, (text, up) in enumerate(zip(page.texts, page.text_parents, strict=True)):
            if place in edges:
                blocks.append("".join(now))
                now = []
            elif place in spaces:
                now.append(" ")
            if not self.marked if up < 0 else self.inside[up] and not gone[up]:
                now.append(references.unescape(text) if "&" in text else text)
        blocks.append("".join(now))
        return "\n".join(b for b in (" ".join(block.split()) for block in blocks) if b)


def host_of(url: Column) -> Column:
    """Lower-case host of an address, without a port; "" for one that has none."""
    found = F.regexp_extract(url, r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.coalesce(F.lower(found), F.lit(""))


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [np.unique(np.array(list(Subtrees(h.as_py()).hashes().values()), np.int64)) for h in batch.column(1)]
        ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
        lists = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(found) if found else [], pa.int64()))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), lists], ["host", "content", "hashes"])


def site_templates(
    pages: DataFrame, url: str = "url", html: str = "html", min_pages: int = MIN_PAGES, share: float = SHARE,
    plain_share: float = PLAIN_SHARE,
) -> DataFrame:
    """(host, template): the hashes of subtrees that recur on many pages of each host.

    A page's hashes are taken once for each distinct content of a host. At most the subtrees of a page
    divided by ``share`` can recur, whatever the number of pages of a host.
    """
    rows = pages.select(host_of(column(url)).alias("host"), column(html).alias("html"), F.md5(column(html)).alias("content"))
    every = rows.mapInArrow(_hashed, "host string, content string, hashes array<long>")
    every = stored(every.dropDuplicates(["host", "content"]).drop("content"), "subtrees")
    sizes = every.groupBy("host").agg(F.count("*").alias("n_pages"))
    counts = every.select("host", F.explode("hashes").alias("hash")).groupBy("host", "hash").agg(F.count("*").alias("n"))
    counts = stored(counts.where(F.col("n") >= min_pages), "recurring")
    least = F.when(F.col("hash").bitwiseAND(1) == 1, plain_share).otherwise(share)
    many = counts.join(sizes, "host").where(F.col("n") >= F.col("n_pages") * least)
    return stored(many.groupBy("host").agg(F.collect_list("hash").alias("template")), "templates")


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        *keep, content, template = batch.columns
        # Neighbouring rows often have the same host.
        last, known = None, set()
        found = []
        for html, hashes in zip(content, template, strict=True):
            if last is None or not hashes.equals(last):
                last, known = hashes, set(hashes.as_py() or ())
            found.append(Subtrees(html.as_py()).text(known))
        names = [*batch.schema.names[:-2], "text"]
        yield pa.RecordBatch.from_arrays([*keep, pa.array(found, pa.string())], names)


def main_texts(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
    min_pages: int = MIN_PAGES, share: float = SHARE, plain_share: float = PLAIN_SHARE,
) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    templates = site_templates(pages, url, html, min_pages, share, plain_share)
    rows = pages.select(
        column(page_id).alias("page_id"), column(url).alias("url"), host_of(column(url)).alias("own_host"), column(html).alias("html")
    )
    joined = rows.join(templates, F.col("own_host") == F.col("host"), "left").select("page_id", "url", "html", "template")
    kind = joined.schema["page_id"].dataType.simpleString()
    texts = joined.mapInArrow(_texts, f"page_id {kind}, url string, text string")
    return texts.withColumn("n_chars", F.length("text").cast("long"))
