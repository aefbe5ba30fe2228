"""Field extraction from stored pages.

A page is parsed once, in Arrow batches, for all fields asked of it; cleaning of texts stays column
expressions. Elements are found at any depth, with any quoting
of attributes, and all character references are decoded. Selectors are a tag plus class names.
"""

from __future__ import annotations

import html as references
from bisect import bisect_right
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .dom import Marked, Page, absolute, attributes
from .text import BROWSER_SPACE, _col, strip


@dataclass(frozen=True)
class Selector:
    tag: str
    classes: tuple[str, ...] = ()
    exact_class: str | None = None


_ICON = Selector("i")


@dataclass(frozen=True)
class Items:
    """Repeated blocks with a label and a value: the label is the text of ``title``, or without
    one the classes of the block's icons."""

    item: Selector
    value: Selector
    title: Selector | None = None


@dataclass(frozen=True)
class Choice:
    """The value of the first item whose label contains ``label`` and that has a value element.

    With ``skip_blank`` an item with a blank value is passed over; otherwise it ends the search.
    """

    items: Items
    label: str
    skip_blank: bool = False


#: Labels whose choices a process remembers: pages of a site repeat them.
_LABELS = 10_000


#: Sets of selectors whose pages a process remembers, and these pages' elements.
_READERS: dict[tuple, _Reader] = {}
_SETS = 16


class _Reader:
    """Elements of pages that any of some selectors match, told apart by the selectors' places."""

    def __init__(self, selectors: tuple[Selector, ...]):
        self.page = Marked(tuple((s.tag, s.classes, s.exact_class) for s in selectors))
        self.places = {s: i for i, s in enumerate(selectors)}

    def first(self, place: int, block: int | None = None) -> int | None:
        """The first element, with ``block`` the first inside that element; None without one."""
        page = self.page
        numbers = page.found[place]
        if block is None:
            return numbers[0] if numbers else None
        at = bisect_right(numbers, block)
        return numbers[at] if at < len(numbers) and numbers[at] <= page.lasts[block] else None

    def text(self, number: int | None) -> str | None:
        """All text in an element, character references decoded."""
        if number is None:
            return None
        page = self.page
        return _decoded("".join(page.texts[page.starts[number] : page.ends[number]]))

    def icons(self, place: int, block: int) -> str:
        """Classes of the icons in a block, each between spaces."""
        page = self.page
        numbers = page.found[place]
        inside = numbers[bisect_right(numbers, block) : bisect_right(numbers, page.lasts[block])]
        return " " + " ".join(c for e in inside for c in attributes(page.raws[e]).get("class", "").split()) + " "


def _reader(selectors: tuple[Selector, ...]) -> _Reader:
    known = _READERS.get(selectors)
    if known is None:
        if len(_READERS) >= _SETS:
            _READERS.clear()
        known = _READERS[selectors] = _Reader(selectors)
    return known


class _Blocks:
    """One kind of items on the pages of a reader."""

    def __init__(self, items: Items, reader: _Reader):
        self.reader, self.iconed = reader, items.title is None
        self.item, self.value, self.title = (reader.places[s] for s in (items.item, items.value, items.title or _ICON))

    def read(self, labels: list[str | None], values: list[str | None]) -> None:
        """Append the labels and values of a page's blocks."""
        reader = self.reader
        for block in reader.page.found[self.item]:
            labels.append(reader.icons(self.title, block) if self.iconed else reader.text(reader.first(self.title, block)))
            values.append(reader.text(reader.first(self.value, block)))


def _decoded(text: str) -> str:
    return references.unescape(text) if "&" in text else text


class _Chooser(_Blocks):
    """The choices among one kind of items, looked for while a page's items are read once."""

    def __init__(self, items: Items, choices: dict[str, Choice], reader: _Reader):
        super().__init__(items, reader)
        self.names = list(choices)
        self.wanted = [c.label.lower() for c in choices.values()]
        self.skip_blank = [c.skip_blank for c in choices.values()]
        self.known: dict[str, list[int]] = {}

    def _fitting(self, label: str) -> list[int]:
        """Choices that a label as written fits."""
        if len(self.known) >= _LABELS:
            self.known.clear()
        text = (label if self.iconed else _decoded(label)).lower()
        found = self.known[label] = [i for i, w in enumerate(self.wanted) if w in text]
        return found

    def choose(self, out: dict[str, list[str | None]]) -> None:
        """Append a page's choices."""
        page, iconed, known = self.reader.page, self.iconed, self.known.get
        values, titles = page.found[self.value], page.found[self.title]
        texts, starts, ends, lasts = page.texts, page.starts, page.ends, page.lasts
        found = [None] * len(self.wanted)
        for block in page.found[self.item]:
            last = lasts[block]
            at = bisect_right(values, block)
            if at == len(values) or values[at] > last:
                continue
            number = values[at]
            if iconed:
                label = self.reader.icons(self.title, block)
            else:
                at = bisect_right(titles, block)
                if at == len(titles) or titles[at] > last:
                    continue
                at = titles[at]
                label = "".join(texts[starts[at] : ends[at]])
            fitting = known(label)
            for i in self._fitting(label) if fitting is None else fitting:
                if found[i] is None:
                    value = _decoded("".join(texts[starts[number] : ends[number]]))
                    if not (self.skip_blank[i] and not value.strip(BROWSER_SPACE)):
                        found[i] = value
        for name, value in zip(self.names, found, strict=True):
            out[name].append(value)


def element(tag: str, *classes: str, exact_class: str | None = None) -> Selector:
    return Selector(tag, classes, exact_class)


def fields(
    html: Column | str, texts: dict[str, Selector] = {}, items: dict[str, Items] = {}, choices: dict[str, Choice] = {}
) -> Column:
    """One struct for a page: the text of each first element, each list of labelled items, and each
    choice among such items, which are read once for all choices among them.

    Null for a null page. Texts are as written, with the space around them; null where there is
    no such element.
    """
    lists = [*items.values(), *(c.items for c in choices.values())]
    selectors = tuple(dict.fromkeys([*texts.values(), *(s for x in lists for s in (x.item, x.value, x.title or _ICON))]))
    kinds = [f"`{n}` string" for n in [*texts, *choices]] + [f"`{n}` array<struct<label:string,value:string>>" for n in items]

    @F.arrow_udf("struct<" + ", ".join(k.replace("` ", "`:", 1) for k in kinds) + ">")
    def read(pages: pa.Array) -> pa.Array:
        heads = {n: [] for n in [*texts, *choices]}
        reader = _reader(selectors)
        firsts = [(heads[n].append, reader.places[selector]) for n, selector in texts.items()]
        kinds_of = dict.fromkeys(c.items for c in choices.values())
        choosers = [_Chooser(x, {n: c for n, c in choices.items() if c.items == x}, reader) for x in kinds_of]
        lists = {n: _Blocks(item, reader) for n, item in items.items()}
        labels, values = {n: [] for n in items}, {n: [] for n in items}
        ends = {n: [0] for n in items}
        for source in pages:
            reader.page.read(source.as_py() or "")
            for append, place in firsts:
                append(reader.text(reader.first(place)))
            for chooser in choosers:
                chooser.choose(heads)
            for n, blocks in lists.items():
                blocks.read(labels[n], values[n])
                ends[n].append(len(labels[n]))
        columns = [pa.array(heads[n], pa.string()) for n in heads]
        for n in items:
            pairs = pa.StructArray.from_arrays([pa.array(x[n], pa.string()) for x in (labels, values)], ["label", "value"])
            columns.append(pa.ListArray.from_arrays(pa.array(ends[n], pa.int32()), pairs))
        return pa.StructArray.from_arrays(columns, [*heads, *items])

    return read(_col(html))


def trimmed(text: Column | str) -> Column:
    return strip(_col(text), BROWSER_SPACE)


def first_text(html: Column | str, selector: Selector) -> Column:
    """Text of the first such element; null without one."""
    return trimmed(fields(html, {"text": selector})["text"])


def text_or_null(text: Column | str) -> Column:
    """Trimmed, and null for an element without text."""
    return F.nullif(trimmed(text), F.lit(""))


def value_text(items: Column | str, label: str, skip_blank: bool = False) -> Column:
    """Value of the first item whose label contains ``label`` and that has a value element.

    With ``skip_blank`` an item with a blank value is passed over; otherwise it ends the search.
    """
    wanted = label.lower()

    def usable(item: Column) -> Column:
        ok = F.contains(F.lower(item["label"]), F.lit(wanted)) & item["value"].isNotNull()
        return ok & (trimmed(item["value"]) != "") if skip_blank else ok

    return trimmed(F.get(F.filter(_col(items), usable), F.lit(0))["value"])


def or_default(text: Column | str, default: str | None) -> Column:
    """The default for text that is null or empty. Apply it to a column, not to an extraction:
    a null check may evaluate its argument twice."""
    return F.coalesce(F.when(_col(text) != "", _col(text)), F.lit(default).cast("string"))


def value_of(items: Column | str, label: str, default: str | None = "", skip_blank: bool = False) -> Column:
    return or_default(value_text(items, label, skip_blank), default)


def links(html: Column | str, page_url: Column | str, link_class: str | None = None) -> Column:
    """Addresses of a page's links in order, repeats kept, relative ones made absolute."""
    classes = (link_class,) if link_class else ()

    @F.arrow_udf("array<string>")
    def read(pages: pa.Array, urls: pa.Array) -> pa.Array:
        out = []
        for source, url in zip(pages, urls, strict=True):
            page = Page(source.as_py() or "")
            anchors = (page.attributes(a).get("href", "") for a in page.find_all("a", classes))
            out.append([absolute(url.as_py(), href) for href in anchors if href])
        return pa.array(out, pa.list_(pa.string()))

    return read(_col(html), _col(page_url))
