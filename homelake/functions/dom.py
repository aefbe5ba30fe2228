"""Elements of a stored page, read in one pass and found by ranges.

Elements are numbered as they begin, so the descendants of an element are the numbers after its own
up to its last one, and a search inside it is a range of the numbers of a tag. End tags that HTML
lets a page leave out are supplied as a browser does: a new ``li``, ``p``, ``td``, ``option`` and so
on ends the open one, as long as no list, table or section has begun in between. An end tag that
ends nothing is passed over. Time grows with the page's length, whatever is left open in it.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from urllib.parse import urljoin

_ATTRIBUTES = r"[^>\"']*+(?:(?:\"[^\"]*+\"|'[^']*+')[^>\"']*+)*+"
_HELD = "iframe|noembed|noframes|script|style|textarea|title"
# The beginning of a name that is not that of an element with held content.
_NAMED = r"(?:[a-hj-mo-ru-zA-HJ-MO-RU-Z]|[sS][abd-su-zABD-SU-Z])[^\s/>]*+"
# Tags, the usual ones first and told without looking at letters' case; comments and declarations; elements whose
# content is no markup, with it.
_TAGS = (
    rf"<(?:/[A-Za-z][^\s/>\"']*+>|{_NAMED}{_ATTRIBUTES}>|/(?i:[A-Za-z])[^\s/>]*+{_ATTRIBUTES}>"
    rf"|(?!(?i:{_HELD})[\s/>])(?i:[A-Za-z])[^\s/>]*+{_ATTRIBUTES}>|!--.*?(?:-->|\Z)|[!?][^>]*+>"
    rf"|(?i:({_HELD})(?=[\s/>]){_ATTRIBUTES}>.*?(?:</\2\s*>|\Z)))"
)
_TOKEN, _RUN = re.compile(f"({_TAGS})", re.S), re.compile(f"((?:{_TAGS})++)", re.S)
_USUAL = re.compile(rf"<(/?)({_NAMED})")
# Parts of a token: of an element with its content, and of a tag.
_PARTS = re.compile(
    rf"<({_HELD})(?=[\s/>])({_ATTRIBUTES})>(.*?)(?:</\1\s*>|\Z)|<(/?)([A-Za-z][^\s/>]*+)({_ATTRIBUTES})>", re.S | re.I
)
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'=<>`]+)))?")

# Fixed values, from the HTML standard: elements without an end tag; those whose content is text, while
# that of the others without markup is not shown.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_PLAIN = frozenset("textarea title".split())
# Start tags that end an open p; elements that an end tag or a start tag does not reach through.
_ENDS_P = frozenset(
    "address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre search section summary table ul".split()
)
_SCOPE = frozenset("applet caption html marquee object table td template th".split())
_SECTIONS = frozenset(
    "article aside blockquote body button center details dialog dir dl fieldset figcaption figure footer form h1 h2 h3"
    " h4 h5 h6 header hgroup html main menu nav ol pre search section select summary table tbody td template tfoot th"
    " thead tr ul".split()
)
_BLOCK = _ENDS_P | _SECTIONS | _SCOPE | {"p"}
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Which open elements a start tag ends, and the elements it does not look beyond.
_ENDING = {
    "li": (("li",), _SECTIONS),
    "dt": (("dt", "dd"), _SECTIONS),
    "dd": (("dt", "dd"), _SECTIONS),
    "tr": (("td", "th", "tr"), frozenset(["table"])),
    "td": (("td", "th"), frozenset(["table"])),
    "th": (("td", "th"), frozenset(["table"])),
    "tbody": (("td", "th", "tr", "caption", "colgroup", "thead", "tbody", "tfoot"), frozenset(["table"])),
    "thead": (("td", "th", "tr", "caption", "colgroup", "thead", "tbody", "tfoot"), frozenset(["table"])),
    "tfoot": (("td", "th", "tr", "caption", "colgroup", "thead", "tbody", "tfoot"), frozenset(["table"])),
    "option": (("option",), frozenset(["select", "datalist"])),
    "optgroup": (("option", "optgroup"), frozenset(["select"])),
    "a": (("a",), _SCOPE | _SECTIONS),
    "button": (("button",), _SCOPE),
}
_TABLE_PARTS = frozenset("tbody td tfoot th thead tr".split())
_HEAD = frozenset("base link meta noscript script style template title".split())


# Pages of a site repeat their tags: what they mean is kept by how they are written, up to this length and number.
_LONG, _MOST = 256, 10_000


def _keep(known: dict, written, found):
    if len(known) >= _MOST:
        known.clear()
    known[written] = found
    return found


def _kind(tag: str) -> int:
    """1 for void, 2 for blocks, 4 for what bounds a scope, 8 for start tags that may end an open p, 16 for those
    that may end other elements."""
    ending = tag in _ENDING or tag in _HEADINGS
    return (tag in _VOID) + 2 * (tag in _BLOCK) + 4 * (tag in _SCOPE) + 8 * (tag in _ENDS_P) + 16 * ending


# (tag, kind, slash, attributes as written, content) of tokens; the tag is None for what is no element.
_TOKENS: dict[str, tuple] = {}


def _read_token(token: str) -> tuple:
    if token[1] in "!?":
        return (None, 0, "", "", None)
    usual = _USUAL.match(token)
    if usual is not None:
        slash, tag = usual.groups()
        tag = tag.lower()
        return (tag, _kind(tag), slash, token[usual.end() : -1], None)
    held, held_raw, content, slash, tag, raw = _PARTS.match(token).groups()
    if held is not None:
        slash, tag, raw = "", held, held_raw
    tag = tag.lower()
    return (tag, _kind(tag), slash, raw, content)


def _token(token: str) -> tuple:
    found = _read_token(token)
    return _keep(_TOKENS, token, found) if len(token) <= _LONG else found


# Attributes by how they are written, and whether those match, for each pair of classes and exact class.
_READ: dict[str, dict[str, str]] = {}
_MATCHING: dict[tuple, dict[str, bool]] = {}


def attributes(raw: str) -> dict[str, str]:
    """By lower-case name; of repeated names the first counts. Not to be changed: pages share them."""
    found = _READ.get(raw)
    if found is None:
        found = {}
        for name, double, single, bare in _ATTRIBUTE.findall(raw):
            value = double or single or bare
            found.setdefault(name.lower(), html.unescape(value) if "&" in value else value)
        if len(raw) <= _LONG:
            _keep(_READ, raw, found)
    return found


def matches(raw: str, classes: tuple[str, ...], exact_class: str | None) -> bool:
    """Whether attributes as written have these classes."""
    if "&" not in raw:
        # Most elements are told by their tag as written, without reading its attributes.
        if exact_class is not None and exact_class not in raw:
            return False
        for name in classes:
            if name not in raw:
                return False
    own = attributes(raw).get("class", "")
    if exact_class is not None and own != exact_class:
        return False
    return not classes or set(classes) <= set(own.split())


class Page:
    """Elements by number, to any depth, and the texts between tags.

    For each element: ``tags``, ``parents`` (-1 outside of all), ``lasts`` (number of the last element
    in it), and ``starts`` and ``ends`` in ``texts``. ``text_parents`` has the element of each text.
    """

    def __init__(self, source: str):
        self.tags: list[str] = []
        self.parents: list[int] = []
        self.lasts: list[int] = []
        self.starts: list[int] = []
        self.ends: list[int] = []
        self.texts: list[str] = []
        self.text_parents: list[int] = []
        self._raw: list[str] = []
        self._numbers: dict[str, list[int]] = {}
        self._read(source)
        del self._stack, self._places, self._blocks, self._scopes

    def _read(self, source: str) -> None:
        # What is open: numbers, the places of each tag among them, those of blocks and of scopes.
        self._stack, self._places, self._blocks, self._scopes = stack, places, blocks, scopes = [], {}, [], []
        tags, parents, lasts, starts, ends, raws = self.tags, self.parents, self.lasts, self.starts, self.ends, self._raw
        texts, text_parents, numbers = self.texts, self.text_parents, self._numbers
        last = source.rfind(">") + 1
        parts = _TOKEN.split(source[:last])
        rest = parts.pop() + source[last:]
        known = _TOKENS.get
        for text, token, _ in zip(*[iter(parts)] * 3, strict=True):
            if text:
                texts.append(text)
                text_parents.append(stack[-1] if stack else -1)
            tag, kind, slash, raw, content = known(token) or _token(token)
            if tag is None:
                continue
            if slash:
                if stack and tags[stack[-1]] == tag:
                    # The end of the innermost element: the usual case.
                    number = stack.pop()
                    ends[number], lasts[number] = len(texts), len(tags) - 1
                    own = places[tag]
                    own.pop()
                    if not own:
                        del places[tag]
                    if kind & 2:
                        blocks.pop()
                        if kind & 4:
                            scopes.pop()
                else:
                    self._end_tag(tag)
                continue
            if kind & 16 or (kind & 8 and "p" in places) or "head" in places:
                self._start_tag(tag)
            number = len(tags)
            tags.append(tag)
            parents.append(stack[-1] if stack else -1)
            starts.append(len(texts))
            raws.append(raw)
            if tag in numbers:
                numbers[tag].append(number)
            else:
                numbers[tag] = [number]
            if kind & 1 or content is not None:
                if content and tag in _PLAIN:
                    texts.append(content)
                    text_parents.append(number)
                lasts.append(number)
                ends.append(len(texts))
                continue
            lasts.append(-1)
            ends.append(-1)
            place = len(stack)
            if tag in places:
                places[tag].append(place)
            else:
                places[tag] = [place]
            stack.append(number)
            if kind & 2:
                blocks.append(place)
                if kind & 4:
                    scopes.append(place)
        if rest:
            texts.append(rest)
            text_parents.append(stack[-1] if stack else -1)
        self._close(0)

    def _close(self, place: int) -> None:
        """End the open elements from ``place`` on."""
        stack, places, tags = self._stack, self._places, self.tags
        text, last = len(self.texts), len(tags) - 1
        while len(stack) > place:
            number = stack.pop()
            self.ends[number], self.lasts[number] = text, last
            tag = tags[number]
            own = places[tag]
            own.pop()
            if not own:
                del places[tag]
            if tag in _BLOCK:
                self._blocks.pop()
                if tag in _SCOPE:
                    self._scopes.pop()

    def _innermost(self, wanted) -> int:
        """Place of the innermost open element of these tags; -1 without one."""
        places = self._places
        return max((places[t][-1] for t in wanted if t in places), default=-1)

    def _start_tag(self, tag: str) -> None:
        """End what this start tag ends."""
        places = self._places
        if "head" in places and tag not in _HEAD:
            self._close(places["head"][-1])
        if tag in _ENDING:
            ended, bounds = _ENDING[tag]
            if any(t in places for t in ended):
                # The elements to end that lie within the innermost bound.
                bound = self._innermost(bounds)
                inside = [places[t][bisect_right(places[t], bound)] for t in ended if t in places and places[t][-1] > bound]
                if inside:
                    self._close(min(inside) if tag in _TABLE_PARTS else max(inside))
        if tag in _ENDS_P and "p" in places:
            p = places["p"][-1]
            if p > max(self._scopes[-1] if self._scopes else -1, self._innermost(("button",))):
                self._close(p)
        if tag in _HEADINGS and self._stack and self.tags[self._stack[-1]] in _HEADINGS:
            self._close(len(self._stack) - 1)

    def _end_tag(self, tag: str) -> None:
        """End the innermost open element of this tag and all in it, if the end tag reaches it."""
        places = self._places
        if tag in _HEADINGS:
            place = self._innermost(_HEADINGS)
        else:
            place = places[tag][-1] if tag in places else -1
        if place < 0:
            return
        if place + 1 == len(self._stack):
            bound = -1
        elif tag in _TABLE_PARTS:
            bound = self._innermost(("table",))
        elif tag in ("table", "body", "html"):
            bound = -1
        elif tag in _BLOCK:
            bound = self._scopes[-1] if self._scopes else -1
            if tag == "li":
                bound = max(bound, self._innermost(("ol", "ul")))
        else:
            bound = self._blocks[-1] if self._blocks else -1
        if bound <= place:
            self._close(place)

    def attributes(self, number: int) -> dict[str, str]:
        """By lower-case name; of repeated names the first counts. Not to be changed: pages share them."""
        return attributes(self._raw[number])

    def classes(self, number: int) -> list[str]:
        return self.attributes(number).get("class", "").split()

    def find_all(self, tag: str, classes: tuple[str, ...] = (), exact_class: str | None = None, inside: int | None = None):
        """Matching elements in order; with ``inside`` only descendants of that element."""
        at = self._next(tag, classes, exact_class, inside, 0)
        while at is not None:
            yield self._numbers[tag][at]
            at = self._next(tag, classes, exact_class, inside, at + 1)

    def first(self, tag: str, classes: tuple[str, ...] = (), exact_class: str | None = None, inside: int | None = None) -> int | None:
        """The first of ``find_all``; None without one."""
        at = self._next(tag, classes, exact_class, inside, 0)
        return None if at is None else self._numbers[tag][at]

    def _next(self, tag, classes, exact_class, inside, at: int) -> int | None:
        """Index among the elements of ``tag`` of the next match from ``at`` on."""
        numbers = self._numbers.get(tag)
        if numbers is None:
            return None
        end = len(numbers)
        if inside is not None:
            at = max(at, bisect_right(numbers, inside))
            end = bisect_right(numbers, self.lasts[inside], at) if at < end else end
        if exact_class is None and not classes:
            return at if at < end else None
        known = _MATCHING.get((classes, exact_class))
        if known is None:
            known = _keep(_MATCHING, (classes, exact_class), {})
        raws = self._raw
        while at < end:
            raw = raws[numbers[at]]
            hit = known.get(raw)
            if hit is None:
                hit = matches(raw, classes, exact_class)
                if len(raw) <= _LONG:
                    _keep(known, raw, hit)
            if hit:
                return at
            at += 1
        return None

    def text(self, number: int | None) -> str | None:
        """All text in an element, character references decoded."""
        if number is None:
            return None
        text = "".join(self.texts[self.starts[number] : self.ends[number]])
        return html.unescape(text) if "&" in text else text


def absolute(page_url: str | None, href: str) -> str | None:
    """The address that a browser would open."""
    try:
        return urljoin(page_url or "", href.strip())
    except ValueError:
        return None


#: Open elements of a page whose runs are kept; deeper ones are read by ``Page``. So are pages while their tags stand in
#: places that were not met before: so many are worked out at first, so many more with each page, and when they
#: are used up, ``_AGAIN`` after ``_REST`` pages.
_DEEPEST = 100
_FIRST, _MORE, _AGAIN, _REST = 2000, 4, 100, 100


class _Path(Page):
    """The open elements alone."""

    def __init__(self, tags: list[str]):
        self.tags, self.texts = tags, []
        self.lasts, self.ends = [-1] * len(tags), [-1] * len(tags)
        self._stack, self._places = list(range(len(tags))), {}
        self._blocks = [place for place, tag in enumerate(tags) if tag in _BLOCK]
        self._scopes = [place for place, tag in enumerate(tags) if tag in _SCOPE]
        for place, tag in enumerate(tags):
            self._places.setdefault(tag, []).append(place)

    def left(self, tag: str, slash: str) -> int:
        """How many of them a tag leaves open."""
        (self._end_tag if slash else self._start_tag)(tag)
        return len(self._stack)


class _Open:
    """The innermost open element and by ``outer`` all others; ``known`` has what tags and runs do here, as far as kept."""

    __slots__ = ("outer", "tag", "marks", "depth", "in_head", "in_p", "known")

    def __init__(self, outer: _Open | None = None, tag: str = "", marks: tuple[int, ...] = ()):
        self.outer, self.tag, self.marks, self.known = outer, tag, marks, {}
        if outer is None:
            self.depth, self.in_head, self.in_p = 0, False, False
        else:
            self.depth, self.in_head, self.in_p = outer.depth + 1, outer.in_head or tag == "head", outer.in_p or tag == "p"


class Marked:
    """The elements of a page that selectors (tag, classes, exact class) match, as ``Page`` finds them.

    For each of these elements: ``lasts`` (number of the last one in it), ``raws`` (attributes as written), and
    ``starts`` and ``ends`` in ``texts``; ``found`` has the numbers for each selector. They hold until the next ``read``.

    What a tag does depends on the elements open before it and on nothing else of the page, so it is worked out once
    and kept, and likewise what tags and comments in a row do, up to a length and number: pages of a site repeat
    their markup. Where none is repeated, each tag is looked up alone, or the page is read by ``Page``.
    """

    def __init__(self, selectors: tuple[tuple[str, tuple[str, ...], str | None], ...]):
        self._selectors = selectors
        self._wanted: dict[str, list[tuple]] = {}
        for i, (tag, classes, exact_class) in enumerate(selectors):
            # What the attributes have to have, as long as nothing in them is written as a reference.
            self._wanted.setdefault(tag, []).append((i, exact_class or "".join(classes[:1]), classes, exact_class))
        self._meanings: dict[str, tuple] = {}
        self._left = _FIRST
        self._forget()

    def _forget(self) -> None:
        self._root, self._kept = _Open(), 0

    def read(self, source: str) -> None:
        if self._left < 0:
            self._left = self._left + 1 or _AGAIN
            self._read_whole(source)
            return
        if self._left < _FIRST:
            self._left += _MORE
        if self._kept >= _MOST:
            self._forget()
        self.found = found = [[] for _ in self._selectors]
        self.lasts, self.raws, self.starts, self.ends, self.texts = lasts, raws, starts, ends, texts = [], [], [], [], []
        last = source.rfind(">") + 1
        parts = _RUN.split(source[:last])
        rest = parts.pop() + source[last:]
        here, still = self._root, []
        for text, run, _ in zip(*[iter(parts)] * 3, strict=True):
            if text and still:
                texts.append(text)
            done = here.known.get(run) or self._run(here, run)
            if done is None:
                self._read_whole(source)
                return
            here, changes = done
            for change in changes:
                if change is None:
                    number = still.pop()
                    lasts[number] = len(lasts) - 1
                    ends[number] = len(texts)
                elif change.__class__ is str:
                    texts.append(change)
                else:
                    marks, raw = change
                    number = len(lasts)
                    for i in marks:
                        found[i].append(number)
                    still.append(number)
                    raws.append(raw)
                    lasts.append(number)
                    starts.append(len(texts))
                    ends.append(-1)
        if rest and still:
            texts.append(rest)
        for number in still:
            lasts[number] = len(lasts) - 1
            ends[number] = len(texts)

    def _read_whole(self, source: str) -> None:
        page = Page(source)
        self.found = [list(page.find_all(*selector)) for selector in self._selectors]
        self.lasts, self.raws, self.starts, self.ends, self.texts = page.lasts, page._raw, page.starts, page.ends, page.texts

    def _run(self, here: _Open, run: str) -> tuple | None:
        """What is open after a run, and changes: None for the end of the innermost marked element, (marks,
        attributes) for the start of one, a text of it. None where the page is to be read by ``Page``."""
        before, changes, repeated = here, [], len(run) <= 2 * _LONG
        known = self._meanings.get
        for token in _TOKEN.split(run)[1::3]:
            meaning = known(token)
            if meaning is None:
                meaning, repeated = self._meaning(token), False
            step, raw, text, alone = meaning
            if step is None:
                continue
            done = here.known.get(step) or self._step(here, step, alone)
            if done is None:
                return None
            here, ended = done
            if ended:
                changes += [None] * ended
            marks = step[2]
            if marks:
                changes.append((marks, raw))
            if text:
                changes.append(text)
            if marks and alone:
                changes.append(None)
        found = (here, tuple(changes))
        if repeated:
            # All its tags were met before.
            before.known[run] = found
            self._kept += 1
        return found

    def _meaning(self, token: str) -> tuple:
        """(tag, slash, marks), None for what is no element; attributes and text in it; whether it needs no end tag."""
        tag, kind, slash, raw, content = _read_token(token)
        marks = ()
        if tag in self._wanted and not slash:
            written = "&" not in raw
            for i, part, classes, exact_class in self._wanted[tag]:
                if not (written and part not in raw) and matches(raw, classes, exact_class):
                    marks += (i,)
        step = None if tag is None else (tag, slash, marks)
        found = (step, raw, content if tag in _PLAIN else None, bool(kind & 1) or content is not None)
        return _keep(self._meanings, token, found) if len(token) <= _LONG else found

    def _step(self, here: _Open, step: tuple, alone: bool) -> tuple | None:
        """What is open after a tag, and how many marked elements it ends."""
        tag, slash, marks = step
        self._left -= 1
        if here.depth >= _DEEPEST:
            return None
        if self._left <= 0:
            self._left = -_REST
            return None
        kind = _kind(tag)
        at, ended = here, 0
        if slash and tag == here.tag:
            left = here.depth - 1
        elif slash or kind & 16 or (kind & 8 and here.in_p) or here.in_head:
            path = []
            while at.outer is not None:
                path.append(at.tag)
                at = at.outer
            left, at = _Path(path[::-1]).left(tag, slash), here
        else:
            left = here.depth
        while at.depth > left:
            ended += bool(at.marks)
            at = at.outer
        if not slash and not alone:
            inner = (tag, marks)
            at = at.known.get(inner) or at.known.setdefault(inner, _Open(at, tag, marks))
        here.known[step] = found = (at, ended)
        self._kept += 1
        return found
