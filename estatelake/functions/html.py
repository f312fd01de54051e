"""Selection of text and attributes from stored HTML pages.

``select_html`` is the only place where page markup crosses into Python: one
Arrow function reads each page once and returns every requested field. Pages
are tag soup (unclosed paragraphs, stray end tags), which rules out the JVM's
XML functions. Decoding and the embedded JSON stay in the JVM.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

# Elements without content, and elements whose content is not text.
VOID_TAGS = frozenset(
    "area base br col embed hr img input keygen link menuitem meta param source track wbr".split()
)
SILENT_TAGS = frozenset(("script", "style", "template"))
# Elements a description breaks its text at.
BREAKING_TAGS = frozenset(("a", "p", "div", "h3", "br", "li"))

OUTPUTS = ("child_strings", "strings", "raw_strings", "texts", "child_texts", "block_texts", "attr")


# Elements that keep a paragraph around them open (fixed values of the HTML rules).
PARAGRAPH_SCOPE = frozenset({"td", "th", "caption", "button", "object", "template", "table"})

# Marks that need no tolerant reading: plain names, attributes in double quotes without references.
PLAIN_START = re.compile(r'<([a-z][a-z0-9]*)((?: [a-z][a-z-]*="[^"&<>]*")*)>')
PLAIN_ATTRS = re.compile(r' ([a-z-]+)="([^"]*)"')
PLAIN_END = re.compile(r"</([a-z][a-z0-9]*)>")
# Elements the parser reads on in a mode of its own.
OWN_MODE = frozenset("script style textarea title iframe noembed noframes noscript plaintext xmp".split())

# Pages whose fields are held at a time.
SLICE = 100


@dataclass(frozen=True)
class Pick:
    """What to take from a page.

    ``tag``/``attr``/``value`` name the element (``None`` matches anything; a
    class matches one token or the whole attribute). The first match is used,
    or all of them with ``every``. ``inner`` descends to the elements of that
    tag below it (only the first with ``inner_first``). ``output`` says what is
    taken from each element reached; ``arg`` names the attribute for ``attr``.
    """

    name: str
    tag: str | None = None
    attr: str | None = None
    value: str | None = None
    output: str = "child_strings"
    every: bool = False
    inner: str | None = None
    inner_first: bool = False
    arg: str | None = None


class _Page(HTMLParser):
    """A page as flat lists in document order; ``end[i]`` closes the span of item ``i``."""

    def __init__(self, markup: str):
        super().__init__(convert_charrefs=True)
        self.tag: list = []  # None for a piece of text
        self.attrs: list = []
        self.text: list = []
        self.end: list = []
        self._open: list = []
        self._open_count: Counter = Counter()
        self._pending: list = []
        self.feed(markup)
        self.close()
        self._flush()
        while self._open:
            self._close_last()
        self._by_tag = defaultdict(list)
        self._with_attrs = []
        for i, tag in enumerate(self.tag):
            self._by_tag[tag].append(i)
            if tag is not None and self.attrs[i]:
                self._with_attrs.append(i)

    def _add(self, tag, attrs, text):
        self.tag.append(tag)
        self.attrs.append(attrs)
        self.text.append(text)
        self.end.append(len(self.tag))

    def _flush(self):
        text = "".join(self._pending)
        self._pending = []
        if not text:
            return
        # White space between tags counts as one character.
        if not text.strip(" \n\t\r\f\v"):
            if not (self._open_count["pre"] or self._open_count["textarea"]):
                text = "\n" if "\n" in text else " "
        parent = self.tag[self._open[-1]] if self._open else None
        self._add(None, parent not in SILENT_TAGS, text)

    def parse_starttag(self, i):
        mark = PLAIN_START.match(self.rawdata, i)
        if mark is None or mark[1] in OWN_MODE:
            return super().parse_starttag(i)
        self.lasttag = mark[1]
        self.handle_starttag(mark[1], PLAIN_ATTRS.findall(mark[2]) if mark[2] else ())
        return mark.end()

    def parse_endtag(self, i):
        mark = PLAIN_END.match(self.rawdata, i) if self.cdata_elem is None else None
        if mark is None:
            return super().parse_endtag(i)
        self.handle_endtag(mark[1])
        return mark.end()

    def handle_starttag(self, tag, attrs):
        self._flush()
        if tag == "p" and self._open_count["p"]:
            self._end_paragraph()
        self._add(tag, {name: value or "" for name, value in attrs}, None)
        if tag not in VOID_TAGS:
            self._open.append(len(self.tag) - 1)
            self._open_count[tag] += 1

    def _end_paragraph(self):
        """A new paragraph ends the open one, unless that lies outside the table cell it begins in."""
        for i in reversed(self._open):
            if self.tag[i] in PARAGRAPH_SCOPE:
                return
            if self.tag[i] == "p":
                break
        while self._close_last() != "p":
            pass

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID_TAGS:
            self._close_last()

    def handle_endtag(self, tag):
        self._flush()
        if self._open_count[tag]:
            while self._close_last() != tag:
                pass

    def _close_last(self):
        i = self._open.pop()
        self.end[i] = len(self.tag)
        self._open_count[self.tag[i]] -= 1
        return self.tag[i]

    def handle_data(self, data):
        self._pending.append(data)

    def handle_comment(self, data):
        self._flush()
        self._add(None, False, data)

    def updatepos(self, i, j):
        return j  # line numbers are not needed

    # --- reading ---------------------------------------------------------------

    def children(self, i):
        j = i + 1
        while j < self.end[i]:
            yield j
            j = self.end[j]

    def only_string(self, i):
        """The single string below ``i``, or None."""
        while self.tag[i] is not None:
            below = list(self.children(i))
            if len(below) != 1:
                return None
            i = below[0]
        return self.text[i]

    def full_text(self, i, breaking=frozenset()):
        """All text of item ``i``; outermost ``breaking`` elements get a blank line after them."""
        if self.tag[i] is None:
            return self.text[i]
        parts, j = [], i + 1
        while j < self.end[i]:
            if self.tag[j] in breaking:
                parts.append(self.full_text(j) + "\n\n")
                j = self.end[j]
            else:
                if self.tag[j] is None and self.attrs[j]:
                    parts.append(self.text[j])
                j += 1
        return "".join(parts)

    def matches(self, i, pick):
        if pick.attr is None:
            return True
        held = self.attrs[i].get(pick.attr)
        if held is None or pick.value is None:
            return held is not None
        return held == pick.value or (pick.attr == "class" and pick.value in held.split())

    def take(self, pick):
        places = self._with_attrs if pick.tag is None else self._by_tag[pick.tag]
        found = (i for i in places if self.matches(i, pick))
        roots = list(found) if pick.every else [i for i in (next(found, None),) if i is not None]
        if not roots and not pick.every:
            return None
        if pick.inner is not None:
            reached = []
            for root in roots:
                same = self._by_tag[pick.inner]
                below = same[bisect_right(same, root) : bisect_left(same, self.end[root])]
                reached += below[:1] if pick.inner_first else below
            if not reached and pick.inner_first:
                return None
            roots = reached
        return [value for i in roots for value in self.values(i, pick)]

    def values(self, i, pick):
        if pick.output == "attr":
            held = self.attrs[i].get(pick.arg)
            return [] if held is None else [held]
        if pick.output == "texts":
            return [self.full_text(i)]
        if pick.output == "block_texts":
            return [self.full_text(i, BREAKING_TAGS)]
        if pick.output == "child_texts":
            return [t for t in map(self.full_text, self.children(i)) if t != ""]
        items = self.children(i) if pick.output == "child_strings" else (i,)
        strings = [s for s in map(self.only_string, items) if s is not None]
        return strings if pick.output == "raw_strings" else [s.strip() for s in strings]


def select_html(html: Column, picks: list[Pick]) -> Column:
    """One struct per page with an ``array<string>`` per pick.

    A field is null where its element is missing. ``error`` holds the reason
    when a page could not be read at all, and all other fields are then null.
    """
    for pick in picks:
        if pick.output not in OUTPUTS:
            raise ValueError(f"unknown output {pick.output!r}")
        if pick.tag is None and pick.attr is None:
            raise ValueError(f"pick {pick.name!r} names neither a tag nor an attribute")
    names = [pick.name for pick in picks]
    schema = StructType(
        [StructField(name, ArrayType(StringType())) for name in names]
        + [StructField("error", StringType())]
    )

    def read(markup):
        try:
            page = _Page(markup)
            return [page.take(pick) for pick in picks] + [None]
        except Exception as problem:  # a bad page must not stop the job
            return [None] * len(picks) + [f"{type(problem).__name__}: {problem}"]

    kinds = [pa.list_(pa.string())] * len(names) + [pa.string()]

    @F.arrow_udf(schema)
    def select(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        # Spark's batches are counted in rows; only a slice of one is ever taken apart.
        for pages in batches:
            for at in range(0, len(pages), SLICE):
                rows = [read(markup) for markup in pages.slice(at, SLICE).to_pylist()]
                fields = [pa.array(field, kind) for field, kind in zip(zip(*rows), kinds, strict=True)]
                yield pa.StructArray.from_arrays(fields, names=[*names, "error"])

    # Kept out of pushed-down filters, where the page would be read a second time.
    return select.asNondeterministic()(html)


def decode_page(content: Column) -> Column:
    """A3: UTF-8 where the bytes are valid UTF-8, Latin-1 otherwise."""
    utf8 = content.cast("string")
    return F.when(F.is_valid_utf8(utf8), utf8).otherwise(F.decode(content, "ISO-8859-1"))
