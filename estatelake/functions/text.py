"""Column expressions for dirty listing text. Everything here stays in the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip and str.split treat as space.
SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004"
    "\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
# The same characters for the regular expression engine. Common characters are
# settled by one table look-up and one range test.
_WIDE_SPACES = r"[\u1680-\u3000&&[\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]]"
SPACE_RUN = r"[\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0" + _WIDE_SPACES + "]+"
# Spaces the standard word wrap does not break at, and the tab it expands.
RARE_SPACE = r"[\t\x1c\x1d\x1e\x1f\x85\xa0" + _WIDE_SPACES + "]"

# A decimal literal both Python and the JVM read the same way.
DECIMAL = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACES))


def words(text: Column) -> Column:
    """Whitespace-separated tokens; blank text gives an empty array."""
    return F.filter(F.split(text, SPACE_RUN), lambda w: w != "")


def indexes(n: Column) -> Column:
    """``0 .. n-1`` as an array, empty when ``n`` is not positive."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


# --- listing pages -------------------------------------------------------------


def rewrite_link(href: Column, old: str, new: str) -> Column:
    """B2: literal substitution of every occurrence."""
    return F.replace(href, F.lit(old), F.lit(new))


def page_numbers(labels: Column) -> Column:
    """``1 .. last label``; a page without readable labels is a single page."""
    last = F.coalesce(F.try_element_at(labels, F.lit(-1)).try_cast("int"), F.lit(1))
    return bind(last, lambda n: F.transform(indexes(n), lambda i: i + 1))


def page_link(link: Column, number: Column) -> Column:
    """Address of one numbered listing page."""
    return F.concat(link, F.lit("?page="), number.cast("string"))


def canonical_link(link: Column) -> Column:
    """The part before the first ``.html``."""
    return F.split_part(link, F.lit(".html"), F.lit(1))


def strip_styling(text: Column) -> Column:
    """Drop style-sheet debris. The first rule also takes one leading character.

    Where no brace follows on a line, its rest is passed over at once: no later
    mark on that line can be closed either. So the time is in proportion to the text.
    """
    # The two debris patterns.
    for mark in (".css", "@media"):
        text = F.regexp_replace(text, rf"(?d){mark}[^}}\n]*+}}|({mark}[^}}\n]*+)", "$1")
    return text


def strip_styling_all(texts: Column) -> Column:
    return F.transform(texts, strip_styling)


# --- cell cleaning -------------------------------------------------------------


def join_list(cell: Column) -> Column:
    """Non-empty entries joined with a comma."""
    return F.array_join(F.filter(cell, lambda x: x != ""), ", ")


def clean_breaks_o(text: Column) -> Column:
    """Three literal rewrites; the last one matches a backslash escape, not a real NBSP."""
    text = F.replace(text, F.lit("\n\n"), F.lit(", "))
    text = F.replace(text, F.lit(", ,"), F.lit(","))
    return F.replace(text, F.lit("\\xa0"), F.lit(" "))


def clean_breaks_m(text: Column) -> Column:
    """Four breaks become a comma, the others vanish, doubled commas collapse."""
    text = F.replace(text, F.lit("\n\n\n\n"), F.lit(", "))
    text = F.replace(text, F.lit("\n"), F.lit(""))
    return F.replace(text, F.lit(",,"), F.lit(","))


def blank_to_null(text: Column) -> Column:
    """C21."""
    return F.nullif(text, F.lit(""))


def nan_to_null(number: Column) -> Column:
    """C22."""
    return F.when(~F.isnan(number), number)


# --- key/value blocks ----------------------------------------------------------


def _pair_up(tokens: Column) -> Column:
    def entries(t: Column) -> Column:
        pairs = F.transform(
            indexes(F.shiftright(F.size(t), 1)),
            lambda i: F.struct(F.get(t, i * 2).alias("key"), F.get(t, i * 2 + 1).alias("value")),
        )
        return F.when(t.isNotNull(), pairs)

    def by_key(pairs: Column) -> Column:
        numbered = F.transform(
            pairs, lambda p, i: F.struct(p["key"].alias("key"), i.alias("i"), p["value"].alias("value"))
        )
        return F.array_sort(numbered)

    def last_wins(ordered: Column) -> Column:
        # Sorted by key and place, so the last of a key is followed by another key or by nothing.
        def is_last(pair: Column, i: Column) -> Column:
            return ~(F.get(ordered, i + 1)["key"].eqNullSafe(pair["key"]) & (i + 1 < F.size(ordered)))

        last = F.transform(
            F.filter(ordered, is_last),
            lambda p: F.struct(p["i"].alias("i"), p["key"].alias("key"), p["value"].alias("value")),
        )
        entries_ = F.transform(
            F.array_sort(last), lambda p: F.struct(p["key"].alias("key"), p["value"].alias("value"))
        )
        return F.map_from_entries(entries_)

    return bind(bind(bind(tokens, entries), by_key), last_wins)


def key_values_o(text: Column) -> Column:
    """C4: ``k:v, k:v`` to a map; an odd tail is dropped, the last duplicate wins."""
    flat = F.replace(F.replace(text, F.lit(":"), F.lit(", ")), F.lit(" ,"), F.lit(""))
    return _pair_up(F.split(flat, ", "))


def key_values_m(text: Column) -> Column:
    """As C4 for the other block style, with trimmed tokens."""
    flat = F.replace(text, F.lit(":"), F.lit(" ,"))
    return _pair_up(F.transform(F.split(flat, " ,"), strip))


# --- numbers, currencies, addresses ---------------------------------------------


def price_o(text: Column) -> Column:
    """Keep digits and separators, read the comma as decimal point."""
    kept = F.regexp_replace(text, "[^0-9,.]", "")
    return F.replace(kept, F.lit(","), F.lit(".")).try_cast("double")


def currency_o(text: Column) -> Column:
    """Last token, null whenever the price itself is unreadable."""
    return F.when(price_o(text).isNotNull(), F.try_element_at(words(text), F.lit(-1)))


def number_m(cell: Column) -> Column:
    """C11: first list entry as a number, ignoring spaces and tildes."""
    dotted = F.translate(F.replace(F.get(cell, F.lit(0)), F.lit(","), F.lit(".")), " ~", "")
    dotted = strip(dotted)
    return F.when(dotted.rlike(DECIMAL), dotted.try_cast("double"))


def currency_m(cell: Column) -> Column:
    """Last list entry."""
    return F.try_element_at(cell, F.lit(-1))


def floor_m(text: Column) -> Column:
    """First token."""
    return F.get(words(text), F.lit(0))


def address_m(path: Column) -> dict[str, Column]:
    """C14: the parts of a breadcrumb path."""
    district = F.get(path, F.lit(4))
    deep = F.size(path) >= 5
    return {
        "voivodeship": F.get(path, F.lit(2)),
        "city": F.get(path, F.lit(3)),
        "district": F.when(deep, district),
        "street": F.when(deep, F.nullif(F.try_element_at(path, F.lit(-1)), district)),
    }


def additional_info(info: Column, details: Column) -> Column:
    """Append the spaced-out details where both sides exist."""
    spaced = F.replace(details, F.lit(":"), F.lit(": "))
    return F.when(info.isNotNull() & details.isNotNull(), F.concat(info, F.lit(", "), spaced)).otherwise(info)


# --- long text -----------------------------------------------------------------

CHUNK = "(?:[^ ]+ ){0,5}[^ ]+"  # fixed value: six words


def chunk_words(text: Column) -> Column:
    """C17: tokens of a long description, commas and hyphens removed."""
    return words(F.replace(F.replace(text, F.lit(",")), F.lit("-")))


def chunks(tokens: Column) -> Column:
    """Consecutive groups of six tokens, lower-cased, in order."""

    line = F.lower(F.array_join(tokens, " "))
    return F.regexp_extract_all(line, F.lit(CHUNK), F.lit(0))
