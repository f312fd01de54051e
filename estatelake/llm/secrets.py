"""Secret scan: fixed patterns, and sliding-window entropy of candidate strings. JVM only.

Three base patterns give spans that always stay. Strings of a key-like alphabet
that no base span covers are candidates: a window slides over the characters,
counts go up for the entering and down for the leaving character, and the
highest Shannon entropy seen is held against the threshold of the string's
character class. An allow list suppresses candidates, never base spans.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estatelake.functions.text import bind
from estatelake.llm.common import running, running_totals, text_of

ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_HINT = r"(?i:passw|secret|token|api_?key)"
ASSIGN_VALUE = 6
# A run that fails its length cannot hide a longer one, so the length is part of the pattern.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
KINDS = ("assign", "access", "hex", "entropy")

#: UUIDs, placeholders, counting runs: a candidate is no secret if what one of these matches
#: is at least a quarter of it. A long key that merely holds such a run stays one.
ALLOWED = (
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"(?i)example(?:key)?|sample|placeholder|changeme|dummy|redacted",
    r"(?i)x{6,}|0{8,}|\*{4,}",
    r"(?i)0123456789|abcdefgh",
)
ALLOWED_SHARE = 0.25


@dataclass(frozen=True)
class CharClass:
    """A class of strings: the pattern its whole candidate matches, and its least entropy in bits."""

    name: str
    pattern: str
    bits: float


#: The first class that matches counts. Words and letters of one case only belong to none. Long words
#: with a number or a capital here and there have nearly the entropy of keys: they meet the
#: higher of two bars, strings that change between kinds of letters all along the lower one.
CLASSES = (
    CharClass("hex", r"^(?=.*[0-9])(?=.*[a-fA-F])[0-9a-fA-F]+$", 2.9),
    CharClass("alnum", r"^(?=.*[0-9].*[0-9])(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9]+$", 3.5),
    CharClass("base64", r"^(?=.*[0-9].*[0-9])(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9+/_=-]+$", 3.7),
    CharClass("base36", r"^(?=[a-z]*[0-9]+[a-z]+[0-9]+[a-z]+[0-9])[a-z0-9]+$", 3.4),
    CharClass("base36 words", r"^(?=.*[0-9].*[0-9])(?=.*[a-z])[a-z0-9]+$", 3.9),
    CharClass("base32", r"^(?=[A-Z]*[0-9]+[A-Z]+[0-9]+[A-Z]+[0-9])[A-Z0-9]+$", 3.4),
    CharClass("base32 words", r"^(?=.*[0-9].*[0-9])(?=.*[A-Z])[A-Z0-9]+$", 3.85),
    CharClass("mixed case", r"^(?=.*(?<![A-Z])(?:[A-Z]+[a-z]{1,3}){4}(?![a-z]))[A-Za-z0-9+/_=-]+$", 3.6),
    CharClass("mixed-case words", r"^(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9]+$", 4.0),
)
WINDOW = 20


def found(text: Column, pattern: str, group: int = 0, hint: str | None = None) -> Column:
    """Leftmost, non-overlapping matches: array of (start, end, value), in code points.

    Every match also takes what lies before it, so lengths add up to positions;
    the last one takes the rest, so the scan stays linear. ``value`` is the
    match, or the given group of the pattern.
    """
    whole = rf"(?s)(.*?)(?:({pattern})|\z)"

    def pieces(number: int) -> Column:
        return F.regexp_extract_all(text, F.lit(whole), F.lit(number))

    hits, gaps = pieces(2), pieces(1)
    values = pieces(group + 2) if group else hits
    lengths = F.zip_with(gaps, hits, lambda g, h: F.length(g) + F.length(h))
    spans = F.transform(
        F.arrays_zip(hits.alias("h"), values.alias("v"), running_totals(lengths).alias("e")),
        lambda x: F.struct(
            (x["e"] - F.length(x["h"])).alias("start"), x["e"].alias("end"), x["v"].alias("value"),
            (x["h"] != "").alias("hit"),
        ),
    )
    none = F.array().cast("array<struct<start:bigint,end:bigint,value:string,hit:boolean>>")
    return F.when(text.rlike(hint or pattern), F.filter(spans, lambda x: x["hit"])).otherwise(none)


def peak_entropy(value: Column, window: int = WINDOW) -> Column:
    """Highest entropy in bits of any ``window`` characters in a row, by incremental counts.

    Letters get numbers once; a step changes two counts, so a string takes time
    in proportion to its length.
    """
    steps = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(window + 2)])

    def at(counts: Column, code: Column) -> Column:
        return F.element_at(counts, code)

    def with_count(counts: Column, code: Column, change: int) -> Column:
        rest = F.size(counts) - code
        return F.concat(F.slice(counts, F.lit(1), code - 1), F.array(at(counts, code) + change), F.slice(counts, code + 1, rest))

    def gain(count: Column) -> Column:
        return F.element_at(steps, count + 1)

    def peak(codes: Column, n_letters: Column) -> Column:
        start = F.struct(
            F.array_repeat(F.lit(0), n_letters).alias("counts"), F.lit(0.0).alias("total"), F.lit(0.0).alias("peak")
        )

        def step(state: Column, position: Column) -> Column:
            here = F.element_at(codes, position + 1)
            full = position >= window
            there = F.element_at(codes, F.greatest(position - window + 1, F.lit(1)))

            def leave(counts: Column) -> Column:
                return F.when(full, with_count(counts, there, -1)).otherwise(counts)

            def moved(counts: Column) -> Column:
                """Counts after the leaving and before the entering character."""
                left = at(state["counts"], there)
                down = F.when(full, gain(left - 1) - gain(left)).otherwise(0.0)
                up = gain(at(counts, here) + 1) - gain(at(counts, here))
                return bind(state["total"] + down + up, lambda total: F.struct(
                    with_count(counts, here, 1).alias("counts"), total.alias("total"),
                    F.when(position >= window - 1, F.greatest(state["peak"], F.lit(math.log2(window)) - total / window))
                    .otherwise(state["peak"]).alias("peak"),
                ))

            return bind(leave(state["counts"]), moved)

        return F.aggregate(F.sequence(F.lit(0), F.size(codes) - 1), start, step, lambda s: s["peak"])

    def coded(chars: Column) -> Column:
        return bind(F.array_distinct(chars), lambda letters: bind(
            F.transform(chars, lambda c: F.array_position(letters, c).cast("int")), lambda codes: peak(codes, F.size(letters))
        ))

    return bind(F.split(value, ""), coded)


def apart(candidates: Column | str, base: Column) -> Column:
    """The candidates that overlap no base span, by one pass over both in the order of positions.

    A candidate is free if all base spans that start before its end also end by
    its start: the running maximum of the ends tells.
    """
    kind = "struct<pos:bigint,base:int,last:bigint,at:int>"

    def event(pos: Column, base_: int, last: Column, at: Column) -> Column:
        return F.struct(pos.alias("pos"), F.lit(base_).alias("base"), last.alias("last"), at.alias("at")).cast(kind)

    asks = F.transform(candidates, lambda x, i: event(x["end"], 0, F.lit(0), i))
    spans = F.transform(base, lambda x: event(x["start"], 1, x["end"], F.lit(-1)))

    def judged(events: Column) -> Column:
        ends = running(F.transform(events, lambda e: e["last"]), lambda a, v: F.greatest(a, v), F.lit(0).cast("long"))
        told = F.filter(F.arrays_zip(events.alias("e"), ends.alias("m")), lambda x: x["e"]["base"] == 0)
        return F.transform(told, lambda x: x["m"])  # candidates do not overlap, so they stand as they were

    # At one position a candidate's end comes before a span's start: they do not overlap.
    return bind(judged(F.array_sort(F.concat(asks, spans))), lambda ends: F.filter(
        candidates, lambda x, i: F.element_at(ends, i + 1) <= x["start"]
    ))


def find_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", classes=CLASSES, allowed=ALLOWED,
    window: int = WINDOW,
) -> DataFrame:
    """One row per input row: doc_id, spans (array of kind, start, end, value).

    Spans are in code points, end exclusive, by start and then by the order of
    ``KINDS``. A null or empty text has no spans; every row is scanned whole and
    for itself, without a shuffle. Other columns are ignored.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("_t"))
    text = F.col("_t")
    rows = rows.select(
        "doc_id", "_t",
        F.filter(
            found(text, ASSIGN, 2, ASSIGN_HINT), lambda x: F.length(x["value"]) >= ASSIGN_VALUE
        ).alias("_assign"),
        found(text, ACCESS).alias("_access"),
        found(text, HEX).alias("_hex"),
        found(text, CANDIDATE).alias("_candidates"),
    )
    base = F.concat("_assign", "_access", "_hex")

    def bar(value: Column) -> Column:
        best = F.lit(None).cast("double")
        for c in reversed(classes):
            best = F.when(value.rlike(c.pattern), F.lit(c.bits)).otherwise(best)
        return best

    def not_allowed(value: Column) -> Column:
        ok = F.lit(True)
        for pattern in allowed:
            left = F.length(F.regexp_replace(value, pattern, ""))
            ok = ok & ~(value.rlike(pattern) & (left <= (1 - ALLOWED_SHARE) * F.length(value)))
        return ok

    barred = F.filter(
        F.transform("_candidates", lambda x: F.struct(
            x["start"].alias("start"), x["end"].alias("end"), x["value"].alias("value"), bar(x["value"]).alias("bar")
        )),
        lambda x: x["bar"].isNotNull() & not_allowed(x["value"]),
    )
    likely = bind(barred, lambda some: F.when(F.size(some) > 0, apart(some, base)).otherwise(some))
    rows = rows.select("doc_id", "_assign", "_access", "_hex", likely.alias("_likely"))
    # The lists are short; the entropy of a string is only taken where one is left.
    entropy = F.filter("_likely", lambda x: peak_entropy(x["value"], window) >= x["bar"])

    def labelled(spans: Column | str, number: int) -> Column:
        return F.transform(
            spans,
            lambda x: F.struct(
                x["start"].alias("start"), F.lit(number).alias("order"), x["end"].alias("end"),
                x["value"].alias("value"),
            ),
        )

    every = F.array_sort(
        F.concat(labelled("_assign", 0), labelled("_access", 1), labelled("_hex", 2), labelled(entropy, 3))
    )
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return rows.select(
        "doc_id",
        F.transform(
            every,
            lambda x: F.struct(
                F.element_at(kinds, x["order"] + 1).alias("kind"), x["start"].alias("start"),
                x["end"].alias("end"), x["value"].alias("value"),
            ),
        ).alias("spans"),
    )
