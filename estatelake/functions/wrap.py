"""C20: greedy word wrap of descriptions into four columns, and a side table for what is longer.

Ordinary text is wrapped by one regular expression. Text whose break points need
more care (tabs, hyphens at a line end, words longer than a line, rare space
characters) is cut into unbreakable chunks and folded line by line. Both stay in
the JVM and give what the standard library's wrap gives.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estatelake.functions.text import RARE_SPACE, bind, blank_to_null, strip

WIDTH = 4000
PIECES = 4


# Where a word may break. Letters and numerals count as word characters, and so does
# the underscore; a hyphen breaks after two letters, a dash of two or more before and after itself.
_WORD, _LETTER = r"\p{L}\p{N}_", r"[\p{L}\p{Nl}\p{No}_]"
_BEFORE_DASH = rf"(?<=[{_WORD}!\"'&.,?])"
CHUNK = (
    rf" +|{_BEFORE_DASH}-{{2,}}(?=[{_WORD}])"
    rf"|[^ ]+?(?:-(?:(?<={_LETTER}{{2}}-)|(?<={_LETTER}-{_LETTER}-))(?={_LETTER}-?{_LETTER})"
    rf"|(?= |\z)|{_BEFORE_DASH}(?=-{{2,}}[{_WORD}]))"
)
TAB = 8  # fixed value: columns of a tab stop


def flat_text(text: Column) -> Column:
    """The text with tabs expanded and every other breaking space as one space."""
    def expanded(line: Column) -> Column:
        cells = F.split(line, "\t")
        return bind(cells, lambda c: F.array_join(
            F.transform(c, lambda x, i: F.when(
                i < F.size(c) - 1, F.concat(x, F.repeat(F.lit(" "), TAB - F.length(x) % TAB))
            ).otherwise(x)), "",
        ))

    flat = F.array_join(F.transform(F.split(text, "[\n\r]"), expanded), " ")
    return F.translate(flat, "\x0b\x0c", "  ")


def careful_lines(text: Column, width: int = WIDTH) -> Column:
    """Lines of any text, by a fold over its chunks: a chunk that does not fit ends the line.

    A line is a span of the text. The fold holds the lines so far, the open line
    (``at``, ``n`` characters, ``k`` chunks), the length ``blank`` of its last
    chunk if that is blank, whether it is ``fresh`` and the position ``pos``. A
    blank chunk goes at the end of a line, and at the start of all but the first.
    """
    def blank(piece: Column) -> Column:
        return strip(piece) == ""

    def ended(s: Column) -> Column:
        kept = s["k"] - F.when(s["blank"] >= 0, 1).otherwise(0) > 0
        line = F.struct(s["at"].alias("at"), (s["n"] - F.greatest(s["blank"], F.lit(0))).alias("n"))
        return F.when(kept, F.concat(s["lines"], F.array(line))).otherwise(s["lines"])

    def state(lines, at, n, k, blank_, fresh, pos) -> Column:
        names = ("lines", "at", "n", "k", "blank", "fresh", "pos")
        return F.struct(*[c.alias(x) for c, x in zip((lines, at, n, k, blank_, fresh, pos), names, strict=True)])

    none, no = F.lit(-1), F.lit(False)

    def placed(s: Column, size: Column, is_blank: Column) -> Column:
        """A chunk of at most a line put on the open line, or on a new one."""
        over = s["pos"] + size
        added = state(
            s["lines"], F.when(s["k"] == 0, s["pos"]).otherwise(s["at"]), s["n"] + size, s["k"] + 1,
            F.when(is_blank, size).otherwise(none), no, over,
        )
        dropped = state(s["lines"], s["at"], s["n"], s["k"], s["blank"], no, over)
        zero = F.lit(0)
        turned = bind(ended(s), lambda lines: F.when(
            is_blank & (F.size(lines) > 0), state(lines, over, zero, zero, none, no, over)
        ).otherwise(state(lines, s["pos"], size, F.lit(1), F.when(is_blank, size).otherwise(none), no, over)))
        return (
            F.when(s["fresh"] & is_blank & (F.size(s["lines"]) > 0), dropped)
            .when(s["n"] + size <= width, added)
            .otherwise(turned)
        )

    def broken(s: Column, chunk: Column) -> Column:
        """A longer chunk: as much as fits on the open line, up to its last hyphen there, then on new lines."""
        end = s["pos"] + F.length(chunk)

        def turn(now: Column, _: Column) -> Column:
            rest = F.substring(chunk, now["pos"] - s["pos"] + 1, end - now["pos"])
            left = width - now["n"]

            def cut(piece: Column) -> Column:
                last = F.instr(F.reverse(piece), "-")
                hyphen = F.length(piece) - last  # where the last hyphen stands, if there is one
                useful = (last > 0) & (hyphen > 0) & F.left(piece, hyphen).rlike("[^-]")
                size = F.when(useful, hyphen + 1).otherwise(F.length(piece))
                full = state(
                    now["lines"], F.when(now["k"] == 0, now["pos"]).otherwise(now["at"]), now["n"] + size, now["k"] + 1,
                    F.when(blank(F.left(piece, size)), size).otherwise(none), no, now["pos"] + size,
                )
                return bind(full, lambda x: state(ended(x), x["pos"], F.lit(0), F.lit(0), none, F.lit(True), x["pos"]))

            short = placed(now, end - now["pos"], blank(rest))
            skipped = state(now["lines"], now["at"], now["n"], now["k"], now["blank"], no, end)
            return (
                F.when(now["pos"] >= end, now)
                .when(now["fresh"] & blank(rest) & (F.size(now["lines"]) > 0), skipped)
                .when(end - now["pos"] <= width, short)
                .otherwise(bind(F.left(rest, left), cut))
            )

        # Two lines in a row take more than a width of the chunk.
        turns = F.sequence(F.lit(0), F.ceil(F.length(chunk) / width).cast("int") * 2 + 3)
        return F.aggregate(turns, s, turn)

    def step(s: Column, chunk: Column) -> Column:
        size = F.length(chunk)
        return F.when(size > width, broken(s, chunk)).otherwise(placed(s, size, blank(chunk)))

    def folded(flat: Column) -> Column:
        zero = F.lit(0)
        begin = state(F.array().cast("array<struct<at:int,n:int>>"), zero, zero, zero, none, F.lit(True), zero)
        lines = F.aggregate(F.regexp_extract_all(flat, F.lit(f"({CHUNK})"), F.lit(1)), begin, step, ended)
        return F.transform(lines, lambda x: F.substring(flat, x["at"] + 1, x["n"]))

    return bind(flat_text(text), folded)


def quick_lines(text: Column, width: int = WIDTH) -> Column:
    """Lines of ordinary text; null where only the exact wrapper gives the right breaks."""
    flat = text
    for space in "\n\x0b\x0c\r":
        flat = F.replace(flat, F.lit(space), F.lit(" "))
    # Each match goes on where the last one ended, fills the line as far as
    # whole words allow and leaves the spaces in between out.
    line = rf"(?s)\G(?:^| +)(.{{0,{width - 1}}}[^ ])(?![^ ])"
    short = F.filter(F.array(F.rtrim(flat)), lambda piece: piece != "")

    def breaks_hyphen(lines: Column) -> Column:
        return F.exists(
            F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0))),
            lambda piece: F.contains(F.split_part(piece, F.lit(" "), F.lit(1)), F.lit("-")),
        )

    long = bind(
        F.regexp_extract_all(flat, F.lit(line), F.lit(1)),
        lambda lines: F.when(~breaks_hyphen(lines), lines),
    )
    long_word = flat.rlike(rf"[^ ]{{{width + 1}}}|^ {{{width}}}")
    return F.when(
        ~text.rlike(RARE_SPACE), F.when(F.length(text) <= width, short).otherwise(F.when(~long_word, long))
    )


def with_lines(df: DataFrame, text: str, lines: str, width: int = WIDTH) -> DataFrame:
    """Add all wrapped lines of ``text``: null for null, empty for blank text."""
    quick = bind(quick_lines(F.col(text), width), lambda q: F.coalesce(q, careful_lines(F.col(text), width)))
    return df.withColumn(lines, F.when(F.col(text).isNotNull(), quick))


def description_columns(lines: Column) -> list[Column]:
    """``description_1`` to ``description_4``; absent pieces are null."""
    return [
        blank_to_null(F.get(lines, F.lit(i))).alias(f"description_{i + 1}") for i in range(PIECES)
    ]


def description_rest(df: DataFrame, lines: str, *keys: str) -> DataFrame:
    """The wrapped pieces that have no column, one row each: keys, ``piece_no`` (from 5), ``text``."""
    rest = F.slice(F.col(lines), PIECES + 1, F.greatest(F.size(lines) - PIECES, F.lit(0)))
    beyond = df.where(F.size(lines) > PIECES)
    return beyond.select(*keys, F.posexplode(rest).alias("_at", "text")).select(
        *keys, (F.col("_at") + PIECES + 1).alias("piece_no"), "text"
    )


def overflow(lines: Column) -> Column:
    """How many wrapped pieces do not fit the four description columns."""
    return F.greatest(F.size(lines) - PIECES, F.lit(0))
