"""The word wrap against the standard library."""

import random
import textwrap

from pyspark.sql import functions as F

from estatelake.functions.wrap import careful_lines, description_columns, overflow, quick_lines, with_lines

PIECES = ["a", "bc", "def", "words", "long-er", "a--b", "semi-de-tached", "x" * 25, "-", "--", "é", "😀", "it's",
          "–", "(see-me)", "12-34", "end."]
GAPS = [" ", " ", " ", " ", "  ", "\n", "\t", "\r\n", "\xa0", "     ", "\x1c", "\x0b"]


def texts(seed, plain):
    rng = random.Random(seed)
    gaps = GAPS[:6] if plain else GAPS
    pieces = PIECES[:4] + PIECES[10:11] if plain else PIECES
    made = ["", " ", "\n\n", "  lead", "trail  ", "x" * 100, " " * 50 + "a"]
    for _ in range(400):
        n = rng.randrange(1, 40)
        made.append("".join(rng.choice(pieces) + rng.choice(gaps) for _ in range(n)))
    return made


def check(spark, given, width):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(given)], "i int, t string")
    out = with_lines(df, "t", "lines", width).orderBy("i").collect()
    for row in out:
        assert row.lines == textwrap.wrap(row.t, width), repr(row.t)


def test_ordinary_text_stays_in_the_jvm(spark):
    given = texts(1, plain=True)
    df = spark.createDataFrame([(t,) for t in given], "t string")
    quick = df.select("t", quick_lines(F.col("t"), 20).alias("lines")).collect()
    assert all(r.lines == textwrap.wrap(r.t, 20) for r in quick if r.lines is not None)
    assert sum(r.lines is None for r in quick) <= 3


def test_wrap_equals_standard_library(spark):
    for width in (7, 20, 61):
        check(spark, texts(width, plain=False), width)


def test_careful_wrap_of_ordinary_text(spark):
    given = texts(5, plain=True) + texts(6, plain=False)
    df = spark.createDataFrame([(t,) for t in given], "t string")
    for row in df.select("t", careful_lines(F.col("t"), 20).alias("lines")).collect():
        assert row.lines == textwrap.wrap(row.t, 20), repr(row.t)


def test_long_words_with_rare_spaces_and_hyphens(spark):
    rng = random.Random(12)
    given = ["".join(rng.choice(["x", "-", "1", "\xa0", "\xa0\xa0\xa0", " ", "ab-", "xyxyxyxyxy"]) for _ in range(rng.randrange(60))) for _ in range(600)]
    check(spark, given, 5)
    check(spark, ["\t" + "-" * 3000 + "a" * 3000, "1-" * 4000 + "\t", "\xa0" * 9000 + " b"], 800)


def test_wrap_at_full_width(spark):
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 12))) for _ in range(4000)]
    check(spark, [" ".join(words), "-".join(words), " ".join(words[:300]), "\t".join(words), "y" * 9000], 4000)


def test_description_columns(spark):
    given = ["", None, " ".join(["ab"] * 3000), " ".join("z" * 2500 for _ in range(6))]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(given)], "i int, t string")
    out = with_lines(df, "t", "lines").orderBy("i")
    rows = out.select(*description_columns(F.col("lines")), overflow(F.col("lines")).alias("over")).collect()
    assert [tuple(r)[:4] for r in rows[:2]] == [(None,) * 4] * 2
    assert [p is None for p in tuple(rows[2])[:4]] == [False, False, False, True]
    assert rows[3].over == 2 and rows[3].description_4 is not None
