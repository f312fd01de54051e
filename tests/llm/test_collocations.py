import random

import numpy as np
import pytest
from plain_collocations import collocations as plain
from pyspark.sql import functions as F

from estatelake.llm import collocations
from estatelake.llm.queries import op13_collocations

OUT = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def check(spark, rows, tmp_path, threshold=5, top=2000, **how):
    df = spark.createDataFrame(rows, "text string, lang string")
    got = collocations.collocations(df, str(tmp_path), threshold=threshold, top=top, **how)
    assert got.columns == OUT
    assert sorted(tuple(r) for r in got.collect()) == sorted(plain(rows, threshold, top=top))


def spoken(seed, n, words=12, length=40):
    rng = random.Random(seed)
    names = ["New", "york", "ÄB", "é", "of", "THE", "x1", "a-b", "\x1c", "日本"][: max(2, words)] + [f"w{i}" for i in range(words)]
    marks = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", " ;", "\x0b", " ! ", " "]
    return ["".join(rng.choice(names) + rng.choice(marks) for _ in range(rng.randrange(length))) for _ in range(n)]


def test_texts_of_every_kind(spark, tmp_path):
    rows = [(t, ("en", "de", None, "und", "")[i % 5]) for i, t in enumerate(spoken(1, 400))]
    rows += [(None, "en"), ("", "en"), (" \t ", "de"), (None, None), ("one", "lone")]
    check(spark, rows, tmp_path)


@pytest.mark.parametrize("how", [{"block_bytes": 50}, {"block_bytes": 50, "partition_bytes": 100, "room": 1}])
def test_small_blocks_and_full_summaries(spark, tmp_path, how):
    check(spark, [(t, "en") for t in spoken(2, 300, 60)], tmp_path, **how)


def test_hot_phrases_overlaps_and_ties(spark, tmp_path):
    rows = [("ha ha ha ha ha. So it goes", "en")] * 300 + [(f"so it w{i % 7} goes", "en") for i in range(150)]
    rows += [("b c. d e. f g. h i", "de")] * 6  # all scores are equal
    check(spark, rows, tmp_path, top=3)


def test_very_long_texts(spark, tmp_path):
    rows = [(" ".join(spoken(3, 300, 30)), "en"), ("la " * 20000, "en")]
    check(spark, rows, tmp_path, threshold=30, block_bytes=2000)


def test_empty_tables(spark, tmp_path):
    check(spark, [], tmp_path / "a")
    check(spark, [(None, None), ("", "en")], tmp_path / "b")


def test_other_columns_are_not_read(spark, tmp_path):
    rows = [(t, "en") for t in spoken(4, 100)]
    df = spark.createDataFrame(rows, "text string, lang string").withColumns({c: F.lit(1) for c in ("phrase", "size", "n", "a", "part")})
    got = collocations.collocations(df, str(tmp_path), threshold=5)
    assert sorted(tuple(r) for r in got.collect()) == sorted(plain(rows, 5))


def test_summaries_keep_what_reaches_the_threshold():
    rng = np.random.default_rng(5)
    keys = np.concatenate([np.repeat(np.arange(40, dtype=np.uint32), 30), rng.integers(100, 1 << 32, 20000).astype(np.uint32)])
    rng.shuffle(keys)
    for room in (1, 2, 5):
        summary = collocations.Summary(room * len(keys) // 30 + 1)
        summary.held = 1 << 16  # settle at every merge
        for some in np.array_split(keys, 300):
            summary.held = 1 << 16
            summary.merge(*collocations.counted(some))
        kept = summary.survivors(30)
        assert set(range(40)) <= set(kept.tolist()) and summary.error * room <= 30
        assert len(summary.keys) <= summary.capacity


def test_phrases_of_one_digest_are_counted_apart():
    block = collocations.Block(["a b. a b. c d. a b. c d"], ["en"])
    block.digest[:] = 7  # every word, so every phrase of a size, has one digest
    table = collocations.BitTable(np.full(128, 255, np.uint8), 2)
    found = collocations.phrase_rows(block, table, 2)
    total = {}
    for size, phrase, n in zip(found["size"], found["phrase"], found["count"], strict=True):
        total[size, phrase] = total.get((size, phrase), 0) + n
    assert total == {(0, b""): 10, (1, b"a"): 3, (1, b"b"): 3, (1, b"c"): 2, (1, b"d"): 2, (2, b"a b"): 3, (2, b"c d"): 2}


def test_scores_beyond_64_bits(spark):
    rows = [(4 * 10**18, 4 * 10**18 + 10**12), (30, 90), (2**62, 2**63 - 1)]
    got = spark.createDataFrame(rows, "a long, b long").select(collocations.score_of("a", "b").alias("s")).collect()
    assert [r["s"] for r in got] == [2000000 * a // b for a, b in rows]


def test_query_over_the_whole_table(spark, tables):
    rows = [tuple(r) for r in spark.read.parquet(f"{tables}/documents.parquet").select("text", "lang").collect()]
    assert sorted(tuple(r) for r in op13_collocations(spark, tables).collect()) == sorted(plain(rows))
