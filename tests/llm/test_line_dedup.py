import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from estatelake.llm import line_dedup, queries
from estatelake.llm.line_dedup import LineSets, entries_of, kept_lines, without_repeats


def plain(docs, t=0.8):
    """For every line with words: does an earlier line have that similarity? All pairs that share a word."""
    lines = []
    for doc_id, text in sorted(docs, key=lambda d: d[0]):
        for number, line in enumerate((text or "").split("\n")):
            words = frozenset(line.encode().lower().split())
            if words:
                lines.append((doc_id, number, words))
    seen, kept = {}, {}
    for i, (doc_id, number, words) in enumerate(lines):
        near = Counter(j for w in words for j in seen.get(w, ()))
        if not any(n / (len(words) + len(lines[j][2]) - n) >= t - 1e-12 for j, n in near.items()):
            kept.setdefault(doc_id, []).append(number)
        for w in words:
            seen.setdefault(w, []).append(i)
    return kept


def fixture(seed, n=60):
    pick = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(90)] + ["the", "of", "and"] * 10
    pool = [" ".join(pick.choice(vocabulary) for _ in range(pick.randint(1, 25))) for _ in range(40)]
    docs = []
    for i in range(n):
        lines = []
        for _ in range(pick.randint(0, 8)):
            line = pick.choice(pool)
            words = line.split()
            for _ in range(pick.randint(0, 3)):
                words[pick.randrange(len(words))] = pick.choice(vocabulary)
            lines.append(pick.choice([line, " ".join(words), "", "  ", line.upper(), "the of"]))
        docs.append((i, "\n".join(lines)))
    pick.shuffle(docs)
    return docs


def run(spark, docs, tmp_path, **kw):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    return {r["doc"]: list(r["lines"]) for r in kept_lines(df, str(tmp_path), **kw).collect()}


@pytest.mark.parametrize("seed,kw", [(1, {}), (2, {"tries": (1, None)}), (3, {"tries": (1, 2, None), "most": 3}), (4, {"similarity": 0.5})])
def test_equals_all_pairs(spark, tmp_path, seed, kw):
    docs = fixture(seed)
    assert run(spark, docs, tmp_path, **kw) == plain(docs, kw.get("similarity", 0.8))


def test_query_on_whole_table(spark, tables):
    docs = [tuple(r) for r in spark.read.parquet(f"{tables}/documents.parquet").select("doc_id", "text").collect()]
    got = {r["doc_id"]: r for r in queries.op6_line_dedup(spark, tables).collect()}
    want = plain(docs)
    assert len(got) == len(docs)
    for doc_id, text in docs:
        assert got[doc_id]["kept_lines"] == ",".join(map(str, want.get(doc_id, [])))
        assert (got[doc_id]["n_lines"], got[doc_id]["n_kept"]) == (len(text.split("\n")), len(want.get(doc_id, [])))


def test_texts_and_odd_rows(spark, tmp_path):
    rows = [(2, "a b c\n\nd e f", 1), (1, "d e f\nx y z", 1), (1, "d e f\nx y z", 1), (None, "a b c\nnew line", 1), (3, None, 1), (4, "", 1), (5, "D  E\tF", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lines int")
    out = sorted(map(tuple, without_repeats(df, str(tmp_path)).collect()), key=str)
    want = [(2, "a b c\n", 1), (1, "d e f\nx y z", 1), (1, "d e f\nx y z", 1), (None, "new line", 1), (3, None, 1), (4, "", 1), (5, "", 1)]
    assert out == sorted(want, key=str)
    assert without_repeats(df.limit(0), str(tmp_path / "e")).collect() == []


def test_query_lists_the_lines_of_a_null_id(spark, tmp_path):
    rows = [(1, "a b c\nx y z"), (None, "a b c\nnew line\nlast one")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: (r["n_lines"], r["n_kept"], r["kept_lines"]) for r in queries.op6_line_dedup(spark, str(tmp_path)).collect()}
    assert got == {1: (2, 2, "0,1"), None: (3, 2, "1,2")}


def test_word_hashes_tell_words_apart():
    pick = random.Random(7)
    words = {"".join(pick.choice("abä\0") for _ in range(n)) for n in [*range(1, 40), 2000] for _ in range(30)}
    words |= {"x" * n for n in range(1, 100)} | {"a\0", "a", "a\0\0", "\0", "\0a"}
    words = sorted(words)
    pieces = [(0, 0, " ".join(words) + "\n" + "\t\r\v\f".join(reversed(words)).upper().replace("Ä", "ä"))]
    ids = LineSets(pieces, None).ids.tolist()
    assert len(set(ids)) == len(words) and ids[: len(words)] == ids[len(words) :][::-1]
    assert LineSets([(0, 0, "")], None).ids.tolist() == [] and LineSets([(0, 0, " \n ")], None).ids.tolist() == []


def long_lines(seed, n=60):
    """Lines of 5 to 300 words, so signatures of every size, and copies with up to a quarter of the words changed."""
    pick = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(900)]
    pool = [pick.sample(vocabulary, pick.choice([5, 30, 33, 60, 125, 130, 300])) for _ in range(25)]
    docs = []
    for i in range(n):
        lines = []
        for _ in range(pick.randint(1, 4)):
            words = list(pick.choice(pool))
            for _ in range(pick.randint(0, len(words) // 4)):
                words[pick.randrange(len(words))] = pick.choice(vocabulary)
            lines.append(" ".join(words[: pick.randint(len(words) * 4 // 5, len(words))]))
        docs.append((i, "\n".join(lines)))
    return docs


def test_lines_of_every_signature(spark, tmp_path):
    docs = long_lines(5)
    want = plain(docs)
    assert 0 < sum(map(len, want.values())) < sum(text.count("\n") + 1 for _, text in docs)
    assert run(spark, docs, tmp_path) == want


@pytest.mark.parametrize("kw", [{}, {"most": 3, "tries": (1, None)}])
def test_few_entries_at_once(spark, tmp_path, monkeypatch, kw):
    # Many rows of entries a part, parts that do not fit, and lists found too long before and after that.
    monkeypatch.setattr(line_dedup, "AT_ONCE", 16)
    monkeypatch.setattr(line_dedup, "DEALT", 16)
    monkeypatch.setattr(line_dedup, "ROW", 3)
    monkeypatch.setattr(line_dedup, "FEW", 0)
    docs = fixture(6)
    assert run(spark, docs, tmp_path, **kw) == plain(docs)


def test_pairs_cut_into_runs_are_the_same(monkeypatch):
    pieces = [(doc, 0, text) for doc, text in fixture(7)]
    s = LineSets(pieces, np.full(line_dedup.BUCKETS, 9, np.uint8))
    count = line_dedup.prefix_length(s.n, 0.5)
    at = np.repeat(np.arange(len(s.n)), count)
    pos = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
    word = (s.ids[s.start[at] + pos] >> np.uint64(32)).astype("<u4")
    e = {"word": word, "n": s.n[at].astype("<i4"), "pos": pos.astype("<i4"), "k": s.k1[at], "doc": s.doc[at], "line": s.line[at]}
    e = line_dedup._in_lists(e | {"sig": line_dedup.signatures_of(s.signature, s.n)[at]})
    whole = set(zip(*map(list, line_dedup.list_pairs(e, 0.5)), strict=True))
    monkeypatch.setattr(line_dedup, "PAIRS", 1)
    assert whole and set(zip(*map(list, line_dedup.list_pairs(e, 0.5)), strict=True)) == whole


def test_entries_move_many_to_a_row(spark, tmp_path):
    run(spark, long_lines(8, 200), tmp_path)
    classes = spark.read.parquet(f"{tmp_path}/classes")
    entries = classes.agg(F.sum(F.length("prefix"))).first()[0] // 4
    assert entries_of(classes, 0.8).count() * 20 < entries


def test_levels_are_those_of_whole_counts(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "COUNTED", 100)
    texts = [f"a{i} b{i} a{i % 7}" for i in range(1000)] + [" ".join(["often"] * 5000)]
    levels = line_dedup.word_levels(spark.createDataFrame([(x,) for x in texts], "text string").repartition(3))
    ids = LineSets([(0, 0, " ".join(texts))], None).ids
    bucket = (ids & np.uint64(line_dedup.BUCKETS - 1)).astype(int).tolist()
    want = {b: 0 if n == 1 else 1 + int(8 * math.log2(n)) for b, n in Counter(bucket).items()}
    assert all(levels[b] == n for b, n in want.items()) and int((levels > 0).sum()) == sum(n > 0 for n in want.values())
