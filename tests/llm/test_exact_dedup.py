import re
from collections import defaultdict

from brute import sha

from estatelake.llm.exact_dedup import exact_groups


def run(spark, rows, tmp_path, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string, grp int, rest string")
    out = exact_groups(df, str(tmp_path), **kw).collect()
    return sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in out), key=nulls_first)


def nulls_first(row):
    return [(x is not None, x) for x in row]


def plain(rows):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[re.sub("[\x20\x09-\x0d]+", " ", text or "")].append(doc_id)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        out += [(i, keep, len(ids), i == keep, sha(text)) for i in ids]
    return sorted(out, key=nulls_first)


def test_levels_agree_with_grouping(spark, tmp_path):
    long = "äbc " * 5000
    texts = [None, "", " ", "\t\n ", "a", "ab", "abc", "abcd", "abcd", "abcd\n", "abcd \r\x0b", long, long, long + "x",
             long[:-4] + "ÿ", "abcdefgh" * 2, "abcdefgh" * 2 + "i", "a b", "a b", "a  b", "a b"]
    rows = [(i * 7 % 23, t, 1, "x") for i, t in enumerate(texts)] + [(99, "abcd", 1, None), (99, "abcd", 1, None)]
    rows += [(None, "ab", 1, None), (None, "only null ids", 1, None), (None, "only null ids", 1, None)]
    assert run(spark, rows, tmp_path, first_bytes=4, growth=2) == plain(rows)


def test_one_hot_group(spark, tmp_path):
    rows = [(i, "same text" if i % 3 else f"text {i}", 0, "") for i in range(600)]
    assert run(spark, rows, tmp_path) == plain(rows)


def test_empty_table(spark, tmp_path):
    assert run(spark, [], tmp_path) == []
