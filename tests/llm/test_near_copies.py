"""One document of each component of near copies."""

import random

from test_simhash import plain_components, plain_print

from estatelake.llm.simhash import one_per_group


def kept(spark, tmp_path, rows, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["text"] or "") for r in one_per_group(df, str(tmp_path), **options).collect())


def test_equals_all_pairs(spark, tmp_path):
    pick = random.Random(4)
    base = [[f"w{pick.randrange(400)}" for _ in range(200)] for _ in range(30)]
    rows = []
    for i in range(200):
        words = list(pick.choice(base))
        for _ in range(pick.choice([0, 0, 1, 2, 9])):
            words[pick.randrange(200)] = "x"
        rows.append((i * 37 % 1009, " ".join(words)))
    ids = [i for i, _ in rows]
    roots = plain_components(ids, [plain_print(t, 3) for _, t in rows])
    want = sorted(row for row, root in zip(rows, roots, strict=True) if row[0] == root)
    assert kept(spark, tmp_path, rows) == want and 30 <= len(want) < 200


def test_null_ids_repeats_and_empty_texts(spark, tmp_path):
    rows = [(5, "a b c d"), (5, "a b c d"), (3, "a b c d"), (None, "a b c d"), (None, "q r s t u"), (None, "q r s t u"),
            (9, None), (8, ""), (7, " "), (3, "other words are here")]
    assert kept(spark, tmp_path, rows) == [(-1, "q r s t u"), (-1, "q r s t u"), (3, "a b c d"), (3, "other words are here"), (7, " ")]


def test_one_hot_group(spark, tmp_path):
    rows = [(i, "one text of many copies") for i in range(1000, 0, -1)] + [(2000, "another one that stays here")]
    assert kept(spark, tmp_path, rows) == [(1, "one text of many copies"), (2000, "another one that stays here")]
