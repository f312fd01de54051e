import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from estatelake.llm import packing, queries


def pack(spark, lengths, tmp_path, **kw):
    df = spark.createDataFrame([(i, n, "x", 1) for i, n in enumerate(lengths)], "doc_id long, length long, seq string, rank int")
    return packing.pack(df, str(tmp_path), **kw).collect()


def check(rows, lengths, capacity):
    assert sorted(r["length"] for r in rows) == sorted(lengths) and len({r["doc_id"] for r in rows}) == len(rows)
    held = defaultdict(list)
    for r in rows:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(held)


def best_fit_decreasing(lengths, capacity):
    free = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, f in enumerate(free) if f >= n]
        if fits:
            free[min(fits, key=lambda i: free[i])] -= n
        else:
            free.append(capacity - n)
    return len(free)


@pytest.mark.parametrize("kind", ["mixed", "hot", "large", "small", "full", "one"])
def test_every_piece_once_and_nearly_as_few_as_possible(spark, tmp_path, kind):
    pick = random.Random(kind)
    lengths = {
        "mixed": [min(256, 1 + int(pick.expovariate(1 / 70))) for _ in range(1200)],
        "hot": [100] * 700 + [pick.randint(1, 256) for _ in range(500)],
        "large": [pick.randint(80, 140) for _ in range(900)],
        "small": [pick.randint(1, 9) for _ in range(500)],
        "full": [256] * 50 + [255] * 3 + [1] * 5,
        "one": [7],
    }[kind]
    used = check(pack(spark, lengths, tmp_path, capacity=256, groups=48), lengths, 256)
    bound = -(-sum(lengths) // 256)
    assert used <= max(best_fit_decreasing(lengths, 256) * 1.02 + 1, bound)


def test_best_fit_on_counts_equals_piece_by_piece():
    pick = random.Random(5)
    for _ in range(30):
        free = {pick.randint(1, 50): pick.randint(1, 6) for _ in range(6)}
        items = {pick.randint(1, 60): pick.randint(1, 9) for _ in range(8)}
        rows = packing.best_fit(items, free, 64)
        spaces = [s for s, n in free.items() for _ in range(n)]
        for n in sorted((x for x, k in items.items() for _ in range(k)), reverse=True):
            fits = [i for i, f in enumerate(spaces) if f >= n]
            if fits:
                spaces[min(fits, key=lambda i: spaces[i])] -= n
            else:
                spaces.append(64 - n)
        opened = len(spaces) - sum(free.values())
        new = [r for r in rows if r[3] == 64]
        assert len({int(r[4]) + k for r in new for k in range(-(-_taken(rows, r, items) // int(r[2])))} ) == opened


def _taken(rows, row, items):
    later = [int(r[1]) for r in rows if r[0] == row[0] and r[1] > row[1]]
    return (min(later) if later else items[int(row[0])]) - int(row[1])


def test_configurations_never_use_more_than_there_is():
    sizes, demand = np.array([20, 33, 50]), np.array([40, 31, 17])
    plan = packing.configurations(sizes, demand, 100)
    used = sum(n * places for n, places in plan)
    assert (used <= demand).all() and all((places @ sizes) <= 100 for _, places in plan)


def test_empty_table(spark, tmp_path):
    assert pack(spark, [], tmp_path) == []


def test_query_on_whole_table(spark, tables):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(queries.tokenizer_file("byte_bpe_50k.json"))
    rows = queries.op1_best_fit_packing(spark, tables).collect()
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
    docs = spark.read.parquet(f"{tables}/documents.parquet").select("doc_id", "text").collect()
    assert len(by_doc) == len(docs)
    for doc_id, text in docs:
        ids, at = own.encode(text or "", add_special_tokens=False).ids + [0], 0
        for k, r in enumerate(sorted(by_doc[doc_id], key=lambda r: r["piece"])):
            part = np.array(ids[at : at + r["length"]], "<u4").tobytes()
            assert (r["piece"], r["start"], r["ids_crc32"]) == (k, at, zlib.crc32(part))
            assert r["length"] == 2048 or k == 0
            at += r["length"]
        assert at == len(ids)
    lengths = [r["length"] for r in rows]
    used = len({r["sequence_id"] for r in rows})
    assert used <= -(-sum(lengths) // 2048) * 1.01 + 1
    held = defaultdict(int)
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == held[r["sequence_id"]]
        held[r["sequence_id"]] += r["length"]
    assert max(held.values()) <= 2048


def test_pieces_of_odd_rows(spark):
    df = spark.createDataFrame([(1, None, 5), (1, None, 5), (None, "", 5), (2, "word " * 9000, 5)], "doc_id long, text string, piece int")
    rows = packing.cut_pieces(df, queries.tokenizer_file("byte_bpe_50k.json"), capacity=100).collect()
    assert sum(r["length"] for r in rows if r["doc_id"] == 1) == 2 and all(1 <= r["length"] <= 100 for r in rows)
    assert all(len(r["ids"]) == 4 * r["length"] for r in rows)
