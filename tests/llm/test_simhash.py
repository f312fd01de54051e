import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from estatelake.llm import queries, simhash
from estatelake.llm.components import components


def plain_print(text, words=3):
    tokens = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    parts = [b" ".join(tokens[i : i + words]) for i in range(max(1, len(tokens) - words + 1))] if tokens else []
    ones = [0] * 64
    for part in parts:
        h = xxhash.xxh64_intdigest(part, 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(parts))


def plain_components(ids, prints):
    parent = list(range(len(ids)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    fps = np.array(prints, np.uint64)
    for i in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= 3):
            parent[find(int(j))] = find(i)
    least = defaultdict(lambda: 1 << 62)
    for i, doc_id in enumerate(ids):
        least[find(i)] = min(least[find(i)], doc_id)
    return [least[find(i)] for i in range(len(ids))]


def test_query_on_whole_table(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet").select("doc_id", "text").collect()
    prints = [plain_print(t) for _, t in docs]
    want = plain_components([d for d, _ in docs], prints)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in queries.op5_simhash_near_dedup(spark, tables).collect()}
    assert got == {d: (f"{p:016x}", c) for (d, _), p, c in zip(docs, prints, want, strict=True)}


@pytest.mark.parametrize("most", [2, 1024])
def test_every_link_of_crowded_prints_is_found(spark, tmp_path, monkeypatch, most):
    pick = random.Random(most)
    base = [pick.getrandbits(64) for _ in range(12)]
    fps = set(base)
    for b in base:
        for _ in range(40):
            x = b
            for _ in range(pick.randint(1, 5)):
                x ^= 1 << pick.randrange(64)
            fps.add(x)
    fps = sorted(fps)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    classes = spark.createDataFrame([(s, i) for i, s in enumerate(signed)], "fp long, rep long")
    first = simhash._links(simhash._postings(classes), 3, most).cache()
    links = first.where("key IS NULL")
    if most == 2:
        again = first.where("key IS NOT NULL").distinct()
        assert not again.isEmpty()
        links = links.unionByName(simhash._links(again.select("key", "fp", "rep"), 3, None))
    edges = links.selectExpr("rep AS a", "other_rep AS b")
    roots = {r["node"]: r["root"] for r in components(edges, str(tmp_path)).collect()}
    assert [roots.get(i, i) for i in range(len(fps))] == plain_components(list(range(len(fps))), fps)


def test_long_list_by_neighbourhoods_equals_pairs():
    pick = random.Random(9)
    fps = np.array(sorted({pick.getrandbits(12) << 20 | 0xABC for _ in range(900)}), np.int64)
    a, b = simhash.linked_pairs(fps)
    want = simhash.forest(len(fps), lambda: [(a, b)])
    own, root = simhash.links_in(fps, most=10)
    label = np.arange(len(fps))
    label[own] = root
    assert (label == want).all()


def test_components_of_chains_and_stars(spark, tmp_path):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    df = spark.createDataFrame(edges, "a long, b long")
    roots = {r["node"]: r["root"] for r in components(df, str(tmp_path)).collect()}
    assert roots == {**{i: 0 for i in range(1, 61)}, **{i: 100 for i in range(101, 160)}}


def test_odd_rows(spark, tmp_path):
    rows = [(5, None, 1), (3, "", 1), (3, "", 1), (None, " \n", 1), (9, "A b c d", 1), (8, "a B c d", 1), (None, "z z z", 1), (11, "one two", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp int")
    got = sorted(((str(r["doc_id"]), r["component_id"]) for r in simhash.near_duplicates(df, str(tmp_path)).collect()), key=str)
    assert got == sorted([("5", 3), ("3", 3), ("3", 3), ("None", 3), ("9", 8), ("8", 8), ("None", None), ("11", 11)], key=str)
    assert simhash.near_duplicates(df.limit(0), str(tmp_path / "e")).collect() == []
