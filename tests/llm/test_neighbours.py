from collections import defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest

from estatelake.llm import queries
from estatelake.llm.neighbours import Index, fit_half, search, share_to_walk, walk


def plain(rows, every, k):
    held = defaultdict(list)
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v) or not any(v) or len(v) != 4:
            continue
        held[i].append(v)
    out = []
    for q in sorted(i for i in held if i % every == 0):
        far = sorted((min(float(np.sqrt(((np.array(min(held[q])) - np.array(v)) ** 2).sum())) for v in vs), i)
                     for i, vs in held.items() if i != q)
        out += [(q, n + 1, i, d) for n, (d, i) in enumerate(far[:k])]
    return out


def run(spark, rows, tmp_path, every=10, k=5, **kw):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, cell int, v string")
    out = [tuple(r) for r in search(df, every, k, Index(**kw), str(tmp_path)).collect()]
    return sorted(out)


def same(got, want):
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert [r[3] for r in got] == pytest.approx([r[3] for r in want], rel=1e-12)


@pytest.mark.parametrize("kw", [{"recall": 1.0}, {"recall": 1.0, "centroids": 3, "block": 7}, {"recall": 1.0, "filling": 1, "sample": 40}])
def test_exact_where_every_cell_is_read(spark, tmp_path, kw):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(120, 4)).astype(np.float32)
    rows = [(i, [float(x) for x in v], 1, "x") for i, v in enumerate(base)]
    rows += [(200 + i, rows[5][1], 1, "x") for i in range(60)]  # one hot vector
    rows += [(300, None, 1, ""), (310, [0.0] * 4, 1, ""), (320, [1.0, None, 2.0, 3.0], 1, ""), (330, [float("nan"), 1.0, 1.0, 1.0], 1, ""),
             (340, [float("inf"), 1.0, 1.0, 1.0], 1, ""), (None, [1.0] * 4, 1, ""), (350, [1.0, 2.0], 1, ""), (5, rows[6][1], 1, ""), (10, rows[10][1], 1, "")]
    same(run(spark, rows, tmp_path, **kw), plain([r[:2] for r in rows], 10, 5))


def test_walk_goes_by_ascending_sum():
    rng = np.random.default_rng(1)
    a, b = rng.random(6), rng.random(5)
    counts = rng.integers(0, 3, 30)
    sums = (a[:, None] + b[None]).ravel()
    cells = walk(a, b, counts, 10**9)
    assert cells == [c for c in np.argsort(sums, kind="stable") if counts[c]]
    part = walk(a, b, counts, 7)
    assert part == cells[: len(part)] and counts[part].sum() >= 7 > counts[part[:-1]].sum()


def recall(got, x, every, k=10):
    """Share of the true neighbours found; every score must be the distance, ranks gapless and ascending."""
    d, hits, total = x.astype(float), 0, 0
    found = defaultdict(list)
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        found[r["query_id"]].append(r)
    for q in range(0, len(x), every):
        far = np.sqrt(((d - d[q]) ** 2).sum(1))
        assert [r["rank"] for r in found[q]] == list(range(1, min(k, len(x) - 1) + 1))
        assert [r["score"] for r in found[q]] == pytest.approx([far[r["vec_id"]] for r in found[q]], rel=1e-12)
        assert [(r["score"], r["vec_id"]) for r in found[q]] == sorted((r["score"], r["vec_id"]) for r in found[q])
        far[q] = np.inf
        hits += len(set(np.argsort(far)[:k].tolist()) & {r["vec_id"] for r in found[q]})
        total += k
    return hits / total


def spheres(rng, n, wide):
    x = rng.normal(size=(n, wide))
    return (x / np.linalg.norm(x, axis=1)[:, None]).astype(np.float32)


@pytest.mark.parametrize("kind", ["structureless", "clustered"])
def test_recall_and_share_read(spark, tmp_path, kind):
    """The walk is as long as the vectors need: over half of the index without structure, little in clusters."""
    rng = np.random.default_rng(3)
    x = spheres(rng, 6000, 64)
    if kind == "clustered":
        x = (spheres(rng, 40, 64)[rng.integers(0, 40, 6000)] + 0.3 * x).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    assert recall(search(df, 100, 10, Index(sample=3000), str(tmp_path)).collect(), x, 100) >= 0.9
    index, d = Index(), x.astype(float)[:3000]
    parts = (slice(0, 32), slice(32, None))
    centres = [fit_half(d[:, p], index.size(6000), index.rounds) for p in parts]
    share = share_to_walk(d, parts, centres, 10, index)
    assert share > 0.4 if kind == "structureless" else share < 0.1


def test_centroids_grow_with_the_table():
    assert [Index().size(n) for n in (0, 1, 1600, 160_000, 10**9)] == [1, 1, 10, 100, 256]


def test_query_against_brute_force(spark):
    folder = "/root/testdata/sf0.1"
    held = pq.read_table(f"{folder}/embeddings.parquet").sort_by("vec_id").to_pydict()
    assert held["vec_id"] == list(range(len(held["vec_id"])))
    got = queries.op8_multi_index_search(spark, folder).collect()
    assert len(got) == 10 * len(range(0, len(held["vec_id"]), 100))
    assert recall(got, np.array(held["embedding"], np.float32), 100) >= 0.9


def test_small_and_empty_tables(spark, tmp_path):
    same(run(spark, [(0, [1.0] * 4, 1, ""), (1, [2.0] * 4, 1, "")], tmp_path), [(0, 1, 1, 2.0)])
    assert run(spark, [], tmp_path / "e") == []
