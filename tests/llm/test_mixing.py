import hashlib
from collections import defaultdict

import numpy as np
import pytest
from compare import difference, duck

from estatelake.llm import queries
from estatelake.llm.mixing import DIMS, Mix, margins, mixed, rake, topic_of


def plain_rake(cells, mix, sweeps=400):
    keys = [list(zip(*cells, strict=True))[i] for i in range(3)]
    w = np.array(list(cells.values()), float)
    start = w / w.sum()
    w = start.copy()
    targets = []
    for i in range(3):
        share = defaultdict(float)
        for k, x in zip(keys[i], start, strict=True):
            share[k] += x
        raw = {k: mix.shares[i].get(k, v ** mix.tempers[i]) for k, v in share.items()}
        targets.append({k: v / sum(raw.values()) for k, v in raw.items()})
    for _ in range(sweeps):
        for i in range(3):
            margin = defaultdict(float)
            for k, x in zip(keys[i], w, strict=True):
                margin[k] += x
            w = np.array([x * targets[i][k] / margin[k] for k, x in zip(keys[i], w, strict=True)])
        w = np.minimum(w, mix.boost * start)
    return dict(zip(cells, w / start, strict=True)), targets


@pytest.mark.parametrize("mix", [Mix(), Mix(shares=({"a": 0.5}, {}, {}))])
def test_raking_reaches_all_margins(spark, tmp_path, mix):
    rng = np.random.default_rng(4)
    cells = {(s, g, t): int(rng.integers(1, 5000)) for s in "abcd" for g in ("en", "") for t in range(3)}
    df = spark.createDataFrame([(*k, v) for k, v in cells.items()] + [("z", "en", 0, 0)], "source string, lang string, topic int, tokens long")
    got = {tuple(r[d] for d in DIMS): r["ratio"] for r in rake(df, mix, str(tmp_path)).collect()}
    want, targets = plain_rake(cells, mix)
    assert got == pytest.approx(want, rel=1e-6)
    total = sum(cells.values())
    for i, target in enumerate(targets):
        for name, share in target.items():
            assert sum(got[k] * v for k, v in cells.items() if k[i] == name) / total == pytest.approx(share, rel=1e-6)


def rare_source(rng):
    """Source r has 2 % of the tokens, spread over languages and topics like the others."""
    return {(s, g, t): int((40 if s == "r" else 980) * rng.uniform(0.7, 1.3))
            for s in "abr" for g in ("en", "de") for t in range(3)}


def test_weights_are_raked_again_under_the_boost(spark, tmp_path):
    cells = rare_source(np.random.default_rng(6))
    mix = Mix(shares=({"r": 0.078}, {"en": 0.7}, {}), tempers=(1.0, 1.0, 1.0), boost=4.0)
    free, _ = plain_rake(cells, Mix(mix.tempers, mix.shares, boost=1e9))
    assert max(free.values()) > 4  # plain raking goes over the bound, cutting it off afterwards misses the targets
    df = spark.createDataFrame([(*k, v) for k, v in cells.items()], "source string, lang string, topic int, tokens long")
    raked = rake(df, mix, str(tmp_path))
    got = {tuple(r[d] for d in DIMS): r["ratio"] for r in raked.collect()}
    want, _ = plain_rake(cells, mix)
    assert got == pytest.approx(want, rel=1e-5) and max(got.values()) <= 4 + 1e-9
    table = margins(raked).collect()
    assert len(table) == 8 and all(r["reached"] == pytest.approx(r["target"], rel=1e-3) for r in table)
    total = sum(cells.values())
    for r in table:
        own = sum(v for k, v in cells.items() if str(k[DIMS.index(r["dimension"])]) == r["category"])
        assert r["tokens"] == own and r["share"] == pytest.approx(own / total)


def test_missed_margins_are_reported(spark, tmp_path):
    """No weights under the bound give source r two fifths of all tokens; the table says so."""
    cells = rare_source(np.random.default_rng(7))
    rows = [(n, " ".join(["w"] * 5), s, g) for n, (s, g, _) in enumerate(k for k, v in cells.items() for _ in range(v // 20))]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    mix = Mix(shares=({"r": 0.9}, {}, {}), sweeps=30)
    out = mixed(df, mix, str(tmp_path / "run"), report=str(tmp_path / "margins")).collect()
    odds = {s: {r["_probability"] for r in out if r["source"] == s} for s in "abr"}
    table = {(r["dimension"], r["category"]): r for r in spark.read.parquet(str(tmp_path / "margins")).collect()}
    rare = table["source", "r"]
    assert rare["target"] > 0.3 > rare["reached"] > 1.5 * rare["share"]
    assert max(odds["r"]) <= 1 and max(odds["r"]) > max(odds["a"] | odds["b"])
    expected = sum(r["_probability"] for r in out if r["source"] == "r") / sum(r["_probability"] for r in out)
    assert expected == pytest.approx(rare["reached"], rel=1e-6)


def test_sql_rakes_under_the_boost_as_well(spark, tables):
    mix = Mix(tempers=(-0.5, -0.5, -0.5), boost=1.3, sweeps=60)
    got = mixed(spark.read.parquet(f"{tables}/documents.parquet"), mix).collect()
    assert sum(r["_probability"] > 1 - 1e-9 for r in got) > 10  # many cells stand at the bound
    rows = duck(tables).sql(queries.raking_sql(mix)).fetchall()
    assert {(r["doc_id"], round(r["_probability"], 3)) for r in got} == {(r[0], round(r[5], 3)) for r in rows}


def test_topic_is_the_fullest_bucket():
    text = "one two two three four\tfive\nsix"
    buckets = [hashlib.md5(w.encode()).digest()[0] % 8 for w in {"one", "two", "three", "four", "five", "six"}]
    assert topic_of(text, {}) == (min(range(8), key=lambda b: (-buckets.count(b), b)), 7)
    assert topic_of(" \n", {}) == (0, 0)


def test_query_against_sql(spark, tables):
    problem = difference(queries.op9_source_mixing(spark, tables), duck(tables), queries.ORACLES["op9_source_mixing"])
    assert problem is None


def test_odd_rows(spark, tmp_path):
    rows = [(1, "a b c", None, None, 1), (1, "a b c", None, None, 1), (None, None, "s", "en", 1), (2, "", "s", "en", 1), (3, "x " * 5000, "t", "en", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, topic int")
    out = mixed(df, folder=str(tmp_path)).collect()
    assert len(out) == 5 and all(0 < r["_probability"] <= 1 for r in out)
    assert len({r["_kept"] for r in out if r["doc_id"] == 1}) == 1 and all(r["_kept"] for r in out if not r["_tokens"])
    assert mixed(df.limit(0), folder=str(tmp_path / "e")).collect() == []
