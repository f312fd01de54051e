import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_line_dedup import plain as kept_plain
from test_mixing import plain_rake
from test_simhash import plain_components, plain_print

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from estatelake.llm import queries, toxicity
from estatelake.llm.mixing import Mix, topic_of

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tables, tmp_path_factory):
    """What every stage left, each stage on the stored rows of the one before."""
    docs, left = spark.read.parquet(f"{tables}/documents.parquet"), []
    left.append({r["doc_id"]: r for r in docs.collect()})
    for n, (_, stage) in enumerate(pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(n))
        stage(spark, docs, tables).write.parquet(path)
        docs = spark.read.parquet(path)
        rows = docs.collect()
        if n < 4:
            assert docs.columns == COLUMNS and len({r["doc_id"] for r in rows}) == len(rows)
        left.append({r["doc_id"]: r for r in rows} if n < 4 else rows)
    return left


def test_registered():
    assert entry.queries()["pipeline"] is pipeline.run
    assert [name for name, _ in pipeline.STAGES] == ["toxicity", "line dedup", "SimHash near-dedup", "mixing", "best-fit packing"]


def test_toxicity(spark, tables, stages):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    reader = toxicity.learn(docs, spark.read.parquet(f"{tables}/labels.parquet")).reader()
    want = {i for i, r in stages[0].items() if reader.score(reader.hits(r["text"] or "")) < 0.3}
    assert set(stages[1]) == want and all(stages[1][i] == stages[0][i] for i in want)


def test_line_dedup(stages):
    kept = kept_plain([(i, r["text"]) for i, r in stages[1].items()])
    for i, r in stages[1].items():
        lines = [x for n, x in enumerate(r["text"].split("\n")) if n in set(kept.get(i, ())) or not x.strip(" \t\n\x0b\x0c\r")]
        assert stages[2][i]["text"] == "\n".join(lines) and stages[2][i]["n_chars"] == len("\n".join(lines))


def test_near_copies(stages):
    """All pairs of fingerprints of three-word shingles, at most three bits apart; the smallest id of what they connect stays."""
    ids = sorted(stages[2])
    prints = [plain_print(stages[2][i]["text"], 3) for i in ids]
    want = {i for i, root in zip(ids, plain_components(ids, prints), strict=True) if i == root}
    assert set(stages[3]) == want and all(stages[3][i] == stages[2][i] for i in want)
    assert len(want) < len(ids)


def test_stages_with_odd_rows_and_clashing_names(spark, tables):
    """Nulls, empty and repeated rows and columns with the names that stages use inside go through every stage."""
    names = ("_id", "_key", "_doc", "_lines", "_topic", "_tokens", "_probability", "_kept", "_source_key", "offset", "sequence_id")
    rows = [(1, "a b c d\ne f", "en", "s", 5), (1, "a b c d\ne f", "en", "s", 5), (None, None, None, None, None),
            (2, "", None, "s", 0), (3, "a b c d", "de", None, None), (4, " \n ", "de", "t", 3), (None, "x y z", "de", "t", 3)]
    plain = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    extra = plain.withColumns({name: F.concat(F.lit("mine "), F.coalesce("text", F.lit(""))) for name in names})
    texts = lambda df: sorted((r["doc_id"] or -1, r["text"] or "") for r in df.collect())
    for _, stage in pipeline.STAGES[:-1]:
        with_extra, without = stage(spark, extra, tables), stage(spark, plain, tables)
        assert with_extra.columns == extra.columns and texts(with_extra) == texts(without)
        assert all(r[name].startswith("mine ") for r in with_extra.collect() for name in names)
        assert stage(spark, plain.limit(0), tables).count() == 0
    pieces = pipeline.pack_sequences(spark, extra, tables)
    assert len(set(pieces.columns)) == len(pieces.columns) and pieces.count() == len(rows)
    assert pipeline.pack_sequences(spark, plain.limit(0), tables).count() == 0


def test_mixing(stages):
    import hashlib

    found = {i: topic_of(r["text"], {}) for i, r in stages[3].items()}
    cells = {}
    for i, r in stages[3].items():
        key = (r["source"], r["lang"], found[i][0])
        cells[key] = cells.get(key, 0) + found[i][1]
    ratio, _ = plain_rake({k: v for k, v in cells.items() if v}, Mix())
    scale = min(max(ratio.values()), Mix().boost)
    want = set()
    for i, r in stages[3].items():
        p = min(1, ratio.get((r["source"], r["lang"], found[i][0]), scale) / scale)
        if int(hashlib.md5(f"mix-1:{i}".encode()).hexdigest()[:12], 16) / 16**12 < p:
            want.add(i)
    assert set(stages[4]) == want


def test_packing(stages):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(queries.tokenizer_file(pipeline.TOKENIZER))
    want = set()
    for i, r in stages[4].items():
        ids = own.encode(r["text"], add_special_tokens=False).ids + [0]
        first = (len(ids) - 1) % 2048 + 1
        cuts = [0, *range(first, len(ids) + 1, 2048)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            want.add((i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    assert {(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in stages[5]} == want
    held = {}
    for r in sorted(stages[5], key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == held.get(r["sequence_id"], 0)
        held[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(held.values()) <= 2048
