import random
import zlib

import numpy as np
import pytest

from estatelake.llm import queries, tokens
from estatelake.llm.token_files import Shard, pack, read_token_files, shard_bytes, unpack, write_token_files
from estatelake.llm.tokens import TextIds

ODD = ["", " ", "don't  STOP\n\n now", "Ünïcode ſtraße İstanbul", "漢字 und mehr", "<|endoftext|> x <|startoftext|>", "x" * 3000, "a\x1cb\x85c\xa0d \t\r\n e",
       "1234 5.6%!? --- '' ''s 'LL we'll", "é vs é", "Ⱥ ǅ ŉ ª º ² ¾ µ", "\x00\x7f\x80"]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_equal_the_library(name, tables):
    import pyarrow.parquet as pq

    own = TextIds(queries.tokenizer_file(name))
    texts = ODD + pq.read_table(f"{tables}/documents.parquet")["text"].to_pylist()
    pick = random.Random(3)
    texts += ["".join(pick.choice("ab'sTLé ²5\n\t\x0b\x1f\x85\xa0ſ-.,") for _ in range(60)) for _ in range(400)]
    for text in texts:
        want = own.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(own.of(text), "<u4").tolist() == want, text


WHITES = ["a  b", "a   b ", " \n x", "\n\n's 't", "  'salt''ll 're're'd1'm", "x\xa0 y\x85", "a'", "a'l", "'", "''", "12 34'5s", " é  'é", "\n", "tail  "]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_many_texts_at_once_equal_the_library(name, monkeypatch):
    """Texts split together, in small groups, in parts, and with pieces forgotten in between."""
    own = TextIds(queries.tokenizer_file(name))
    pick = random.Random(9)
    texts = ODD + WHITES + ["".join(pick.choice("ab'sTLémrdv ²5\n\t\x0b\x1f\x85\xa0ſ-.,'  ") for _ in range(pick.randint(0, 90))) for _ in range(600)]
    texts += ["\n".join(texts[20:400])]
    want = [own.tokenizer.encode(x, add_special_tokens=False).ids for x in texts]
    for chars, kept in ((1 << 30, 1 << 30), (300, 50), (40, 500), (1, 1)):
        monkeypatch.setattr(tokens, "GROUP_CHARS", chars)
        monkeypatch.setattr(tokens, "KEPT_PIECES", kept)
        rows = list(own.of_rows(enumerate(texts)))
        assert [k for k, _ in rows] == list(range(len(texts)))
        for text, (_, ids), ok in zip(texts, rows, want, strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == ok, text
        assert len(own.pieces) == len(own.stops) - 1 == len(own.uses)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_known_pieces_cost_no_python_step_each(name):
    """Repeats of a piece within a group of texts are looked up once, and pieces that come again are not forgotten."""
    own, looked = TextIds(queries.tokenizer_file(name)), []

    class Seen(type(own.pieces)):
        def __getitem__(self, piece):
            looked.append(piece)
            return super().__getitem__(piece)

    own.pieces = Seen()
    words = ["alpha", "beta", "gamma"] * 500
    assert len(list(own.of_rows([(i, " ".join(words)) for i in range(20)]))) == 20
    assert len(looked) < 10


def test_pieces_that_come_again_are_kept(monkeypatch):
    own = TextIds(queries.tokenizer_file("byte_bpe_50k.json"))
    monkeypatch.setattr(tokens, "KEPT_PIECES", 8)
    for text in ("often once", "often twice", "often x y z u v w"):
        own.of(text)
    assert len(own.pieces) >= 8
    own.of("new")
    assert set(own.pieces) == {"often", "new"}


@pytest.mark.parametrize("width", [1, 5, 8, 13, 16, 17, 31, 32])
def test_bits_round_trip(width):
    ids = np.random.default_rng(width).integers(0, 1 << width, 70_001).astype(np.uint32)
    data = pack(ids, width)
    assert len(data) == -(-len(ids) * width // 8) and (unpack(data, width, len(ids)) == ids).all()


@pytest.mark.parametrize("width", [11, 16])
def test_random_access(tmp_path, width):
    ids = np.random.default_rng(1).integers(0, 1 << width, 1000).astype(np.uint32)
    (tmp_path / "s.bits").write_bytes(shard_bytes([3, None, 9], np.array([10, 10, 1000]), ids, width, block=64))
    shard = Shard(str(tmp_path / "s.bits"))
    for a, b in [(0, 1), (63, 65), (64, 128), (999, 1000), (5, 5), (0, 1000)]:
        assert (shard.ids(a, b) == ids[a:b]).all()
    assert [(i, s, len(x)) for i, s, x in shard.documents()] == [(3, 0, 10), (None, 10, 0), (9, 10, 990)]


def expected(docs, name):
    own, start, out = TextIds(queries.tokenizer_file(name)), 0, []
    for doc_id, text in docs:
        ids = own.tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_query_on_whole_table(spark, tables):
    docs = sorted(tuple(r) for r in spark.read.parquet(f"{tables}/documents.parquet").select("doc_id", "text").collect())
    assert sorted(map(tuple, queries.op7_bit_packed_ids(spark, tables).collect())) == expected(docs, "word_bpe_49k.json")


def test_odd_rows_and_small_shards(spark, tmp_path):
    rows = [(7, None, 1), (None, "b", 1), (5, "", 1), (5, "", 1), (-3, "word " * 500, 1), (9, "x y", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, part int")
    name = "word_bpe_49k.json"
    manifest = write_token_files(df, queries.tokenizer_file(name), 1, str(tmp_path), shard_ids=3, block=8)
    got = read_token_files(manifest, with_ids=True).collect()
    order = [(None, "b"), (-3, "word " * 500), (5, ""), (5, ""), (7, None), (9, "x y")]
    assert sorted((tuple(r)[:4] for r in got), key=lambda r: r[1]) == expected(order, name)
    assert all(len(r["ids"]) == r["n_tokens"] for r in got)


def test_empty_table(spark, tmp_path):
    df = spark.createDataFrame([], "doc_id long, text string")
    manifest = write_token_files(df, queries.tokenizer_file("word_bpe_49k.json"), 1, str(tmp_path))
    assert read_token_files(manifest).collect() == []
