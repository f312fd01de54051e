import pytest
from plain_manifest import manifest as plain
from pyspark.sql import functions as F

from estatelake.llm import manifest
from estatelake.llm.queries import op12_merkle_manifest

KIND = "doc_id long, source string, lang string, n_chars long, text string"
OUT = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def by_row(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: [(x is not None, x) for x in r])


def check(spark, rows, tmp_path):
    got = manifest.verify(spark.createDataFrame(rows, KIND), str(tmp_path))
    assert tuple(got.columns) == OUT
    assert by_row(got.collect()) == by_row(plain(rows))


def test_heights_and_lone_leaves(spark, tmp_path):
    rows = [(i, "s", "en", 3, f"Text {i}") for i in range(73)]  # 73, 10, 2, 1: runs of one node too
    rows += [(100 + i, "s", "de", 3, f"Ärger {i}") for i in range(8)] + [(200, None, None, None, None)]
    rows += [(300 + i, "t", "", i, "") for i in range(9)] + [(400, "t", "ünd", 1, "ALONE")]
    check(spark, rows, tmp_path)


def test_nulls_repeats_and_many_groups(spark, tmp_path):
    rows = [(None, None, "en", None, "A"), (None, "x", "en", None, "B"), (0, "x", "en", 1, None)]
    rows += [(7, "x", "en", 1, "SAME ROW")] * 40 + [(7, "x", "en", 1, "other")]
    rows += [(i, "x", f"lang {i % 11}", 1, "T" * 5000) for i in range(30)]
    check(spark, rows, tmp_path)


@pytest.mark.parametrize("n", [0, 1])
def test_empty_table_and_one_row(spark, tmp_path, n):
    check(spark, [(5, "s", "en", 1, "One ROW")][:n], tmp_path)


def test_requests_for_some_leaves(spark, tmp_path):
    rows = [(i, "s", "en" if i % 3 else "de", 3, f"Text {i}") for i in range(200)]
    made = manifest.build(spark.createDataFrame(rows, KIND), str(tmp_path))
    some = spark.createDataFrame([("=en", 0), ("=en", 70), ("=de", 66), ("=de", 67), ("=xx", 0)], "group string, rank long")
    got = made.proofs(some).withColumn("folded", manifest.fold(F.col("digest"), F.col("path"))).collect()
    leaves = {(r["group"], r["rank"]): r["digest"] for r in made.leaves.collect()}
    assert {(r["group"], r["rank"]) for r in got} == {("=en", 0), ("=en", 70), ("=de", 66)}
    for r in got:
        assert r["folded"] == r["root"] and r["digest"] == leaves[r["group"], r["rank"]]


def test_other_columns_are_not_read(spark, tmp_path):
    rows = [(i, "s", "en", 3, f"Text {i}") for i in range(10)]
    df = spark.createDataFrame(rows, KIND).withColumn("group", F.lit("g")).withColumn("rank", F.lit(1)).withColumn("digest", F.lit(""))
    assert by_row(manifest.verify(df, str(tmp_path)).collect()) == by_row(plain(rows))


def test_query_over_the_whole_table(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text").collect()
    assert by_row(op12_merkle_manifest(spark, tables).collect()) == by_row(plain([tuple(r) for r in docs]))
