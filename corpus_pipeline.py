"""The corpus pipeline: documents through the operators of ``estatelake.llm``.

Toxic documents go, later repeats of lines go, of near-duplicates one stays,
sources, languages and topics are brought to target weights, and what is left is
packed into sequences. Each stage works on all rows of the one before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estatelake.llm import line_dedup, mixing, packing, simhash, toxicity
from estatelake.llm.common import scratch, stored

TOKENIZER = "byte_bpe_50k.json"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model predicts as toxic go; it learns from the labels that are not held out."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return toxicity.keep_clean(docs, toxicity.learn(docs, labels))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier one go; every document stays, with its number of characters."""
    left = line_dedup.without_repeats(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        left = left.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))
    return left.select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: shingles of three words, at most three bits apart."""
    return simhash.one_per_group(docs, words=3, bits=3)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are sampled towards the target shares of source, language and topic."""
    return mixing.sampled(docs).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """Token pieces and their places in sequences of 2048."""
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path(TOKENIZER)
    folder = scratch(spark, "pack")
    pieces = stored(packing.cut_pieces(docs, tokenizer, end_id=0), f"{folder}/pieces")
    slim = pieces.select("doc_id", "piece", "start", "length", packing.crc32_of("ids").alias("ids_crc32"))
    return packing.pack(slim, f"{folder}/packing")


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("SimHash near-dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("best-fit packing", pack_sequences),
]

#: No SQL states the learnt toxicity score; tests/llm/test_pipeline.py has a plain version of every stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each one's rows are written and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    folder = scratch(spark, "pipeline")
    for number, (name, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"{folder}/{number}-{name.replace(' ', '-')}")
    return docs
