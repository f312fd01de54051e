"""Keep the chunks of a long description that are in the target language.

The model is the table of all character trigrams of words with a score per
language. Training counts words before it takes them apart, so the shuffle
carries distinct words and not letters. Labelling is factorised alike: each
distinct word is taken apart and scored once per language, chunks look up the
scores of their words and add them up. Scores are whole numbers, so sums do not
depend on their order.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estatelake.functions.text import bind, chunk_words, chunks
from estatelake.session import shared_folder

SCALE = 1000  # scores are thousandths of a natural logarithm
LONG_TEXT = 16000  # fixed value: longer descriptions are filtered by language
FREQUENT = 50_000  # words whose scores every task holds, at most
TARGET = "pl"  # fixed value: the language that is kept


def grams(word: Column) -> Column:
    """The trigrams of a word with a space on either side, one per letter."""
    padded = F.concat(F.lit(" "), word, F.lit(" "))
    return F.regexp_extract_all(padded, F.lit("(?s)(?=(...))"), F.lit(1))


def train(corpus: DataFrame, text: str, language: str, languages: Iterable[str]) -> DataFrame:
    """Naive Bayes model rows ``(language, gram, score)`` from labelled text.

    The empty gram holds the score of an unlisted trigram, the others what a
    listed trigram adds to it. Every trigram of the corpus is listed.
    """
    labelled = corpus.where(F.col(language).isin(list(languages)))
    spoken = labelled.select(
        F.col(language).alias("language"), F.explode(chunk_words(F.lower(text))).alias("word")
    )
    counts = (
        spoken.groupBy("language", "word")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("language", F.explode(grams(F.col("word"))).alias("gram"), "n")
        .groupBy("language", "gram")
        .agg(F.sum("n").alias("n"))
    )
    known = counts.select("language", "gram", _score(F.ln(F.col("n") + 1)))
    totals = counts.groupBy("language").agg((F.sum("n") + F.count(F.lit(1))).alias("n"))
    base = totals.select("language", F.lit("").alias("gram"), _score(-F.ln("n")))
    return known.unionByName(base)


def _score(log_odds: Column) -> Column:
    return F.round(log_odds * SCALE).cast("bigint").alias("score")


def word_scores(words: DataFrame, model: DataFrame, names: list[str]) -> DataFrame:
    """Every distinct ``_word``: ``_s0``, ``_s1`` ... for the languages, its trigrams ``_n``, and whether one is ``_listed``."""
    listed = model.where("gram <> ''")
    wide = listed.groupBy("gram").agg(
        *[F.max(F.when(F.col("language") == x, F.col("score"))).alias(f"_s{i}") for i, x in enumerate(names)],
        F.lit(True).alias("_listed"),
    )
    letters = words.select("_word").distinct().select("_word", F.explode(grams(F.col("_word"))).alias("gram"))
    return letters.join(wide, "gram", "left").groupBy("_word").agg(
        *[F.coalesce(F.sum(f"_s{i}"), F.lit(0)).alias(f"_s{i}") for i in range(len(names))],
        F.count(F.lit(1)).alias("_n"), F.bool_or("_listed").alias("_listed"),
    )


def _stored(rows: DataFrame, name: str) -> DataFrame:
    """Rows written once to the shared folder and read back."""
    path = f"{shared_folder(rows.sparkSession)}/language-{name}-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def label_chunks(parts: DataFrame, model: DataFrame, *keys: str, with_text: bool = True) -> DataFrame:
    """The best language of every row of ``keys`` and ``chunk``: the same columns and ``language``.

    The first language by name wins ties; null where the model lists none of
    the trigrams. Rows that share their keys must not differ in ``chunk``.
    The scores of frequent words, at most ``FREQUENT``, go to every task, where
    the words of a chunk are added up before it moves; only other words move by
    themselves. Without ``with_text`` no text moves, and ``chunk`` is left out.
    """
    trained = _stored(model, "model")
    # One row per language of the model.
    base = {r["language"]: r["score"] for r in trained.where("gram = ''").collect()}
    names = sorted(base)
    spoken = F.posexplode_outer(F.split("chunk", " ")).alias("_at", "_word")
    text = [F.when(F.coalesce("_at", F.lit(0)) == 0, F.col("chunk")).alias("chunk")] if with_text else []
    each = parts.select(*keys, "chunk", spoken).select(*keys, "_word", *text)
    counted = _stored(each.groupBy("_word").agg(F.count(F.lit(1)).alias("_k")), "words")
    spoken_words = counted.agg(F.sum("_k")).first()[0] or 0
    often = counted.where(F.col("_k") * FREQUENT > spoken_words)  # fewer than FREQUENT words
    frequent = F.broadcast(_stored(word_scores(often, trained, names), "scores"))
    sums = [*[f"_s{i}" for i in range(len(names))], "_n"]
    widest = [F.max("chunk").alias("chunk")] if with_text else []
    near = each.join(frequent, "_word")
    other = each.join(frequent, "_word", "left_anti")
    far = other.join(word_scores(other.select("_word"), model, names), "_word", "left")
    totals = near.unionByName(far).groupBy(*keys).agg(
        *[F.coalesce(F.sum(x), F.lit(0)).alias(x) for x in sums], F.bool_or("_listed").alias("_listed"), *widest
    )
    best = F.array_sort(
        F.array(*[
            F.struct((-(F.col(f"_s{i}") + F.col("_n") * F.lit(base[x]))).alias("score"), F.lit(x).alias("language"))
            for i, x in enumerate(names)
        ])
    ) if names else F.array()
    told = F.get(best, F.lit(0))["language"] if names else F.lit(None).cast("string")
    chunk = ["chunk"] if with_text else []
    return totals.select(*keys, *chunk, F.when(F.col("_listed"), told).alias("language"))


def keep_language(
    df: DataFrame,
    text: str,
    model: DataFrame | None,
    target: str = TARGET,
    longer_than: int = LONG_TEXT,
) -> DataFrame:
    """Reduce long texts to their chunks in the target language, joined by spaces.

    Chunks whose language cannot be told are kept. Texts up to ``longer_than``
    characters, and all texts without a model, stay as they are and do not move.
    What a text becomes depends on the text only, so equal long texts are
    labelled once.
    """
    if model is None:
        return df
    is_long = F.coalesce(F.length(text) > longer_than, F.lit(False))
    keyed = df.where(is_long).withColumn("_key", F.unhex(F.sha2(F.col(text), 256)))
    long = keyed.groupBy("_key").agg(F.max(text).alias("_long"))
    parts = long.select("_key", F.posexplode(chunks(chunk_words(F.col("_long")))).alias("chunk_no", "chunk"))
    told = label_chunks(parts, model, "_key", "chunk_no", with_text=False)
    wanted = F.coalesce(F.col("language"), F.lit(target)) == target
    # Only numbers of chunks come back; the text is taken apart again where it lies.
    numbers = told.where(wanted).groupBy("_key").agg(F.array_sort(F.collect_list("chunk_no")).alias("_wanted"))
    reduced = long.join(numbers, "_key").select("_key", bind(
        chunks(chunk_words(F.col("_long"))),
        lambda c: F.array_join(F.transform("_wanted", lambda i: F.get(c, i)), " "),
    ).alias("_kept"))
    # A long text without a single word has no chunk at all.
    shorter = keyed.drop(text).join(reduced, "_key", "left").withColumn(text, F.coalesce("_kept", F.lit("")))
    return df.where(~is_long).unionByName(shorter.select(*df.columns))
