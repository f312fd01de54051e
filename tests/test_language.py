"""Language filter: accuracy, a brute-force restatement, and the long-text rule."""

import math
from collections import Counter

from pyspark.sql import functions as F

from estatelake.functions.text import chunk_words, chunks
from estatelake.operators.language import keep_language, label_chunks, train

POLISH = "mieszkanie jest bardzo ładne i przestronne z widokiem na park oraz blisko do centrum miasta"
ENGLISH = "the apartment is very nice and spacious with a view of the park and close to the city centre"


def corpus(spark):
    return spark.createDataFrame([("pl", POLISH), ("en", ENGLISH), ("xx", "ignored")], "lang string, text string")


def grams(text):
    return [f" {w} "[i : i + 3] for w in text.split() for i in range(len(w))]


def label(spark, model, texts):
    parts = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, chunk string")
    found = {r.i: r.language for r in label_chunks(parts, model, "i").collect()}
    return [found[i] for i in range(len(texts))]


def test_model_against_brute_force(spark):
    model = train(corpus(spark), "text", "lang", ["pl", "en"])
    expected, base = {}, {}
    for lang, text in (("pl", POLISH), ("en", ENGLISH)):
        counts = Counter(grams(text))
        expected[lang] = {g: round(1000 * math.log(n + 1)) for g, n in counts.items()}
        base[lang] = round(-1000 * math.log(sum(counts.values()) + len(counts)))
    found = {(r.language, r.gram): r.score for r in model.collect()}
    assert found == {(l, g): s for l in expected for g, s in expected[l].items()} | {(l, ""): base[l] for l in base}

    def brute(text):
        found = grams(text)
        if not any(g in expected[l] for g in found for l in expected):
            return None
        score = {l: base[l] * len(found) + sum(expected[l].get(g, 0) for g in found) for l in expected}
        return max(sorted(score), key=score.get)

    tests = ["the view", "park jest", "qqq", "", "ab", "😀😀😀", "mieszkanie", "city", "and the", "ie i"]
    assert label(spark, model, tests) == [brute(t) for t in tests]


def test_accuracy_on_labelled_documents(spark):
    languages = ("de", "en", "es", "fr")
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = train(documents.where("doc_id % 2 = 0"), "text", "lang", languages)
    parts = documents.where("doc_id % 2 = 1").select(
        "doc_id", "lang", F.posexplode(chunks(chunk_words(F.col("text")))).alias("n", "chunk")
    )
    told = label_chunks(parts, model, "doc_id", "lang", "n").agg(
        F.avg((F.col("lang") == F.col("language")).cast("int")).alias("share")
    ).first()
    assert told.share > 0.9


def test_no_row_per_letter_is_shuffled_with_a_chunk(spark):
    parts = spark.createDataFrame([(1, "the view of the park")], "i int, chunk string")
    plan = label_chunks(parts, train(corpus(spark), "text", "lang", ["pl", "en"]), "i")._jdf.queryExecution().executedPlan().toString()
    # Letters exist below the count of distinct words only: taken apart after, and apart from, the chunks.
    assert plan.count("Generate explode(regexp_extract_all") == 2 and plan.count("HashAggregate(keys=[_word") >= 2


def test_only_long_texts_are_filtered(spark):
    # Six-word chunks that are all of one language.
    polish, english = "mieszkanie jest bardzo ładne i przestronne", "the apartment is very nice and"
    model = train(corpus(spark), "text", "lang", ["pl", "en"])
    df = spark.createDataFrame(
        [(1, f"{polish} {english} {polish}"), (2, f"{polish} {english}"), (3, None), (4, f"{polish.upper()}, Q-Q 1 2 3 4 5"),
         (5, f"{polish} {english} {polish}"), (6, " " * 200)],
        "i int, text string",
    )
    limit = len(f"{polish} {english}")
    kept = {r.i: r.text for r in keep_language(df, "text", model, longer_than=limit).collect()}
    assert kept[1] == kept[5] == f"{polish} {polish}" and kept[2] == f"{polish} {english}" and kept[3] is None
    assert kept[6] == ""
    every = {r.i: r.text for r in keep_language(df, "text", None, longer_than=10).collect()}
    assert every[1] == f"{polish} {english} {polish}" and every[4] == f"{polish.upper()}, Q-Q 1 2 3 4 5"


def test_frequent_words_are_added_up_before_they_move(spark, monkeypatch):
    model = train(corpus(spark), "text", "lang", ["pl", "en"])
    tests = ["the view the park", "park jest", "qqq", "", "ab ab", "mieszkanie the the", "city the"]
    before = label(spark, model, tests)
    # Of 15 words only the most frequent ones go to every task.
    monkeypatch.setattr("estatelake.operators.language.FREQUENT", 4)
    after = label(spark, model, tests)
    assert after == before and before[:5] == ["en", "pl", None, None, None]
    parts = spark.createDataFrame([(i, t) for i, t in enumerate(tests)], "i int, chunk string")
    plan = label_chunks(parts, model, "i", with_text=False)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin [_word") >= 2
    assert "HashAggregate(keys=[i" in plan and "partial_max(chunk" not in plan
