import math
import random
import re
import zlib

import pyarrow.parquet as pq
import pytest

from estatelake.llm import queries, toxicity
from estatelake.llm.toxicity import Model, Reader, automaton, learn, score_documents


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(new[j] + 1, row[j + 1] + 1, row[j] + (x != y)))
        row = new
    return row[-1]


@pytest.mark.parametrize("edits", [0, 1, 2])
def test_automaton_finds_the_nearest_term(edits):
    terms = ["idiot", "moron", "loser", "lowei", "scum", "loweia"]
    moves, results = automaton(terms, edits)
    pick = random.Random(edits)
    words = terms + ["".join(pick.choice("idotmrnlseweia") for _ in range(pick.randint(1, 8))) for _ in range(400)]
    words += [t[:i] + pick.choice("xyzio") + t[i + pick.randint(0, 1):] for t in terms for i in range(len(t))]
    for word in words:
        state = 0
        for letter in word:
            state = moves[state].get(letter, moves[state][""]) if state >= 0 else -1
        got = results[state] if state >= 0 else None
        near = min(((distance(word, t), i) for i, t in enumerate(terms)), default=None)
        assert got == (near if near[0] <= edits else None), word


def test_quotation_is_told_from_abuse():
    model = Model(["idiot"], {(0, 0): 6.0, (0, 1): 3.0})
    reader = Reader(model)
    plain, misspelt = reader.hits("you are an idiot today"), reader.hits("you are an ydiot")
    quoted, reported = reader.hits('the sign read "what an idiot" in red'), reader.hits("they called him idiot")
    assert [plain, misspelt, quoted, reported] == [[(0, 0, False)], [(0, 1, False)], [(0, 0, True)], [(0, 0, True)]]
    assert reader.score(plain) > 0.3 > reader.score(quoted) and reader.score(plain) > reader.score(misspelt)
    assert reader.hits("") == [] and reader.hits("idea idle") == []


def corpus(spark, n=400, toxic_word="scoundrel"):
    pick = random.Random(2)
    rows, labels = [], []
    for i in range(n):
        words = [pick.choice(["alpha", "beta", "gamma", "delta", "omega"]) + str(pick.randint(0, 300)) for _ in range(30)]
        bad = i % 5 == 0
        if bad:
            words[7] = toxic_word if i % 3 else toxic_word.replace("o", "0")
        rows.append((i, " ".join(words), "src", toxic_word))
        labels.append((i, 1, int(bad)))
    return (spark.createDataFrame(rows, "doc_id long, text string, source string, score string"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_held_out_rows_are_told_apart(spark):
    docs, labels = corpus(spark)
    model = learn(docs, labels)
    assert "scoundrel" in model.terms
    rows = score_documents(docs, model).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert all(r["predicted"] == int(r["doc_id"] % 5 == 0) for r in rows if r["held_out"])
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    kept = toxicity.keep_clean(docs, model)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {i for i in range(400) if i % 5}


def test_held_out_labels_are_never_read(spark):
    docs, labels = corpus(spark, 80)
    turned = labels.withColumn("toxic", toxicity.F.when(toxicity.held_out(), 1 - toxicity.F.col("toxic")).otherwise(toxicity.F.col("toxic")))
    assert learn(docs, labels) == learn(docs, turned)


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 2), (None, "", 2), (1, "x" * 100_000, 2), (1, None, 2)], "doc_id long, text string, held_out int")
    none = spark.createDataFrame([(None, None), (1, None)], "doc_id long, toxic int")
    model = learn(docs, none)
    rows = score_documents(docs, model).collect()
    assert len(rows) == 4 and len({r["score"] for r in rows}) == 1 and rows[0]["predicted"] == 0
    assert score_documents(docs.limit(0), model).collect() == []
    assert toxicity.keep_clean(docs, model).count() == 4


@pytest.mark.parametrize("every", [2, 3])
def test_terms_are_learnt_at_high_base_rates(spark, every):
    """A third or half of the labelled texts are toxic; one term is also quoted in some clean texts."""
    pick, rows, labels = random.Random(every), [], []
    for i in range(400):
        words = [f"{pick.choice(['alpha', 'beta', 'gamma'])}{pick.randint(0, 300)}" for _ in range(30)]
        bad = i % every == 0
        if bad or i % 10 == 1:
            words[7] = "scoundrel"
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = learn(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert "scoundrel" in model.terms
    assert all(r["predicted"] for r in score_documents(docs, model).collect() if r["doc_id"] % every == 0)


def test_only_near_copies_of_one_label_count_once(spark):
    """Texts share common words; each of ten toxic ones also has a near copy, and one has its words in a clean text."""
    pick, rows = random.Random(5), []
    common = [f"common{i}" for i in range(20)]
    for i in range(60):
        words = common + [f"own{i}x{pick.randrange(10**6)}" for _ in range(40)] + (["scoundrel"] if i < 10 else [])
        rows.append((" ".join(words), i < 10))
        if i < 10:
            rows.append((" ".join([*words, f"extra{i}"]), True))
    rows.append((rows[0][0] + " quote", False))
    df = spark.createDataFrame(rows, "text string, toxic boolean")
    assert toxicity.learn_terms(df) == (["scoundrel"], 10, 51)


def plain_hits(text, terms, near):
    """Hits by edit distance to every term; ``near`` keeps what a word is."""
    marks = re.findall(r"\w+|[\"“”„«»‹›]", text.lower())
    out = []
    for i, word in enumerate(marks):
        if word not in near:
            far = [(distance(word, t), n) for n, t in enumerate(terms) if abs(len(t) - len(word)) <= 1]
            near[word] = min((x for x in far if x[0] <= (len(terms[x[1]]) >= toxicity.SHORTEST)), default=None)
        if re.match(r"\w", word) and near[word]:
            before, after = marks[max(0, i - 6) : i], marks[i + 1 : i + 7]
            quoted = any(re.match(r"\W", w) for w in before) and any(re.match(r"\W", w) for w in after)
            out.append((*near[word][::-1], quoted or any(w in toxicity.REPORTING for w in before + after)))
    return out


def test_query_against_a_plain_scorer(spark):
    """Every score of the whole table, by edit distances and sums."""
    folder = "/root/testdata/sf0.01"
    docs, labels = (queries.table(spark, folder, n) for n in ("documents", "labels"))
    model = learn(docs, labels)
    got = {r["doc_id"]: r for r in queries.op2_toxicity(spark, folder).collect()}
    texts = pq.read_table(f"{folder}/documents.parquet", columns=["doc_id", "text"]).to_pydict()
    assert len(got) == len(texts["doc_id"]) and model.terms
    near = {}
    for doc, text in zip(texts["doc_id"], texts["text"], strict=True):
        hits = plain_hits(text or "", model.terms, near)
        sums = [sum(model.weights.get((t, e), 0.0) for t, e, q in hits if q == kind) for kind in (False, True)]
        sums = [x if x <= 20 else 20 + math.log(1 + x - 20) for x in sums]
        score = 1 / (1 + math.exp(-(model.bias + model.plain * sums[0] + model.quoted * sums[1])))
        row = got[doc]
        assert row["score"] == pytest.approx(score, rel=1e-9) and row["n_terms"] == len(model.terms)
        assert (row["n_exact"], row["n_misspelt"], row["n_quoted"]) == (
            sum(e == 0 for _, e, _ in hits), sum(e > 0 for _, e, _ in hits), sum(q for *_, q in hits))
        assert row["predicted"] == int(row["score"] >= 0.3)
        assert row["held_out"] == (zlib.crc32(str(doc).encode()) % 4 == 2)


def test_held_out_precision_and_recall(spark):
    """On the 990 held-out labels of sf0.1; the texts that are missed hold no word of any lexicon (sf0.01 has 14 toxic ones)."""
    folder = "/root/testdata/sf0.1"
    rows = {r["doc_id"]: r for r in queries.op2_toxicity(spark, folder).where("held_out").collect()}
    told = pq.read_table(f"{folder}/labels.parquet").to_pydict()
    labels = {d: t for d, t in zip(told["doc_id"], told["toxic"], strict=True) if d in rows}
    toxic, found = {d for d, t in labels.items() if t}, {d for d in labels if rows[d]["predicted"]}
    assert len(toxic & found) >= 0.85 * len(toxic) and len(toxic & found) >= 0.95 * len(found)


def test_many_and_short_terms_are_learnt(spark):
    """A lexicon of any size, terms of three letters among them; those match exactly only."""
    pick, rows = random.Random(9), []
    bad = [f"{a}{b}{c}" for a in "bdfgklmnprst" for b in "aeiou" for c in "bdfgklmnp"][:500] + ["blackguard"]
    for i in range(3000):
        words = [f"word{pick.randrange(500)}" for _ in range(20)]
        rows.append((i, " ".join(words + (pick.sample(bad, 60) if i % 3 == 0 else [])), int(i % 3 == 0)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    terms, toxic, clean = toxicity.learn_terms(df.select("text", (toxicity.F.col("toxic") > 0).alias("toxic")))
    assert set(terms) == set(bad) and (toxic, clean) == (1000, 2000)
    reader = Reader(Model(terms))
    assert [x[1] for x in reader.hits(f"{bad[3]} x{bad[3]} blackguart")] == [0, 1]


def test_more_evidence_scores_higher_and_an_empty_lexicon_is_told(spark):
    reader = Reader(Model(["scum"], {(0, 0): 6.0}))
    scores = [reader.score(reader.hits("scum " * n)) for n in (1, 3, 4, 8, 100)]
    assert scores == sorted(set(scores))
    docs = spark.createDataFrame([(i, "same words") for i in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    with pytest.raises(ValueError, match="no term"):
        learn(docs, labels, strict=True)
    assert {r["n_terms"] for r in score_documents(docs, learn(docs, labels)).collect()} == {0}
