"""Toxicity scores: a lexicon trie met by Levenshtein automata, read in context windows.

The lexicon is learnt from labelled rows: words that toxic texts hold far more
often than clean ones. Its trie and the automata of its terms are multiplied out
into one deterministic automaton, so a word is looked up letter by letter and
gives the nearest term and the edits it takes. Each hit's context window tells
whether it stands in quotation or is reported; both kinds of evidence have
weights of their own in the score.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelake.llm.common import small_batches, text_of
from estatelake.llm.simhash import minima

#: Labelled rows that a model is fitted on at most. Terms of fewer letters than ``SHORTEST`` match exactly only.
TRAINING_ROWS = 20_000
SHORTEST = 4
#: Times the odds of all texts that a term's texts are toxic; least hashes per text, and how many near copies share.
ODDS = 3
MINIMA, COPY_SHARED = 64, 56
WINDOW = 6
STEEP = 20.0
THRESHOLD = 0.3
WORD = re.compile(r"\w+")
MARKED = re.compile(r"(\w+)|([\"“”„«»‹›])")
REPORTING = frozenset("said says wrote writes called quote quoted quotes word term reads replied".split())


def automaton(terms: list[str], edits: int = 1) -> tuple[dict, list]:
    """The trie of ``terms`` times their Levenshtein automata, determinised.

    Returns transitions (per state: letter to state, "" for any other letter) and
    per state what a word that ends there is: None or (edits, number of the term).
    Terms of fewer than ``SHORTEST`` letters only match exactly.
    """
    children: list[dict[str, int]] = [{}]
    ends: dict[int, int] = {}
    for n, term in enumerate(terms):
        node = 0
        for letter in term:
            if letter not in children[node]:
                children[node][letter] = len(children)
                children.append({})
            node = children[node][letter]
        ends.setdefault(node, n)

    def closed(found: dict[int, int]) -> frozenset:
        """With letters of terms left out; the fewest edits per node."""
        todo = list(found.items())
        while todo:
            node, used = todo.pop()
            if used < edits:
                for child in children[node].values():
                    if found.get(child, edits + 1) > used + 1:
                        found[child] = used + 1
                        todo.append((child, used + 1))
        return frozenset(found.items())

    def step(state: frozenset, letter: str) -> frozenset:
        found: dict[int, int] = {}

        def put(node, used):
            if used <= edits and found.get(node, edits + 1) > used:
                found[node] = used

        for node, used in state:
            put(node, used + 1)
            for own, child in children[node].items():
                put(child, used if own == letter else used + 1)
        return closed(found)

    def best(state: frozenset):
        fits = [
            (used, ends[node]) for node, used in state
            if node in ends and (used == 0 or len(terms[ends[node]]) >= SHORTEST)
        ]
        return min(fits) if fits else None

    start = closed({0: 0})
    numbers, moves, results, todo = {start: 0}, [], [best(start)], [start]
    while todo:
        state = todo.pop(0)
        letters = {letter for node, _ in state for letter in children[node]}
        letters |= {letter for node, _ in state for child in children[node].values() for letter in children[child]}
        row = {}
        for letter in [*sorted(letters), ""]:
            after = step(state, letter)
            if after and after not in numbers:
                numbers[after] = len(numbers)
                results.append(best(after))
                todo.append(after)
            row[letter] = numbers[after] if after else -1
        moves.append(row)
    return moves, results


@dataclass
class Model:
    """Terms, weights per (term, edits), and the score's bias and two slopes."""

    terms: list[str] = field(default_factory=list)
    weights: dict[tuple[int, int], float] = field(default_factory=dict)
    bias: float = -3.0
    plain: float = 1.0
    quoted: float = 0.3

    def reader(self) -> Reader:
        return Reader(self)


class Reader:
    """Looks words up; what a word is, is kept."""

    def __init__(self, model: Model):
        self.model = model
        moves, results = automaton(model.terms)

        class Words(dict):
            def __missing__(self, word):
                state = 0
                for letter in word:
                    row = moves[state]
                    state = row[letter] if letter in row else row[""]
                    if state < 0:
                        break
                found = results[state] if state >= 0 else None
                if len(self) > 500_000:
                    self.clear()
                self[word] = found
                return found

        self.words = Words()

    def hits(self, text: str) -> list[tuple[int, int, bool]]:
        """(term, edits, in quotation or reported) of every hit in the whole text."""
        text = text.lower()
        if not any(map(self.words.__getitem__, WORD.findall(text))):
            return []
        marks = [(m[1], m[2]) for m in MARKED.finditer(text)]
        out = []
        for i, (word, _) in enumerate(marks):
            found = self.words[word] if word else None
            if found:
                before, after = marks[max(0, i - WINDOW) : i], marks[i + 1 : i + 1 + WINDOW]
                framed = any(q for _, q in before) and any(q for _, q in after)
                reported = any(w in REPORTING for w, _ in before + after)
                out.append((found[1], found[0], framed or reported))
        return out

    def evidence(self, hits: list) -> tuple[float, float]:
        """Weights of the hits told plainly and in quotation; past ``STEEP`` more hits add ever less, but they add."""
        sums = [0.0, 0.0]
        for term, edits, quoted in hits:
            sums[quoted] += self.model.weights.get((term, edits), 0.0)
        plain, quoted = (x if x <= STEEP else STEEP + math.log1p(x - STEEP) for x in sums)
        return plain, quoted

    def score(self, hits: list) -> float:
        plain, quoted = self.evidence(hits)
        return 1 / (1 + math.exp(-(self.model.bias + self.model.plain * plain + self.model.quoted * quoted)))


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, most: int = TRAINING_ROWS) -> DataFrame:
    """(text, toxic) of at most ``most`` labelled documents that are not held out, by a hash of the id."""
    known = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    )
    rows = docs.select("doc_id", text_of().alias("text"))
    return rows.join(F.broadcast(known), "doc_id").select("text", (F.col("toxic") > 0).alias("toxic"))


def copy_leaders(marks: list[tuple[bool, int, bytes]]) -> list[tuple[bool, int, int]]:
    """(toxic, mark, copy) per text: the number of the first text of the same label that it is a near copy of.

    ``marks`` have the label, a hash of the text and the ``MINIMA`` least word
    hashes. A text is a near copy if ``COPY_SHARED`` of the minima agree with a
    leader's, which takes a word-set similarity of about 0.9.
    """
    leaders: dict[tuple, list[tuple[int, np.ndarray]]] = {}
    out = []
    for number, (toxic, mark, raw) in enumerate(sorted(set(marks))):
        own = np.frombuffer(raw, "<u8")
        bands = [(toxic, i, raw[8 * i : 8 * i + 32]) for i in range(0, MINIMA, 4)]
        near = (
            n for band in bands for n, other in leaders.get(band, ()) if np.count_nonzero(own == other) >= COPY_SHARED
        )
        copy = next(near, number)
        if copy == number:
            for band in bands:
                leaders.setdefault(band, []).append((number, own))
        out.append((toxic, mark, copy))
    return out


def learn_terms(rows: DataFrame) -> tuple[list[str], int, int]:
    """Words of toxic texts by likelihood ratio; near copies of one text with one label count once.

    Returns the terms and the numbers of toxic and clean texts. The odds of a
    term's texts to be toxic are over ``ODDS`` times those of all texts. The bar
    rises with the number of words that are compared. All words over it are
    terms, as many as the labelled rows have, the best first.
    """

    def marked(batches):
        import xxhash

        for batch in batches:
            raw = [
                minima(np.array([xxhash.xxh64_intdigest(w) for w in set(WORD.findall(t.lower()))], np.uint64), MINIMA)
                .astype("<u8").tobytes()
                for t in batch.column("text").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), batch.column("mark"), pa.array(raw, pa.binary())], ["toxic", "mark", "minima"]
            )

    small_batches(rows.sparkSession)
    rows = rows.withColumn("mark", F.xxhash64("text"))
    marks = [tuple(r) for r in rows.mapInArrow(marked, "toxic boolean, mark long, minima binary").collect()]
    found = copy_leaders([(t, m, bytes(x)) for t, m, x in marks])
    toxic, clean = (len({c for t, _, c in found if t == kind}) for kind in (True, False))
    if not toxic or not clean:
        return [], toxic, clean
    copies = rows.sparkSession.createDataFrame(found, "toxic boolean, mark long, copy long")
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0)))
    counts = (
        rows.join(F.broadcast(copies), ["toxic", "mark"]).select("toxic", "copy", F.explode(words).alias("word"))
        .distinct()
        .groupBy("word").agg(
            F.count_if(F.col("toxic")).cast("double").alias("a"), F.count_if(~F.col("toxic")).cast("double").alias("b")
        )
    )
    a, b, base = F.col("a"), F.col("b"), toxic / (toxic + clean)
    share = a / (a + b)

    def term(count, part, whole):
        return F.when(count > 0, count * F.log(part / whole)).otherwise(0.0)

    ratio = 2 * (term(a, share, F.lit(base)) + term(b, 1 - share, F.lit(1 - base)))
    bar = 2 * math.log(max(2, counts.count()))
    found = counts.where((a >= 2) & (a * clean > ODDS * b * toxic)).withColumn("ratio", ratio).where(F.col("ratio") >= bar)
    return [r["word"] for r in found.orderBy(F.desc("ratio"), "word").collect()], toxic, clean


def learn(docs: DataFrame, labels: DataFrame, most: int = TRAINING_ROWS, strict: bool = False) -> Model:
    """Fit lexicon, weights and score.

    Where no word tells toxic texts from clean ones (or one kind of label is
    lacking) the lexicon is empty and every score is the prior's: ``n_terms`` of
    the scores is 0 then, and with ``strict`` it is an error.
    """
    rows = training_rows(docs, labels, most)
    terms, toxic, clean = learn_terms(rows)
    if not terms:
        if strict:
            raise ValueError(f"no term tells {toxic} toxic from {clean} clean labelled texts")
        return Model()
    blank = Model(terms)

    def read(batches):
        reader = blank.reader()
        for batch in batches:
            hits = [reader.hits(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), pa.array([[x * 4 + e * 2 + q for x, e, q in h] for h in hits], pa.list_(pa.int32()))],
                ["toxic", "hits"],
            )

    small_batches(docs.sparkSession)
    seen = rows.mapInArrow(read, "toxic boolean, hits array<int>").collect()
    held: dict[tuple[int, int], list[int]] = {}
    for row in seen:
        for key in {(h // 4, h // 2 % 2) for h in row["hits"]}:
            held.setdefault(key, [0, 0])[row["toxic"]] += 1
    n = [sum(not r["toxic"] for r in seen), sum(r["toxic"] for r in seen)]
    for key, (b, a) in held.items():
        weight = math.log((a + 0.5) / (n[1] + 1)) - math.log((b + 0.5) / (n[0] + 1))
        blank.weights[key] = max(0.0, min(6.0, weight if a + b > 1 else weight / 2))
    # A spelling variant of a term that no labelled text holds counts for half of what the term does.
    for k in range(len(terms)):
        blank.weights.setdefault((k, 1), blank.weights.get((k, 0), 0.0) / 2)
    reader = blank.reader()
    x = np.array([(1.0, *reader.evidence([(h // 4, h // 2 % 2, bool(h % 2)) for h in r["hits"]])) for r in seen])
    y = np.array([float(r["toxic"]) for r in seen])
    prior, hold = np.array([-3.0, 1.0, 0.3]), np.diag([0.1, 1.0, 1.0])
    beta = prior.copy()
    for _ in range(50):  # Newton steps of a logistic regression held to the prior
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (p - y) + hold @ (beta - prior)
        move = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + hold, grad)
        beta -= move
        if np.abs(move).max() < 1e-9:
            break
    blank.bias, blank.plain, blank.quoted = (float(v) for v in beta)
    return blank


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted, n_exact, n_misspelt, n_quoted, n_terms.

    ``n_terms`` is the size of the lexicon, the same for all rows. Whole texts; a null text is empty and gets the score of a text without hits.
    Only the text is an input of the score. Other columns are ignored.
    """
    small_batches(docs.sparkSession)
    schema = "doc_id long, held_out boolean, score double, predicted int, n_exact long, n_misspelt long, n_quoted long"
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches):
        reader = model.reader()
        for batch in batches:
            found = [reader.hits(t) for t in batch.column("text").to_pylist()]
            score = np.array([reader.score(h) for h in found], np.float64)
            columns = [
                batch.column("doc_id"), batch.column("held_out"), pa.array(score),
                pa.array((score >= THRESHOLD).astype(np.int32)),
                pa.array([sum(e == 0 for _, e, _ in h) for h in found], pa.int64()),
                pa.array([sum(e > 0 for _, e, _ in h) for h in found], pa.int64()),
                pa.array([sum(q for *_, q in h) for h in found], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    scored = rows.withColumn("held_out", held_out()).mapInArrow(run, schema)
    return scored.withColumn("n_terms", F.lit(len(model.terms)).cast("long"))


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, whose text the model does not predict as toxic."""
    names = docs.columns
    small_batches(docs.sparkSession)

    def run(batches):
        reader = model.reader()
        for batch in batches:
            texts = batch.column(names.index(text_col)).to_pylist()
            clean = pa.array([reader.score(reader.hits(t or "")) < THRESHOLD for t in texts], pa.bool_())
            yield batch.filter(clean)

    return docs.mapInArrow(run, docs.schema)
