"""Phrase collocations: frequent phrases by Misra-Gries summaries, counted exactly in a second pass.

First pass: every block of texts gives a summary of its phrases of one to four
words, divided by hash partition. Summaries of a partition are merged; beyond
its capacity a summary takes its next largest counter off all counters. The
capacity exceeds the partition's mass divided by the threshold, so the error
stays below the threshold and every frequent phrase survives, however the
summaries came together. Second pass: texts are read again and phrases whose
digest survived are counted by their words, exactly.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estatelake.llm.common import in_order, scratch, small_batches, stored, text_of, width_of

THRESHOLD = 30
LONGEST = 4
TOP = 2000
#: Share of a part, in hundredths, that a longer candidate must reach to stand for it.
COVERED = 80
SCALE = 2_000_000
UNKNOWN = "und"

#: Bytes of text whose words a task holds at once; longer texts are cut between pieces.
BLOCK_BYTES = 2 << 20
#: Entries that a task puts together before it hands out their summaries.
HELD = 1 << 22
#: Bytes of text per hash partition, which bound a summary's memory.
PARTITION_BYTES = 64 << 20
#: Counters of a summary as a multiple of mass / threshold: the error is at most threshold / ROOM.
ROOM = 2
#: Entries of one row of a block's summary.
ENTRIES = 1 << 14
#: Bits per survivor in the table that the second pass reads, and at most (64 MB). A fuller
#: table lets more phrases through to the exact count, which drops them.
BITS_EACH, MOST_BITS, SLICE = 16, 1 << 29, 1 << 20

_BREAK = re.compile(r"[.,;:!?\x0a-\x0d]")
_BYTES = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\x0d\t", b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 9 + b" ")


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits in which every bit depends on all others."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Block:
    """The words of some texts: their numbers, pieces and languages, and phrases by digest."""

    def __init__(self, texts: list[str], langs: list[str]):
        import xxhash

        coded = [t.encode() for t in texts]
        data = b"\n".join(coded).translate(_BYTES)
        letters = np.frombuffer(data, np.uint8)
        ends = letters == 10
        gap = ends | (letters == 32)
        starts = np.flatnonzero(~gap & np.concatenate([[True], gap[:-1]])[: len(gap)])
        self.words = data.split()  # only spaces and line ends are left
        self.piece = np.cumsum(ends, dtype=np.int32)[starts]
        text_starts = np.cumsum([0, *(len(c) + 1 for c in coded)])[:-1]
        self.langs = sorted(set(langs))
        number = {name: i for i, name in enumerate(self.langs)}
        text = np.searchsorted(text_starts, starts, "right") - 1
        self.lang = np.array([number[x] for x in langs], np.int32)[text]
        coded_words = pa.array(self.words, pa.binary()).dictionary_encode()
        self.ids = coded_words.indices.to_numpy(zero_copy_only=False)
        digests = np.array([xxhash.xxh64_intdigest(w) for w in coded_words.dictionary.to_pylist()], np.uint64)
        spoken = np.array([xxhash.xxh64_intdigest(x.encode(), 1) for x in self.langs], np.uint64)
        self.digest = digests[self.ids]
        self.seed = spoken[self.lang]

    def phrases(self, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Per number of words: it, the phrases' first words and their digests, which cover the language."""
        at, key = np.arange(len(self.words), dtype=np.int32), mixed(self.digest ^ self.seed)
        for size in range(1, longest + 1):
            if size > 1:
                whole = at + size - 1 < len(self.words)
                at, key = at[whole], key[whole]
                whole = self.piece[at] == self.piece[at + size - 1]
                at, key = at[whole], key[whole]
                key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + self.digest[at + size - 1])
            yield size, at, key


def cut(text: str, size: int) -> Iterator[str]:
    """A text in parts of about ``size`` characters, cut where a piece ends; a longer piece stays whole."""
    start = 0
    while len(text) - start > size and (mark := _BREAK.search(text, start + size)):
        yield text[start : mark.start()]
        start = mark.end()
    yield text[start:]


def blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[Block]:
    """Blocks of the rows ``text`` and ``lang``."""
    texts, langs, held = [], [], 0
    for batch in batches:
        for text, lang in zip(batch["text"].to_pylist(), batch["lang"].to_pylist(), strict=True):
            for part in cut(text, size):
                texts.append(part)
                langs.append(lang)
                held += len(part) + 1
                if held > size:
                    yield Block(texts, langs)
                    texts, langs, held = [], [], 0
    if texts:
        yield Block(texts, langs)


def counted(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Different keys in order, with their summed counts (of one each without ``counts``)."""
    if counts is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[: len(keys)])
    if not len(first):
        return keys, np.empty(0, np.int64)
    sums = np.diff(np.append(first, len(keys))) if counts is None else np.add.reduceat(counts, first)
    return keys[first], sums


def together(some: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = zip(*some, strict=True)
    return counted(np.concatenate(keys), np.concatenate(counts))


class Summary:
    """A Misra-Gries summary of bounded size; others are merged into it."""

    def __init__(self, capacity: int):
        self.capacity, self.error = capacity, 0
        self.keys, self.counts = np.empty(0, np.uint32), np.empty(0, np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def merge(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.waiting.append((keys, counts))
        self.held += len(keys)
        if self.held > max(self.capacity, 1 << 16):
            self.settle()

    def settle(self) -> None:
        """Add up what waits; beyond the capacity the next largest counter is taken off all of them."""
        if self.waiting:
            self.keys, self.counts = together([(self.keys, self.counts), *self.waiting])
            self.waiting, self.held = [], 0
        over = len(self.keys) - self.capacity
        if over > 0:
            least = int(np.partition(self.counts, over - 1)[over - 1])
            left = self.counts > least
            self.keys, self.counts = self.keys[left], self.counts[left] - least
            self.error += least

    def survivors(self, threshold: int) -> np.ndarray:
        """All keys that may have been merged ``threshold`` times or more."""
        self.settle()
        return self.keys[self.counts >= threshold - self.error]


def summarised(longest: int, bits: int, size: int):
    """Rows of a block's summary per hash partition: first the mass, then entries.

    A key is a digest's upper bits: ``bits`` name the partition, 32 more stand in
    the row. Keys that meet add up, so none is lost. Keys seen once come first,
    ``counts`` belong to the others.
    """

    def rows_of(keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        short = ((keys << np.uint64(bits)) >> np.uint64(32)).astype("<u4")
        bounds = np.searchsorted(keys, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits))
        bounds = np.append(bounds, len(keys))
        for part in np.flatnonzero(np.diff(bounds)).tolist():
            rows = {"part": [part], "kind": [0], "mass": [0], "keys": [b""], "counts": [b""]}
            for a in range(bounds[part], bounds[part + 1], ENTRIES):
                some = slice(a, min(a + ENTRIES, bounds[part + 1]))
                often = counts[some] > 1
                rows["mass"][0] += int(counts[some].sum())
                row = (part, 1, 0, np.concatenate([short[some][~often], short[some][often]]).tobytes(),
                       counts[some][often].astype("<u4").tobytes())
                for name, value in zip(rows, row, strict=True):
                    rows[name].append(value)
            yield pa.RecordBatch.from_pydict(rows, pa.schema(
                [("part", pa.int32()), ("kind", pa.int32()), ("mass", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())]
            ))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for block in blocks(batches, size):
            held.append(counted(np.concatenate([key for _, _, key in block.phrases(longest)])))
            n += len(held[-1][0])
            if n > HELD:
                yield from rows_of(*together(held))
                held, n = [], 0
        if held:
            yield from rows_of(*together(held))

    return run


def merged(threshold: int, room: int):
    """Rows sorted by partition and kind to the keys that survive in each partition."""

    def done(part: int, summary: Summary) -> pa.RecordBatch:
        keys = summary.survivors(threshold)
        cuts = [keys[a : a + ENTRIES].tobytes() for a in range(0, len(keys), ENTRIES)]
        return pa.RecordBatch.from_pydict(
            {"part": [part] * len(cuts), "keys": cuts}, pa.schema([("part", pa.int32()), ("keys", pa.binary())])
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, mass, summary = None, 0, None
        for batch in batches:
            columns = (batch["part"].to_pylist(), batch["mass"].to_pylist(), batch["kind"].to_pylist(), batch["keys"], batch["counts"])
            for part, some, kind, keys, counts in zip(*columns, strict=True):
                if part != now:
                    if summary:
                        yield done(now, summary)
                    now, mass, summary = part, 0, None
                if kind == 0:
                    mass += some
                    continue
                summary = summary or Summary(room * mass // threshold + 1)
                key, often = np.frombuffer(keys.as_py(), "<u4"), np.frombuffer(counts.as_py(), "<u4")
                summary.merge(key, np.concatenate([np.ones(len(key) - len(often), np.int64), often.astype(np.int64)]))
        if summary:
            yield done(now, summary)

    return run


class BitTable:
    """Bits of the surviving keys; a key that is not in it did not survive."""

    def __init__(self, table: np.ndarray, bits: int):
        self.table, self.bits = table, bits

    @staticmethod
    def places(keys: np.ndarray, size: int) -> Iterator[np.ndarray]:
        """Three places of every key in a table of ``size`` bits, a power of two."""
        word = mixed(keys + np.uint64(1))
        for turn in range(3):
            yield (word >> np.uint64(turn * 17)) & np.uint64(size - 1) if turn < 2 else mixed(word) & np.uint64(size - 1)

    def holds(self, digests: np.ndarray) -> np.ndarray:
        """Which digests the table holds, as positions."""
        left = np.arange(len(digests))
        for places in self.places(digests >> np.uint64(32 - self.bits), len(self.table) * 8):
            places = places[left]
            left = left[(self.table[places >> np.uint64(3)] >> (places & np.uint64(7)).astype(np.uint8)) & 1 == 1]
        return left


def bit_table(survivors: DataFrame, bits: int) -> BitTable:
    """The survivors' table, of a size measured by their number and bounded by MOST_BITS."""
    n = survivors.agg(F.coalesce(F.sum(F.octet_length("keys") / 4), F.lit(0)).cast("long")).first()[0]
    size = min(MOST_BITS, max(1 << 10, 1 << (n * BITS_EACH - 1).bit_length())) if n else 1 << 10
    span = min(size, SLICE)

    def placed(batches):
        for batch in batches:
            for part, keys in zip(batch["part"].to_pylist(), batch["keys"].to_pylist(), strict=True):
                keys = np.frombuffer(keys, "<u4").astype(np.uint64) | (np.uint64(part) << np.uint64(32))
                places = np.unique(np.concatenate(list(BitTable.places(keys, size))))
                slices, first = np.unique(places // np.uint64(span), return_index=True)
                cuts = np.split((places % np.uint64(span)).astype("<u4"), first[1:])
                yield pa.RecordBatch.from_pydict(
                    {"slice": slices.astype(np.int32), "places": [c.tobytes() for c in cuts]},
                    pa.schema([("slice", pa.int32()), ("places", pa.binary())]),
                )

    def set_bits(batches):
        bits, now = None, None
        for batch in batches:
            for number, places in zip(batch["slice"].to_pylist(), batch["places"].to_pylist(), strict=True):
                if number != now:
                    if bits is not None:
                        yield row(now, bits)
                    bits, now = np.zeros(span, np.uint8), number
                bits[np.frombuffer(places, "<u4")] = 1
        if bits is not None:
            yield row(now, bits)

    def row(number, bits):
        return pa.RecordBatch.from_pydict(
            {"slice": [number], "bits": [np.packbits(bits, bitorder="little").tobytes()]},
            pa.schema([("slice", pa.int32()), ("bits", pa.binary())]),
        )

    rows = survivors.mapInArrow(placed, "slice int, places binary").repartition("slice").sortWithinPartitions("slice")
    table = np.zeros(size // 8, np.uint8)
    for number, part in rows.mapInArrow(set_bits, "slice int, bits binary").collect():  # MOST_BITS / 8 bytes at most
        table[number * span // 8 : (number + 1) * span // 8] = np.frombuffer(part, np.uint8)
    return BitTable(table, bits)


def phrase_rows(block: Block, table: BitTable, longest: int) -> dict[str, list]:
    """Counts of a block's phrases that the table holds, by their words; size 0 holds a language's words."""
    sizes, starts, keys = [], [], []
    for size, at, key in block.phrases(longest):
        some = table.holds(key)
        sizes.append(np.full(len(some), size, np.int8))
        starts.append(at[some])
        keys.append(key[some])
    size, start, key = np.concatenate(sizes), np.concatenate(starts), np.concatenate(keys)
    order = np.argsort(key, kind="stable")
    size, start, key = size[order], start[order], key[order]
    new = np.concatenate([[True], key[1:] != key[:-1]])[: len(key)]
    # Phrases of one digest that are not the same words are counted by themselves.
    lead = np.maximum.accumulate(np.where(new, np.arange(len(key)), 0)) if len(key) else np.empty(0, np.int64)
    del key, order
    same = (size == size[lead]) & (block.lang[start] == block.lang[start[lead]])
    last = len(block.ids) - 1
    for j in range(longest):
        inside = j < size
        same &= ~inside | (block.ids[np.minimum(start + j, last)] == block.ids[np.minimum(start[lead] + j, last)])
    first = np.flatnonzero(new)
    counts = np.add.reduceat(same.astype(np.int64), first) if len(first) else np.empty(0, np.int64)
    other = np.flatnonzero(~same)
    first, counts = np.concatenate([first, other]), np.concatenate([counts, np.ones(len(other), np.int64)])
    spoken = np.bincount(block.lang, minlength=len(block.langs)).tolist()
    a, n = start[first].tolist(), size[first].tolist()
    return {
        "lang": [*block.langs, *(block.langs[i] for i in block.lang[start[first]].tolist())],
        "size": [0] * len(spoken) + n,
        "phrase": [b"", *[b""] * (len(spoken) - 1), *(b" ".join(block.words[i : i + k]) for i, k in zip(a, n, strict=True))],
        "count": spoken + counts.tolist(),
    }


def frequent_phrases(
    docs: DataFrame, folder: str, threshold: int = THRESHOLD, longest: int = LONGEST,
    text_col: str = "text", lang_col: str = "lang", block_bytes: int = BLOCK_BYTES,
    partition_bytes: int = PARTITION_BYTES, room: int = ROOM,
) -> DataFrame:
    """Exact counts (lang, size, phrase, f) of all phrases of up to ``longest`` words with f >= threshold.

    Size 0 is a language's number of words. A null language is ``und``, a null text
    empty. Rows that repeat count each time. Other columns are not read. The result
    is a stored table; an empty one, or one without words, has no phrases.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(text_of(text_col).alias("text"), F.coalesce(F.col(lang_col), F.lit(UNKNOWN)).alias("lang"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(4 * width_of(docs.sparkSession), -(-size // partition_bytes))
    bits = min((parts - 1).bit_length(), 24)
    summaries = rows.mapInArrow(
        summarised(longest, bits, block_bytes), "part int, kind int, mass long, keys binary, counts binary"
    )
    ordered = summaries.repartition(1 << bits, "part").sortWithinPartitions("part", "kind")
    survivors = stored(ordered.mapInArrow(merged(threshold, room), "part int, keys binary"), f"{folder}/survivors")
    table = docs.sparkSession.sparkContext.broadcast(bit_table(survivors, bits))

    def exact(batches):
        for block in blocks(batches, block_bytes):
            found = phrase_rows(block, table.value, longest)
            names = pa.array(found["phrase"], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(found["lang"], pa.string()), pa.array(found["size"], pa.int32()), names, pa.array(found["count"], pa.int64())],
                ["lang", "size", "phrase", "n"],
            )

    counts = rows.mapInArrow(exact, "lang string, size int, phrase string, n long")
    total = counts.groupBy("lang", "size", "phrase").agg(F.sum("n").alias("f"))
    return stored(total.where(F.col("f") >= F.when(F.col("size") == 0, 1).otherwise(threshold)), f"{folder}/frequent")


def part(first: int | Column, count: int | Column) -> Column:
    """Words of ``_words`` put together, from the ``first`` one (from 1)."""
    return F.array_join(F.slice("_words", first, count), " ")


def parts_of(n: int) -> Column:
    """All phrases of ``n`` words inside a longer phrase."""
    some = F.transform(F.sequence(F.lit(1), F.col("size") - n + 1), lambda i: part(i, F.lit(n)))
    return F.when(F.col("size") > n, some).otherwise(F.array().cast("array<string>"))


def score_of(a: str, both: str) -> Column:
    """floor(SCALE * a / both), exact beyond 64 bits."""
    return F.expr(f"(CAST({SCALE} AS DECIMAL(18,0)) * CAST({a} AS DECIMAL(19,0))) div CAST({both} AS DECIMAL(20,0))")


def collocations(
    docs: DataFrame, folder: str | None = None, threshold: int = THRESHOLD, longest: int = LONGEST,
    top: int = TOP, covered: int = COVERED, **how,
) -> DataFrame:
    """The best phrases of every language: lang, rank, phrase, a, l, r, n, score.

    A candidate has two to ``longest`` words and a >= threshold occurrences. Of its
    cuts into two phrases with l and r occurrences the one with the lowest score
    counts, of equal ones the first. Candidates that lie inside a longer candidate
    with at least ``covered`` hundredths of their occurrences go. Ranks go by score
    and a, descending, then by the phrase's bytes. Languages without candidates
    have no rows.
    """
    folder = folder or scratch(docs.sparkSession, "collocations")
    found = frequent_phrases(docs, folder, threshold, longest, **how)
    words = F.split("phrase", " ")
    known = found.where("size > 0").select("lang", "phrase", "f")
    candidates = found.where("size > 1").select("lang", "phrase", "size", F.col("f").alias("a"), words.alias("_words"))
    cut_at = F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")
    cuts = candidates.select("*", cut_at).select(
        "lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("_first"), part(F.col("k") + 1, F.col("size") - F.col("k")).alias("_rest")
    )
    # Both parts of a candidate occur at least as often, so they are known.
    lefts = known.select("lang", F.col("phrase").alias("_first"), F.col("f").alias("l"))
    rights = known.select("lang", F.col("phrase").alias("_rest"), F.col("f").alias("r"))
    scored = (
        cuts.join(lefts, ["lang", "_first"]).join(rights, ["lang", "_rest"])
        .withColumn("score", score_of("a", "l + r"))
        .groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("_cut"))
    )
    inner = F.flatten(F.array(*[parts_of(n) for n in range(2, longest)] or [F.array().cast("array<string>")]))
    longer = candidates.select("lang", F.explode(inner).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("_longer"))
    left = scored.join(longer, ["lang", "phrase"], "left").where(
        F.expr(f"_longer IS NULL OR CAST(_longer AS DECIMAL(19,0)) * 100 < CAST(a AS DECIMAL(19,0)) * {covered}")
    )
    down = [(-F.col(c)).alias(f"_{c}") for c in ("score", "a")]
    ranked = in_order(
        left.select("lang", "phrase", "a", "_cut.l", "_cut.r", "_cut.score").select("*", *down),
        "lang", ["_score", "_a", "phrase"], f"{folder}/ranks",
    ).where(F.col("rank") < top).drop("n")
    spoken = found.where("size = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(spoken, "lang").select(
        "lang", (F.col("rank") + 1).alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score")
    )
