"""SimHash near-duplicates through an inverted index of positional bytes.

A fingerprint has eight bytes. Fingerprints that differ in at most three bits
differ in at most three bytes, so they share at least five bytes at their
positions: that is the guaranteed minimum of the count filter. Of five shared
positions, three lie in the same half of the fingerprint, so the index lists
each fingerprint under the eight triples of positional bytes within its halves.
Within a list, shared positional bytes are tallied per pair, pairs that reach
the minimum are verified bit by bit, and only a forest of the links leaves the
task. A list of very many fingerprints is listed again under five positional
bytes, which leaves 24 free bits and so bounds a list whatever the corpus.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelake.llm.common import scratch, small_batches, stored, text_of, unused
from estatelake.llm.components import components

BITS = 3
SHARED_BYTES = 5
TRIPLES = [*combinations(range(4), 3), *combinations(range(4, 8), 3)]
#: Fingerprints of one list that are tallied pair by pair; longer lists are split once more.
LIST_PAIRS = 1024
NO_ID = (1 << 63) - 1


def shingles(text: str, words: int) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The text with A-Z lower-cased and single spaces, and where its shingles begin and end."""
    tokens = text.encode().lower().split()
    joined = b" ".join(tokens)
    lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    if len(tokens) > words:
        return joined, starts[: len(tokens) - words + 1], ends[words - 1 :]
    return joined, starts[:1], ends[-1:]


def shingle_hashes(text: str, words: int, seed: int = 42) -> np.ndarray:
    import xxhash

    joined, starts, ends = shingles(text, words)
    one = xxhash.xxh64_intdigest
    return np.array(
        [one(joined[a:b], seed) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], dtype=np.uint64
    )


def fingerprint(text: str, words: int = 3, seed: int = 42) -> int:
    """64 bits: each set if over half of the shingles' hashes have it; zero without words."""
    hashes = shingle_hashes(text, words, seed)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 14):
        part = hashes[i : i + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_key (of the exact text) and fp (as a signed long); a null text is empty."""
    small_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            fps = np.array([fingerprint(t, words) for t in batch.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(fps.view(np.int64))],
                ["doc_id", "text_key", "fp"],
            )

    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_of(text_col)).alias("text_key"),
        text_of(text_col).alias("text"),
    )
    return rows.mapInArrow(run, "doc_id long, text_key long, fp long")


def index_keys(fps: np.ndarray, subsets: list[tuple[int, ...]]) -> np.ndarray:
    """For each fingerprint and subset of byte positions: those bytes, and which subset, as one number."""
    raw = fps.view(np.uint64).astype("<u8").view(np.uint8).reshape(-1, 8).astype(np.int64)
    keys = [sum(raw[:, p] << (8 * i) for i, p in enumerate(s)) + (n << 40) for n, s in enumerate(subsets)]
    return np.stack(keys, axis=1)


def linked_pairs(fps: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Positions of pairs within ``bits`` bits: tally shared positional bytes, then verify."""
    fps, found = fps.view(np.uint64), []
    for i in range(0, len(fps), 128):
        apart = fps[i : i + 128, None] ^ fps[None, :]
        tally = (apart.view(np.uint8).reshape(*apart.shape, 8) == 0).sum(axis=2)
        a, b = np.nonzero(tally >= 8 - bits)
        near = (np.bitwise_count(apart[a, b]) <= bits) & (a + i < b)
        found.append((a[near] + i, b[near]))
    return np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found])


def near_masks(bits: int = BITS, free: int = 24) -> np.ndarray:
    """All patterns of one to ``bits`` set bits among ``free``."""
    return np.array([sum(1 << b for b in c) for n in range(1, bits + 1) for c in combinations(range(free), n)])


def forest(count: int, pairs) -> np.ndarray:
    """Least position linked with each position; ``pairs()`` yields arrays of links."""
    label = np.arange(count)
    changed = True
    while changed:
        before = label.copy()
        for a, b in pairs():
            low = np.minimum(label[a], label[b])
            np.minimum.at(label, a, low)
            np.minimum.at(label, b, low)
        label = label[label]
        changed = (label != before).any()
    return label


def links_in(fps: np.ndarray, bits: int = BITS, most: int = LIST_PAIRS) -> tuple[np.ndarray, np.ndarray]:
    """A forest of the links among the distinct fingerprints of one list of five shared bytes."""
    if len(fps) <= 4 * most:
        a, b = linked_pairs(fps, bits)
        label = forest(len(fps), lambda: [(a, b)])
    else:
        varying = np.bitwise_or.reduce(fps.view(np.uint64) ^ fps.view(np.uint64)[0])
        spots = [b for b in range(64) if int(varying) >> b & 1]
        small = sum(((fps.view(np.uint64) >> np.uint64(b)) & np.uint64(1)).astype(np.int64) << i for i, b in enumerate(spots))
        order = np.argsort(small)
        ordered = small[order]

        def pairs():
            for mask in near_masks(bits, len(spots)):
                other = ordered ^ mask
                at = np.minimum(np.searchsorted(ordered, other), len(ordered) - 1)
                hit = ordered[at] == other
                yield order[np.flatnonzero(hit)], order[at[hit]]

        label = forest(len(fps), pairs)
    own = np.flatnonzero(label != np.arange(len(fps)))
    return own, label[own]


POSTING = "key long, fp long, rep long"
EDGE = "key long, fp long, rep long, other_fp long, other_rep long"


def _postings(classes: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            fps = batch.column("fp").to_numpy(zero_copy_only=False)
            keys = index_keys(fps, TRIPLES)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.ravel()), pa.array(np.repeat(fps, len(TRIPLES))),
                 pa.array(np.repeat(batch.column("rep").to_numpy(zero_copy_only=False), len(TRIPLES)))],
                ["key", "fp", "rep"],
            )

    return classes.mapInArrow(run, POSTING)


def _links(postings: DataFrame, bits: int, most: int | None) -> DataFrame:
    """Links of each list of the index, which arrives in key order, row by row.

    A row of another key than null is a posting of a list longer than ``most``,
    under five positional bytes; the others are links. Without ``most`` every
    list is taken whole: five shared bytes leave at most 2**24 fingerprints.
    """
    fives = {
        t: [c for c in combinations(range(8), SHARED_BYTES) if set(t) <= set(c)] for t in TRIPLES
    }
    number = {c: i for i, c in enumerate(combinations(range(8), SHARED_BYTES))}

    def run(batches):
        key, fps, reps, many = None, [], [], 0

        def close():
            nonlocal fps, reps, many
            out = None
            if many > 1:
                f, r = np.concatenate(fps), np.concatenate(reps)
                own, other = links_in(f, bits)
                if len(own):
                    out = edges(None, f[own], r[own], f[other], r[other])
            fps, reps, many = [], [], 0
            return out

        def edges(keys, *columns):
            n = len(columns[0])
            first = pa.nulls(n, pa.int64()) if keys is None else pa.array(keys)
            rest = [pa.array(c) if c is not None else pa.nulls(n, pa.int64()) for c in columns]
            return pa.RecordBatch.from_arrays([first, *rest], ["key", "fp", "rep", "other_fp", "other_rep"])

        def again():
            """What is held goes to the lists of five bytes."""
            nonlocal fps, reps, many
            f, r = np.concatenate(fps), np.concatenate(reps)
            subsets = fives[TRIPLES[int(key) >> 40]]
            keys = index_keys(f, subsets) & ((1 << 40) - 1)
            keys = keys + (np.array([number[s] for s in subsets], np.int64) << 40)
            fps, reps, many = [], [], 0
            return edges(keys.ravel(), np.repeat(f, len(subsets)), np.repeat(r, len(subsets)), None, None)

        long = False
        for batch in batches:
            keys, f, r = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            if not len(keys):
                continue
            cuts = np.flatnonzero(np.diff(keys)) + 1
            starts, stops = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(keys)]])
            # Lists of one fingerprint inside a batch need no look.
            look = (stops - starts > 1) | (starts == 0) | (stops == len(keys))
            for a, b in zip(starts[look].tolist(), stops[look].tolist(), strict=True):
                if keys[a] != key:
                    if long and many:
                        yield again()
                    elif (made := close()) is not None:
                        yield made
                    key, long, fps, reps, many = keys[a], False, [], [], 0
                fps.append(f[a:b])
                reps.append(r[a:b])
                many += b - a
                if most and many > most:
                    long = True
                    yield again()
        if long and many:
            yield again()
        elif (made := close()) is not None:
            yield made

    return postings.repartition("key").sortWithinPartitions("key", "fp").mapInArrow(run, EDGE)


def near_duplicates(
    docs: DataFrame, folder: str | None = None, words: int = 3, bits: int = BITS, id_col: str = "doc_id",
    text_col: str = "text", list_pairs: int = LIST_PAIRS,
) -> DataFrame:
    """One row per input row: doc_id, text_key, fp (signed long), component_id.

    Documents whose fingerprints differ in at most ``bits`` (up to 3) bits are
    linked; ``component_id`` is the smallest id reachable over links. A null
    text is empty; texts without words have fingerprint zero and are linked like
    any other. Null ids count as larger than all; a component of null ids has a
    null id. Rows may repeat. Other columns are ignored.
    """
    if not 0 <= bits <= BITS:
        raise ValueError(f"bits must be 0 to {BITS}: the index guarantees {SHARED_BYTES} shared bytes")
    spark = docs.sparkSession
    folder = folder or scratch(spark, "simhash")
    prints = stored(fingerprints(docs, words, id_col, text_col), f"{folder}/prints")
    classes = stored(
        prints.groupBy("fp").agg(F.coalesce(F.min("doc_id"), F.lit(NO_ID)).alias("rep")), f"{folder}/classes"
    )
    first = stored(_links(_postings(classes), bits, list_pairs), f"{folder}/links")
    links = first.where("key IS NULL")
    long = first.where("key IS NOT NULL").distinct()
    if not long.isEmpty():
        links = links.unionByName(_links(long.select("key", "fp", "rep"), bits, None))
    edges = links.select(
        F.struct("rep", "fp").alias("a"),
        F.struct(F.col("other_rep").alias("rep"), F.col("other_fp").alias("fp")).alias("b"),
    )
    roots = components(edges, folder).select(
        F.col("node")["fp"].alias("fp"), F.col("root")["rep"].alias("root")
    )
    # Stored, so that both sides of the last join are shuffled for it and a hot fingerprint can be split.
    named = stored(
        classes.join(roots.hint("merge"), "fp", "left").select(
            "fp", F.nullif(F.coalesce("root", "rep"), F.lit(NO_ID)).alias("component_id")
        ),
        f"{folder}/components",
    )
    return prints.join(named.hint("merge"), "fp").select("doc_id", "text_key", "fp", "component_id")


_DRAW = np.random.Generator(np.random.PCG64(20240301))
_TURN = _DRAW.integers(0, 1 << 64, 64, np.uint64)
_FACTOR = _DRAW.integers(0, 1 << 64, 64, np.uint64) | np.uint64(1)


def minima(hashes: np.ndarray, count: int) -> np.ndarray:
    """The least value of a set of u64 under each of ``count`` (up to 64) orders."""
    least = np.full(count, (1 << 64) - 1, np.uint64)
    for i in range(0, len(hashes), 1 << 12):
        part = (hashes[i : i + (1 << 12), None] ^ _TURN[:count]) * _FACTOR[:count]
        np.minimum(least, ((part ^ (part >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)).min(axis=0), out=least)
    return least


def one_per_group(
    docs: DataFrame, folder: str | None = None, words: int = 3, bits: int = BITS, id_col: str = "doc_id",
    text_col: str = "text", list_pairs: int = LIST_PAIRS,
) -> DataFrame:
    """The rows with all their columns; of each component of ``near_duplicates`` one document stays, the smallest id.

    Rows that repeat an id are one document and stay or go together where their
    texts are of one component. Rows of a null id stay unless a document of
    their component has an id. Whole rows move once, against the ids that go.
    """
    folder = folder or scratch(docs.sparkSession, "one-per-group")
    id_, key = unused(docs, "_id", "_key")
    groups = near_duplicates(docs, f"{folder}/groups", words, bits, id_col, text_col, list_pairs)
    goes = F.col("component_id").isNotNull() & ~F.col("doc_id").eqNullSafe(F.col("component_id"))
    gone = groups.where(goes).select(F.coalesce("doc_id", F.lit(NO_ID)).alias(id_), F.col("text_key").alias(key)).distinct()
    keyed = docs.withColumns({id_: F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)), key: F.xxhash64(text_of(text_col))})
    return keyed.join(stored(gone, f"{folder}/gone").hint("merge"), [id_, key], "left_anti").select(*docs.columns)


def hex_digits(fp: str = "fp"):
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))
