"""Line dedup: an exact set-similarity join of lines, after which later matches go.

A line is the set of its words. Words have one global order, rarest first, from
counts over all documents; a word that occurs once is in no list. Two lines of a Jaccard similarity of at least t share
a word among their first |x| - ceil(t |x|) + 1 words, so lines are listed under
these (prefix filter). Within a list, pairs must have fitting sizes (length
filter), enough words left behind the shared one (positional filter) and
signatures that do not differ in more words than they may (each word turns one
bit of 64, 128 or 256, by the length of the line). What is left is verified on
the whole sets. Entries move many to a row, as arrays; lists that share a row's
part are told apart by sorting where they are paired.

Equal sets are one class from the start, so a line that a third of all documents
repeat is one entry. Only the earliest candidates of a class travel to the
verification; where they fail and there were more, all of them are tried.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelake.llm.common import scratch, small_batches, stored, text_of, unused, width_of

SIMILARITY = 0.8
#: Words are counted in this many buckets, of which a table keeps one byte each (16 MB). Words that
#: share a bucket count together: that may order them worse, it never changes a result.
BUCKETS = 1 << 24
#: Words that a task counts before it hands out its counts.
COUNTED = 1 << 21
#: Buckets of one row of the table.
SLICE = 1 << 16
#: Candidates of a class under one word that are tried, round by round: the earliest, more of them, all.
TRIES = (3, 48, None)
#: Entries of a list that one task pairs; longer lists are cut into blocks that meet in pairs.
LIST = 8192
#: Entries that a task deals out at once and that a part has or somewhat more, and at most so many in one row.
DEALT, ROW = 1 << 19, 512
#: Parts that small tables are cut into, at most.
PARTS = 256
#: Entries that a task pairs at once, or the whole of a part, and pairs that are filtered at once.
AT_ONCE, PAIRS = 1 << 17, 1 << 17
#: Lines that are looked for by a broadcast of their documents, at most.
FEW = 1 << 20
#: Bits per row of a bit table, and its words of 64 bits at least and at most (32 MB).
BITS_EACH, LEAST_WORDS, MOST_WORDS = 16, 1 << 14, 1 << 22
NO_ID = (1 << 63) - 1
#: Lines of fewer than NARROW words have a signature of 64 bits, of fewer than WIDE one of 128, others
#: one of 256. Halves put together by exclusive or are the next shorter one.
NARROW, WIDE = 32, 128


def signature_words(n: np.ndarray) -> np.ndarray:
    return np.where(n < NARROW, 1, np.where(n < WIDE, 2, 4))


def signatures_of(flat: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Four words for each signature, of which shorter ones leave the last ones zero."""
    out = np.zeros((len(n), 4), np.uint64)
    out[np.arange(4) < signature_words(n)[:, None]] = flat
    return out


def planes(x: np.ndarray) -> bytes:
    """All lowest bytes, then all second ones and so on: the upper bytes of small numbers take no room when compressed."""
    return np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()


def from_planes(data: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.frombuffer(data, np.uint8).reshape(size, -1).T.copy().view(kind).ravel()


def binary(data: np.ndarray, count: np.ndarray) -> pa.Array:
    """``count`` numbers of ``data`` for each row."""
    offsets = np.concatenate([[0], np.cumsum(count)]) * data.itemsize
    return pa.Array.from_buffers(
        pa.binary(), len(count), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)]
    )


def stir(x: np.ndarray, factor: int) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(factor)
    return x ^ (x >> np.uint64(29))


def words_of(line: str) -> list[bytes]:
    return line.encode().lower().split()


#: Bytes of text that are taken apart at once: few enough for their arrays to stay in a core's cache.
CHUNK = 1 << 18
#: The lower 0 to 8 bytes of a number.
BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def chunks_of(texts: list[str]):
    """Lists of (text number, number of its first line here, lines): no list has more than a line beyond CHUNK."""
    held, size = [], 0
    for number, text in enumerate(texts):
        parts = [text] if len(text) <= CHUNK else text.split("\n")
        line = 0
        for part in parts:
            if held and size + len(part) > CHUNK:
                yield held
                held, size = [], 0
            held.append((number, line, part))
            size += len(part)
            line += 1
    if held:
        yield held


class LineSets:
    """The lines with words of some pieces of text, as sorted sets of word hashes.

    A word's hash is the sum of its stirred blocks of eight bytes, each times a
    number per place, and of its length, in 64 bits and then stirred; so all words
    of all pieces are hashed at once.
    """

    def __init__(self, pieces: list[tuple[int, int, str]], levels: np.ndarray | None):
        # A blank before and nine behind: every word has two edges, and eight bytes can be read at any of its letters.
        data = np.frombuffer(b" " + "\n".join(p[2] for p in pieces).encode().lower() + b" " * 9, np.uint8)
        text = data[:-8]
        blank = (text == 32) | (text - np.uint8(9) < 5)
        edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
        begin, length = edge[::2], edge[1::2] - edge[::2]
        blocks = (length + 7) >> 3
        offsets = np.cumsum(blocks) - blocks
        place = np.arange(int(blocks.sum())) - np.repeat(offsets, blocks)
        eight = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))[np.repeat(begin, blocks) + 8 * place]
        eight &= BYTES[np.minimum(8, np.repeat(length, blocks) - 8 * place)]
        places = stir(np.arange(1, int(blocks.max(initial=0)) + 2, dtype=np.uint64), 0xC2B2AE3D27D4EB4F) | np.uint64(1)
        values = stir(eight, 0x9E3779B97F4A7C15) * places[place]
        every = np.empty(0, np.uint64)
        if len(begin):
            sizes = length.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            every = stir(np.add.reduceat(values, offsets) + sizes, 0xFF51AFD7ED558CCD)
        if levels is None:
            self.ids = every
            return
        ends = np.concatenate([np.searchsorted(begin, np.flatnonzero(text == 10)), [len(begin)]])
        words = np.diff(ends, prepend=0)
        used = np.flatnonzero(words)
        at = np.repeat(np.arange(len(used)), words[used])
        many = np.array([p[2].count("\n") + 1 for p in pieces])
        first = np.cumsum(many) - many
        piece = np.searchsorted(first, used, side="right") - 1
        self.doc = np.array([p[0] for p in pieces], np.int64)[piece]
        self.line = (np.array([p[1] for p in pieces], np.int64)[piece] + used - first[piece]).astype(np.int32)
        # Line, level and the upper bits of the word in one key; the rest of the word breaks ties.
        level = levels[(every & np.uint64(BUCKETS - 1)).astype(np.int64)]
        key = (at.astype(np.uint64) << np.uint64(42)) | (level.astype(np.uint64) << np.uint64(34)) | (every >> np.uint64(30))
        order = np.argsort(key)
        ordered, ids = key[order], every[order]
        if ((ordered[1:] == ordered[:-1]) & (ids[1:] != ids[:-1])).any():
            order = np.lexsort((every, key))
        every, at, level = every[order], at[order], level[order]
        new = np.ones(len(every), bool)
        new[1:] = (every[1:] != every[:-1]) | (at[1:] != at[:-1])
        self.ids, at = every[new], at[new]
        self.n = np.bincount(at, minlength=len(used))
        self.start = np.cumsum(self.n) - self.n
        # Words that occur once anywhere stand first.
        self.alone = np.bincount(at[level[new] == 0], minlength=len(used))
        if len(used):
            self.k1 = np.add.reduceat(stir(self.ids, 0x9E3779B97F4A7C15), self.start).view(np.int64)
            self.k2 = np.bitwise_xor.reduceat(stir(self.ids, 0xC2B2AE3D27D4EB4F), self.start).view(np.int64)
            mixed = stir(self.ids, 0xFF51AFD7ED558CCD)
            bit = np.uint64(1) << (mixed >> np.uint64(58))
            quarter = (mixed >> np.uint64(56)) & np.uint64(3)
            four = [np.bitwise_xor.reduceat(np.where(quarter == q, bit, np.uint64(0)), self.start) for q in range(4)]
            two, zero = [four[0] ^ four[2], four[1] ^ four[3]], np.zeros(len(self.n), np.uint64)
            size = signature_words(self.n)
            short = [two[0] ^ two[1], zero, zero, zero]
            by_size = [np.choose(size // 2, x) for x in zip(short, [*two, zero, zero], four, strict=True)]
            self.signature = np.stack(by_size, 1)[np.arange(4) < size[:, None]]
        else:
            self.k1 = self.k2 = np.empty(0, np.int64)
            self.signature = np.empty(0, np.uint64)

    def parts(self, skip: np.ndarray, count: np.ndarray, kind: str) -> pa.Array:
        """``count`` words of each line after the first ``skip``, as a binary array; u4 takes the upper half."""
        start = self.start + skip
        total = int(count.sum())
        at = np.repeat(start - (np.cumsum(count) - count), count) + np.arange(total)
        data = self.ids[at]
        data = (data >> np.uint64(32)).astype("<u4") if kind == "<u4" else data.astype("<u8")
        return binary(data, count)

    def signatures(self) -> pa.Array:
        return binary(self.signature, signature_words(self.n))

    def prefixes(self, t: float) -> tuple[np.ndarray, pa.Array]:
        """Words that are passed over because nothing shares them, and the rest of each prefix."""
        skip = np.minimum(self.alone, prefix_length(self.n, t))
        # Up to three words at 0.8, only an equal set is similar, and that is the same class.
        small = np.floor(self.n / t + 1e-9) <= self.n
        small &= np.ceil(self.n * t - 1e-9) >= self.n
        skip = np.where(small, prefix_length(self.n, t), skip)
        return skip, self.parts(skip, prefix_length(self.n, t) - skip, "<u4")


def prefix_length(n: np.ndarray, t: float) -> np.ndarray:
    return (n - np.ceil(t * n - 1e-9) + 1).astype(np.int64)


def word_levels(rows: DataFrame) -> np.ndarray:
    """The level of each bucket of words by its count over all documents: 0 for one occurrence, then finer logarithms."""
    def count(batches):
        held, n = [], 0

        def counts():
            bucket, many = np.unique(np.concatenate(held), return_counts=True)
            own = bucket // SLICE
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(own)) + 1, [len(own)]])
            spans = [slice(a, b) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True) if a < b]
            yield pa.RecordBatch.from_arrays(
                [pa.array([own[x.start] for x in spans], pa.int32()),
                 pa.array([planes((bucket[x] % SLICE).astype("<u2")) for x in spans], pa.binary()),
                 pa.array([planes(many[x].astype("<u4")) for x in spans], pa.binary())],
                ["slice", "bucket", "n"],
            )

        for batch in batches:
            for pieces in chunks_of(batch.column("text").to_pylist()):
                held.append((LineSets(pieces, None).ids & np.uint64(BUCKETS - 1)).astype(np.int32))
                n += len(held[-1])
                if n > COUNTED:
                    yield from counts()
                    held, n = [], 0
        if held:
            yield from counts()

    def pack(batches):
        own, now = np.zeros(SLICE, np.int64), None
        for batch in batches:
            for number, bucket, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now not in (None, number):
                    yield row(now, own)
                    own = np.zeros(SLICE, np.int64)
                now = number
                own[from_planes(bucket, "<u2")] += from_planes(n, "<u4")  # a bucket is in a row once
        if now is not None:
            yield row(now, own)

    def row(number, own):
        level = np.where(own < 2, 0, 1 + np.floor(8 * np.log2(np.maximum(own, 1))))
        levels = np.minimum(255, level).astype(np.uint8).tobytes()
        return pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([levels])], ["slice", "levels"])

    counted = rows.select("text").mapInArrow(count, "slice int, bucket binary, n binary")
    dealt = counted.repartition("slice").sortWithinPartitions("slice")
    table = np.zeros(BUCKETS, np.uint8)
    for number, own in dealt.mapInArrow(pack, "slice int, levels binary").collect():  # BUCKETS bytes at most
        table[number * SLICE : (number + 1) * SLICE] = np.frombuffer(own, np.uint8)
    return table


#: What an entry knows, and how it travels: many entries of a part in one row, an array each.
KINDS = {"word": "<u4", "n": "<i4", "pos": "<i4", "k": "<i8", "doc": "<i8", "line": "<i4"}
ENTRY = [*KINDS, "sig"]
ENTRIES = "part long, " + ", ".join(f"{c} binary" for c in ENTRY)
#: Entries of lists that are too long for one task travel one by one.
SINGLE = ["word", "n", "pos", "k", "doc", "line", "sig", "sig2", "sig3", "sig4"]
SINGLE_SCHEMA = ", ".join(f"{c} long" for c in SINGLE)


def singles(e: dict[str, np.ndarray]) -> list[pa.Array]:
    return [*(pa.array(e[c].astype(np.int64)) for c in KINDS), *(pa.array(x) for x in e["sig"].view(np.int64).T)]


def from_singles(batch) -> dict[str, np.ndarray]:
    e = {c: batch.column(c).to_numpy().astype(kind) for c, kind in KINDS.items()}
    return e | {"sig": np.stack([batch.column(c).to_numpy().view(np.uint64) for c in SINGLE[len(KINDS) :]], 1)}


def shared(words: np.ndarray, t: float) -> np.ndarray:
    """Words that two sets of so many words in all must share."""
    return np.ceil(t / (1 + t) * words - 1e-9).astype(np.int64)


def list_pairs(e: dict[str, np.ndarray], t: float, other: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of entries of the same list that may match; entries are in (word, n) order.

    ``other``: pair only entries of different blocks. An entry meets the longer
    ones of its list as far as their sizes fit, by the positional and signature filters.
    """
    n, k, sig = e["n"].astype(np.int64), e["k"], e["sig"]
    left = n - e["pos"]
    whole = sig[:, 0] ^ sig[:, 1] ^ sig[:, 2] ^ sig[:, 3]
    size = signature_words(n)
    most = int(n.max(initial=0))
    word = e["word"].astype(np.uint64) << np.uint64(32)
    largest = np.minimum(most, np.floor((n + 1e-9) / t)).astype(np.uint64)
    end = np.searchsorted(word | n.astype(np.uint64), word | largest, side="right")
    one = np.flatnonzero(left >= shared(2 * n, t))  # the shorter of two has at least this many left
    one = one[end[one] > one + 1]
    many = end[one] - one - 1
    done = np.cumsum(many)
    found = [(np.empty(0, np.int64), np.empty(0, np.int64))]
    begin = 0
    while begin < len(one):
        stop = max(begin + 1, int(np.searchsorted(done, done[begin] - many[begin] + PAIRS, side="right")))
        count = many[begin:stop]
        i = np.repeat(one[begin:stop], count)
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(count) - count, count)
        begin = stop
        both = n[i] + n[j]
        least = shared(both, t)
        ok = np.flatnonzero(np.minimum(left[i], left[j]) >= least)
        i, j, apart = i[ok], j[ok], (both - 2 * least)[ok]
        ok = np.flatnonzero(np.bitwise_count(whole[i] ^ whole[j]) <= apart)
        i, j, apart = i[ok], j[ok], apart[ok]
        bits, by = sig[i] ^ sig[j], np.minimum(size[i], size[j])
        halves = np.bitwise_count(bits[:, :2] ^ bits[:, 2:]).sum(1, dtype=np.int64)
        ok = np.where(by > 1, halves, 0) <= apart
        ok &= np.where(by > 2, np.bitwise_count(bits).sum(1, dtype=np.int64), 0) <= apart
        ok &= k[i] != k[j]
        if other is not None:
            ok &= other[i] != other[j]
        found.append((i[ok], j[ok]))
    i, j = (np.concatenate(x) for x in zip(*found, strict=True))
    return i, j


def pair_batch(
    e: dict[str, np.ndarray], i: np.ndarray, j: np.ndarray, tries: int | None, asked: np.ndarray | None = None
) -> pa.RecordBatch:
    """Rows (later, earlier, more): the earliest candidates of each later entry (of those in the bit table ``asked``)."""
    doc, line, k = e["doc"], e["line"], e["k"]
    turn = (line[j] < line[i]) | ((line[j] == line[i]) & (k[j] < k[i]))
    turn = (doc[j] < doc[i]) | ((doc[j] == doc[i]) & turn)
    i, j = np.where(turn, j, i), np.where(turn, i, j)
    if asked is not None:
        wanted = is_set(asked, key_spot(k[j]))
        i, j = i[wanted], j[wanted]
    order = np.lexsort((k[i], line[i], doc[i], j))
    i, j = i[order], j[order]
    more = np.zeros(len(i), bool)
    if tries and len(j):
        starts = np.concatenate([[0], np.flatnonzero(np.diff(j)) + 1])
        nth = np.arange(len(j)) - np.repeat(starts, np.diff(np.concatenate([starts, [len(j)]])))
        more = np.repeat(np.diff(np.concatenate([starts, [len(j)]])) > tries, np.diff(np.concatenate([starts, [len(j)]])))
        i, j, more = i[nth < tries], j[nth < tries], more[nth < tries]
    return pa.RecordBatch.from_arrays([pa.array(k[j]), pa.array(k[i]), pa.array(more)], ["later", "earlier", "more"])


def _pick(e: dict[str, np.ndarray], at) -> dict[str, np.ndarray]:
    return {c: v[at] for c, v in e.items()}


def _joined(some: list[dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    return {c: np.concatenate([e[c] for e in some]) for c in ENTRY}


def _in_lists(e: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    return _pick(e, np.argsort((e["word"].astype(np.int64) << 31) | e["n"]))


def entries_of(classes: DataFrame, t: float, words_of_interest: np.ndarray | None = None) -> DataFrame:
    """Each class under the words of its prefix, or under those of a bit table only: rows of many entries.

    Words are dealt to parts by hash; parts are as many as keep one to some DEALT entries.
    """
    total = classes.agg(F.sum(F.length("prefix"))).first()[0] or 0
    parts = max(min(4 * width_of(classes.sparkSession), PARTS), total // 4 // DEALT)
    own = {"n": "n", "k": "k1", "doc": "doc", "line": "line"}

    def taken(batch):
        """Words and positions of the entries, which class each is of, and columns of the classes that have some."""
        n, skip = batch.column("n").to_numpy(), batch.column("skip").to_numpy()
        count = prefix_length(n, t) - skip
        at = np.repeat(np.arange(len(n)), count)
        words = np.frombuffer(b"".join(batch.column("prefix").to_pylist()), "<u4")
        pos = np.arange(len(at)) - np.repeat(np.cumsum(count) - count - skip, count)
        sig = signatures_of(np.frombuffer(b"".join(batch.column("sig").to_pylist()), "<u8"), n)
        some = slice(None)
        if words_of_interest is not None:
            hit = is_set(words_of_interest, key_spot(words.astype(np.int64)))
            at, words, pos = at[hit], words[hit], pos[hit]
            some = np.bincount(at, minlength=len(n)) > 0
            at = (np.cumsum(some) - 1)[at]
        return words, pos.astype(np.int32), at, {c: batch.column(x).to_numpy()[some] for c, x in own.items()} | {"sig": sig[some]}

    def dealt(held):
        words, pos, at, rows = zip(*held, strict=True)
        many = np.array([len(r["n"]) for r in rows])
        at = np.concatenate([x + first for x, first in zip(at, np.cumsum(many) - many, strict=True)])
        words = np.concatenate(words)
        order = np.argsort(words)
        words, at = words[order], at[order]
        part = words.astype(np.int64) * parts >> 32
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [len(part)]]).tolist()
        spans = [slice(x, min(x + ROW, b)) for a, b in zip(cuts[:-1], cuts[1:], strict=True) for x in range(a, b, ROW)]
        columns = {"word": words, "pos": np.concatenate(pos)[order]}
        columns |= {c: np.concatenate([r[c] for r in rows])[at] for c in own}
        sig = np.concatenate([r["sig"] for r in rows])
        for x in range(0, len(spans), 256):
            some = spans[x : x + 256]
            used = [(sig[at[s]], np.arange(4) < signature_words(columns["n"][s])[:, None]) for s in some]
            yield pa.RecordBatch.from_arrays(
                [pa.array([part[s.start] for s in some], pa.int64()),
                 *(pa.array([planes(columns[c][s].astype(kind)) for s in some], pa.binary()) for c, kind in KINDS.items()),
                 pa.array([four[words].tobytes() for four, words in used], pa.binary())],
                ["part", *ENTRY],
            )

    def run(batches):
        held, n = [], 0
        for batch in batches:
            held.append(taken(batch))
            n += len(held[-1][0])
            if n >= DEALT:
                yield from dealt(held)
                held, n = [], 0
        if n:
            yield from dealt(held)

    return classes.where("length(prefix) > 0").select("n", "skip", "prefix", "k1", "sig", "doc", "line").mapInArrow(run, ENTRIES)


def prefix_words(classes: DataFrame) -> DataFrame:
    """The prefix words of the classes."""
    def run(batches):
        for batch in batches:
            words = np.frombuffer(b"".join(batch.column("prefix").to_pylist()), "<u4")
            yield pa.RecordBatch.from_arrays([pa.array(words.astype(np.int64))], ["word"])

    return classes.where("length(prefix) > 0").select("prefix").mapInArrow(run, "word long").distinct()


CANDIDATE = "later long, earlier long, more boolean"


def candidates(
    entries: DataFrame, t: float, tries: int | None, folder: str, most: int = LIST, asked: np.ndarray | None = None
) -> DataFrame:
    """Candidate pairs of all lists. Lists longer than ``most`` are joined block by block."""
    names = [*CANDIDATE.replace(",", "").split()[::2], *SINGLE]

    def found(e):
        """Candidates of whole lists; those too long are written out."""
        e = _in_lists(e)
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(e["word"])) + 1, [len(e["word"])]])
        size = np.repeat(np.diff(cuts), np.diff(cuts))
        yield from single(_pick(e, size > most))
        e = _pick(e, (size > 1) & (size <= most))
        pairs = pair_batch(e, *list_pairs(e, t), tries, asked)
        if len(pairs):
            blank = [pa.nulls(len(pairs), pa.int64()) for _ in SINGLE]
            yield pa.RecordBatch.from_arrays([*pairs.columns, *blank], names)

    def single(e):
        for x in range(0, len(e["word"]), AT_ONCE):
            rows = singles(_pick(e, slice(x, x + AT_ONCE)))
            blank = [pa.nulls(len(rows[0]), kind) for kind in (pa.int64(), pa.int64(), pa.bool_())]
            yield pa.RecordBatch.from_arrays([*blank, *rows], names)

    def run(batches):
        held, n, now, room, long = [], 0, None, 4 * DEALT, np.empty(0, "<u4")
        for batch in batches:
            for part, *data, sig in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if part != now:
                    if n >= AT_ONCE:
                        yield from found(_joined(held))
                        held, n = [], 0
                    now, room, long = part, 4 * DEALT + n, np.empty(0, "<u4")
                e = {c: from_planes(x, kind) for (c, kind), x in zip(KINDS.items(), data, strict=True)}
                e["sig"] = signatures_of(np.frombuffer(sig, "<u8"), e["n"])
                if len(long):
                    is_long = np.isin(e["word"], long)
                    yield from single(_pick(e, is_long))
                    e = _pick(e, ~is_long)
                held.append(e)
                n += len(e["word"])
                if n > room:  # lists that are already known to be too long need not be held
                    e = _joined(held)
                    word, many = np.unique(e["word"], return_counts=True)
                    long = np.concatenate([long, word[many > most]])
                    is_long = np.isin(e["word"], long)
                    yield from single(_pick(e, is_long))
                    held = [_pick(e, ~is_long)]
                    n = len(held[0]["word"])
                    room = max(4 * DEALT, 2 * n)
        if n:
            yield from found(_joined(held))

    dealt = entries.repartition("part").sortWithinPartitions("part")
    out = stored(dealt.mapInArrow(run, f"{CANDIDATE}, {SINGLE_SCHEMA}"), f"{folder}/pairs")
    pairs = out.where("later IS NOT NULL").select("later", "earlier", "more")
    long = out.where("later IS NULL").select(*SINGLE)
    if long.isEmpty():
        return pairs
    # Blocks b and c of a list meet in one task for every pair b <= c.
    cut = long.groupBy("word").agg(F.ceil(F.count(F.lit(1)) / F.lit(most)).cast("int").alias("blocks"))
    spread = (
        long.join(cut.hint("merge"), "word")
        .withColumn("own", F.pmod(F.xxhash64("k"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(*SINGLE, "own", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
    )

    def meet(table):
        table = table.combine_chunks()
        e = from_singles(table) | {"own": table.column("own").to_numpy()}
        e = _in_lists(e)
        same = table.column("low")[0].as_py() == table.column("high")[0].as_py()
        pairs = list_pairs(e, t, None if same else e["own"])
        return pa.Table.from_batches([pair_batch(e, *pairs, tries, asked)])

    return pairs.unionByName(spread.groupBy("word", "low", "high").applyInArrow(meet, CANDIDATE))


def verified(rows: DataFrame, classes: DataFrame, pairs: DataFrame, levels, t: float, folder: str) -> DataFrame:
    """(later, hit): which classes have a similar earlier one among ``pairs``; exact, on whole sets.

    The sets are read off the texts again: only the first line of each class in
    question is sent on, found by a bit table of bounded size.
    """
    wanted = pairs.select(F.col("later").alias("k1")).unionByName(pairs.select(F.col("earlier").alias("k1"))).distinct()
    first = stored(classes.select("k1", "doc", "line").join(wanted, "k1", "left_semi"), f"{folder}/wanted")
    if first.count() <= FEW:
        rows = rows.join(F.broadcast(first.select("doc").distinct()), "doc", "left_semi")
    table = bit_table(first.select("doc", "line"), spot_of)

    def asked(batches):
        for batch in batches:
            texts, docs = batch.column("text").to_pylist(), batch.column("doc").to_numpy()
            many = np.array([t.count("\n") + 1 for t in texts], np.int64)
            of = np.repeat(np.arange(len(texts)), many)
            line = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
            at = spot_of(docs[of], line)
            hit = np.flatnonzero(is_set(table, at))
            held, kept, size = None, [], 0
            for k in hit.tolist():
                d = int(of[k])
                if held is None or held[0] != d:
                    held = (d, texts[d].split("\n"))
                kept.append((d, int(line[k]), held[1][line[k]]))
                size += len(kept[-1][2])
                if size > CHUNK:
                    yield whole(LineSets(kept, levels.value), docs)
                    kept, size = [], 0
            if kept:
                yield whole(LineSets(kept, levels.value), docs)

    def whole(sets, docs):
        return pa.RecordBatch.from_arrays(
            [pa.array(sets.k1), pa.array(docs[sets.doc]), pa.array(sets.line), sets.parts(0 * sets.n, sets.n, "<u8")],
            ["k1", "doc", "line", "tokens"],
        )

    kept = rows.mapInArrow(asked, "k1 long, doc long, line int, tokens binary")
    own = kept.join(first.hint("merge"), ["k1", "doc", "line"]).distinct()  # rows may repeat an id
    sets = stored(own.select("k1", "tokens"), f"{folder}/sets")

    def compare(batches):
        for batch in batches:
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            sizes = np.array([len(x) // 8 for x in a + b], np.int64)
            rows = np.concatenate([np.arange(len(a))] * 2)
            of = np.repeat(rows, sizes)
            # A word that both sets of a pair have gives the same number twice.
            key = np.frombuffer(b"".join(a + b), "<u8") + stir(of.astype(np.uint64) + np.uint64(1), 0x9E3779B97F4A7C15)
            order = np.argsort(key)
            twice = np.flatnonzero(key[order][1:] == key[order][:-1])
            both = np.bincount(of[order[twice]], minlength=len(a))
            hit = both >= t * (sizes[: len(a)] + sizes[len(a) :] - both) - 1e-9
            yield pa.RecordBatch.from_arrays(
                [batch.column("later"), batch.column("more"), pa.array(hit)], ["later", "more", "hit"]
            )

    once = pairs.groupBy("later", "earlier").agg(F.bool_or("more").alias("more"))
    full = once.join(sets.select(F.col("k1").alias("later"), F.col("tokens").alias("a")).hint("merge"), "later").join(
        sets.select(F.col("k1").alias("earlier"), F.col("tokens").alias("b")).hint("merge"), "earlier"
    )
    return (
        full.select("later", "more", "a", "b").mapInArrow(compare, "later long, more boolean, hit boolean")
        .groupBy("later").agg(F.bool_or("hit").alias("hit"), F.bool_or("more").alias("more"))
    )


def spot_of(doc: np.ndarray, line: np.ndarray) -> np.ndarray:
    """A number of a line, of which a bit table takes the lower bits."""
    mixed = stir(doc.astype(np.int64).view(np.uint64), 0x9E3779B97F4A7C15) + line.astype(np.int64).view(np.uint64)
    return stir(mixed, 0xC2B2AE3D27D4EB4F)


def key_spot(key: np.ndarray) -> np.ndarray:
    """A number of a class, of which a bit table takes the lower bits."""
    return stir(key.view(np.uint64), 0x9E3779B97F4A7C15)


def is_set(table: np.ndarray, spot: np.ndarray) -> np.ndarray:
    at = spot & np.uint64(len(table) * 64 - 1)
    return ((table[(at >> np.uint64(6)).view(np.int64)].view(np.uint64) >> (at & np.uint64(63))) & np.uint64(1)).astype(bool)


def bit_table(df: DataFrame, place) -> np.ndarray:
    """A table with the bit of every row set; ``place`` gives it from the row's columns.

    Its size follows from the number of rows and is bounded; a fuller table lets more through.
    """
    size = min(MOST_WORDS, max(LEAST_WORDS, 1 << (df.count() * BITS_EACH // 64).bit_length()))

    def spots(batches):
        for batch in batches:
            at = place(*(c.to_numpy() for c in batch.columns)) & np.uint64(size * 64 - 1)
            bits = (np.uint64(1) << (at & np.uint64(63))).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array((at >> np.uint64(6)).view(np.int64)), pa.array(bits)], ["word", "bits"])

    words = df.mapInArrow(spots, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    table = np.zeros(size, np.int64)
    table[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return table


def kept_lines(
    docs: DataFrame, folder: str | None = None, similarity: float = SIMILARITY, id_col: str = "doc_id",
    text_col: str = "text", tries: tuple[int | None, ...] = TRIES, most: int = LIST,
) -> DataFrame:
    """(doc, lines): per document the numbers (from 0) of its lines with words that stay.

    A line goes if an earlier line, by document id and line number, has a Jaccard
    similarity of at least ``similarity`` to it, whether that one stays or not.
    Words are split at ASCII white space, A-Z in lower case. Lines without words
    are not listed. A null id comes last and is listed as ``NO_ID``; rows that
    repeat an id are one document, and equal lines at the same place in them stay
    or go together. Documents of which nothing stays are not listed.
    """
    spark = docs.sparkSession
    small_batches(spark)
    folder = folder or scratch(spark, "lines")
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"), text_of(text_col).alias("text"))
    levels = spark.sparkContext.broadcast(word_levels(rows))

    def read(batches):
        for batch in batches:
            docs = batch.column("doc").to_numpy()
            for pieces in chunks_of(batch.column("text").to_pylist()):
                s = LineSets(pieces, levels.value)
                skip, prefix = s.prefixes(similarity)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(s.k1), pa.array(s.k2), pa.array(docs[s.doc]), pa.array(s.line),
                     pa.array(s.n.astype(np.int32)), pa.array(skip.astype(np.int32)),
                     s.signatures(), prefix],
                    ["k1", "k2", "doc", "line", "n", "skip", "sig", "prefix"],
                )

    lines = rows.mapInArrow(read, "k1 long, k2 long, doc long, line int, n int, skip int, sig binary, prefix binary")
    first = F.min(F.struct("doc", "line", "n", "skip", "sig", "prefix")).alias("first")
    classes = stored(lines.groupBy("k1", "k2").agg(first).select("k1", "k2", "first.*"), f"{folder}/classes")
    gone, open_ = None, None
    for number, some in enumerate(tries):
        place = f"{folder}/round-{number}"
        if open_ is None:
            pairs = candidates(entries_of(classes, similarity), similarity, some, place, most)
        else:
            # Earlier candidates failed and there were more: the lists that the open classes are in, found by
            # bit tables of their keys and words. What these let through beside them is only tried in vain.
            keys = bit_table(open_, key_spot)
            words = stored(prefix_words(classes.join(open_, "k1", "left_semi")), f"{place}/words")
            again = entries_of(classes, similarity, bit_table(words, key_spot))
            pairs = candidates(again, similarity, some, place, most, keys)
        checked = stored(verified(rows, classes, pairs, levels, similarity, place), f"{place}/checked")
        found = checked.where("hit").select(F.col("later").alias("k1"))
        gone = found if gone is None else gone.unionByName(found)
        open_ = stored(checked.where("NOT hit AND more").select(F.col("later").alias("k1")), f"{place}/open")
        if open_.isEmpty():
            break
    stay = classes.join(gone.hint("merge"), "k1", "left_anti")
    return stay.groupBy("doc").agg(F.sort_array(F.collect_set("line")).alias("lines"))


def without_repeats(docs: DataFrame, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """The rows with all their columns, less the lines of ``text_col`` that repeat an earlier one.

    Lines without words stay; a text of which nothing stays is what is left of
    it, at the least empty. A null text stays null.
    """
    keep = kept_lines(docs, folder, id_col=id_col, text_col=text_col, **kw)
    names = docs.columns
    doc, kept = unused(docs, "_doc", "_lines")
    marked = docs.withColumn(doc, F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID))).join(
        keep.select(F.col("doc").alias(doc), F.col("lines").alias(kept)).hint("merge"), doc, "left"
    )
    place = names.index(text_col)

    def cut(batches):
        for batch in batches:
            out = []
            for text, lines in zip(batch.column(place).to_pylist(), batch.column(len(names)).to_pylist(), strict=True):
                if text is not None:
                    stay = set(lines or ())
                    text = "\n".join(x for i, x in enumerate(text.split("\n")) if i in stay or not words_of(x))
                out.append(text)
            columns = [pa.array(out, pa.string()) if i == place else batch.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays(columns, names)

    return marked.select(*names, kept).mapInArrow(cut, docs.schema)
