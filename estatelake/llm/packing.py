"""Packing of token pieces into sequences of a fixed capacity: linear grouping and best fit.

Large pieces are sorted by length into groups of equal cardinality and rounded
up to their group's longest, so only a few sizes are left. A linear program over
configurations (what one sequence can hold of each size), solved by column
generation, says how often each configuration is used; actual pieces, by their
rank, take its places. Small pieces, and the few large ones that rounding the
program down leaves over, then go best fit into what is free.

The plans are made of counts per length and per free space. There are no more
of these than the capacity, whatever the corpus; pieces themselves never leave
their tasks.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass
from itertools import batched

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from estatelake.llm.common import ranked, scratch, small_batches, stored, text_of
from estatelake.llm.tokens import text_ids

CAPACITY = 2048
GROUPS = 96
#: Pieces up to this share of the capacity are small.
SMALL_SHARE = 8


def cut_pieces(
    docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY, id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Token pieces: doc_id, piece, start, length, ids (little-endian u32 in a binary).

    A document is its text's ids and ``end_id``; a null text is empty. A longer
    one is cut so that all pieces but the first have exactly ``capacity`` ids.
    """
    small_batches(docs.sparkSession)

    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]

    def texts(batches):
        for batch in batches:
            yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)

    def pieces(batches):
        end = int(end_id).to_bytes(4, "little")
        for doc_id, ids in text_ids(tokenizer).of_rows(texts(batches)):
            data = ids + end
            count = len(data) // 4
            start, stop, piece = 0, (count - 1) % capacity + 1, 0
            while start < count:
                yield doc_id, piece, start, stop - start, data[start * 4 : stop * 4]
                start, stop, piece = stop, stop + capacity, piece + 1

    def cut(batches):
        for part in batched(pieces(batches), 2000):
            yield pa.RecordBatch.from_arrays(
                [pa.array(values, kind) for values, kind in zip(zip(*part, strict=True), kinds, strict=True)],
                ["doc_id", "piece", "start", "length", "ids"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    return rows.mapInArrow(cut, "doc_id long, piece int, start long, length long, ids binary")


def crc32_of(column: str) -> Column:
    """Unsigned CRC-32 of a binary column."""

    @F.pandas_udf("long")
    def crc32(data: pd.Series) -> pd.Series:
        return data.map(zlib.crc32).astype("int64")

    return crc32(column)


def best_configuration(sizes: np.ndarray, values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable multiset of sizes that fits (unbounded knapsack)."""
    best, pick = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for c in range(int(sizes.min()), capacity + 1):
        fits = np.flatnonzero(sizes <= c)
        worth = best[c - sizes[fits]] + values[fits]
        k = int(worth.argmax())
        if worth[k] > best[c - 1] + 1e-12:
            best[c], pick[c] = worth[k], fits[k]
        else:
            best[c] = best[c - 1]
    used, c = np.zeros(len(sizes), np.int64), capacity
    while c > 0:
        if pick[c] < 0:
            c -= 1
        else:
            used[pick[c]] += 1
            c -= int(sizes[pick[c]])
    return float(best[capacity]), used


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = 2000) -> list[tuple[int, np.ndarray]]:
    """(times, places per size) that use the fewest sequences, rounded down: simplex with column generation."""
    if not len(sizes):
        return []
    columns = np.diag(capacity // sizes).astype(float)
    times = demand / columns.diagonal()
    for _ in range(rounds):
        inverse = np.linalg.inv(columns)
        worth, new = best_configuration(sizes, inverse.sum(axis=0), capacity)
        if worth <= 1 + 1e-7:
            break
        change = inverse @ new
        up = change > 1e-9
        ratios = np.where(up, times / np.where(up, change, 1), np.inf)
        out = int(ratios.argmin())
        times = np.maximum(times - ratios[out] * change, 0)
        times[out] = ratios[out]
        columns[:, out] = new
    whole = np.floor(times + 1e-9).astype(np.int64)
    left, plan = demand.astype(np.int64).copy(), []
    for k in range(len(sizes)):
        places = columns[:, k].astype(np.int64)
        n = int(whole[k])
        if n and places.any():  # rounding errors must not promise more places than there are pieces
            n = min(n, int((left[places > 0] // places[places > 0]).min()))
        if n > 0 and places.any():
            plan.append((n, places))
            left -= n * places
    return plan


@dataclass
class LargePlan:
    """Where the large pieces go, by their rank within all large ones (by length)."""

    first: np.ndarray  # by length: rank of the first piece of that length
    ends: np.ndarray  # by group: rank after its last piece
    rows: list[list[tuple[int, int, int]]]  # by group: (first position, pieces per sequence, first sequence)
    kept: np.ndarray  # by length: pieces that get a place; the rest is left over

    def sequence(self, length: np.ndarray, rank: np.ndarray) -> np.ndarray:
        place = self.first[length] + rank
        group = np.searchsorted(self.ends, place, side="right")
        out = np.full(len(place), -1, np.int64)
        for g in np.unique(group):
            own = np.flatnonzero(group == g)
            if not self.rows[g]:
                continue
            at = place[own] - (self.ends[g - 1] if g else 0)
            starts, per, first = (np.array(x) for x in zip(*self.rows[g], strict=True))
            row = np.searchsorted(starts, at, side="right") - 1
            out[own] = first[row] + (at - starts[row]) // per[row]
        return out


def plan_large(counts: dict[int, int], capacity: int, groups: int) -> LargePlan:
    """Linear grouping of the large lengths (below the capacity) and the configurations' places."""
    lengths = np.array(sorted(counts), np.int64)
    n = np.array([counts[x] for x in lengths], np.int64)
    total = int(n.sum())
    stop = np.cumsum(n)
    first = np.zeros(capacity + 1, np.int64)
    kept = np.zeros(capacity + 1, np.int64)
    if not total:
        return LargePlan(first, np.array([], np.int64), [], kept)
    first[lengths] = stop - n
    # Equal cardinality, but pieces of one length stay together: a length of more than a
    # group's share is a group of its own, the others fill groups in between.
    hot = n * groups >= total
    share = max(1, -(-int(n[~hot].sum()) // groups))
    last, held = [], 0
    for i, many in enumerate(n):
        held += 0 if hot[i] else int(many)
        if hot[i] or i + 1 == len(n) or hot[i + 1] or held >= share:
            last.append(i)
            held = 0
    ends, size = stop[last], lengths[last]
    demand = np.diff(ends, prepend=0)
    rows: list[list[tuple[int, int, int]]] = [[] for _ in ends]
    used, sequence = np.zeros(len(ends), np.int64), 0
    for times, places in configurations(size, demand, capacity):
        for g in np.flatnonzero(places):
            rows[g].append((int(used[g]), int(places[g]), sequence))
            used[g] += times * places[g]
        sequence += times
    begin = np.concatenate([[0], ends[:-1]])
    for a, b, length in zip(first[lengths], stop, lengths, strict=True):
        placed = np.clip(np.minimum(b, begin + used) - np.maximum(a, begin), 0, None).sum()
        kept[length] = placed
    return LargePlan(first, ends, rows, kept)


def best_fit(items: dict[int, int], free: dict[int, int], capacity: int) -> np.ndarray:
    """Best fit decreasing on counts: where the pieces of each length go.

    ``items``: pieces by length, ``free``: sequences by free space. Rows of
    (length, first rank, pieces per sequence, free space it began with, first
    sequence of that space); a beginning space of ``capacity`` is a new sequence.
    """
    room: list[list[tuple[int, int, int]]] = [[] for _ in range(capacity + 1)]
    for space, n in free.items():
        room[space].append((space, 0, n))
    fresh, out = 0, []
    for length in sorted(items, reverse=True):
        left, rank, space = items[length], 0, length
        while left:
            while space <= capacity and not room[space]:
                space += 1
            if space > capacity:
                each = capacity // length
                room[capacity].append((capacity, fresh, fresh + -(-left // each)))
                fresh += -(-left // each)
                space = capacity
            began, a, b = room[space].pop()
            each = space // length
            whole = min(b - a, left // each)
            if whole:
                out.append((length, rank, each, began, a))
                room[space - each * length].append((began, a, a + whole))
                a, rank, left = a + whole, rank + whole * each, left - whole * each
            if a < b and 0 < left < each:
                out.append((length, rank, left, began, a))
                room[space - left * length].append((began, a, a + 1))
                a, left = a + 1, 0
            if a < b:
                room[space].append((began, a, b))
    return np.array(out, np.int64).reshape(-1, 5)


def counts_by(df: DataFrame, column: str) -> dict[int, int]:
    """Rows by a column that has at most as many values as a sequence has places."""
    return {int(r[0]): int(r[1]) for r in df.groupBy(column).count().collect()}


def pack(
    pieces: DataFrame, folder: str | None = None, capacity: int = CAPACITY, groups: int = GROUPS,
    small_share: int = SMALL_SHARE,
) -> DataFrame:
    """Add sequence_id and offset to rows that have a ``length`` of 1 to ``capacity``.

    All other columns stay, but for such as have the name of a result. A row is one piece, also where rows repeat. Sequence
    numbers have gaps; offsets are gapless from 0.
    """
    spark = pieces.sparkSession
    folder = folder or scratch(spark, "packing")
    own = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    if {"_uid", "_rank", "_seq", "_space", "_part", "_n", "_before"} & set(own):
        raise ValueError("columns that begin with an underscore are used here")
    pieces = stored(pieces.withColumn("_uid", F.monotonically_increasing_id()), f"{folder}/pieces")
    counts = counts_by(pieces, "length")
    if counts and not 1 <= min(counts) <= max(counts) <= capacity:
        raise ValueError(f"lengths must be 1 to {capacity}")
    small = capacity // small_share
    plan = plan_large({k: n for k, n in counts.items() if small < k < capacity}, capacity, groups)

    def first_places(batches):
        for df in batches:
            length, rank = df["length"].to_numpy(np.int64), df["_rank"].to_numpy(np.int64)
            seq = np.full(len(df), -1, np.int64)
            whole, large = length == capacity, (length > small) & (length < capacity)
            seq[whole] = rank[whole]
            fits = large & (rank < plan.kept[length])
            seq[fits] = (1 << 60) + plan.sequence(length[fits], rank[fits])
            yield df.assign(_seq=seq, _rank=rank - np.where(large & ~fits, plan.kept[length], 0))

    numbers = ranked(pieces.select("_uid", "length"), "length", ["_uid"], "_rank")
    placed = stored(
        numbers.mapInPandas(first_places, "length long, _uid long, _rank long, _seq long"), f"{folder}/first"
    )
    spaces = stored(
        placed.where(f"_seq >= {1 << 60}").groupBy("_seq")
        .agg((F.lit(capacity) - F.sum("length")).cast("int").alias("_space")),
        f"{folder}/spaces",
    )
    left = {k: n - int(plan.kept[k]) for k, n in counts.items() if k < capacity and n > plan.kept[k]}
    fit = best_fit(left, counts_by(spaces, "_space"), capacity)
    fit = fit[np.lexsort((fit[:, 1], fit[:, 0]))]
    keys = (fit[:, 0] << 48) + fit[:, 1]

    def later_places(batches):
        for df in batches:
            length, rank = df["length"].to_numpy(np.int64), df["_rank"].to_numpy(np.int64)
            row = fit[np.searchsorted(keys, (length << 48) + rank, side="right") - 1]
            at = row[:, 4] + (rank - row[:, 1]) // np.maximum(row[:, 2], 1)
            yield pd.DataFrame({"_uid": df["_uid"], "_space": row[:, 3].astype(np.int32), "_rank": at})

    later = placed.where("_seq < 0").mapInPandas(later_places, "_uid long, _space int, _rank long")
    opened = later.where(F.col("_space") == capacity).select(
        "_uid", (F.col("_rank") + (1 << 61)).alias("_seq")
    )
    filled = later.where(F.col("_space") < capacity).join(
        ranked(spaces, "_space", ["_seq"], "_rank"), ["_space", "_rank"]
    ).select("_uid", "_seq")
    where = placed.where("_seq >= 0").select("_uid", "_seq").unionByName(opened).unionByName(filled)
    order = Window.partitionBy("_seq").orderBy(F.desc("length"), "_uid")
    return pieces.join(where, "_uid").select(
        *own,
        F.col("_seq").alias("sequence_id"),
        (F.sum("length").over(order) - F.col("length")).alias("offset"),
    )
