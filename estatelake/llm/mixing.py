"""Mixing sources to target weights by iterative proportional fitting (raking).

Tokens are counted per cell of source, language and topic. Raking multiplies
the cells' weights until each margin has its target share; what a cell weighs
afterwards over what it has is its ratio, and documents are sampled by their
cell's ratio, scaled to probabilities. The cells are a Spark table throughout:
each raking step is a sum per category over the cells, however many there are.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from estatelake.llm.common import scratch, small_batches, stored, unused

TOPICS = 8
DIMS = ("source", "lang", "topic")


@dataclass(frozen=True)
class Mix:
    """Targets and limits of a mix.

    A margin's target shares are its token shares to the power ``tempers`` (1
    leaves it as it is, 0 makes all categories equal), or ``shares`` where a
    category has one. A cell's documents are kept with at most ``boost`` times
    the mean probability of the corpus; without that bound a tiny category
    would thin out all others. The bound is a step of the raking, so the other
    cells make up for it; ``margins`` tells what was reached.
    """

    tempers: tuple[float, float, float] = (0.7, 0.7, 0.5)
    shares: tuple[dict, dict, dict] = ({}, {}, {})
    boost: float = 4.0
    seed: str = "mix-1"
    tolerance: float = 1e-9
    sweeps: int = 200


def topic_of(text: str, cache: dict) -> tuple[int, int]:
    """The vocabulary bucket that most of a text's distinct words fall into, and its words in all.

    Buckets are by the first byte of a word's MD5; ties go to the smaller one, a
    text without words is in bucket 0.
    """
    words = text.encode().split()
    buckets = []
    for word in set(words):
        bucket = cache.get(word)
        if bucket is None:
            if len(cache) > 500_000:
                cache.clear()
            bucket = cache[word] = hashlib.md5(word).digest()[0] % TOPICS
        buckets.append(bucket)
    return int(np.bincount(buckets, minlength=TOPICS).argmax()) if buckets else 0, len(words)


def with_topic(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows with ``_topic`` and ``_tokens``. A null text is empty."""
    small_batches(docs.sparkSession)
    names = [*docs.columns, "_topic", "_tokens"]

    def run(batches):
        cache: dict = {}
        for batch in batches:
            found = [topic_of(t or "", cache) for t in batch.column(names.index(text_col)).to_pylist()]
            more = [pa.array([f[0] for f in found], pa.int32()), pa.array([f[1] for f in found], pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names)

    more = [T.StructField("_topic", T.IntegerType()), T.StructField("_tokens", T.LongType())]
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *more]))


def rake(cells: DataFrame, mix: Mix, folder: str) -> DataFrame:
    """Add ``ratio`` to cells of ``DIMS`` and ``tokens``: raked weight over token share.

    A sweep brings each margin to its target and then cuts weights to ``boost``
    times the token share. Ends when every margin is within ``tolerance`` of its
    target after the cut, at the latest after ``sweeps`` sweeps. ``_t0`` to
    ``_t2`` are the targets of the cell's categories. Cells without tokens take
    no part.
    """
    cells = cells.where("tokens > 0")
    total = cells.agg(F.sum("tokens")).first()[0]
    if not total:
        none = F.lit(None).cast("double")
        return cells.withColumns({"ratio": none} | {f"_t{i}": none for i in range(len(DIMS))})
    start = F.col("tokens") / F.lit(float(total))
    shaped = cells.withColumn("w", start)
    for i, dim in enumerate(DIMS):
        share = F.sum("w").over(Window.partitionBy(dim))
        target: Column = F.pow(share, F.lit(mix.tempers[i]))
        for name, wanted in sorted(mix.shares[i].items(), key=str):
            target = F.when(F.col(dim) == name, F.lit(float(wanted))).otherwise(target)
        shaped = shaped.withColumn(f"_t{i}", target).withColumn(f"_p{i}", F.col("w") / share)
    shaped = stored(shaped, f"{folder}/cells")
    # Every cell adds its part of its category's target, so a category counts once.
    norms = shaped.agg(*[F.sum(F.col(f"_t{i}") * F.col(f"_p{i}")) for i in range(len(DIMS))]).first()
    for i, norm in enumerate(norms):
        shaped = shaped.withColumn(f"_t{i}", F.col(f"_t{i}") / F.lit(norm))
    sweep, chunk = 0, 6
    while True:
        for _ in range(chunk):
            for i, dim in enumerate(DIMS):
                margin = F.sum("w").over(Window.partitionBy(dim))
                shaped = shaped.withColumn("w", F.col("w") * F.col(f"_t{i}") / margin)
            shaped = shaped.withColumn("w", F.least(F.col("w"), start * mix.boost))
        sweep += chunk
        shaped = stored(shaped, f"{folder}/sweep-{sweep}")
        off = [F.sum("w").over(Window.partitionBy(d)) / F.col(f"_t{i}") - 1 for i, d in enumerate(DIMS)]
        worst = shaped.select(F.greatest(*[F.abs(x) for x in off]).alias("off")).agg(F.max("off")).first()[0]
        if worst <= mix.tolerance or sweep >= mix.sweeps:
            break
    targets = [f"_t{i}" for i in range(len(DIMS))]
    return shaped.select(*DIMS, "tokens", (F.col("w") / start).alias("ratio"), *targets)


def margins(raked: DataFrame) -> DataFrame:
    """(dimension, category, tokens, share, target, reached) of every category of raked cells.

    ``share`` is the category's part of all tokens, ``target`` the wanted part
    and ``reached`` its part of the tokens that are expected to be sampled. The
    two differ where ``boost`` or the cells that there are rule the target out.
    """
    parts = None
    for i, dim in enumerate(DIMS):
        part = raked.groupBy(F.lit(dim).alias("dimension"), F.col(dim).cast("string").alias("category")).agg(
            F.sum("tokens").alias("tokens"), F.sum(F.col("tokens") * F.col("ratio")).alias("w"), F.max(f"_t{i}").alias("target")
        )
        parts = part if parts is None else parts.unionByName(part)
    whole = Window.partitionBy("dimension")
    return parts.select(
        "dimension", "category", "tokens", (F.col("tokens") / F.sum("tokens").over(whole)).alias("share"), "target",
        (F.col("w") / F.sum("w").over(whole)).alias("reached"),
    )


def draw(key: Column, seed: str) -> Column:
    """A number from 0 to 1 that depends on seed and key only."""
    digits = F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(key.cast("string"), F.lit("")))), 1, 12)
    return F.conv(digits, 16, 10).cast("double") / float(16**12)


#: Columns that ``mixed`` adds.
RESULTS = ("_topic", "_tokens", "_probability", "_kept")


def sampled(docs: DataFrame, mix: Mix = Mix(), folder: str | None = None, **columns) -> DataFrame:
    """The rows that ``mixed`` keeps, with their own columns only."""
    rows = mixed(docs, mix, folder, **columns).where("_kept").drop(*RESULTS)
    return rows.withColumnsRenamed({new: old for old, new in zip(RESULTS, unused(docs, *RESULTS), strict=True)})


def mixed(
    docs: DataFrame, mix: Mix = Mix(), folder: str | None = None, id_col: str = "doc_id", text_col: str = "text",
    source_col: str = "source", lang_col: str = "lang", report: str | None = None,
) -> DataFrame:
    """The rows with ``_topic``, ``_tokens``, ``_probability`` and ``_kept``.

    Sampling goes by the id, so it does not depend on the order of rows and rows
    that repeat an id share their fate. A null source or language is the
    category "". Texts without words weigh nothing and are kept. Other columns stay;
    one that has the name of a result comes back with underscores after its name.
    ``report``: a folder for the table of ``margins``.
    """
    docs = docs.withColumnsRenamed(dict(zip(RESULTS, unused(docs, *RESULTS), strict=True)))
    folder = folder or scratch(docs.sparkSession, "mixing")
    rows = with_topic(docs, text_col)
    keys = [F.coalesce(F.col(source_col), F.lit("")), F.coalesce(F.col(lang_col), F.lit("")), F.col("_topic")]
    cells = stored(
        rows.select(*[k.alias(d) for k, d in zip(keys, DIMS, strict=True)], F.col("_tokens").alias("tokens"))
        .groupBy(*DIMS).agg(F.sum("tokens").alias("tokens")),
        f"{folder}/counts",
    )
    raked = rake(cells, mix, folder)
    peak = raked.agg(F.max("ratio")).first()[0] or 1.0
    scale = 1 / min(peak, mix.boost)
    names = unused(rows, *(f"_{d}_key" for d in DIMS))
    odds = stored(
        raked.select(
            *[F.col(d).alias(x) for d, x in zip(DIMS, names, strict=True)],
            F.least(F.lit(1.0), F.col("ratio") * F.lit(scale)).alias("_probability"),
        ),
        f"{folder}/odds",
    )
    if report:
        stored(margins(raked), report)
    # Joined by size: broadcast while the cells are few, else shuffled with hot sources split.
    on = [k == F.col(x) for k, x in zip(keys, names, strict=True)]
    joined = rows.join(odds, on, "left").withColumn("_probability", F.coalesce("_probability", F.lit(1.0)))
    return joined.select(
        *rows.columns, "_probability", (draw(F.col(id_col), mix.seed) < F.col("_probability")).alias("_kept")
    )
