"""Exact duplicates by distributed MSD radix partitioning.

Texts are split by their successive bytes. A level looks at the next bytes of
every text that still shares all earlier bytes with another one; groups of one
text, and groups whose texts have ended, are finished. Equality follows from
the bytes themselves, no digest takes part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estatelake.llm.common import scratch, stored, text_of

#: Bytes looked at by the first level; each level looks at GROWTH times as many.
FIRST_BYTES = 64
GROWTH = 16
MOST_BYTES = 1 << 22


def one_space(text: Column) -> Column:
    """Each run of space, tab, LF, VT, FF and CR as one space; single spaces need no match."""
    return F.regexp_replace(text, r"\x20[\x20\x09-\x0D]+|[\x09-\x0D][\x20\x09-\x0D]*", " ")


def exact_groups(
    docs: DataFrame, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text",
    first_bytes: int = FIRST_BYTES, growth: int = GROWTH,
) -> DataFrame:
    """One row per input row: doc_id, text_sha256, keep_id, group_size, kept.

    Texts are compared after ``one_space``; a null text is empty. Of equal texts
    the smallest id stays. Rows that repeat both id and text are one document
    twice: they count in ``group_size`` and are kept or dropped together. A null
    id never beats another one; a group of null ids only keeps all its rows.
    Other columns are ignored. An empty table gives an empty result.

    A level is one count per (group, next bytes), combined before the shuffle,
    and one join back, whose hot groups adaptive execution splits. Only texts
    that are not finished go on to the next level, with the bytes not yet seen.
    """
    folder = folder or scratch(docs.sparkSession, "exact")
    norm = one_space(text_of(text_col))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        norm.alias("_norm"),
    ).select(
        "doc_id",
        F.sha2("_norm", 256).alias("text_sha256"),
        F.lit(0).cast("long").alias("grp"),
        F.encode("_norm", "UTF-8").alias("rest"),
    )
    done, width, level = [], first_bytes, 0
    while True:
        sliced = rows.withColumn("digit", F.substring("rest", 1, width))
        counted = sliced.groupBy("grp", "digit").agg(
            F.count(F.lit(1)).alias("group_size"), F.min("doc_id").alias("keep_id")
        )
        shared = stored(
            counted.where("group_size > 1").withColumn("next_grp", F.monotonically_increasing_id()),
            f"{folder}/groups-{level}",
        )
        # One plan at every size: the groups grow with the corpus and are never broadcast.
        joined = sliced.join(shared.hint("merge"), ["grp", "digit"], "left")
        over = F.col("next_grp").isNull() | (F.length("digit") < width)
        table = stored(
            joined.select(
                "doc_id", "text_sha256", "keep_id", "group_size", over.alias("over"),
                F.col("next_grp").alias("grp"),
                F.when(~over, F.substring(F.col("rest"), F.lit(width + 1), F.length("rest"))).alias("rest"),
            ),
            f"{folder}/level-{level}",
        )
        done.append(table.where("over"))
        if shared.where(F.length("digit") == width).isEmpty():
            break
        rows = table.where("NOT over").select("doc_id", "text_sha256", "grp", "rest")
        width, level = min(width * growth, MOST_BYTES), level + 1
    result = done[0]
    for part in done[1:]:
        result = result.unionByName(part)
    alone = F.col("group_size").isNull()
    keep = F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id"))
    return result.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        "text_sha256",
    )
