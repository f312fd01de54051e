"""Membership tests that hold up when one key owns a large share of the rows.

The join side with whole rows is salted for its heaviest keys only. Heavy keys
are an exact top list of at most ``TOP`` keys, so broadcasting them is bounded
whatever the data; every other key holds less than ``1/TOP`` of the rows and
takes the ordinary path. No row is dropped either way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOP = 1000
HEAVY_ROWS = 1_000_000
SALTS = 256


def heavy_keys(rows: DataFrame, key: str, floor: int = HEAVY_ROWS, top: int = TOP) -> DataFrame:
    """The at most ``top`` keys with ``floor`` rows or more."""
    counts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return counts.where(F.col("_n") >= floor).orderBy(F.desc("_n"), key).limit(top).select(key)


def _salted(rows: DataFrame, keys: DataFrame, key: str, floor: int, salts: int):
    heavy = heavy_keys(rows, key, floor).withColumn("_heavy", F.lit(True))
    # The salt follows the input partition, so copies of one row spread too and
    # a retried task salts its rows as before.
    spread = F.when(F.col("_heavy"), F.pmod(F.spark_partition_id(), F.lit(salts))).otherwise(0)
    left = rows.join(F.broadcast(heavy), key, "left").withColumn("_salt", spread).drop("_heavy")
    all_salts = F.when(F.col("_heavy"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(
        F.array(F.lit(0))
    )
    right = (
        keys.select(key)
        .distinct()
        .join(F.broadcast(heavy), key, "left")
        .select(key, F.explode(all_salts).alias("_salt"))
    )
    return left, right


def keep_unlisted(
    rows: DataFrame, keys: DataFrame, key: str,
    floor: int = HEAVY_ROWS, salts: int = SALTS, small: bool = False,
) -> DataFrame:
    """The rows whose key is not in ``keys``; rows with a null key stay.

    With ``small`` the caller vouches for the size of ``keys``: they are
    broadcast, and the rows are neither counted nor shuffled.
    """
    if small:
        return rows.join(F.broadcast(keys.select(key)), key, "left_anti").select(*rows.columns)
    left, right = _salted(rows, keys, key, floor, salts)
    return left.join(right, [key, "_salt"], "left_anti").select(*rows.columns)


def mark_listed(
    rows: DataFrame, keys: DataFrame, key: str, flag: str,
    floor: int = HEAVY_ROWS, salts: int = SALTS, small: bool = False,
) -> DataFrame:
    """All rows with a boolean ``flag``: is the key in ``keys``? ``small`` as above."""
    if small:
        left, right, on = rows, F.broadcast(keys.select(key).distinct()), [key]
    else:
        left, right = _salted(rows, keys, key, floor, salts)
        on = [key, "_salt"]
    marked = left.join(right.withColumn("_hit", F.lit(True)), on, "left")
    return marked.select(*rows.columns, F.col("_hit").isNotNull().alias(flag))
