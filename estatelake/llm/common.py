"""Helpers that several operators share: scratch tables, batches, exact ranks, prefix sums."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from estatelake.session import shared_folder

#: Rows of one Arrow batch where whole texts cross into Python.
TEXT_ROWS = 500


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder below ``spark.checkpoint.dir`` for the tables of one run."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write and read again: lineage ends here and nothing above runs twice."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Keep an Arrow batch of whole texts to a few MB."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > TEXT_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXT_ROWS))


def width_of(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_of(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores added as it takes to be no column of ``df``."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def running(values: Column, merge, zero: Column, block: int = 256) -> Column:
    """Running ``merge`` of an array's elements (each one included), from ``zero`` on.

    Works block by block, so that an array of n elements costs n times the
    block and not n squared. Null gives null, empty gives empty.
    """
    blocks = F.transform(
        F.when(F.size(values) > 0, F.sequence(F.lit(0), F.floor((F.size(values) - 1) / block).cast("int")))
        .otherwise(F.array().cast("array<int>")),
        lambda b: F.slice(values, b * block + 1, F.lit(block)),
    )

    def scan(items: Column, first: Column) -> Column:
        return F.aggregate(
            items,
            F.array(first),
            lambda done, v: F.concat(done, F.array(merge(F.element_at(done, -1), v))),
        )

    totals = F.transform(blocks, lambda part: F.aggregate(part, zero, merge))
    starts = scan(totals, zero)
    parts = F.transform(F.arrays_zip(blocks.alias("b"), F.slice(starts, 1, F.size(blocks)).alias("s")),
                        lambda x: F.slice(scan(x["b"], x["s"]), F.lit(2), F.size(x["b"])))
    return F.when(values.isNotNull(), F.flatten(parts))


def running_totals(values: Column, block: int = 256) -> Column:
    """Prefix sums of an array of whole numbers."""
    longs = F.transform(values, lambda v: v.cast("long"))
    return running(longs, lambda a, v: a + v, F.lit(0).cast("long"), block)


def ranked(df: DataFrame, key: str, order: list[str], rank: str = "rank", spread: int | None = None) -> DataFrame:
    """Add the exact position (from 0) of each row among the rows of its ``key``.

    A key may hold most of the rows: rows are spread by a hash of ``order``,
    ranked within (key, part), and the parts' counts are added up. ``order``
    must name rows; equal rows get different positions in any order. The input
    is read twice, so it should be a stored table.
    """
    spread = spread or width_of(df.sparkSession)
    parted = df.withColumn("_part", F.pmod(F.xxhash64(*order), F.lit(spread)))
    counts = parted.groupBy(key, "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.withColumn(
        "_before",
        F.sum("_n").over(Window.partitionBy(key).orderBy("_part")) - F.col("_n"),
    ).drop("_n")
    within = F.row_number().over(Window.partitionBy(key, "_part").orderBy(*order)) - 1
    return (
        parted.join(before, [key, "_part"])
        .withColumn(rank, F.col("_before") + within)
        .drop("_part", "_before")
    )


def in_order(df: DataFrame, group: str, order: list[str], folder: str) -> DataFrame:
    """Add ``rank``, the exact place (from 0) of each row in its group by ``order``, and ``n``, the group's rows.

    Rows are range-partitioned, so a group of any size spreads over tasks. A task
    numbers its rows as they stand; the counts of tasks before are added. The
    result is a stored table.
    """
    sort = [group, *order]
    line = F.monotonically_increasing_id()  # the task in the upper bits, the row in the task in the lower 33
    placed = stored(
        df.repartitionByRange(*sort).sortWithinPartitions(*sort).withColumn("_line", line), f"{folder}/placed"
    ).withColumn("_task", F.shiftright("_line", 33))
    runs = placed.groupBy(group, "_task").agg(F.min("_line").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    tasks = Window.partitionBy(group)
    before = F.sum("_rows").over(tasks.orderBy("_task")) - F.col("_rows")
    starts = runs.select(
        group, "_task", (before - F.col("_first")).alias("_shift"), F.sum("_rows").over(tasks).alias("n")
    )
    ranked = placed.join(starts, [group, "_task"]).withColumn("rank", F.col("_line") + F.col("_shift"))
    return stored(ranked.drop("_line", "_task", "_shift"), f"{folder}/ranked")
