from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The provided tables of one folder, read on first use."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(sql: str | None = None):
    """Register a function of ``Tables`` under its own name, with its SQL check."""

    def register(function: Callable[[Tables], DataFrame]):
        name = function.__name__
        QUERIES[name] = lambda spark, folder: function(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register
