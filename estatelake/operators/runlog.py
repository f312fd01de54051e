"""The run log: one row per run and site with two stage flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STAGES = ("scraping_offers", "scraping_details")


def runs_on(log: DataFrame, site: str, run_date: str) -> DataFrame:
    """How many runs of a site the log has for one date."""
    same = (F.col("page_name") == site) & (F.col("curr_date") == run_date)
    return log.where(same).agg(F.count(F.lit(1)).alias("n_runs"))


def run_number(count: Column) -> Column:
    """1 for the first run of a day, 2 for any later one."""
    return F.least(count + 1, F.lit(2)).cast("int")


def run_numbers(log: DataFrame, requests: DataFrame) -> DataFrame:
    """C35 for many ``(page_name, curr_date)`` requests at once."""
    keys = ["page_name", "curr_date"]
    asked = requests.select(*keys, F.lit(1).alias("_asked"), F.lit(0).alias("_run"))
    logged = log.select(*keys, F.lit(0).alias("_asked"), F.lit(1).alias("_run"))
    counted = (
        asked.unionByName(logged)
        .groupBy(*keys)
        .agg(F.max("_asked").alias("_asked"), F.sum("_run").alias("_runs"))
    )
    return counted.where(F.col("_asked") == 1).select(
        *keys, run_number(F.col("_runs")).alias("process_number")
    )


def log_entry(log: DataFrame, site: str, run_date: str) -> DataFrame:
    """The row a new run appends: its number, both flags still ``F``."""
    return runs_on(log, site, run_date).select(
        F.xxhash64(F.lit(run_date), F.lit(site), F.col("n_runs")).alias("process_id"),
        F.lit(run_date).alias("curr_date"),
        run_number(F.col("n_runs")).alias("process_number"),
        F.lit(site).alias("page_name"),
        F.lit("F").alias("scraping_offers"),
        F.lit("F").alias("scraping_details"),
    )


def latest_date(log: DataFrame) -> DataFrame:
    """C37."""
    return log.agg(F.max("curr_date").alias("curr_date"))


def flag_stage(log: DataFrame, stage: str) -> DataFrame:
    """Set a stage flag on all rows of the latest date, whatever their site."""
    if stage not in STAGES:
        raise ValueError(f"unknown stage {stage!r}")
    newest = F.col("curr_date") == latest_date(log).scalar()
    return log.withColumn(stage, F.when(newest, "T").otherwise(F.col(stage)))


def stage_event(log: DataFrame, stage: str, run: int) -> DataFrame:
    """C38 as an event to append: the stage is done for all rows that the log has of its latest date."""
    if stage not in STAGES:
        raise ValueError(f"unknown stage {stage!r}")
    return latest_date(log).where(F.col("curr_date").isNotNull()).select(
        "curr_date", F.lit(stage).alias("stage"), F.lit(run).cast("long").alias("run")
    )
