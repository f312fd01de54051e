"""Offer records from stored detail pages."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estatelake.functions.html import select_html
from estatelake.functions.json_fields import longest_script, parse_record, record_columns
from estatelake.functions.text import strip_styling_all
from estatelake.profiles import PROFILE_M, PROFILE_O
from estatelake.schemas import RAW_M, RAW_O

OK, DEAD, FAILED = "ok", "dead", "failed"


def _with_status(pages: DataFrame, dead: Column) -> DataFrame:
    error = F.when(F.col("html").isNull(), F.lit("no content")).otherwise(F.col("_page.error"))
    status = F.when(error.isNotNull(), FAILED).when(dead, DEAD).otherwise(OK)
    return pages.withColumn("status", status).withColumn("error", error)


def extract_offers_o(pages: DataFrame, strict: bool = False) -> DataFrame:
    """Raw profile O records with ``status`` and ``error``.

    ``pages`` has ``link`` and ``html``. A page without a readable embedded
    record keeps its visible fields; with ``strict`` it counts as dead.
    """
    parsed = (
        pages.select("link", "html")
        .withColumn("_script", longest_script(F.col("html")))
        .withColumn("_record", parse_record(F.col("_script")))
        .withColumn("_page", select_html(F.col("html"), list(PROFILE_O.record)))
    )
    columns = {pick.name: F.col(f"_page.{pick.name}") for pick in PROFILE_O.record}
    for name in ("details", "description", "additional_info"):
        columns[name] = strip_styling_all(columns[name])
    columns |= record_columns(F.col("_record"))
    columns["link"] = F.col("link")
    readable = F.col("_record.props").isNotNull() | F.json_object_keys("_script").isNotNull()
    # A page whose record cannot be read has no usable price either.
    columns["price"] = F.when(readable, columns["price"])
    with_status = _with_status(parsed, ~readable if strict else F.lit(False))
    return with_status.select(*(columns[f.name].alias(f.name) for f in RAW_O), "status", "error")


def extract_offers_m(pages: DataFrame) -> DataFrame:
    """Raw profile M records; dead where title, breadcrumb or parameters are missing."""
    parsed = pages.select("link", "html").withColumn(
        "_page", select_html(F.col("html"), list(PROFILE_M.record))
    )
    columns = {pick.name: F.col(f"_page.{pick.name}") for pick in PROFILE_M.record}
    for name in ("lat", "lng"):
        columns[name] = F.get(columns[name], F.lit(0))
    columns["link"] = F.col("link")
    dead = (
        F.col("_page.title").isNull()
        | F.col("_page.localization_path").isNull()
        | F.col("_page.params_h3").isNull()
    )
    with_status = _with_status(parsed, dead)
    return with_status.select(*(columns[f.name].alias(f.name) for f in RAW_M), "status", "error")


def split_by_status(results: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The records that worked, the links that failed, and the dead links."""
    ok = results.where(F.col("status") == OK).drop("status", "error")
    failed = results.where(F.col("status") == FAILED).select("link", "error")
    dead = results.where(F.col("status") == DEAD).select("link")
    return ok, failed, dead


def combine(frames: Iterable[DataFrame]) -> DataFrame:
    """Stack frames by column name; missing columns become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def join_retried(first: DataFrame, retried: DataFrame, key: str = "link") -> DataFrame:
    """First-pass and retried results together, nulls dropped."""
    return combine([first, retried]).where(F.col(key).isNotNull())


EXTRACTORS = {PROFILE_O.page_name: extract_offers_o, PROFILE_M.page_name: extract_offers_m}


def details(pages: DataFrame, page_name: str, retried: DataFrame | None = None) -> DataFrame:
    """Records of a site's detail pages, and of a later attempt at some of them.

    With ``retried`` there is one row per link of either: the best status first,
    of equal ones the first attempt. A link that failed and was not tried again
    stays, as failed; a retry that fails takes nothing away.
    """
    extract = EXTRACTORS[page_name]
    first = extract(pages)
    return first if retried is None else best_attempt(first, extract(retried))


def best_attempt(first: DataFrame, retried: DataFrame) -> DataFrame:
    """One row per link of two attempts: ok before dead before failed, then the first attempt."""
    rank = F.when(F.col("status") == OK, 2).when(F.col("status") == DEAD, 1).otherwise(0)
    both = first.withColumn("_try", F.lit(0)).unionByName(retried.withColumn("_try", F.lit(1)))
    row = F.struct(*first.columns)
    best = both.where(F.col("link").isNotNull()).groupBy("link").agg(
        F.max_by(row, F.struct(rank.alias("rank"), (-F.col("_try")).alias("try"))).alias("_best")
    )
    return best.select("_best.*")
