"""Link lists from stored listing pages.

Every function maps pages to links row by row; only ``list_offers`` shuffles,
to drop repeated links once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estatelake.functions.html import select_html
from estatelake.functions.text import canonical_link, page_link, page_numbers, rewrite_link
from estatelake.profiles import Profile, container_links


def anchors(html: Column, attr: str, value: str) -> Column:
    """B1: ``names`` and ``hrefs`` of a container's anchors, empty without container."""
    names, hrefs = container_links("a", attr, value)
    return select_html(html, [names, hrefs])


def container_hrefs(
    pages: DataFrame, attr: str, value: str, rewrite: tuple[str, str] | None = None
) -> DataFrame:
    """B1 and B2: one row per anchor href, ``link`` of the page kept."""
    found = pages.withColumn("_a", anchors(F.col("html"), attr, value))
    hrefs = found.select("link", F.explode("_a.a_hrefs").alias("href"))
    return hrefs.withColumn("href", rewrite_link(F.col("href"), *rewrite)) if rewrite else hrefs


def container_names(pages: DataFrame, attr: str, value: str) -> DataFrame:
    """B1: one row per anchor text, ``link`` of the page kept."""
    found = pages.withColumn("_a", anchors(F.col("html"), attr, value))
    return found.select("link", F.explode("_a.a_names").alias("name"))


def seed_links(regions: DataFrame, base: str, column: str = "region") -> DataFrame:
    """Start address of every region, or of every relative path."""
    return regions.select(F.concat(F.lit(base), F.col(column)).alias("link"))


def list_places(city_pages: DataFrame, profile: Profile, prefix: str = "") -> DataFrame:
    """Newest-first district links of stored city pages."""
    _, hrefs = profile.places
    found = container_hrefs(city_pages, hrefs.attr, hrefs.value, profile.newest_first)
    return found.select(F.concat(F.lit(prefix), F.col("href")).alias("link"))


PAGES, OFFERS = "pages", "offers"  # fixed values: the kinds of links a listing page can hold


def read_listing(pages: DataFrame, profile: Profile, kind: str = OFFERS) -> DataFrame:
    """One row per stored page, with its links, ``status`` and ``error``.

    A page that was not fetched or cannot be read is ``failed`` and has no
    links; it is no empty page. Store the result to read every page once.
    """
    if kind not in (PAGES, OFFERS):
        raise ValueError(f"unknown kind {kind!r}")
    pick = profile.pager if kind == PAGES else profile.offers
    read = pages.select("link", "html").withColumn("_page", select_html(F.col("html"), [pick]))
    error = F.when(F.col("html").isNull(), F.lit("no content")).otherwise(F.col("_page.error"))
    read = read.select("link", error.alias("error"), F.coalesce(f"_page.{pick.name}", F.array().cast("array<string>")).alias("_found"))
    links = F.col("_found")
    if kind == PAGES:
        links = F.transform(page_numbers(F.col("_found")), lambda n: page_link(F.col("link"), n))
    elif profile.offer_marker is not None:
        links = F.filter(F.col("_found"), lambda x: F.contains(x, F.lit(profile.offer_marker)))
    return read.select(
        "link",
        F.when(F.col("error").isNull(), "ok").otherwise("failed").alias("status"),
        "error",
        F.when(F.col("error").isNull(), links).otherwise(F.array().cast("array<string>")).alias("links"),
    )


def unread_pages(listing: DataFrame) -> DataFrame:
    """The pages of ``read_listing`` that gave nothing because they could not be read."""
    return listing.where(F.col("status") == "failed").select("link", "error")


def list_pages(seed_pages: DataFrame, profile: Profile) -> DataFrame:
    """The numbered listing pages behind every seed page that could be read."""
    return read_listing(seed_pages, profile, PAGES).select(F.explode("links").alias("link"))


def offer_links(listing_pages: DataFrame, profile: Profile) -> DataFrame:
    """Every offer link on every listing page that could be read."""
    return read_listing(listing_pages, profile).select(F.explode("links").alias("link"))


def offer_sightings(listing: DataFrame, profile: Profile) -> DataFrame:
    """The offer links of a ``read_listing`` result in canonical form, each once per ``page`` that shows it."""
    seen = listing.select(F.col("link").alias("page"), F.explode("links").alias("link"))
    if profile.offer_marker is None:
        seen = seen.withColumn("link", canonical_link(F.col("link")))
    return seen.where(F.col("link").isNotNull()).select("link", "page").distinct()


def offers_listed(listing: DataFrame, profile: Profile) -> DataFrame:
    """The offer links of a ``read_listing`` result in canonical form, each once."""
    links = listing.select(F.explode("links").alias("link"))
    if profile.offer_marker is None:
        links = links.select(canonical_link(F.col("link")).alias("link"))
    return links.where(F.col("link").isNotNull()).distinct()


def list_offers(listing_pages: DataFrame, profile: Profile) -> DataFrame:
    """The site's offer links in canonical form, each once. See ``unread_pages`` for the others."""
    return offers_listed(read_listing(listing_pages, profile), profile)


def flatten_links(df: DataFrame, column: str) -> DataFrame:
    """One row per link of a nested link list, order kept within a row."""
    return df.select(F.explode(F.flatten(F.col(column))).alias("link"))
