"""Schemas of the state tables, the raw records and the canonical offer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def _table(*columns: tuple) -> StructType:
    return StructType([StructField(name, kind, nullable) for name, kind, nullable in columns])


_TEXT, _LONG, _INT, _REAL, _LIST = (
    StringType(),
    LongType(),
    IntegerType(),
    DoubleType(),
    ArrayType(StringType()),
)

ACTIVE_LINKS = _table(
    ("link_id", _LONG, False), ("page_name", _TEXT, False), ("link", _TEXT, False)
)
# ``run`` is the state version that queued the link or saw it fail.
TO_SCRAPE = _table(
    ("link_id", _LONG, False), ("page_name", _TEXT, False), ("link", _TEXT, False), ("run", _LONG, True)
)
MISSING_LINKS = _table(
    ("missing_id", _LONG, False),
    ("page_name", _TEXT, False),
    ("link", _TEXT, False),
    ("link_type", _TEXT, False),
    ("run", _LONG, True),
)
# Offers that a run retired: all rows of a link, of one site or any, that the table had before that run.
DEACTIVATIONS = _table(
    ("page_name", _TEXT, False), ("link", _TEXT, False), ("every_site", BooleanType(), False),
    ("only_active", BooleanType(), False), ("run_date", _TEXT, False), ("run", _LONG, False),
)
# A stage that was reported done for a date, in the version ``run``.
STAGE_EVENTS = _table(("curr_date", _TEXT, False), ("stage", _TEXT, False), ("run", _LONG, False))
# The listing pages on which each link was seen when it was last seen, and the version that saw it.
LINK_PAGES = _table(
    ("page_name", _TEXT, False), ("link", _TEXT, False), ("page", _TEXT, False), ("run", _LONG, False)
)
# Failed tries of a queued link since it was last queued (in ``queued``), as of version ``run``.
RETRY_COUNTERS = _table(
    ("page_name", _TEXT, False), ("link", _TEXT, False), ("queued", _LONG, False),
    ("attempts", _LONG, False), ("run", _LONG, False),
)
# Wrapped pieces of a description that its four columns do not hold.
DESCRIPTION_REST = _table(
    ("page_name", _TEXT, False), ("link", _TEXT, True), ("scrape_date", _TEXT, True),
    ("piece_no", _INT, False), ("text", _TEXT, True),
)
PROCESS_STAGE = _table(
    ("process_id", _LONG, False),
    ("curr_date", _TEXT, False),
    ("process_number", _INT, True),
    ("page_name", _TEXT, False),
    ("scraping_offers", _TEXT, False),
    ("scraping_details", _TEXT, False),
)

# Canonical offer columns, in output order.
CANONICAL_COLUMNS = (
    "area", "latitude", "longitude", "link", "price", "currency", "rooms", "floors_number",
    "floor", "type_building", "material_building", "year", "headers", "additional_info", "city",
    "address", "district", "voivodeship", "active", "scrape_date", "inactive_date", "page_name",
    "offer_title", "description_1", "description_2", "description_3", "description_4",
)
_NUMERIC = {"area", "latitude", "longitude", "price"}
OFFERS = _table(
    *((name, _REAL if name in _NUMERIC else _TEXT, True) for name in CANONICAL_COLUMNS)
)

# Feature keys of the embedded profile O record.
FEATURES_O = (
    "Area", "Build_year", "Building_floors_num", "Building_material", "Building_type",
    "Construction_status", "Deposit", "Floor_no", "Heating", "Rent", "Rooms_num",
)
RAW_O = _table(
    *((name, _LIST, True) for name in FEATURES_O),
    *((name, _TEXT, True) for name in ("city", "district", "address", "voivodeship")),
    *((name, _LIST, True) for name in ("title", "subtitle", "price", "additional_info_headers",
                                       "additional_info", "details", "description")),
    ("lat", _REAL, True), ("lng", _REAL, True), ("link", _TEXT, True),
)
RAW_M = _table(
    *((name, _LIST, True) for name in ("title", "subtitle", "localization_path", "price", "priceM2",
                                       "area", "rooms", "params_h3", "params_tables", "params_p",
                                       "description")),
    ("lat", _TEXT, True), ("lng", _TEXT, True), ("link", _TEXT, True),
)

STATE_TABLES = {
    "active_links": ACTIVE_LINKS,
    "preprocessing_offers": OFFERS,
    "to_scrape": TO_SCRAPE,
    "missing_links": MISSING_LINKS,
    "process_stage": PROCESS_STAGE,
    "stage_events": STAGE_EVENTS,
    "link_pages": LINK_PAGES,
    "retry_counters": RETRY_COUNTERS,
    "deactivations": DEACTIVATIONS,
    "description_rest": DESCRIPTION_REST,
}

# Declared text widths of the sink columns and the columns that
# must not be null (C41). offer_title has no declared width.
OFFER_WIDTHS = {
    **{name: 128 for name in CANONICAL_COLUMNS if name not in _NUMERIC | {"offer_title"}},
    "headers": 256, "additional_info": 4000, "description_1": 4000, "description_2": 4000,
    "description_3": 4000, "description_4": 4000,
}
LINK_WIDTHS = {"page_name": 128, "link": 256}
QUEUE_WIDTHS = {"page_name": 128, "link": 128}
LINK_REQUIRED = ("page_name", "link")


def empty(spark: SparkSession, schema: StructType) -> DataFrame:
    return spark.createDataFrame([], schema)
