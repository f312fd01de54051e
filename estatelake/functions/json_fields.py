"""The record embedded as JSON in a page's longest script."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from estatelake.functions.text import bind
from estatelake.schemas import FEATURES_O

# Where the record lives inside the script.
RECORD_SCHEMA = """
    props STRUCT<pageProps: STRUCT<ad: STRUCT<
        location: STRUCT<
            coordinates: STRUCT<latitude: STRING, longitude: STRING>,
            address: ARRAY<STRUCT<value: STRING>>,
            geoLevels: ARRAY<STRUCT<type: STRING, label: STRING>>>,
        target: MAP<STRING, STRING>>>>
"""
# An opening mark that is never closed takes the rest of the page: no later one is closed either.
SCRIPT = r"(?is)(<script\b[^>]*>.*?</script\s*>)|<script\b.*"
SCRIPT_TAGS = r"(?is)^<script\b[^>]*>|</script\s*>$"


def longest_script(html: Column) -> Column:
    """Body of the longest script element, the first one on ties."""
    scripts = F.filter(F.regexp_extract_all(html, F.lit(SCRIPT), F.lit(1)), lambda s: s != "")
    longest = F.aggregate(
        scripts,
        F.lit(None).cast("string"),
        lambda best, s: F.when(best.isNull() | (F.length(s) > F.length(best)), s).otherwise(best),
    )
    return F.regexp_replace(longest, SCRIPT_TAGS, "")


def parse_record(script: Column) -> Column:
    """The record as a struct; unreadable parts are null."""
    return F.from_json(script, RECORD_SCHEMA)


def coordinate(record: Column, name: str) -> Column:
    """B15."""
    return record["props"]["pageProps"]["ad"]["location"]["coordinates"][name].try_cast("double")


def address(record: Column) -> Column:
    """Value of the first address entry."""
    return F.get(record["props"]["pageProps"]["ad"]["location"]["address"], F.lit(0))["value"]


def geo_label(record: Column, level: str) -> Column:
    """Label of the first geographic level of one type."""
    levels = record["props"]["pageProps"]["ad"]["location"]["geoLevels"]
    return F.get(F.filter(levels, lambda x: x["type"] == level), F.lit(0))["label"]


def feature(record: Column, name: str) -> Column:
    """A target feature as a list; a scalar becomes a list of one, also one that begins with a bracket."""
    value = F.try_element_at(record["props"]["pageProps"]["ad"]["target"], F.lit(name))
    return bind(
        value,
        lambda v: F.when(
            F.startswith(v, F.lit("[")), F.coalesce(F.from_json(v, "ARRAY<STRING>"), F.array(v))
        ).when(v.isNotNull(), F.array(v)),
    )


def record_columns(record: Column) -> dict[str, Column]:
    """Every profile O column that comes from the embedded record."""
    columns = {name: feature(record, name) for name in FEATURES_O}
    columns["city"] = geo_label(record, "city")
    columns["district"] = geo_label(record, "district")
    columns["address"] = address(record)
    columns["voivodeship"] = geo_label(record, "region")
    columns["lat"] = coordinate(record, "latitude")
    columns["lng"] = coordinate(record, "longitude")
    return columns
