"""Whole offer records: stored pages to raw records to canonical offers.

Every document becomes one listing page of each profile; its whole text is the
description. Spanish profile O pages lack the embedded record, Spanish profile M
pages lack the breadcrumb, and pages of source 'src7' could not be fetched.
"""

from pyspark.sql import functions as F

from drives.cells import DESCRIPTIONS, wrap_sql
from drives.pages import escaped
from drives.registry import query
from estatelake.operators.contract import contract_report
from estatelake.operators.links import read_listing
from estatelake.operators.records import details, split_by_status
from estatelake.plans import canonical
from estatelake.profiles import PROFILE_M, PROFILE_O
from estatelake.schemas import LINK_REQUIRED, LINK_WIDTHS, OFFER_WIDTHS

RUN_DATE = "2024-03-01"
LINK = "concat('https://listings.example/{}/', doc_id)"
LINK_SQL = "'https://listings.example/{}/' || doc_id"
FETCHED = "source <> 'src7'"


def joined(*parts):
    return F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))


def pages_o(t):
    size = F.col("n_chars")
    script = joined(
        '<script>{"props": {"pageProps": {"ad": {"location": {"coordinates": {"latitude": ', size / 8,
        ', "longitude": ', size / 4, '}, "address": [{"value": "', F.col("source"),
        ' street"}], "geoLevels": [{"type": "region", "label": "', F.col("lang"),
        '"}, {"type": "city", "label": "', F.col("source"), '"}]}, "target": {"Area": "', size / 2,
        '", "Heating": ["gas", "', F.col("lang"), '"]}}}}, "padding": "', F.repeat(F.lit("-"), 100),
        '"}</script>',
    )
    html = joined(
        '<html><body><h1 class="css-46s0sq eu6swcv18">Offer <b>', F.col("doc_id"), "</b></h1>",
        '<a class="css-1qz7z11 e1nbpvi61">flat</a><script>track(1);</script>',
        '<strong class="css-srd1q3 eu6swcv17">', size, '<!-- --> zł</strong>',
        '<div class="css-1d9dws4 egzohkh2"><div>Liczba pokoi:', size % 7, "</div><div>Piętro:3</div><div>",
        "Rodzaj zabudowy:BLOK</div></div><h3>Extras</h3><h3></h3><h3>More</h3>",
        '<ul class="css-13isnqa ex3yvbv0"><li>balcony</li><li>', F.col("source"), "</li></ul><p>",
        F.replace(escaped("text"), F.lit("\n"), F.lit("<br>")), "</p>",
        F.when(F.col("lang") != "es", script).otherwise("<script>no record</script>"),
    )
    link = F.expr(LINK.format("o")).alias("link")
    return t.documents.select(link, F.when(F.expr(FETCHED), html).alias("html"))


def pages_m(t, fetched=FETCHED):
    size = F.col("n_chars")
    crumbs = joined(
        '<nav class="breadcrumbs"><span>start</span>\n<span>rent</span><span>', F.col("lang"),
        "</span><span>", F.col("source"), "</span><span>centre</span><span>",
        F.when(F.col("lang") == "fr", "centre").otherwise("quay"), "</span></nav>",
    )
    lines = F.replace(escaped("text"), F.lit("\n"), F.lit("</p><p>"))
    html = joined(
        '<html><div class="summaryLocation clearfix row"><span>Offer</span> <span>', F.col("doc_id"),
        '</span></div><div class="summaryTypeTransaction clearfix">to let</div>',
        F.when(F.col("lang") != "es", crumbs).otherwise(""),
        '<li class="paramIconPrice">Price <em>~', F.translate(F.format_number(size / 4, 2), ",.", " ,"),
        ' <b>zł</b></em></li><li class="paramIconPriceM2"><em>1</em></li>',
        '<li class="paramIconLivingArea"><em>', size, " <b>m2</b></em></li>",
        '<li class="paramIconNumberOfRooms"><em>', size % 5, "</em></li>",
        '<section class="propertyParams box"><h3>Flat</h3><table><tr><td>Piętro: ', size % 9,
        " / 9 ,Rok budowy: 1990 ,Typ budynku: BLOK</td></tr></table><p>lift</p></section>",
        '<div class="description"><p>', lines, "</p></div>",
        '<div class="GoogleMap" data-lat="', size / 8, '" data-lng="', size / 16, '"></div></html>',
    )
    link = F.expr(LINK.format("m")).alias("link")
    return t.documents.select(link, F.when(F.expr(fetched), html).alias("html"))


def with_retry(t, pages, site):
    """First attempt on all pages, second attempt on the pages that gave nothing."""
    first = pages.where(F.col("html").isNotNull())
    return details(first, site, retried=pages.where(F.col("html").isNull()))


@query(
    f"""
SELECT {LINK_SQL.format('o')} AS link, CASE WHEN {FETCHED} THEN 'ok' ELSE 'failed' END AS status,
       CASE WHEN {FETCHED} THEN 'Offer/' || doc_id END AS title,
       CASE WHEN {FETCHED} THEN 'flat' END AS subtitle,
       CASE WHEN found THEN n_chars || '//zł' END AS price,
       CASE WHEN found THEN 'gas/' || lang END AS heating,
       CASE WHEN found THEN n_chars / 4 END AS lng,
       CASE WHEN found THEN source || ' street' END AS address,
       CASE WHEN {FETCHED} THEN 'Extras//More' END AS headers,
       CASE WHEN {FETCHED} THEN replace(text, chr(10), chr(10) || chr(10)) END AS description
FROM (SELECT *, {FETCHED} AND lang <> 'es' AS found FROM documents)"""
)
def details_o(t):
    return with_retry(t, pages_o(t), PROFILE_O.page_name).select(
        "link", "status", "lng", "address",
        F.array_join("title", "/").alias("title"),
        F.array_join("subtitle", "/").alias("subtitle"),
        F.array_join("price", "/").alias("price"),
        F.array_join("Heating", "/").alias("heating"),
        F.array_join("additional_info_headers", "/").alias("headers"),
        F.array_join("description", "/").alias("description"),
    )


@query(
    f"""
SELECT {LINK_SQL.format('m')} AS link,
       CASE WHEN NOT {FETCHED} THEN 'failed' WHEN lang = 'es' THEN 'dead' ELSE 'ok' END AS status,
       CASE WHEN {FETCHED} THEN 'Offer/' || doc_id END AS title,
       CASE WHEN {FETCHED} AND lang <> 'es' THEN 'start/rent/' || lang || '/' || source || '/centre/'
         || CASE WHEN lang = 'fr' THEN 'centre' ELSE 'quay' END END AS path,
       CASE WHEN {FETCHED} THEN n_chars || '/m2' END AS area,
       CASE WHEN {FETCHED} THEN 'lift' END AS params_p,
       CASE WHEN {FETCHED} THEN n_chars / 8 END AS lat,
       CASE WHEN {FETCHED} THEN array_to_string(list_transform(string_split(text, chr(10)), lambda x: trim(x)), '|')
         END AS description
FROM documents"""
)
def details_m(t):
    return with_retry(t, pages_m(t), PROFILE_M.page_name).select(
        "link", "status",
        F.array_join("title", "/").alias("title"),
        F.array_join("localization_path", "/").alias("path"),
        F.array_join("area", "/").alias("area"),
        F.array_join("params_p", "/").alias("params_p"),
        F.col("lat").try_cast("double").alias("lat"),
        F.array_join("description", "|").alias("description"),
    )


@query(
    f"""
SELECT {LINK_SQL.format('m')} AS link,
       CASE WHEN NOT {FETCHED} AND doc_id % 2 = 0 THEN 'failed' WHEN lang = 'es' THEN 'dead' ELSE 'ok' END AS status,
       CASE WHEN {FETCHED} OR doc_id % 2 = 1 THEN 'Offer/' || doc_id END AS title
FROM documents"""
)
def details_retried(t):
    """Half of the failed pages are tried again and can be read, and so are some that were ok before."""
    first = pages_m(t)
    again = pages_m(t, fetched="true").where("link RLIKE '[13579]$'")
    return details(first, PROFILE_M.page_name, retried=again).select(
        "link", "status", F.array_join("title", "/").alias("title")
    )


@query(
    """
WITH d AS (SELECT *, source <> 'src7' AS fetched FROM documents)
SELECT 'https://listings.example/list/' || doc_id AS link, 'failed' AS status, 'no content' AS error, 0 AS n_links
FROM d WHERE NOT fetched
UNION ALL
SELECT 'https://listings.example/list/' || doc_id, 'ok', NULL, CASE WHEN lang = 'es' THEN 0 ELSE 2 END FROM d WHERE fetched"""
)
def listing_failures(t):
    """Listing pages with their status: pages not fetched are failed, not empty."""
    mark = F.concat(F.lit("<a class='property_link' href='/oferta/"), F.col("doc_id"), F.lit("'>x</a>"))
    other = F.concat(F.lit("<a class='property_link' href='/oferta/b"), F.col("doc_id"), F.lit("'>y</a><p>"))
    html = F.concat(F.when(F.col("lang") == "es", "").otherwise(F.concat(mark, other)), escaped("text"))
    pages = t.documents.select(
        F.concat(F.lit("https://listings.example/list/"), F.col("doc_id")).alias("link"),
        F.when(F.expr(FETCHED), html).alias("html"),
    )
    listing = read_listing(pages, PROFILE_M)
    return listing.select("link", "status", "error", F.size("links").alias("n_links"))


TEXT_O = "replace(replace(text, chr(10), ', '), ', ,', ',')"
TEXT_M = (
    "replace(array_to_string(list_filter(list_transform(string_split(text, chr(10)), "
    "lambda x: trim(x)), lambda x: x <> ''), ', '), ',,', ',')"
)
_PIECES = ", ".join(DESCRIPTIONS)

CANONICAL_O = f"""
WITH d AS (SELECT *, {TEXT_O} AS description, lang <> 'es' AS found FROM documents WHERE {FETCHED}),
{wrap_sql('d', '*', 'description', DESCRIPTIONS)}
SELECT CASE WHEN found THEN n_chars / 2 END AS area,
       CASE WHEN found THEN n_chars / 8 END AS latitude,
       CASE WHEN found THEN n_chars / 4 END AS longitude,
       {LINK_SQL.format('o')} AS link,
       CASE WHEN found THEN CAST(n_chars AS DOUBLE) END AS price,
       CASE WHEN found THEN 'zł' END AS currency,
       CAST(n_chars % 7 AS VARCHAR) AS rooms, CAST(NULL AS VARCHAR) AS floors_number, '3' AS floor,
       'blok' AS type_building, CAST(NULL AS VARCHAR) AS material_building, CAST(NULL AS VARCHAR) AS year,
       'Extras, More' AS headers,
       'balcony, ' || source || ', , Liczba pokoi: ' || (n_chars % 7) || ', Piętro: 3, Rodzaj zabudowy: BLOK'
         AS additional_info,
       CASE WHEN found THEN source END AS city, CASE WHEN found THEN source || ' street' END AS address,
       CAST(NULL AS VARCHAR) AS district, CASE WHEN found THEN lang END AS voivodeship,
       'Yes' AS active, '{RUN_DATE}' AS scrape_date, '-' AS inactive_date,
       '{PROFILE_O.page_name}' AS page_name, 'Offer, ' || doc_id AS offer_title, {_PIECES}
FROM w4"""

CANONICAL_M = f"""
WITH d AS (SELECT *, {TEXT_M} AS description FROM documents WHERE {FETCHED} AND lang <> 'es'),
{wrap_sql('d', '*', 'description', DESCRIPTIONS)}
SELECT CAST(n_chars AS DOUBLE) AS area, n_chars / 8 AS latitude, n_chars / 16 AS longitude,
       {LINK_SQL.format('m')} AS link, n_chars / 4 AS price, 'zł' AS currency,
       CAST(n_chars % 5 AS VARCHAR) AS rooms, CAST(NULL AS VARCHAR) AS floors_number,
       CAST(n_chars % 9 AS VARCHAR) AS floor, 'blok' AS type_building,
       CAST(NULL AS VARCHAR) AS material_building, '1990' AS year, 'Flat' AS headers,
       'lift, Piętro:  ' || (n_chars % 9) || ' / 9 ,Rok budowy:  1990 ,Typ budynku:  BLOK' AS additional_info,
       source AS city, CASE WHEN lang <> 'fr' THEN 'quay' END AS address, 'centre' AS district,
       lang AS voivodeship, 'Yes' AS active, '{RUN_DATE}' AS scrape_date, '-' AS inactive_date,
       '{PROFILE_M.page_name}' AS page_name, 'Offer, ' || doc_id AS offer_title, {_PIECES}
FROM w4"""


def offers_o(t):
    ok, _, _ = split_by_status(details(pages_o(t), PROFILE_O.page_name))
    return canonical.canonical_o(ok, RUN_DATE)


def offers_m(t):
    ok, _, _ = split_by_status(details(pages_m(t), PROFILE_M.page_name))
    return canonical.canonical_m(ok, RUN_DATE)


@query(CANONICAL_O)
def canonical_o(t):
    return offers_o(t)


@query(CANONICAL_M)
def canonical_m(t):
    return offers_m(t)


@query(f"SELECT * FROM ({CANONICAL_O}) UNION ALL BY NAME SELECT * FROM ({CANONICAL_M})")
def offers_all(t):
    return canonical.offers_all(offers_o(t), offers_m(t))


WIDTHS_SQL = "\nUNION ALL\n".join(
    f"""SELECT '{name}' AS "column", count(*) FILTER (WHERE length({name}) > {width}) AS too_long,
       count(*) FILTER (WHERE {name} IS NULL) AS nulls, true AS nullable FROM offers"""
    for name, width in OFFER_WIDTHS.items()
)


@query(
    f"WITH offers AS (SELECT * FROM ({CANONICAL_O}) UNION ALL BY NAME SELECT * FROM ({CANONICAL_M}))\n{WIDTHS_SQL}"
)
def offer_contract(t):
    """The declared limits of the sink, held against the canonical offers."""
    return contract_report(canonical.offers_all(offers_o(t), offers_m(t)), OFFER_WIDTHS)


@query(
    f"""
WITH links AS (SELECT 'site-' || l_shipmode AS page_name, {LINK_SQL.format('c')} AS link FROM
  (SELECT l_orderkey AS doc_id, l_linestatus AS l_shipmode FROM lineitem))
SELECT 'page_name' AS "column", count_if(length(page_name) > 128) AS too_long, count_if(page_name IS NULL) AS nulls,
       false AS nullable FROM links
UNION ALL SELECT 'link', count_if(length(link) > 256), count_if(link IS NULL), false FROM links"""
)
def registry_contract(t):
    link = F.concat(F.lit("https://listings.example/c/"), F.col("l_orderkey"))
    site = F.concat(F.lit("site-"), F.col("l_linestatus"))
    return contract_report(t.lineitem.select(site.alias("page_name"), link.alias("link")), LINK_WIDTHS, LINK_REQUIRED)
