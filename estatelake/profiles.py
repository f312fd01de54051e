"""The two source profiles: where each site keeps its links and offer fields."""

from __future__ import annotations

from dataclasses import dataclass

from estatelake.functions.html import Pick


@dataclass(frozen=True)
class Profile:
    """One site: its label in the tables and the places its pages keep things."""

    page_name: str
    pager: Pick
    offers: Pick
    offer_marker: str | None  # an offer link must contain it
    record: tuple[Pick, ...]
    places: tuple[Pick, ...] = ()
    newest_first: tuple[str, str] | None = None  # link rewrite to the newest-first order


def container_links(prefix: str, attr: str, value: str) -> tuple[Pick, Pick]:
    """B1: names and hrefs of the anchors below the first element with an id or class.

    Both lists are filtered on their own, so they need not line up.
    """
    where = {"attr": attr, "value": value, "inner": "a"}
    return (
        Pick(f"{prefix}_names", output="raw_strings", **where),
        Pick(f"{prefix}_hrefs", output="attr", arg="href", **where),
    )


# Start regions of profile O.
REGIONS_O = (
    "dolnoslaskie", "kujawsko-pomorskie", "lodzkie", "lubelskie", "lubuskie", "malopolskie",
    "mazowieckie", "opolskie", "podkarpackie", "podlaskie", "pomorskie", "slaskie",
    "warminsko-mazurskie", "wielkopolskie", "zachodniopomorskie",
)

# page_name label, element classes and attributes of profile O.
PROFILE_O = Profile(
    page_name="Otodom",
    pager=container_links("pager", "class", "pager")[0],
    offers=Pick("offers", "article", "data-url", output="attr", every=True, arg="data-url"),
    offer_marker=None,
    record=(
        Pick("title", "h1", "class", "css-46s0sq eu6swcv18"),
        Pick("subtitle", "a", "class", "css-1qz7z11 e1nbpvi61"),
        Pick("price", "strong", "class", "css-srd1q3 eu6swcv17"),
        Pick("details", "div", "class", "css-1d9dws4 egzohkh2", output="child_texts"),
        Pick("description", "p", output="block_texts", every=True),
        Pick("additional_info_headers", "h3", output="texts", every=True),
        Pick("additional_info", "ul", "class", "css-13isnqa ex3yvbv0", output="block_texts", every=True),
    ),
)

# page_name label, element classes and attributes of profile M.
PROFILE_M = Profile(
    page_name="Morizon",
    pager=container_links("pager", "class", "nav nav-pills mz-pagination-number")[0],
    offers=Pick("offers", None, "class", "property_link", output="attr", every=True, arg="href"),
    offer_marker="oferta",
    places=container_links("place", "id", "locationListChildren"),
    newest_first=("mieszkania", "mieszkania/najnowsze"),
    record=(
        Pick("title", "div", "class", "summaryLocation clearfix row", output="strings", inner="span"),
        Pick("subtitle", "div", "class", "summaryTypeTransaction clearfix"),
        Pick("localization_path", "nav", "class", "breadcrumbs", output="strings", inner="span"),
        Pick("price", "li", "class", "paramIconPrice", inner="em", inner_first=True),
        Pick("priceM2", "li", "class", "paramIconPriceM2", inner="em", inner_first=True),
        Pick("area", "li", "class", "paramIconLivingArea", inner="em", inner_first=True),
        Pick("rooms", "li", "class", "paramIconNumberOfRooms", inner="em", inner_first=True),
        Pick("params_h3", None, "class", "propertyParams", output="texts", inner="h3"),
        Pick("params_tables", None, "class", "propertyParams", output="texts", inner="table"),
        Pick("params_p", None, "class", "propertyParams", output="texts", inner="p"),
        Pick("description", "div", "class", "description", output="strings", inner="p"),
        Pick("lat", "div", "class", "GoogleMap", output="attr", arg="data-lat"),
        Pick("lng", "div", "class", "GoogleMap", output="attr", arg="data-lng"),
    ),
)
PROFILES = {profile.page_name: profile for profile in (PROFILE_O, PROFILE_M)}
