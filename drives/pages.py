"""Links and fields of stored pages."""

from pyspark.sql import functions as F

from drives.registry import query
from estatelake.functions import json_fields as J
from estatelake.functions.html import Pick, select_html
from estatelake.functions.text import page_link, page_numbers, strip_styling_all
from estatelake.operators import links
from estatelake.profiles import PROFILE_M, PROFILE_O

ESCAPED = "replace(replace(replace({}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


def escaped(column):
    return F.expr(ESCAPED.format(column))


def with_html(t, old, new):
    """All stored pages with one piece of markup replaced."""
    return t.pages.select("page_id", F.col("url").alias("link"), F.replace("html", F.lit(old), new).alias("html"))


NAV = "unnest(regexp_extract_all(regexp_extract(html, '<nav>(.*?)</nav>', 1), '<a href=\"([^\"]*)\">([^<]*)</a>', {}))"


@query(f"SELECT url AS link, replace({NAV.format(1)}, 'en', 'en/new') AS href FROM pages")
def nav_hrefs(t):
    marked = with_html(t, "<nav>", F.lit('<nav id="menu">'))
    return links.container_hrefs(marked, "id", "menu", rewrite=("en", "en/new"))


@query(f"SELECT url AS link, {NAV.format(2)} AS name FROM pages")
def nav_names(t):
    marked = with_html(t, "<nav>", F.lit('<nav class="menu pager wide">'))
    return links.container_names(marked, "class", "pager")


@query("SELECT p_partkey, 'https://listings.example/' || p_partkey || '?page=' || unnest(range(1, p_size + 1)) AS link FROM part")
def page_range(t):
    labels = F.transform(F.sequence(F.lit(1), F.col("p_size")), lambda n: n.cast("string"))
    listed = t.part.select("p_partkey", F.explode(page_numbers(labels)).alias("n"))
    base = F.concat(F.lit("https://listings.example/"), F.col("p_partkey"))
    return listed.select("p_partkey", page_link(base, F.col("n")).alias("link"))


@query("SELECT 'https://listings.example/rent/' || s_name AS link FROM supplier")
def seed_links(t):
    return links.seed_links(t.supplier, "https://listings.example/rent/", "s_name")


@query(
    "SELECT page_id, replace(regexp_replace(regexp_extract(html, '<h1>(.*?)</h1>', 1, 's'), '&amp;?', '&', 'g'), "
    "'&quot;', '\"') AS heading FROM pages"
)
def heading_text(t):
    found = select_html(F.col("html"), [Pick("h", "article", output="texts", inner="h1")])
    return t.pages.select("page_id", F.explode(found["h"]).alias("heading"))


@query(f"SELECT page_id, trim({NAV.format(2)}) AS item FROM pages")
def child_strings(t):
    found = select_html(F.col("html"), [Pick("items", "nav", output="strings", inner="a")])
    return t.pages.select("page_id", F.explode(found["items"]).alias("item"))


@query("SELECT url AS link FROM pages WHERE url LIKE 'https:%'")
def offer_links_o(t):
    # Only pages reached over https carry the attribute.
    marked = F.when(
        F.col("url").startswith("https:"), F.concat(F.lit('<article data-url="'), "url", F.lit('">'))
    ).otherwise("<article>")
    return links.offer_links(with_html(t, "<article>", marked), PROFILE_O)


@query(f"SELECT '/oferta' || {NAV.format(1)} AS link FROM pages")
def offer_links_m(t):
    # Every menu entry becomes an offer next to one that lacks the marker.
    both = F.lit('<a class="property_link" href="/news">x</a><a class="big property_link" href="/oferta')
    return links.offer_links(with_html(t, '<a href="', both), PROFILE_M)


@query("SELECT DISTINCT CASE WHEN contains(url, '.html') THEN left(url, strpos(url, '.html') - 1) ELSE url END AS link FROM pages")
def list_offers(t):
    twice = F.concat(
        F.lit('<article data-url="'), F.col("url"), F.lit('"></article><article data-url="'),
        F.col("url"), F.lit('">'),
    )
    return links.list_offers(with_html(t, "<article>", twice), PROFILE_O)


@query(
    f"SELECT replace({NAV.format(1)}, '/', '/mieszkania/najnowsze/') AS link FROM pages"
)
def list_districts(t):
    listed = t.pages.select(
        F.col("url").alias("link"),
        F.expr(
            """replace(replace(html, '<nav>', '<nav id="locationListChildren">'),
                       'href="/', 'href="/mieszkania/')"""
        ).alias("html"),
    )
    return links.list_places(listed, PROFILE_M)


@query("SELECT s_name || '?page=' || unnest(range(1, s_nationkey + 2)) AS link FROM supplier")
def list_pages(t):
    # A pager with the labels 1 to the nation key plus one; nation 0 has no pager at all.
    anchors = F.transform(
        F.sequence(F.lit(1), F.col("s_nationkey") + 1),
        lambda n: F.concat(F.lit("<li><a href='#'>"), n, F.lit("</a></li>")),
    )
    pager = F.concat(F.lit("<ul class='pager'>"), F.array_join(anchors, "\n"), F.lit("</ul>"))
    body = F.when(F.col("s_nationkey") > 0, pager).otherwise("<p>one page only")
    seeds = t.supplier.select(F.col("s_name").alias("link"), body.alias("html"))
    return links.list_pages(seeds, PROFILE_O)


@query(f"SELECT {NAV.format(1)} AS link FROM pages")
def flattened_links(t):
    hrefs = links.anchors(F.col("html"), "id", "menu")["a_hrefs"]
    marked = with_html(t, "<nav>", F.lit('<nav id="menu">')).select(hrefs.alias("hrefs"))
    nested = marked.select(F.transform("hrefs", lambda h: F.array(h)).alias("nested"))
    return links.flatten_links(nested, "nested")


@query("SELECT doc_id, replace(text, chr(10), chr(10) || chr(10)) AS text FROM documents")
def block_text(t):
    body = F.replace(escaped("text"), F.lit("\n"), F.lit("<br>"))
    html = F.concat(F.lit("<div><style>p{}</style><p class='x'>"), body, F.lit("</p></div>"))
    found = select_html(html, [Pick("d", "p", output="block_texts", every=True)])
    return t.documents.select("doc_id", F.explode(strip_styling_all(found["d"])).alias("text"))


@query("SELECT doc_id, unnest(string_split(text, chr(10))) AS piece FROM documents")
def child_texts(t):
    body = F.replace(escaped("text"), F.lit("\n"), F.lit("</b> <i>end</i></p><div></div><p><b>"))
    html = F.concat(F.lit("<div id='d'><p><b>"), body, F.lit("</b> <i>end</i></p></div>"))
    found = select_html(html, [Pick("d", "div", "id", "d", output="child_texts")])
    pieces = t.documents.select("doc_id", F.explode(found["d"]).alias("piece"))
    return pieces.select("doc_id", F.regexp_replace("piece", " end$", "").alias("piece"))


@query("SELECT page_id, '{\"page\": ' || page_id || ', \"url\": \"' || url || '\"}' AS script FROM pages")
def longest_script(t):
    script = F.concat(
        F.lit('</h1><script type="application/json">{"page": '), "page_id", F.lit(', "url": "'),
        "url", F.lit('"}</script><script>var short = 1;</script>'),
    )
    marked = with_html(t, "</h1>", script)
    return marked.select("page_id", J.longest_script(F.col("html")).alias("script"))


@query(
    """
SELECT event_id, CASE WHEN event_type NOT IN ('error', 'click') THEN value END AS lat,
       CASE WHEN event_type <> 'error' THEN regexp_extract(props, '[0-9]+') END AS area,
       CASE WHEN event_type <> 'error' THEN user_id || '/' || event_type END AS rooms
FROM events"""
)
def json_scalars(t):
    # Errors lose their tail and clicks have an object where the number should be.
    lat = F.when(F.col("event_type") == "click", F.lit('{"x": 1}')).otherwise(
        F.concat(F.lit('"'), "value", F.lit('"'))
    )
    text = F.concat(
        F.lit('{"props": {"pageProps": {"ad": {"location": {"coordinates": {"latitude": '), lat,
        F.lit('}}, "target": {"Area": '), F.regexp_extract("props", "[0-9]+", 0),
        F.lit(', "Rooms_num": ["'), "user_id", F.lit('", "'), "event_type", F.lit('"]}}}}'),
        F.when(F.col("event_type") == "error", "").otherwise("}"),
    )
    parsed = t.events.select("event_id", J.parse_record(text).alias("r"))
    return parsed.select(
        "event_id",
        J.coordinate(F.col("r"), "latitude").alias("lat"),
        F.array_join(J.feature(F.col("r"), "Area"), "/").alias("area"),
        F.array_join(J.feature(F.col("r"), "Rooms_num"), "/").alias("rooms"),
    )


@query(
    """
SELECT c_custkey, c_name AS address, r_name AS region, n_name AS city, CAST(NULL AS VARCHAR) AS district
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""
)
def geo_levels(t):
    places = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey")
    )

    def level(kind, label):
        return F.struct(F.lit(kind).alias("type"), label.alias("label"))

    location = F.struct(
        F.array(F.struct(F.col("c_name").alias("value"))).alias("address"),
        F.array(
            level("region", F.col("r_name")), level("city", F.col("n_name")), level("city", F.lit("other"))
        ).alias("geoLevels"),
    )
    ad = F.struct(location.alias("location"))
    nested = F.struct(F.struct(F.struct(ad.alias("ad")).alias("pageProps")).alias("props"))
    parsed = places.select("c_custkey", J.parse_record(F.to_json(nested)).alias("r"))
    return parsed.select(
        "c_custkey",
        J.address(F.col("r")).alias("address"),
        *(J.geo_label(F.col("r"), k).alias(k) for k in ("region", "city", "district")),
    )


@query(
    """
SELECT c_custkey, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_acctbal END AS lat,
       CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_name END AS price FROM customer"""
)
def attributes_and_facts(t):
    # Builders have no map, machinery customers no price.
    place = F.when(
        F.col("c_mktsegment") != "BUILDING",
        F.concat(F.lit("<div class='GoogleMap' data-lat='"), "c_acctbal", F.lit("'></div>")),
    ).otherwise("<div class=map></div>")
    fact = F.when(
        F.col("c_mktsegment") != "MACHINERY",
        F.concat(F.lit("<li class='paramIconPrice x'>Cena<em> "), "c_name", F.lit(" <i>a</i></em><em>b</em>")),
    ).otherwise("<li class='paramIconPriceM2'><em>9</em>")
    picks = [p for p in PROFILE_M.record if p.name in ("lat", "price")]
    found = t.customer.select("c_custkey", select_html(F.concat(place, fact), picks).alias("f"))
    return found.select(
        "c_custkey",
        F.get("f.lat", F.lit(0)).try_cast("double").alias("lat"),
        F.get("f.price", F.lit(0)).alias("price"),
    )
