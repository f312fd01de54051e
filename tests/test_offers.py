"""Pages to raw records to canonical offers, with the rows that used to break a whole batch."""

from pyspark.sql import functions as F

from estatelake.functions.html import Pick, select_html
from estatelake.functions.json_fields import feature, parse_record
from estatelake.operators.links import list_offers, list_pages, list_places, read_listing, unread_pages
from estatelake.operators.language import train
from estatelake.operators.records import details, extract_offers_m, extract_offers_o
from estatelake.plans.canonical import canonical_m, canonical_o, offers_all
from estatelake.profiles import PROFILE_M, PROFILE_O, REGIONS_O
from estatelake.schemas import CANONICAL_COLUMNS, OFFERS, RAW_M, RAW_O

DAY = "2024-03-01"


def pages(spark, rows):
    return spark.createDataFrame(rows, "link string, html string")


def raw(spark, schema, *rows):
    return spark.createDataFrame([{f.name: row.get(f.name) for f in schema} for row in rows], schema)


def test_profile_o_statuses(spark):
    good = """<h1 class="css-46s0sq eu6swcv18"> T </h1><strong class="css-srd1q3 eu6swcv17">2 500<!-- --> zł</strong>
      <script>{"props": {"pageProps": {"ad": {"target": {"Area": "40"}}}}}</script>"""
    rows = [("a", good), ("b", "<h1>x</h1>"), ("c", None), ("d", good.replace('{"props"', '{"x'))]
    out = {r.link: r for r in extract_offers_o(pages(spark, rows)).collect()}
    assert [out[k].status for k in "abcd"] == ["ok", "ok", "failed", "ok"]
    assert out["a"].title == ["T"] and out["a"].price == ["2 500", "", "zł"] and out["a"].Area == ["40"]
    # Without a readable record the page keeps its title but not its price.
    assert out["d"].title == ["T"] and out["d"].price is None and out["d"].city is None
    assert out["b"].details is None and out["b"].description == []
    strict = {r.link: r.status for r in extract_offers_o(pages(spark, rows), strict=True).collect()}
    assert strict == {"a": "ok", "b": "dead", "c": "failed", "d": "dead"}
    assert extract_offers_o(pages(spark, [])).count() == 0


M_PAGE = """<div class="summaryLocation clearfix row"><span>T</span></div>
<nav class="breadcrumbs"><span>a</span><span>b</span><span>V</span><span>K</span></nav>
<li class="paramIconPrice">Cena <em>~2 500,5 <b>zł</b></em></li>
<section class="x propertyParams"><h3>H</h3><table>
<tr><th>Piętro: </th><td>3 / 4</td></tr></table><p>lift</p></section>"""


def test_profile_m_statuses(spark):
    rows = [("a", M_PAGE), ("b", M_PAGE.replace("breadcrumbs", "x")), ("c", None), ("d", M_PAGE.replace("propertyParams", "x"))]
    out = {r.link: r for r in extract_offers_m(pages(spark, rows)).collect()}
    assert [out[k].status for k in "abcd"] == ["ok", "dead", "failed", "dead"]
    a = out["a"]
    assert (a.price, a.priceM2, a.lat, a.description) == (["~2 500,5", "zł"], None, None, None)
    offer = canonical_m(details(pages(spark, rows), PROFILE_M.page_name).where("status = 'ok'"), DAY).first()
    assert (offer.price, offer.currency, offer.city, offer.voivodeship, offer.district) == (2500.5, "zł", "K", "V", None)
    assert (offer.floor, offer.latitude) == ("3", None)


def test_retried_pages_join_the_first_pass(spark):
    first, second = pages(spark, [("a", M_PAGE), ("b", None)]), pages(spark, [("b", M_PAGE)])
    out = details(first, PROFILE_M.page_name, retried=second).collect()
    assert sorted((r.link, r.status) for r in out) == [("a", "ok"), ("b", "ok")]


def test_canonical_o_rows_that_used_to_lose_a_batch(spark):
    rows = [
        {"link": "full", "Area": ["45.5"], "price": ["2 500", "zł"], "details": ["Liczba pokoi:2", "Piętro:3"],
         "additional_info": ["i\n\n"], "title": ["T", ""], "lat": float("nan"), "city": "K", "description": ["x\n\ny"],
         "additional_info_headers": [""]},
        {"link": "no details", "additional_info": ["i"]},
        {"link": "grouped price", "price": ["1.500,00 zł"]},
        {"link": "bad area", "Area": ["big"], "price": ["2500 zł/m²"]},
        {"link": "too long", "description": ["z" * 2500 + " "] * 6},
    ]
    df = canonical_o(raw(spark, RAW_O, *rows), DAY)
    assert df.schema.names == list(CANONICAL_COLUMNS) and [f.dataType for f in df.schema] == [f.dataType for f in OFFERS]
    out = {r.link: r for r in df.collect()}
    full = out["full"]
    assert (full.area, full.price, full.currency, full.rooms, full.floor) == (45.5, 2500.0, "zł", "2", "3")
    assert (full.additional_info, full.offer_title, full.latitude, full.headers) == (
        "i, , Liczba pokoi: 2, Piętro: 3", "T", None, None)
    assert (full.active, full.scrape_date, full.inactive_date) == ("Yes", DAY, "-")
    assert (full.description_1, full.description_2) == ("x, y", None)
    assert (out["no details"].additional_info, out["no details"].rooms) == ("i", None)
    assert (out["grouped price"].price, out["grouped price"].currency) == (None, None)
    assert (out["bad area"].area, out["bad area"].price) == (None, 2500.0)
    assert out["too long"].description_4 is not None


def test_canonical_m_rows_that_used_to_lose_a_batch(spark):
    rows = [
        {"link": "bad\nprice", "price": ["ask"], "area": ["40,5", "m²"], "localization_path": list("abVKDxS")},
        {"link": "no path", "price": ["1 000", "zł"], "rooms": ["3", ""], "lat": "52.5", "lng": "x"},
    ]
    out = {r.link: r for r in canonical_m(raw(spark, RAW_M, *rows), DAY).collect()}
    bad = out["badprice"]
    assert (bad.price, bad.currency, bad.area) == (None, "ask", 40.5)
    assert (bad.voivodeship, bad.city, bad.district, bad.address) == ("V", "K", "D", "S")
    other = out["no path"]
    assert (other.city, other.price, other.rooms, other.latitude, other.longitude) == (None, 1000.0, "3", 52.5, None)


def test_both_sites_in_one_table(spark):
    both = offers_all(
        canonical_o(raw(spark, RAW_O, {"link": "a"}), DAY), canonical_m(raw(spark, RAW_M, {"link": "b"}), DAY)
    )
    assert sorted((r.link, r.page_name) for r in both.collect()) == [("a", "Otodom"), ("b", "Morizon")]


def test_listing_links(spark):
    seeds = pages(spark, [("s", "<ul class=pager><a>1</a><a>3</a></ul>"), ("t", "<p>"), ("u", None)])
    assert sorted(r.link for r in list_pages(seeds, PROFILE_O).collect()) == ["s?page=1", "s?page=2", "s?page=3", "t?page=1"]
    listing = "<article data-url='/x.html?1'></article><article></article><article data-url='/x.html?2'></article>"
    assert [r.link for r in list_offers(pages(spark, [("s", listing), ("t", None)]), PROFILE_O).collect()] == ["/x"]
    marked = "<a class='y property_link' href='/oferta/1'></a><a class=property_link href='/page'></a><a class=property_link>"
    assert [r.link for r in list_offers(pages(spark, [("s", marked)]), PROFILE_M).collect()] == ["/oferta/1"]
    places = "<ul id=locationListChildren><a href='/mieszkania/k'>k</a><a>no</a></ul>"
    assert [r.link for r in list_places(pages(spark, [("c", places), ("d", "")]), PROFILE_M, "https://h").collect()] == [
        "https://h/mieszkania/najnowsze/k"]
    assert len(REGIONS_O) == 15


def test_unread_listing_pages_are_reported(spark):
    seeds = pages(spark, [("s", "<ul class=pager><a>1</a></ul>"), ("u", None)])
    listing = read_listing(seeds, PROFILE_O, "pages")
    assert [tuple(r) for r in unread_pages(listing).collect()] == [("u", "no content")]
    assert sorted(r.link for r in list_pages(seeds, PROFILE_O).collect()) == ["s?page=1"]
    broken = spark.createDataFrame([("s", "<![unended")], "link string, html string")
    assert read_listing(broken, PROFILE_M).first().status in ("ok", "failed")


def test_one_row_per_link_of_two_attempts(spark):
    page = "<div class='summaryLocation clearfix row'><span>{}</span></div><nav class=breadcrumbs><span>a</span></nav><section class='propertyParams box'></section>"
    first = pages(spark, [("a", page.format("first")), ("b", None), ("c", None), ("d", page.format("d")), (None, page.format("n"))])
    again = pages(spark, [("b", page.format("second")), ("a", page.format("again")), ("d", None), ("e", "<p>")])
    out = {r.link: (r.status, r.title) for r in details(first, PROFILE_M.page_name, retried=again).collect()}
    assert out == {"a": ("ok", ["first"]), "b": ("ok", ["second"]), "c": ("failed", None), "d": ("ok", ["d"]), "e": ("dead", None)}


def test_bracketed_scalar_and_unclosed_paragraphs(spark):
    script = '{"props": {"pageProps": {"ad": {"target": {"Heating": "[gas] central", "Area": ["[x", "y"]}}}}}'
    row = spark.createDataFrame([(script,)], "s string").select(
        feature(parse_record(F.col("s")), "Heating").alias("h"), feature(parse_record(F.col("s")), "Area").alias("a")).first()
    assert (row.h, row.a) == (["[gas] central"], ["[x", "y"])
    markup = "".join(f"<p>word{i} <b>bold</b>" for i in range(5000))
    pick = Pick("t", tag="p", every=True, output="block_texts")
    texts = spark.createDataFrame([(markup,)], "h string").select(select_html(F.col("h"), [pick])["t"].alias("t")).first().t
    assert len(texts) == 5000 and texts[7] == "word7 bold" and sum(map(len, texts)) < len(markup)
    cell = "<p>a<table><tr><td><p>b<p>c</td></tr></table>"
    texts = spark.createDataFrame([(cell,)], "h string").select(select_html(F.col("h"), [pick])["t"].alias("t")).first().t
    assert texts[1:] == ["b", "c"]


def test_long_descriptions_keep_the_target_language(spark):
    polish, english = "mieszkanie jest bardzo ładne i przestronne", "the apartment is very nice and"
    corpus = spark.createDataFrame([("pl", polish), ("en", english)], "lang string, text string")
    model = train(corpus, "text", "lang", ["pl", "en"])
    mixed = " ".join([polish, english] * 300)
    rows = [{"link": "long", "description": [mixed]}, {"link": "short", "description": [mixed[:400]]}]
    out = {r.link: r for r in canonical_o(raw(spark, RAW_O, *rows), DAY, model=model).collect()}
    pieces = [out["long"][f"description_{i}"] for i in range(1, 5)]
    assert " ".join(p for p in pieces if p) == " ".join([polish] * 300)
    assert out["short"].description_1 == mixed[:400].rstrip()
