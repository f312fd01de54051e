"""Selection from tag soup, and the embedded record."""

import json
import time

from pyspark.sql import functions as F

from estatelake.functions import json_fields as J
from estatelake.functions.html import Pick, select_html
from estatelake.functions.text import strip_styling
from estatelake.operators.links import anchors


def pick_one(evaluate, html, **how):
    (found,) = evaluate([html], "string", lambda x: select_html(x, [Pick("f", **how)])["f"])
    return found


def test_child_strings_skip_children_without_a_single_string(evaluate):
    html = "<h1 class='a b'> x <b> y </b><i>p<u>q</u></i><!-- c --><em><s>z</s></em></h1>"
    assert pick_one(evaluate, html, tag="h1", attr="class", value="b") == ["x", "y", "c", "z"]
    assert pick_one(evaluate, html, tag="h1", attr="class", value="a b") == ["x", "y", "c", "z"]
    assert pick_one(evaluate, html, tag="h1", attr="class", value="b a") is None
    assert pick_one(evaluate, "<h1></h1>", tag="h1") == []


def test_descendant_strings_and_texts(evaluate):
    html = "<div id=d><p> one </p><p>two <b>three</b></p><section><p>four</section></div><p>five</p>"
    assert pick_one(evaluate, html, attr="id", value="d", output="strings", inner="p") == ["one", "four"]
    assert pick_one(evaluate, html, attr="id", value="d", output="texts", inner="p") == [" one ", "two three", "four"]
    assert pick_one(evaluate, html, tag="p", every=True, output="texts")[-1] == "five"
    assert pick_one(evaluate, html, tag="h3", every=True, output="texts") == []
    assert pick_one(evaluate, html, tag="h3", output="texts") is None


def test_silent_content_and_entities(evaluate):
    html = "<div>a &amp; b<style>.x{}</style><script>var y</script><!--z--> &lt;c&gt;</div>"
    assert pick_one(evaluate, html, tag="div", output="texts") == ["a & b <c>"]


def test_white_space_between_tags_counts_once(evaluate):
    html = "<table>\n   <tr>\n\n <td>k</td>   <td>v</td></tr></table>"
    assert pick_one(evaluate, html, tag="table", output="texts") == ["\n\nk v"]
    assert pick_one(evaluate, "<pre>\n  \n<b>x</b></pre>", tag="pre", output="texts") == ["\n  \nx"]


def test_block_texts(evaluate):
    html = "<p>a<br>b<div>c<br>d</div><span>e<li>f</li></span></p>"
    assert pick_one(evaluate, html, tag="p", every=True, output="block_texts") == ["a\n\nbcd\n\nef\n\n"]
    # A new paragraph ends an open one.
    nested = pick_one(evaluate, "<p>a<p>b</p>", tag="p", every=True, output="block_texts")
    assert nested == ["a", "b"]


def test_child_texts_and_attributes(evaluate):
    html = "<div id=d><b>x</b><i></i><u>y<s>z</s></u></div><a href>e</a><a>n</a><a href='/h' href='/i'>h</a>"
    assert pick_one(evaluate, html, attr="id", value="d", output="child_texts") == ["x", "yz"]
    assert pick_one(evaluate, html, tag="a", every=True, output="attr", arg="href") == ["", "/i"]


def test_first_inner_element(evaluate):
    html = "<li class='p'>x<em>1 <b>zł</b></em><em>2</em></li>"
    where = {"tag": "li", "attr": "class", "value": "p", "inner": "em", "inner_first": True}
    assert pick_one(evaluate, html, **where) == ["1", "zł"]
    assert pick_one(evaluate, "<li class='p'>x</li>", **where) is None


def test_stray_end_tags_and_void_tags(evaluate):
    html = "</b><div>a</span><img src=x>b<p/>c</div>d"
    assert pick_one(evaluate, html, tag="div", output="texts") == ["abc"]


def test_deeply_unclosed_markup(evaluate):
    html = "<div>" * 3000 + "x"
    assert pick_one(evaluate, html, tag="div", output="texts") == ["x"]


def test_anchor_lists_are_independent(evaluate):
    html = "<ul class='pager big'><a href='/1'> 1 </a><a>2</a><a href='/3'><b>3</b>x</a></ul>"
    (found,) = evaluate([html], "string", lambda x: anchors(x, "class", "pager"))
    assert (found["a_names"], found["a_hrefs"]) == ([" 1 ", "2"], ["/1", "/3"])


def test_unreadable_page_reports(evaluate):
    rows = evaluate([None, "<p>x"], "string", lambda x: select_html(x, [Pick("f", "p")]))
    assert rows[0]["f"] is None and "TypeError" in rows[0]["error"]
    assert rows[1]["f"] == ["x"] and rows[1]["error"] is None


def test_longest_script(evaluate):
    html = "<script>aa</script><SCRIPT>bbb</SCRIPT><script>ccc</script><p>long text that is no script</p>"
    assert evaluate([html, "<p>", None], "string", J.longest_script) == ["bbb", None, None]


def record(**ad):
    return json.dumps({"props": {"pageProps": {"ad": ad}}})


def columns_of(evaluate, texts):
    rows = evaluate(
        texts,
        "string",
        lambda x: F.struct(*(c.alias(n) for n, c in J.record_columns(J.parse_record(x)).items())),
    )
    return [r.asDict() for r in rows]


def test_record_columns(evaluate):
    full = record(
        location={
            "coordinates": {"latitude": 52.25, "longitude": "21.5"},
            "address": [{"value": "Main 1"}, {"value": "x"}],
            "geoLevels": [{"type": "region", "label": "M"}, {"type": "city", "label": "K"}, {"type": "city", "label": "L"}],
        },
        target={"Area": 45.5, "Heating": ["gas", "coal"], "Rent": "10", "Deposit": None},
    )
    (row,) = columns_of(evaluate, [full])
    assert (row["lat"], row["lng"]) == (52.25, 21.5)
    assert (row["address"], row["voivodeship"], row["city"], row["district"]) == ("Main 1", "M", "K", None)
    assert (row["Area"], row["Heating"], row["Rent"]) == (["45.5"], ["gas", "coal"], ["10"])
    assert row["Deposit"] is None and row["Floor_no"] is None


def test_broken_records_are_null_field_by_field(evaluate):
    half = record(location={"coordinates": {"latitude": {"x": 1}, "longitude": 2}, "address": {"value": "x"}}, target=7)
    rows = columns_of(evaluate, ["not json", "{}", half, None])
    assert all(v is None for row in (rows[0], rows[1], rows[3]) for v in row.values())
    assert rows[2]["lng"] == 2.0 and rows[2]["address"] is None


def test_unclosed_marks_take_time_in_proportion(spark):
    def seconds(mark, expression, n):
        df = spark.createDataFrame([(mark * n,)] * 2, "x string").select(expression(F.col("x")).alias("y"))
        df.collect()
        start = time.perf_counter()
        df.collect()
        return time.perf_counter() - start

    for mark, expression in (("<script>", J.longest_script), ("<script", J.longest_script), ("a.css{", strip_styling), ("@media ", strip_styling)):
        assert seconds(mark, expression, 400_000) < 16 * seconds(mark, expression, 100_000) + 1, mark


def test_scripts_before_an_unclosed_one_are_found(evaluate):
    pages = ["<script>ab</script><script>c", "<script x>ab</SCRIPT ><script <script>abc", "<scripty>x</scripty>", "<script>a<script>b</script>"]
    assert evaluate(pages, "string", J.longest_script) == ["ab", "ab", None, "a<script>b"]


def test_pages_are_taken_apart_slice_by_slice(spark):
    """Spark hands over batches of 10,000 pages; the fields of all of them are never held at once."""
    html = F.when(F.col("id") % 7 != 3, F.concat(F.lit("<p>x<b>"), "id", F.lit("</b><br class='z'></p>")))
    pages = spark.range(0, 250, 1, 1).select("id", html.alias("html"))
    found = pages.select("id", select_html(F.col("html"), [Pick("f", "b"), Pick("g", "i", every=True)]).alias("f"))
    rows = {r.id: r.f for r in found.collect()}
    assert len(rows) == 250
    assert all(r.f == [str(i)] and r.g == [] and r.error is None for i, r in rows.items() if i % 7 != 3)
    assert all(r.f is None and r.g is None and r.error.startswith("TypeError") for i, r in rows.items() if i % 7 == 3)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython [select(" in plan and ", 251" in plan  # an iterator over Arrow arrays
