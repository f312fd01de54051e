"""Worked examples, expected values written by hand."""

import math

from pyspark.sql import functions as F

from estatelake.functions import text as T
from estatelake.functions.html import decode_page
from estatelake.operators.keyvalues import attributes_o, kv_keys, widen

NBSP = "\xa0"


def test_decode_page(evaluate):
    stored = [bytearray("zażółć".encode()), bytearray("café".encode("latin-1")), None]
    assert evaluate(stored, "binary", decode_page) == ["zażółć", "café", None]


def test_page_numbers(evaluate):
    labels = [["1", "2", "4"], [], ["1", "next"], None, ["0"]]
    assert evaluate(labels, "array<string>", T.page_numbers) == [[1, 2, 3, 4], [1], [1], [1], []]


def test_links(evaluate):
    assert evaluate(["https://h/x-1.html?a=1", "https://h/x", None], "string", T.canonical_link) == [
        "https://h/x-1", "https://h/x", None]
    rewritten = evaluate(["/a/flats/flats"], "string", lambda x: T.rewrite_link(x, "flats", "flats/new"))
    assert rewritten == ["/a/flats/new/flats/new"]


def test_strip_styling(evaluate):
    given = ["50 m.css-1a{color:red} x", "Xcss{a}", "css-only}", "a@media (x){b}c", ".css\n}", None]
    assert evaluate(given, "string", T.strip_styling) == ["50 m x", "", "css-only}", "ac", ".css\n}", None]


def test_join_list(evaluate):
    assert evaluate([["a", "", "b"], [""], None], "array<string>", T.join_list) == ["a, b", "", None]


def test_clean_breaks(evaluate):
    given = ["a\n\nb", "a, ,b", "a\n\n\n\nb", f"a{NBSP}b", "a\\xa0b", None]
    assert evaluate(given, "string", T.clean_breaks_o) == ["a, b", "a,b", "a, b", f"a{NBSP}b", "a b", None]
    assert evaluate(["a\n\n\n\nb\nc", "a,,b", None], "string", T.clean_breaks_m) == ["a, bc", "a,b", None]


def test_key_values_o(evaluate):
    given = ["Liczba pokoi:2, Piętro:3", "A:1, A:2, odd", "", None, "Okna:a, b, Piętro:3"]
    assert evaluate(given, "string", T.key_values_o) == [
        {"Liczba pokoi": "2", "Piętro": "3"}, {"A": "2"}, {}, None, {"Okna": "a", "b": "Piętro"}]


def test_key_values_m(evaluate):
    given = ["Piętro: 3 / 4 , Rok budowy: 1990", f"{NBSP}A\t: 1 ,A:2 ,B", None]
    assert evaluate(given, "string", T.key_values_m) == [
        {"Piętro": "3 / 4", "Rok budowy": "1990"}, {"A": "2"}, None]


def test_wide_attributes(spark):
    df = spark.createDataFrame([(1, "A:x, B:y"), (2, "B:z"), (3, None)], "i int, t string")
    df = df.select("i", T.key_values_o(F.col("t")).alias("kv"))
    assert {r.key for r in kv_keys(df, "kv").collect()} == {"A", "B"}
    wide = widen(df, "kv", ["A", "B", "C"]).orderBy("i").collect()
    assert [(r.A, r.B, r.C) for r in wide] == [("x", "y", None), (None, "z", None), (None, None, None)]
    assert [r.rooms for r in df.select(attributes_o("kv")["rooms"].alias("rooms")).collect()] == [None] * 3


def test_price_and_currency_o(evaluate):
    given = ["2 500 zł", "1 234,56 zł", "Zapytaj o cenę", None, "1.500,00 zł", "ok. 2500 zł", ",", "2500 zł/m²",
             f"2{NBSP}500{NBSP}zł", "2 500, zł"]
    assert evaluate(given, "string", T.price_o) == [
        2500.0, 1234.56, None, None, None, 0.25, None, 2500.0, 2500.0, 2500.0]
    assert evaluate(given, "string", T.currency_o) == [
        "zł", "zł", None, None, None, "zł", None, "zł/m²", "zł", "zł"]


def test_number_and_currency_m(evaluate):
    given = [["~45,5 ", "m²"], ["2 500", "zł"], ["x"], [], None, ["1d"], [f"7{NBSP}"], [f"2{NBSP}500"], ["-1.5e2"]]
    assert evaluate(given, "array<string>", T.number_m) == [
        45.5, 2500.0, None, None, None, None, 7.0, None, -150.0]
    assert evaluate([["2 500", "zł"], [], None], "array<string>", T.currency_m) == ["zł", None, None]


def test_floor_m(evaluate):
    assert evaluate(["3 / 4", "parter", "", f"{NBSP}5{NBSP}x", None], "string", T.floor_m) == [
        "3", "parter", None, "5", None]


def test_address_m(evaluate):
    paths = [list("abVK"), list("abVKD"), list("abVKDD"), list("abVKDxS"), ["a"], None]
    found = evaluate(paths, "array<string>", lambda p: F.struct(*(c.alias(n) for n, c in T.address_m(p).items())))
    assert [tuple(r) for r in found] == [
        ("V", "K", None, None), ("V", "K", "D", None), ("V", "K", "D", None), ("V", "K", "D", "S"),
        (None,) * 4, (None,) * 4]


def test_additional_info(spark):
    df = spark.createDataFrame([("i", "k:v"), ("i", None), (None, "k:v"), (None, None)], "a string, b string")
    out = df.select(T.additional_info(F.col("a"), F.col("b")).alias("y")).collect()
    assert [r.y for r in out] == ["i, k: v", "i", None, None]


def test_blank_and_nan(evaluate):
    assert evaluate(["", "a", None], "string", T.blank_to_null) == [None, "a", None]
    assert evaluate([math.nan, 1.0, None], "double", T.nan_to_null) == [None, 1.0, None]


def test_chunks(evaluate):
    given = ["A b-c, d e f g H", "  \n ", None, f"a{NBSP}b c\x1cd"]
    assert evaluate(given, "string", T.chunk_words) == [
        ["A", "bc", "d", "e", "f", "g", "H"], [], None, ["a", "b", "c", "d"]]
    assert evaluate(given[:3], "string", lambda x: T.chunks(T.chunk_words(x))) == [["a bc d e f g", "h"], [], None]


def test_words_split_like_python(evaluate):
    spaces = [c for c in map(chr, range(0x3100)) if c.isspace()]
    assert sorted(T.SPACES) == spaces
    given = ["x" + c + "y" for c in map(chr, range(0x3100))]
    assert evaluate(given, "string", T.words) == [g.split() for g in given]
    assert evaluate([c + "z" + c for c in spaces], "string", T.strip) == ["z"] * len(spaces)
