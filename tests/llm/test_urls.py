import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from estatelake.llm import urls
from estatelake.llm.queries import URL_RULES, op11_url_filter


def plain(rows, rules, default="allow"):
    out = []
    for page_id, url in rows:
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
        host = m[1].translate({c: c + 32 for c in range(65, 91)}) if m else ""
        path = m[2] if m else ""
        fit = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fit, default=None)  # of one rule with both verdicts, block is the greater
        out.append((page_id, host, path, best[2] if best else None, best[3] if best else default))
    return out


def order(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: [(x is not None, x) for x in r])


def check(spark, rows, rules, tmp_path):
    listed = urls.write_list(urls.rule_table(spark, rules), str(tmp_path / "list"))
    got = urls.judge(spark.createDataFrame(rows, "page_id long, url string"), listed)
    assert order(got.collect()) == order(plain(rows, [(h or "", p or "", v) for h, p, v in rules]))


URLS = [None, "", "no scheme", "http://", "HTTP://A.COM", "http://a.com/", "x://a.com?q=/en/", "x://a.com#/", "x://Com/",
        "x://.com/", "x://com./", "x://xcom/", "x://b.a.com/en/1", "x://b.a.com/english", "x://b.a.com/EN/", "x://ÄB.com/é/ü",
        "x://u:p@a.com:80/en/", "x://y://z.net/fr/", "a\nb://net/fr/\n?x", "x://" + "s." * 3000 + "a.com/" + "p/" * 5000,
        "x://http://a.com/", "://a.com/en/"]


def test_rules_of_every_kind(spark, tmp_path):
    rules = [("com", "/", "allow"), ("a.com", "/en", "block"), ("b.a.com", "/en/", "allow"), ("net", "/fr/", "block"),
             ("Äb.com", "/é", "block"), ("y:", "", "block"), ("", "", "block"), ("a.com", "/en", "allow"), (None, "/", "allow"),
             ("a.com:80", None, "block"), ("z/", "/", "block"), ("com", "x", "block")]
    rows = [(i, u) for i, u in enumerate(URLS)] + [(None, "x://a.com/en/"), (3, "x://a.com/en/"), (3, "x://a.com/en/")]
    rules = [(h.replace("Ä", "Ä") if h else h, p, v) for h, p, v in rules]
    check(spark, rows, rules, tmp_path)


def test_equal_lengths_go_to_the_longer_host(spark, tmp_path):
    rules = [("b.com", "/", "block"), ("com", "/x/", "allow")]
    check(spark, [(1, "x://b.com/x/"), (2, "x://b.com/y"), (3, "x://c.com/x/")], rules, tmp_path)


@pytest.mark.parametrize("rows", [[], [(1, "x://a.com/")]])
def test_empty_tables(spark, tmp_path, rows):
    check(spark, rows, [], tmp_path)
    check(spark, rows, URL_RULES, tmp_path / "some")


def test_many_rules_in_several_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(urls, "FILE_RULES", 100)
    rules = [(f"h{i}.org", f"/{i % 7}/", ("allow", "block")[i % 2]) for i in range(1000)]
    check(spark, [(i, f"https://w.h{i}.org/{i % 5}/x") for i in range(1100)], rules, tmp_path)


def test_digests_that_collide_are_told_apart_by_their_strings(tmp_path):
    names = [b"a.com/", b"b.com/", b"c.com/"]
    same = np.uint64(xxhash.xxh64_intdigest(b"b.com/", urls.SEED)).astype(np.int64)
    np.array([same] * 3).tofile(tmp_path / "digests")
    np.cumsum([len(n) for n in names]).astype(np.int64).tofile(tmp_path / "ends")
    (tmp_path / "strings").write_bytes(b"".join(names))
    np.array([False, True, False]).tofile(tmp_path / "blocks")
    assert urls.SortedDigests(tmp_path).find([b"b.com/", b"x", b"c.com/"]) == [True, None, None]


def test_a_list_beyond_its_bound_is_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="max_bytes"):
        urls.write_list(urls.rule_table(spark, URL_RULES), str(tmp_path), max_bytes=10)


def test_other_columns_and_shuffles(spark, tmp_path):
    listed = urls.write_list(urls.rule_table(spark, URL_RULES), str(tmp_path / "list"))
    df = spark.createDataFrame([(1, "x://example.com/en/")], "page_id long, url string")
    df = df.withColumns({c: F.lit("mine") for c in ("host", "path", "rule", "verdict", "html")})
    got = urls.judge(df, listed)
    assert [tuple(r) for r in got.collect()] == [(1, "example.com", "/en/", "example.com/en/", "block")]
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()


def test_query_over_the_whole_table(spark, tables):
    rows = [tuple(r) for r in spark.read.parquet(f"{tables}/pages.parquet").select("page_id", "url").collect()]
    assert order(op11_url_filter(spark, tables).collect()) == order(plain(rows, URL_RULES))
