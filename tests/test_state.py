"""Runs against the state tables: the worked four-run lifecycle and the commit rules."""

import uuid

import pytest
from pyspark.sql import functions as F

from estatelake.operators.links import list_offers
from estatelake.operators.records import details
from estatelake.plans import phases
from estatelake.profiles import PROFILE_M
from estatelake.schemas import OFFERS, PROCESS_STAGE
from estatelake.session import shared_folder
from estatelake.sources.state import State, check_site, read_snapshot


@pytest.fixture
def state(spark):
    return State(spark, f"{shared_folder(spark)}/state-{uuid.uuid4().hex}")


def links(spark, text):
    return spark.createDataFrame([(x,) for x in text.split()], "link string")


def offers(spark, text, site, run_date):
    rows = [
        {"link": x, "page_name": site, "active": "Yes", "scrape_date": run_date, "inactive_date": "-"} for x in text.split()
    ]
    return spark.createDataFrame(rows, OFFERS) if rows else spark.createDataFrame([], OFFERS)


def run(state, snapshot, site, run_date, unreadable="", **options):
    """One run of both phases; returns the new state, the new links and the removed ones."""
    spark = state.spark
    phase = phases.apply_links(state, links(spark, snapshot), site, run_date, **options)
    new = sorted(r.link for r in phase.new_links.collect())
    gone = sorted(r.link for r in phase.removed_links.collect())
    state = phases.queue_links(phase.state, phase.new_links, site)
    readable = " ".join(x for x in new if x not in unreadable.split())
    state = phases.apply_offers(state, offers(spark, readable, site, run_date), site)
    return state, " ".join(new), " ".join(gone)


def registry(state):
    return " ".join(sorted(r.link for r in state.read("active_links").collect()))


def test_four_run_lifecycle(spark, state):
    state, *diff = run(state, "a b c", "P", "2024-01-01")
    assert diff == ["a b c", ""] and registry(state) == "a b c"
    state, *diff = run(state, "b c d e", "P", "2024-01-02", unreadable="e")
    assert diff == ["d e", "a"] and registry(state) == "b c d"
    (a,) = state.read("preprocessing_offers").where("link = 'a'").collect()
    assert (a.active, a.inactive_date) == ("No", "2024-01-02")
    state, *diff = run(state, "a c d e", "P", "2024-01-03")
    assert diff == ["a e", "b"] and registry(state) == "a c d e"
    rows = state.read("preprocessing_offers").where("link = 'a'").orderBy("scrape_date").collect()
    assert [(r.active, r.inactive_date) for r in rows] == [("No", "2024-01-02"), ("Yes", "-")]
    state, *diff = run(state, "c d e", "P", "2024-01-04")
    assert diff == ["", "a"] and registry(state) == "c d e"
    rows = state.read("preprocessing_offers").where("link = 'a'").collect()
    assert [(r.active, r.inactive_date) for r in rows] == [("No", "2024-01-04")] * 2
    log = state.read("process_stage").orderBy("curr_date").collect()
    assert [(r.curr_date, r.process_number, r.scraping_offers, r.scraping_details) for r in log] == [
        (f"2024-01-0{i}", 1, "T", "T") for i in range(1, 5)]
    assert sorted(r.link for r in state.read("to_scrape").collect()) == list("aabcdee")
    # Reopening the folder finds the same version.
    again = State(spark, state.base)
    assert (again.version, registry(again)) == (state.version, "c d e")


def test_same_snapshot_twice_changes_no_links(spark, state):
    state, *_ = run(state, "a b", "P", "2024-01-01")
    before = state.tables["active_links"]
    state, *diff = run(state, "a b", "P", "2024-01-01")
    assert diff == ["", ""] and state.tables["active_links"] == before
    assert sorted(r.process_number for r in state.read("process_stage").collect()) == [1, 2]


def test_removal_crosses_sites_unless_scoped(spark, state):
    state, *_ = run(state, "a b", "P", "2024-01-01")
    state, *_ = run(state, "a c", "Q", "2024-01-01")
    scoped, *_ = run(state, "b", "P", "2024-01-02", scope="site")
    assert sorted((r.page_name, r.link) for r in scoped.read("active_links").collect()) == [
        ("P", "b"), ("Q", "a"), ("Q", "c")]
    # The other run starts from the same version, so its commit is refused.
    with pytest.raises(RuntimeError, match="was published after"):
        run(state, "b", "P", "2024-01-02")


def test_removal_on_every_site_rewrites_nothing(spark, state):
    for site, shown in (("P", "a b"), ("Q", "a c"), ("R", "x")):
        state, *_ = run(state, shown, site, "2024-01-01")
    before = state.tables
    state, *_ = run(state, "b", "P", "2024-01-02")
    assert registry(state) == "b c x"
    for table in ("preprocessing_offers", "active_links", "process_stage"):
        assert set(before[table]) <= set(state.tables[table])
    (gone,) = state.tables["deactivations"]
    assert state.read_folders("deactivations", [gone]).count() == 1
    inactive = state.read("preprocessing_offers").where("active = 'No'").collect()
    assert sorted((r.page_name, r.link) for r in inactive) == [("P", "a"), ("Q", "a")]
    assert [r.link for r in state.read("active_links", "R").collect()] == ["x"]


def test_older_months_are_not_rewritten(spark, state):
    state, *_ = run(state, "a b", "P", "2024-01-31")
    state, *_ = run(state, "a b c", "P", "2024-02-01")
    january = [f for f in state.tables["preprocessing_offers"] if f.endswith("=2024-01")]
    state, *_ = run(state, "a b", "P", "2024-02-02")
    assert len(january) == 1 and january[0] in state.tables["preprocessing_offers"]
    rows = state.read("preprocessing_offers").select("link", "active").collect()
    assert sorted(map(tuple, rows)) == [("a", "Yes"), ("b", "Yes"), ("c", "No")]


def test_emptying_snapshot(spark, state):
    state, *_ = run(state, "a b", "P", "2024-01-01")
    with pytest.raises(ValueError, match="remove 2 of 2"):
        phases.apply_links(state, links(spark, ""), "P", "2024-01-02", max_removed_fraction=0.5)
    state, *diff = run(state, "", "P", "2024-01-02")
    assert diff == ["", "a b"] and registry(state) == ""
    assert {r.active for r in state.read("preprocessing_offers").collect()} == {"No"}


def test_unpublished_writes_stay_invisible(spark, state):
    state, *_ = run(state, "a", "P", "2024-01-01")
    state.append("active_links", phases.link_rows(links(spark, "z"), "P"), "P")
    assert registry(State(spark, state.base)) == "a"


def test_second_writer_of_a_version_fails_and_readers_go_on(spark, state):
    first, second = State(spark, state.base), State(spark, state.base)
    first.publish({"active_links": ["x"]})
    second._latest = lambda: {"version": 0}
    with pytest.raises(RuntimeError, match="another writer"):
        second.publish({"active_links": ["y"]})
    again = State(spark, state.base)
    assert (again.version, again.tables["active_links"]) == (1, ["x"])
    assert again.publish({}).version == 2


def test_unread_listing_page_retires_nothing(spark, state):
    state, *_ = run(state, "a b", "P", "2024-01-01")
    state, *diff = run(state, "b c", "P", "2024-01-02", unread=links(spark, "page-2"))
    assert diff == ["c", ""] and registry(state) == "a b c"
    assert {r.active for r in state.read("preprocessing_offers").collect()} == {"Yes"}
    assert [(r.link, r.link_type) for r in state.read("missing_links").collect()] == [("page-2", "listing")]
    state, *diff = run(state, "b c", "P", "2024-01-03", unread=links(spark, ""))
    assert diff == ["", "a"]


def test_only_links_of_unread_pages_are_withheld(spark, state):
    seen = lambda text: spark.createDataFrame([tuple(x.split("@")) for x in text.split()], "link string, page string")
    first = seen("a@1 b@1 b@2 c@2 d@3 e@3")
    state, *_ = run(state, "a b c d e", "P", "2024-01-01", listed=first)
    # Page 2 is unread: c and b were on it, d was not; a moved to page 3.
    phase = phases.apply_links(state, links(spark, "a e"), "P", "2024-01-02", unread=links(spark, "2"), listed=seen("a@3 e@3"))
    names = lambda df: " ".join(sorted(r.link for r in df.collect()))
    assert (names(phase.removed_links), names(phase.withheld_links)) == ("d", "b c")
    assert registry(phase.state) == "a b c e"
    kept = {(r.link, r.page) for r in phase.state.read("link_pages", "P").collect()}
    assert kept == {("a", "3"), ("e", "3"), ("b", "1"), ("b", "2"), ("c", "2")}
    # Page 3 is unread now: a and e may stand on it, b and c were last seen on 1 and 2.
    phase = phases.apply_links(phase.state, links(spark, ""), "P", "2024-01-03", unread=links(spark, "3"), listed=seen(""))
    assert (names(phase.removed_links), names(phase.withheld_links)) == ("b c", "a e")
    # Links that were seen without a page may stand anywhere.
    phase = phases.apply_links(phase.state, links(spark, "a e"), "P", "2024-01-04")
    phase = phases.apply_links(phase.state, links(spark, "e"), "P", "2024-01-05", unread=links(spark, "9"))
    assert (names(phase.removed_links), names(phase.withheld_links)) == ("", "a")
    assert names(phases.apply_links(phase.state, links(spark, "e"), "P", "2024-01-06").removed_links) == "a"


def test_a_site_is_read_without_moving_its_offers(spark, state):
    for site, shown in (("P", "a b c"), ("Q", "x y z")):
        state, *_ = run(state, shown, site, "2024-01-01")
    state, *_ = run(state, "b c d", "P", "2024-02-02")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    with_events = plan(state.read("preprocessing_offers", "P"))
    assert "Bucketed: true" in with_events and "Join" in with_events and "Exchange" not in with_events
    assert "Exchange" not in plan(state.read("active_links", "P"))
    # No link of Q can have been hit, and the offers of February are newer: they are read as they are.
    assert "Join" not in plan(state.read("preprocessing_offers", "Q"))
    february = [f for f in state.tables["preprocessing_offers"] if f.endswith("2024-02")]
    assert len(february) == 1 and not state._hits(february[0])
    state.forget()


def test_folders_that_cannot_hold_a_link_are_not_joined(spark, state):
    state, *_ = run(state, "a" * 300 + " b", "P", "2024-01-01")
    (folder,) = state.tables["preprocessing_offers"]
    low, high, site = state.spans[folder]
    assert (len(low), len(high), site) == (128, 1, "P")
    gone = lambda text: phases.apply_links(state, links(spark, text), "P", "2024-01-02").state._hits(folder)
    assert len(gone("b")) == 1  # the long link vanished; its first characters are enough to find it


def test_played_again_a_run_changes_nothing(spark, state):
    page = spark.createDataFrame([("/a", DETAIL.format(1)), ("/b", None)], "link string, html string")
    site = PROFILE_M.page_name
    for _ in range(3):
        state = State(spark, state.base)
        phase = phases.apply_links(state, links(spark, "/a /b"), site, "2024-01-01", run_id="one")
        assert sorted(r.link for r in phase.new_links.collect()) == ["/a", "/b"]
        state = phases.queue_links(phase.state, phase.new_links, site, "one")
        # Once the load dies before its commit: what it wrote is not seen.
        if not state.tables["preprocessing_offers"]:
            publish, State.publish = State.publish, lambda *_: (_ for _ in ()).throw(OSError("lost"))
            with pytest.raises(OSError):
                phases.load_details(state, details(page, site), site, "2024-01-01", run_id="one")
            State.publish = publish
        state = phases.load_details(State(spark, state.base), details(page, site), site, "2024-01-01", run_id="one")
    assert state.version == 3 and state.read("preprocessing_offers").count() == 1 and registry(state) == "/a"
    assert [(r.scraping_offers, r.scraping_details) for r in state.read("process_stage").collect()] == [("T", "T")]
    assert [tuple(r) for r in phases.links_to_retry(state, site).collect()] == [("/b", 1)]
    assert state.publish({"to_scrape": []}, "other").publish({"to_scrape": ["x"]}, "other").tables["to_scrape"] == []


def test_stage_flags_reach_only_rows_before_them(spark, state):
    for site in "PQ":
        state, *_ = run(state, "a", site, "2024-01-01")
    phase = phases.apply_links(state, links(spark, "a"), "P", "2024-01-01")
    flags = lambda s: sorted((r.page_name, r.process_number, r.scraping_offers, r.scraping_details) for r in s.read("process_stage").collect())
    assert flags(phase.state) == [("P", 1, "T", "T"), ("P", 2, "F", "F"), ("Q", 1, "T", "T")]
    state = phases.queue_links(phase.state, phase.new_links, "P")
    assert flags(state)[1] == ("P", 2, "T", "F")
    assert flags(state.compact()) == flags(state) and state.compact.__self__.tables["stage_events"]


def test_vacuum_keeps_what_commits_name(spark, state):
    for day in (1, 2, 3):
        state, *_ = run(state, "a b" if day < 3 else "b", "P", f"2024-01-0{day}")
    older, state = state, state.compact()
    orphan = older._write("to_scrape", older.read("to_scrape"))[0].rsplit("/", 1)[0]
    assert state.vacuum(keep=2, grace_seconds=3600) == []
    gone = state.vacuum(keep=2, grace_seconds=-5)
    named = {"/".join(f.split("/")[:2]) for s in (older, state) for folders in s.tables.values() for f in folders}
    assert orphan in gone and not named & set(gone)
    assert registry(older) == registry(state) == "b"  # the commit before is read by another
    assert older.read("preprocessing_offers").count() == state.read("preprocessing_offers").count() == 2
    gone = state.vacuum(keep=1, grace_seconds=-5)
    assert {f.split("/")[0] for f in gone} >= {"preprocessing_offers", "active_links", "deactivations"}
    assert registry(State(spark, state.base)) == "b"


def test_compaction_counts_files_from_bytes(spark, state, monkeypatch):
    names = " ".join(f"https://x.y/{i * 7919 % 10007:05d}" for i in range(2000))
    state, *_ = run(state, names, "P", "2024-01-01")
    monkeypatch.setattr("estatelake.sources.state.FILE_BYTES", 2000)
    made = state.compact()
    assert made.buckets > state.buckets and state.buckets == 8
    files = lambda s, t: len(s.read_folders(t, s.tables[t]).inputFiles())
    assert files(made, "active_links") == made.buckets and files(made, "to_scrape") > 1
    assert registry(made) == registry(state)
    made, *diff = run(made, names.replace("https://x.y/00000 ", ""), "P", "2024-01-02")
    assert diff == ["", "https://x.y/00000"] and registry(made) == registry(state).replace("https://x.y/00000 ", "")


def test_relisted_links_are_retried(spark, state):
    site = PROFILE_M.page_name
    page = lambda html: spark.createDataFrame([("/a", html)], "link string, html string")
    for day, shown, html in (("1", "/a", DETAIL.format(1)), ("2", "", None), ("3", "/a", None)):
        phase = phases.apply_links(state, links(spark, shown), site, f"2024-03-0{day}")
        state = phases.queue_links(phase.state, phase.new_links, site)
        if shown:
            state = phases.load_details(state, details(page(html), site), site, f"2024-03-0{day}")
    assert [tuple(r) for r in phases.links_to_retry(state, site).collect()] == [("/a", 1)]
    for _ in range(6):
        state = phases.record_failures(state, links(spark, "/a"), site)
    assert phases.links_to_retry(state, site).count() == 0
    assert [tuple(r) for r in phases.links_given_up(state, site).collect()] == [("/a", 7)]


def test_compacted_state_reads_the_same(spark, state):
    for day, shown in (("1", "a b c"), ("2", "b c"), ("3", "a c"), ("4", "c")):
        state, *_ = run(state, shown, "P", f"2024-02-0{day}", only_active=day == "4")
    key = lambda s: sorted(map(tuple, s.read("preprocessing_offers").select("link", "scrape_date", "active", "inactive_date").collect()))
    before, log, known = key(state), state.read("process_stage").count(), registry(state)
    state = state.compact()
    assert key(state) == before and state.read("process_stage").count() == log and registry(state) == known
    assert state.tables["deactivations"] == [] and len(state.tables["preprocessing_offers"]) == 1
    state, *diff = run(state, "", "P", "2024-02-05")
    assert diff == ["", "c"] and {r[3] for r in key(state) if r[0] == "c"} == {"2024-02-05"}


def test_long_descriptions_are_published_whole(spark, state):
    site = PROFILE_M.page_name
    words = " ".join(f"w{i:05d}" for i in range(3500))
    html = DETAIL.format(1) + f"<div class='description'><p>{words}</p></div>"
    pages_ = spark.createDataFrame([("/a", html), ("/b", DETAIL.format(2))], "link string, html string")
    state = phases.load_details(state, details(pages_, site), site, "2024-03-01")
    (row,) = state.read("preprocessing_offers").where("link = '/a'").collect()
    rest = state.read("description_rest").orderBy("piece_no").collect()
    assert [(r.link, r.scrape_date, r.piece_no) for r in rest] == [("/a", "2024-03-01", 5), ("/a", "2024-03-01", 6), ("/a", "2024-03-01", 7)]
    assert " ".join([row.description_1, row.description_2, row.description_3, row.description_4] + [r.text for r in rest]) == words


def test_empty_tables_have_their_schemas(spark, state):
    assert state.read("process_stage").schema.names == PROCESS_STAGE.names
    assert state.read("preprocessing_offers", "P").schema == OFFERS
    with pytest.raises(ValueError):
        check_site("a/b")
    with pytest.raises(ValueError):
        phases.apply_links(state, links(spark, "a"), "P", "2024-01-01", scope="all")


def test_snapshot_reader_and_failures(spark, state, tmp_path):
    links(spark, "a b").withColumn("n", F.lit(1)).write.parquet(str(tmp_path / "snap"))
    assert read_snapshot(spark, str(tmp_path / "snap")).columns == ["link"]
    state = phases.record_failures(state, links(spark, "x y"), "P")
    assert {(r.link, r.link_type) for r in state.read("missing_links").collect()} == {("x", "details"), ("y", "details")}


LISTING = "<a class=property_link href='/oferta/{}'>x</a>"
DETAIL = """<div class="summaryLocation clearfix row"><span>T</span></div>
<nav class="breadcrumbs"><span>a</span><span>b</span><span>V</span><span>K</span></nav>
<li class="paramIconPrice"><em>~{}00,5 <b>zł</b></em></li><section class="propertyParams"></section>"""


def test_pages_to_offers_with_retry(spark, state):
    site = PROFILE_M.page_name
    listing = spark.createDataFrame([(str(i), LISTING.format(i)) for i in range(1, 5)], "link string, html string")
    phase = phases.apply_links(state, list_offers(listing, PROFILE_M), site, "2024-03-01")
    state = phases.queue_links(phase.state, phase.new_links, site)
    stored = [(f"/oferta/{i}", DETAIL.format(i)) for i in (1, 2)] + [("/oferta/3", None), ("/oferta/4", "<p>gone</p>")]
    stored = spark.createDataFrame(stored, "link string, html string")
    new_pages = stored.join(phase.new_links.distinct(), "link", "left_semi")
    state = phases.load_details(state, details(new_pages, site), site, "2024-03-01")
    assert registry(state) == "/oferta/1 /oferta/2"
    priced = state.read("preprocessing_offers").select("link", "price", "city").collect()
    assert sorted(map(tuple, priced)) == [("/oferta/1", 100.5, "K"), ("/oferta/2", 200.5, "K")]
    assert [tuple(r) for r in phases.links_to_retry(state, site).collect()] == [("/oferta/3", 1)]
    assert phases.links_to_retry(state, site, limit=1).count() == 0
    second = spark.createDataFrame([("/oferta/3", DETAIL.format(3))], "link string, html string")
    state = phases.load_details(state, details(second, site), site, "2024-03-01")
    assert phases.links_to_retry(state, site).count() == 0
    assert registry(state) == "/oferta/1 /oferta/2 /oferta/3"


def test_compaction_cuts_repeated_links_by_rows(spark, state, monkeypatch):
    """Copies of a few links take few bytes, but many rows: one task must not sort them all."""
    state, *_ = run(state, "a b c d e f g h " * 40, "P", "2024-01-01")
    state, *_ = run(state, "a b", "Q", "2024-01-01")
    monkeypatch.setattr("estatelake.sources.state.FILE_ROWS", 40)
    made = state.compact()
    sizes = lambda site: [
        r["count"] for r in made.read_folders("to_scrape", made.site_folders("to_scrape", site)).groupBy(F.input_file_name()).count().collect()
    ]
    assert len(sizes("P")) > 2 and sum(sizes("P")) == 320 and sizes("Q") == [2]


def test_first_snapshot_chooses_the_buckets(spark, state, monkeypatch):
    monkeypatch.setattr("estatelake.sources.state.BUCKET_LINKS", 100)
    names = " ".join(f"https://x.y/{i:05d}" for i in range(2000))
    state, *_ = run(state, names, "P", "2024-01-01")
    assert state.buckets == 32
    assert len(state.read_folders("active_links", state.tables["active_links"]).inputFiles()) == 32
    state, *diff = run(state, names.replace("https://x.y/00007 ", ""), "P", "2024-01-02")
    assert diff == ["", "https://x.y/00007"] and state.buckets == 32
    assert state.read("preprocessing_offers").where("active = 'No'").count() == 1
