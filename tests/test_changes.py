"""Change capture: worked cases, properties, and salting forced on small data."""

import random
from collections import Counter

import pytest

from estatelake.operators import changes, runlog
from estatelake.operators.contract import contract_report
from estatelake.operators.records import combine, join_retried, split_by_status
from estatelake.operators.skew import heavy_keys, keep_unlisted, mark_listed


def frame(spark, links):
    return spark.createDataFrame([(x,) for x in links], "link string")


def values(df):
    return sorted((r[0] for r in df.collect()), key=str)


def test_new_and_removed(spark):
    snapshot = frame(spark, ["a", "b", "b", None, "c"])
    registry = frame(spark, ["a", "x", "x", None])
    assert values(changes.new_links(snapshot, registry)) == ["b", "b", "c"]
    assert values(changes.new_links(snapshot, registry, distinct=True)) == ["b", "c"]
    assert values(changes.removed_links(snapshot, registry)) == ["x", "x"]
    assert values(changes.removed_links(snapshot, registry, distinct=True)) == ["x"]


def test_empty_registry_lets_everything_through(spark):
    snapshot, none = frame(spark, ["a", None, "a", None]), frame(spark, [])
    assert Counter(r[0] for r in changes.new_links(snapshot, none).collect()) == {"a": 2, None: 2}
    assert values(changes.removed_links(snapshot, none)) == []
    assert values(changes.removed_links(none, frame(spark, ["a", None]))) == ["a"]
    assert changes.link_status(none, none).count() == 0


def test_many_copies_are_built_from_bounded_slices(spark, monkeypatch):
    monkeypatch.setattr(changes, "COPIES_PER_ROW", 7)
    snapshot = frame(spark, ["hot"] * 100 + ["b"] * 7 + ["c"] * 8 + ["d"])
    copies = Counter(values(changes.new_links(snapshot, frame(spark, ["d"]))))
    assert copies == {"hot": 100, "b": 7, "c": 8}


def test_status_partitions_the_union(spark):
    rng = random.Random(3)
    for _ in range(3):
        now = [rng.choice("abcdefgh") for _ in range(6)]
        known = [rng.choice("abcdefgh") for _ in range(6)]
        status = dict(map(tuple, changes.link_status(frame(spark, now), frame(spark, known)).collect()))
        assert set(status) == set(now) | set(known)
        assert {k for k, v in status.items() if v == "kept"} == set(now) & set(known)
        assert {k for k, v in status.items() if v == "new"} == set(now) - set(known)
        gone = changes.removed_links(frame(spark, now), frame(spark, known), distinct=True)
        registry = frame(spark, known)
        left = changes.delete_links(registry, gone)
        after = changes.link_status(frame(spark, now), left).collect()
        assert "removed" not in {r.status for r in after}


def test_delete_by_link_on_any_site_or_one(spark):
    registry = spark.createDataFrame(
        [(1, "P", "a"), (2, "Q", "a"), (3, "P", "b"), (4, "Q", None)], "link_id long, page_name string, link string"
    )
    gone = frame(spark, ["a", "a", None])
    assert values(changes.delete_links(registry, gone)) == [3, 4]
    assert values(changes.delete_links(registry, gone, site="P")) == [2, 3, 4]


OFFERS = "link string, page_name string, active string, inactive_date string"


def test_deactivation(spark):
    offers = spark.createDataFrame(
        [("a", "P", "Yes", "-"), ("a", "Q", "No", "2023-01-01"), ("b", "P", "Yes", "-"), (None, "P", "Yes", "-")], OFFERS
    )
    gone = frame(spark, ["a", "a"])
    run = sorted(map(tuple, changes.deactivate_offers(offers, gone, "2024-01-02").collect()), key=str)
    assert run == [
        ("a", "P", "No", "2024-01-02"), ("a", "Q", "No", "2024-01-02"), ("b", "P", "Yes", "-"), (None, "P", "Yes", "-")]
    own = changes.deactivate_offers(offers, gone, "2024-01-02", site="Q").collect()
    assert sorted(r.inactive_date for r in own) == ["-", "-", "-", "2024-01-02"]
    active = changes.deactivate_offers(offers, gone, "2024-01-02", only_active=True).collect()
    assert sorted(r.inactive_date for r in active) == ["-", "-", "2023-01-01", "2024-01-02"]


def test_salted_membership_equals_plain_membership(spark):
    rng = random.Random(5)
    links = ["hot"] * 600 + ["warm"] * 300 + [f"k{rng.randrange(200)}" for _ in range(900)] + [None] * 20
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(links)], "i int, link string").repartition(16)
    listed = ["hot", "k1", "k2", "k3", "absent", "hot", None]
    for floor in (1, 50, 10**9):
        left = {r.i for r in keep_unlisted(rows, frame(spark, listed), "link", floor, salts=5).collect()}
        assert left == {i for i, x in enumerate(links) if x is None or x not in listed}
        marked = mark_listed(rows, frame(spark, listed), "link", "hit", floor, salts=5).collect()
        assert len(marked) == len(links)
        assert {r.i for r in marked if r.hit} == {i for i, x in enumerate(links) if x is not None and x in listed}


def test_heavy_keys_are_bounded(spark):
    rows = frame(spark, ["a"] * 9 + ["b"] * 8 + ["c"] * 7 + ["d"] + [None] * 50)
    assert values(heavy_keys(rows, "link", floor=2)) == ["a", "b", "c"]
    assert values(heavy_keys(rows, "link", floor=2, top=2)) == ["a", "b"]


def test_pending_links(spark):
    queue = frame(spark, ["new", "failed", "done", "spent", "done", "last", None])
    tried = [("failed", False)] * 5 + [("done", False), ("done", True)] + [("spent", False)] * 7 + [("last", False)] * 6 + [("other", False)]
    attempts = spark.createDataFrame(tried, "link string, ok boolean")
    assert sorted(map(tuple, changes.pending_links(queue, attempts).collect())) == [("failed", 5), ("last", 6), ("new", 0)]
    assert [tuple(r) for r in changes.exhausted_links(queue, attempts).collect()] == [("spent", 7)]


def test_attempts_count_from_the_last_queueing(spark):
    queue = spark.createDataFrame([("a", 1), ("a", 5), ("b", 1), ("c", 1)], "link string, run long")
    tried = [("a", 2, False), ("a", 3, True), ("a", 6, False), ("b", 2, True), ("c", 1, True), ("c", 4, False)]
    attempts = spark.createDataFrame(tried, "link string, run long, ok boolean")
    assert sorted(map(tuple, changes.pending_links(queue, attempts).collect())) == [("a", 1), ("c", 1)]


def test_split_join_and_combine(spark):
    results = spark.createDataFrame(
        [("a", 1, "ok", None), ("b", None, "failed", "e"), ("c", None, "dead", None)],
        "link string, v int, status string, error string",
    )
    ok, failed, dead = split_by_status(results)
    assert [tuple(r) for r in ok.collect()] == [("a", 1)]
    assert [tuple(r) for r in failed.collect()] == [("b", "e")]
    assert values(dead) == ["c"]
    assert values(join_retried(ok, frame(spark, ["b", None]))) == ["a", "b"]
    assert combine([ok, dead]).columns == ["link", "v"]


LOG = "curr_date string, page_name string, scraping_offers string, scraping_details string"


def test_run_log(spark):
    log = spark.createDataFrame(
        [("2024-01-01", "P", "F", "F"), ("2024-01-02", "P", "F", "F"), ("2024-01-02", "Q", "F", "F"), ("2024-01-02", "P", "F", "F")],
        LOG,
    )
    number = lambda site, day: runlog.log_entry(log, site, day).first().process_number
    assert [number("P", "2024-01-01"), number("P", "2024-01-02"), number("Q", "2024-01-03")] == [2, 2, 1]
    asked = spark.createDataFrame([("P", "2024-01-02"), ("R", "2024-01-01")], "page_name string, curr_date string")
    found = {(r.page_name, r.process_number) for r in runlog.run_numbers(log, asked).collect()}
    assert found == {("P", 2), ("R", 1)}
    assert runlog.latest_date(log).first().curr_date == "2024-01-02"
    flagged = runlog.flag_stage(log, "scraping_details").collect()
    assert {(r.curr_date, r.scraping_details, r.scraping_offers) for r in flagged} == {
        ("2024-01-01", "F", "F"), ("2024-01-02", "T", "F")}
    assert runlog.flag_stage(log.limit(0), "scraping_offers").count() == 0
    with pytest.raises(ValueError):
        runlog.flag_stage(log, "other")


def test_contract_report(spark):
    df = spark.createDataFrame([("abc", None, 1), ("a", "x", 2), (None, "yy", 3)], "a string, b string, c int")
    report = {r.column: (r.too_long, r.nulls, r.nullable) for r in contract_report(df, {"a": 2, "b": 1}, ("b",)).collect()}
    assert report == {"a": (1, 1, True), "b": (1, 1, False)}
