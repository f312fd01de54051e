"""The two phases of a site's run against the state tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelake.functions.wrap import description_rest
from estatelake.operators import changes, runlog
from estatelake.operators.records import split_by_status
from estatelake.plans.canonical import canonical_m, canonical_o
from estatelake.profiles import PROFILE_M, PROFILE_O
from estatelake.sources.state import State, check_site

# A registered offer counts as an attempt after any run.
NEVER = (1 << 63) - 1

CANONICAL = {PROFILE_O.page_name: canonical_o, PROFILE_M.page_name: canonical_m}


@dataclass(frozen=True)
class LinkPhase:
    """What a link phase found; ``withheld`` links vanished, but may stand on an unread page."""

    state: State
    new_links: DataFrame
    removed_links: DataFrame
    withheld_links: DataFrame


def link_rows(links: DataFrame, site: str) -> DataFrame:
    """Registry or queue rows of a site's links."""
    return links.select(
        F.xxhash64(F.lit(site), F.col("link")).alias("link_id"),
        F.lit(site).alias("page_name"),
        "link",
    )


def apply_links(
    state: State,
    snapshot: DataFrame,
    site: str,
    run_date: str,
    scope: str = "link",
    only_active: bool = False,
    max_removed_fraction: float | None = None,
    unread: DataFrame | None = None,
    listed: DataFrame | None = None,
    run_id: str | None = None,
) -> LinkPhase:
    """Log the run, diff the snapshot, drop vanished links and retire their offers.

    With ``scope='link'`` a vanished link is dropped and retired on every site,
    with ``'site'`` on its own. Nothing is rewritten: a run appends its vanished
    links, and reading resolves them. ``max_removed_fraction`` refuses a snapshot
    that would remove more than that share of the site's registry.

    ``unread`` are the listing pages that could not be read (``link``); they are
    recorded as failed. ``listed`` are the sightings (``link``, ``page``) of this
    run; the state keeps those of every link's last sighting. A vanished link is
    withheld, and stays as it is, if a page that showed it last is unread, or if
    the state does not know its pages; all others go.

    With a ``run_id`` a phase that has been published before is not run again:
    its results come back as they were.
    """
    if scope not in ("link", "site"):
        raise ValueError(f"unknown scope {scope!r}")
    check_site(site)
    key = _key(run_id, site, "links")
    if key and (done := state.published(key)):
        return _link_phase(State(state.spark, state.base), done["notes"])
    log = state.read("process_stage")
    published = {
        "process_stage": state.append("process_stage", runlog.log_entry(log, site, run_date))
    }
    notes = {"diff": state.work_path("diff"), "gone": state.work_path("gone")}
    diff = state.work_table("diff", changes.link_diff(snapshot, state.read("active_links", site)), notes["diff"])
    if not state.version:
        state.fit_buckets(diff.count())
    # A first run also lets null links through.
    notes["first"] = str(not diff.agg(F.max(F.col("n_registry") > 0)).first()[0])

    vanished = changes.removed_links_of(diff, distinct=True)
    if unread is not None and not unread.isEmpty():
        rows = failure_rows(state, unread, site, "listing")
        published["missing_links"] = state.append("missing_links", rows, site)
        seen, pages = state.read("link_pages", site), unread.select(F.col("link").alias("page"))
        marked = changes.withheld_links(vanished, seen.select("link", "page"), pages)
    else:
        marked = vanished.withColumn("withheld", F.lit(False))
    gone = state.work_table("gone", marked, notes["gone"])
    removed = gone.where("NOT withheld").select("link")
    count = removed.count()
    if max_removed_fraction is not None:
        _check_removed(count, diff, max_removed_fraction)
    if count:
        retired = removed.select(
            F.lit(site).alias("page_name"),
            "link",
            F.lit(scope == "link").alias("every_site"),
            F.lit(only_active).alias("only_active"),
            F.lit(run_date).alias("run_date"),
            F.lit(state.version + 1).cast("long").alias("run"),
        )
        published["deactivations"] = state.append("deactivations", retired)
    if listed is not None or state.site_folders("link_pages", site):
        rows = _last_sightings(state, site, listed, gone.where("withheld"))
        published["link_pages"] = state.rewrite_parts("link_pages", rows, [f"page_name={site}"])
    return _link_phase(state.publish(published, key, notes), notes)


def _key(run_id: str | None, site: str, phase: str) -> str | None:
    return run_id and f"{site}/{run_id}/{phase}"


def _link_phase(state: State, notes: Mapping[str, str]) -> LinkPhase:
    diff, gone = (state.spark.read.parquet(notes[name]) for name in ("diff", "gone"))
    new = changes.new_links_of(diff, null_too=notes["first"] == "True")
    return LinkPhase(
        state, new, gone.where("NOT withheld").select("link"), gone.where("withheld").select("link")
    )


def _last_sightings(state: State, site: str, listed: DataFrame | None, withheld: DataFrame) -> DataFrame:
    """The pages of this run's links, and the old ones of links that are withheld."""
    old = state.read("link_pages", site).join(withheld.select("link"), "link", "left_semi")
    if listed is None:
        return old
    fresh = listed.where(F.col("link").isNotNull() & F.col("page").isNotNull()).select("link", "page").distinct()
    return old.unionByName(fresh.select(
        F.lit(site).alias("page_name"), "link", "page", F.lit(state.version + 1).cast("long").alias("run")
    ))


def _check_removed(gone: int, diff: DataFrame, limit: float) -> None:
    known = diff.where("n_registry > 0").count()
    if known and gone / known > limit:
        raise ValueError(f"snapshot would remove {gone} of {known} links")


def queue_links(state: State, new_links: DataFrame, site: str, run_id: str | None = None) -> State:
    """Second half of the link phase: queue the new links (A6) and flag the stage.

    The failed tries of earlier runs are added to the site's counters (C33).
    """
    key = _key(run_id, site, "queue")
    if key and state.published(key):
        return State(state.spark, state.base)
    queued = link_rows(new_links.where(F.col("link").isNotNull()), site).withColumn(
        "run", F.lit(state.version + 1).cast("long")
    )
    done = runlog.stage_event(state.read("process_stage"), "scraping_offers", state.version + 1)
    counters = _counters(state, site).select(
        F.lit(site).alias("page_name"), "link", "queued", F.col("n").alias("attempts"),
        F.lit(state.version).cast("long").alias("run"),
    )
    return state.publish(
        {
            "to_scrape": state.append("to_scrape", queued, site),
            "stage_events": state.append("stage_events", done),
            "retry_counters": state.rewrite_parts("retry_counters", counters, [f"page_name={site}"]),
        },
        key,
    )


def apply_offers(
    state: State, offers: DataFrame, site: str, rest: DataFrame | None = None,
    failed: DataFrame | None = None, run_id: str | None = None,
) -> State:
    """Append offers (A4), flag the stage (C38), register the links that gave an offer (A5).

    ``rest`` are the description pieces beyond the four columns (C20), ``failed``
    the links whose page could not be read: they stay unregistered and come back
    as new in the next run. All of it is one commit; with a ``run_id`` a second
    one changes nothing.
    """
    key = _key(run_id, site, "offers")
    if key and state.published(key):
        return State(state.spark, state.base)
    done = runlog.stage_event(state.read("process_stage"), "scraping_details", state.version + 1)
    folders = state.append("preprocessing_offers", offers, site)
    loaded = state.read_folders(
        "preprocessing_offers", [f for f in folders if f not in state.tables["preprocessing_offers"]]
    )
    registered = link_rows(loaded.where(F.col("link").isNotNull()), site)
    published = {
        "preprocessing_offers": folders,
        "stage_events": state.append("stage_events", done),
        "active_links": state.append("active_links", registered, site),
    }
    if rest is not None:
        published["description_rest"] = state.append("description_rest", rest, site)
    if failed is not None:
        published["missing_links"] = state.append("missing_links", failure_rows(state, failed, site, "details"), site)
    return state.publish(published, key)


def failure_rows(state: State, failed: DataFrame, site: str, link_type: str) -> DataFrame:
    """Rows of the failed table for links that failed in the version being made."""
    run = state.version + 1
    return failed.where(F.col("link").isNotNull()).select(
        F.xxhash64(F.lit(site), F.col("link"), F.lit(run)).alias("missing_id"),
        F.lit(site).alias("page_name"),
        "link",
        F.lit(link_type).alias("link_type"),
        F.lit(run).cast("long").alias("run"),
    )


def record_failures(state: State, failed: DataFrame, site: str, link_type: str = "details") -> State:
    """Keep the links of one attempt that failed, for the retry query."""
    rows = failure_rows(state, failed, site, link_type)
    return state.publish({"missing_links": state.append("missing_links", rows, site)})


def _counters(state: State, site: str) -> DataFrame:
    """Per queued link its last queueing, failures since and whether an offer is registered now.

    The stored counters stand for all runs up to theirs; only rows of later runs are read with them.
    """
    counters = state.read("retry_counters", site)
    folded = F.coalesce(counters.agg(F.max("run")).scalar(), F.lit(0))
    later = F.col("run") > folded
    queue = state.read("to_scrape", site).where(later).select(
        "link", "run", F.lit(True).alias("q"), F.lit(0).cast("long").alias("n"), F.lit(False).alias("ok")
    )
    failed = state.read("missing_links", site).where((F.col("link_type") == "details") & later)
    parts = (
        queue.unionByName(failed.select("link", "run", F.lit(False).alias("q"), F.lit(1).cast("long").alias("n"), F.lit(False).alias("ok")))
        .groupBy("link", "run")
        .agg(F.bool_or("q").alias("q"), F.sum("n").alias("n"), F.bool_or("ok").alias("ok"))
        .withColumn("n", F.when(F.col("q"), 0).otherwise(F.col("n")))
    )
    so_far = counters.select(
        "link", F.col("queued").alias("run"), F.lit(True).alias("q"), F.col("attempts").alias("n"), F.lit(False).alias("ok")
    )
    loaded = state.read("active_links", site).select(
        "link", F.lit(NEVER).alias("run"), F.lit(False).alias("q"), F.lit(0).cast("long").alias("n"), F.lit(True).alias("ok")
    )
    return changes.merged_counters(parts.unionByName(so_far).unionByName(loaded))


def links_to_retry(state: State, site: str, limit: int = changes.ATTEMPTS) -> DataFrame:
    """Queued links of a site that failed since they were queued, gave no offer, and have tries left.

    A link that vanished and was listed again is queued anew: what happened
    before that does not count.
    """
    left = F.col("n").between(1, limit - 1) & ~F.col("ok")
    return _counters(state, site).where(left).select("link", F.col("n").alias("attempts"))


def links_given_up(state: State, site: str, limit: int = changes.ATTEMPTS) -> DataFrame:
    """Queued links of a site that have failed as often as they may."""
    over = (F.col("n") >= limit) & ~F.col("ok")
    return _counters(state, site).where(over).select("link", F.col("n").alias("attempts"))


def load_details(
    state: State, results: DataFrame, site: str, run_date: str, model: DataFrame | None = None, run_id: str | None = None
) -> State:
    """Detail results of a site to canonical offers in the state, failures to the failed table.

    Description pieces that have no column are published with the offers, and all
    of it at once: a failure before the commit leaves nothing, and with a
    ``run_id`` playing the load again after it changes nothing.
    """
    key = _key(run_id, site, "offers")
    if key and state.published(key):
        return State(state.spark, state.base)
    results = state.work_table("details", results)
    ok, failed, _ = split_by_status(results)
    wrapped = state.work_table("canonical", CANONICAL[site](ok, run_date, model=model, keep_lines=True))
    rest = description_rest(wrapped, "_lines", "page_name", "link", "scrape_date")
    return apply_offers(state, wrapped.drop("_lines"), site, rest, failed, run_id)
