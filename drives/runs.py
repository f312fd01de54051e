"""Run log (C35 to C38) and whole runs against the state tables."""

import uuid

from pyspark.sql import functions as F

from drives.registry import query
from estatelake.functions.text import canonical_link
from estatelake.operators import runlog
from estatelake.plans import phases
from estatelake.schemas import OFFERS
from estatelake.session import shared_folder
from estatelake.sources.state import State, read_snapshot

DAY_SQL = "strftime(ts, '%Y-%m-%d')"


def log(t):
    return t.events.select(
        "event_id",
        F.date_format("ts", "yyyy-MM-dd").alias("curr_date"),
        F.col("event_type").alias("page_name"),
        "value",
        F.lit("F").alias("scraping_offers"),
        F.lit("F").alias("scraping_details"),
    )


@query(
    f"""
WITH log AS (SELECT event_type AS page_name, {DAY_SQL} AS curr_date, value FROM events)
SELECT page_name, curr_date,
       CAST(CASE WHEN max(value) >= 100 THEN 2 ELSE 1 END AS INTEGER) AS process_number
FROM log GROUP BY page_name, curr_date"""
)
def run_number(t):
    return runlog.run_numbers(log(t).where("value >= 100"), log(t))


@query(f"SELECT count(*) AS n_runs FROM events WHERE event_type = 'click' AND {DAY_SQL} = '2024-01-15'")
def runs_on_date(t):
    return runlog.runs_on(log(t), "click", "2024-01-15")


@query(f"SELECT max({DAY_SQL}) AS curr_date FROM events")
def latest_date(t):
    return runlog.latest_date(log(t))


@query(
    f"""
SELECT event_id, {DAY_SQL} AS curr_date, event_type AS page_name, 'F' AS scraping_details,
       CASE WHEN {DAY_SQL} = (SELECT max({DAY_SQL}) FROM events) THEN 'T' ELSE 'F' END AS scraping_offers
FROM events"""
)
def stage_flags(t):
    return runlog.flag_stage(log(t), "scraping_offers").drop("value")


# --- whole runs: one site, one snapshot per two order years ----------------------
# Run k sees the listings of all lines shipped in its years; a listing whose line
# was returned fails to parse and must come back as new in the next run. Lines
# before the first and after the last year belong to the first and last run.

BASE = "https://listings.example/lot-"
SITE = "lots"
RUNS = (1, 2, 3, 4)
RUN_SQL = "least(greatest((year(l_shipdate) - 1995) // 2, 0), 3) + 1"


def run_date(k):
    return f"{2023 + k}-01-01"


def run_lines(t, k):
    number = F.least(F.greatest(F.floor((F.year("l_shipdate") - 1995) / 2), F.lit(0)), F.lit(3)) + 1
    return t.lineitem.where(number == k)


def lot_link():
    return canonical_link(F.concat(F.lit(BASE), F.col("l_partkey"), F.lit(".html"))).alias("link")


def run_snapshot(t, k):
    return run_lines(t, k).select(lot_link())


def parsed_offers(t, k, links):
    # Lines are combined by their short key and flag first: a maximum of texts sorts what it is given.
    lots = run_lines(t, k).groupBy("l_partkey", "l_returnflag").agg(F.max("l_extendedprice").alias("price"))
    readable = lots.groupBy(lot_link()).agg(F.max("l_returnflag").alias("flag"), F.max("price").alias("price"))
    offers = readable.where("flag <> 'R'").join(links.distinct(), "link", "left_semi")
    fixed = {"link", "price", "active", "scrape_date", "inactive_date", "page_name"}
    return offers.select(
        *(F.lit(None).cast(f.dataType).alias(f.name) for f in OFFERS if f.name not in fixed),
        "link",
        "price",
        F.lit("Yes").alias("active"),
        F.lit(run_date(k)).alias("scrape_date"),
        F.lit("-").alias("inactive_date"),
        F.lit(SITE).alias("page_name"),
    )


PLAYED: dict[tuple, str] = {}


def play_runs(t, compact_after=None, replayed=False):
    """The state after all runs; queries of one session and folder read one state."""
    played = (t.spark.sparkContext.applicationId, t.folder, compact_after, replayed)
    if played not in PLAYED:
        base = f"{shared_folder(t.spark)}/runs-{uuid.uuid4().hex}"
        for k in RUNS:
            (replay_run if replayed else play_run)(t, base, k)
            if k == compact_after:
                State(t.spark, base).compact()
        PLAYED[played] = base
    return State(t.spark, PLAYED[played])


def play_run(t, base, k):
    phase = phases.apply_links(State(t.spark, base), run_snapshot(t, k), SITE, run_date(k))
    state = phases.queue_links(phase.state, phase.new_links, SITE)
    phases.apply_offers(state, parsed_offers(t, k, phase.new_links), SITE)


def replay_run(t, base, k):
    """A run whose every step is played twice, the load once more before it fails to commit."""
    for _ in range(2):
        phase = phases.apply_links(State(t.spark, base), run_snapshot(t, k), SITE, run_date(k), run_id=run_date(k))
    for _ in range(2):
        phases.queue_links(State(t.spark, base), phase.new_links, SITE, run_date(k))
    offers = parsed_offers(t, k, phase.new_links)
    State(t.spark, base).append("preprocessing_offers", offers, SITE)
    for _ in range(2):
        phases.apply_offers(State(t.spark, base), offers, SITE, run_id=run_date(k))


def _runs_sql():
    steps = ["WITH r0 AS (SELECT NULL::VARCHAR AS link WHERE false)"]
    for k in RUNS:
        shown = f"""
  SELECT '{BASE}' || l_partkey AS link, max(l_returnflag) AS flag, max(l_extendedprice) AS price,
         count(*) AS copies
  FROM lineitem WHERE {RUN_SQL} = {k} GROUP BY 1"""
        steps += [
            f"s{k} AS ({shown})",
            f"n{k} AS (SELECT * FROM s{k} WHERE link NOT IN (SELECT link FROM r{k - 1}))",
            f"g{k} AS (SELECT link FROM r{k - 1} WHERE link NOT IN (SELECT link FROM s{k}))",
            f"""r{k} AS (SELECT link FROM r{k - 1} WHERE link NOT IN (SELECT link FROM g{k})
  UNION ALL SELECT link FROM n{k} WHERE flag <> 'R')""",
        ]
    return ",\n".join(steps)


RUNS_SQL = _runs_sql()


def _offers_sql():
    parts = []
    for k in RUNS:
        later = " ".join(
            f"WHEN link IN (SELECT link FROM g{j}) THEN '{run_date(j)}'" for j in range(RUNS[-1], k, -1)
        )
        date = f"CASE {later} ELSE '-' END" if later else "'-'"
        parts.append(
            f"""SELECT link, price, '{run_date(k)}' AS scrape_date, {date} AS inactive_date,
       CASE WHEN {date} = '-' THEN 'Yes' ELSE 'No' END AS active
FROM n{k} WHERE flag <> 'R'"""
        )
    return "\nUNION ALL\n".join(parts)


@query(RUNS_SQL + f"\nSELECT '{SITE}' AS page_name, link FROM r{RUNS[-1]}")
def link_phase(t):
    return play_runs(t).read("active_links", SITE).select("page_name", "link")


@query(RUNS_SQL + "\n" + _offers_sql())
def offer_phase(t):
    offers = play_runs(t).read("preprocessing_offers", SITE)
    return offers.select("link", "price", "scrape_date", "inactive_date", "active")


@query(RUNS_SQL + "\n" + _offers_sql())
def offer_phase_compacted(t):
    """The same offers where the state was compacted half way."""
    offers = play_runs(t, compact_after=2).read("preprocessing_offers", SITE)
    return offers.select("link", "price", "scrape_date", "inactive_date", "active")


@query(RUNS_SQL + "\n" + _offers_sql())
def offer_phase_replayed(t):
    """The same offers where every step of every run was played again after it had been published."""
    offers = play_runs(t, replayed=True).read("preprocessing_offers", SITE)
    return offers.select("link", "price", "scrape_date", "inactive_date", "active")


# Two runs with listing pages: the second one cannot read two of ten pages.
LOTS, UNREAD = "lots-by-page", (0, 3)
SEEN_SQL = f"SELECT DISTINCT '{BASE}' || l_partkey || '-' || l_linenumber AS link, l_suppkey % 10 AS page FROM lineitem"


def sightings(t, lines):
    link = F.concat(F.lit(BASE), F.col("l_partkey"), F.lit("-"), F.col("l_linenumber"))
    page = F.concat(F.lit("page-"), F.col("l_suppkey") % 10)
    return t.lineitem.where(lines).select(link.alias("link"), page.alias("page"))


@query(
    f"""
WITH first AS ({SEEN_SQL} WHERE year(l_shipdate) <= 1997),
second AS ({SEEN_SQL} WHERE year(l_shipdate) >= 1999 AND l_suppkey % 10 NOT IN {UNREAD}),
gone AS (SELECT DISTINCT link FROM first WHERE link NOT IN (SELECT link FROM second)),
marked AS (SELECT link, CASE WHEN link IN (SELECT link FROM first WHERE page IN {UNREAD}) THEN 'withheld'
                             ELSE 'retired' END AS outcome FROM gone)
SELECT * FROM marked
UNION ALL SELECT DISTINCT link, 'registered' FROM first
WHERE link NOT IN (SELECT link FROM marked WHERE outcome = 'retired')"""
)
def links_withheld(t):
    """Vanished links with pages unread: those last seen on these stay registered, the others are retired."""
    state = State(t.spark, f"{shared_folder(t.spark)}/runs-{uuid.uuid4().hex}")
    seen = sightings(t, F.year("l_shipdate") <= 1997)
    phase = phases.apply_links(state, seen.select("link"), LOTS, run_date(1), listed=seen)
    loaded = phase.new_links.distinct().select(
        *(F.lit(None).cast(f.dataType).alias(f.name) for f in OFFERS if f.name not in ("link", "page_name")),
        "link", F.lit(LOTS).alias("page_name"),
    )
    state = phases.apply_offers(phase.state, loaded, LOTS)
    seen = sightings(t, (F.year("l_shipdate") >= 1999) & ~(F.col("l_suppkey") % 10).isin(*UNREAD))
    unread = t.region.select(F.concat(F.lit("page-"), F.col("r_regionkey")).alias("link")).where(
        F.col("link").isin(*(f"page-{i}" for i in UNREAD))
    )
    phase = phases.apply_links(state, seen.select("link"), LOTS, run_date(2), unread=unread, listed=seen)
    outcomes = {
        "withheld": phase.withheld_links, "retired": phase.removed_links, "registered": phase.state.read("active_links", LOTS)
    }
    parts = [rows.select("link", F.lit(name).alias("outcome")) for name, rows in outcomes.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    RUNS_SQL
    + "\n"
    + "\nUNION ALL\n".join(f"SELECT link FROM (SELECT link, unnest(range(copies)) FROM n{k})" for k in RUNS)
)
def queue_phase(t):
    return play_runs(t).read("to_scrape", SITE).select("link")


@query(
    "\nUNION ALL\n".join(
        f"SELECT '{run_date(k)}' AS curr_date, CAST(1 AS INTEGER) AS process_number, '{SITE}' AS page_name, "
        f"'T' AS scraping_offers, 'T' AS scraping_details, "
        f"(SELECT count(*) FROM lineitem WHERE {RUN_SQL} = {k}) AS lines"
        for k in RUNS
    )
)
def run_log_after_runs(t):
    """The run log as whole runs leave it, next to the lines each run listed."""
    log = play_runs(t).read("process_stage").drop("process_id")
    number = F.least(F.greatest(F.floor((F.year("l_shipdate") - 1995) / 2), F.lit(0)), F.lit(3))
    lines = t.lineitem.groupBy(F.concat((number + 2024).cast("string"), F.lit("-01-01")).alias("curr_date")).agg(
        F.count(F.lit(1)).alias("lines")
    )
    return log.join(lines, "curr_date")


@query("SELECT url AS link FROM pages")
def snapshot_links(t):
    """A stored snapshot with more columns than its links, read back."""
    path = f"{shared_folder(t.spark)}/snapshot-{uuid.uuid4().hex}"
    t.pages.withColumnRenamed("url", "link").write.parquet(path)
    return read_snapshot(t.spark, path)
