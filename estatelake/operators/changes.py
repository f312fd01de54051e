"""Change capture between a link snapshot and the registry.

Snapshot and registry are stacked and counted per link. That is one shuffle
with map-side counting, so neither repeated links nor a hot link can overload
a task, and both differences come out of the same pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from estatelake.operators.skew import HEAVY_ROWS, SALTS, keep_unlisted, mark_listed

NEW, KEPT, REMOVED = "new", "kept", "removed"
COPIES_PER_ROW = 100_000
RETRY_ROUNDS = 6  # fixed value: tries again after the first attempt
ATTEMPTS = 1 + RETRY_ROUNDS


def link_diff(snapshot: DataFrame, registry: DataFrame) -> DataFrame:
    """Per link: copies in the snapshot, copies in the registry, and the status."""
    seen = snapshot.select("link", F.lit(1).alias("_s"), F.lit(0).alias("_r"))
    known = registry.select("link", F.lit(0).alias("_s"), F.lit(1).alias("_r"))
    counted = (
        seen.unionByName(known)
        .groupBy("link")
        .agg(F.sum("_s").alias("n_snapshot"), F.sum("_r").alias("n_registry"))
    )
    status = (
        F.when(F.col("n_registry") == 0, NEW).when(F.col("n_snapshot") == 0, REMOVED).otherwise(KEPT)
    )
    return counted.withColumn("status", status)


def _copies(diff: DataFrame, count: str) -> DataFrame:
    """Each link as often as it was counted.

    Small counts are written out in place. Larger ones are cut into slices of
    bounded size, which are spread over tasks first.
    """
    def written_out(rows: DataFrame, size: Column) -> DataFrame:
        return rows.select("link", F.explode(F.sequence(F.lit(1), size.cast("int")))).select("link")

    few = F.col(count) <= COPIES_PER_ROW
    slices = F.sequence(F.lit(0), F.floor((F.col(count) - 1) / COPIES_PER_ROW))
    sliced = diff.where(~few).select("link", count, F.explode(slices).alias("_slice"))
    size = F.least(F.lit(COPIES_PER_ROW), F.col(count) - F.col("_slice") * COPIES_PER_ROW)
    return written_out(diff.where(few), F.col(count)).unionByName(
        written_out(sliced.repartition("link", "_slice"), size)
    )


def new_links_of(diff: DataFrame, distinct: bool = False, null_too: Column | bool = False) -> DataFrame:
    """The new links of a computed diff."""
    null_too = F.lit(null_too) if isinstance(null_too, bool) else null_too
    new = diff.where((F.col("status") == NEW) & (F.col("link").isNotNull() | null_too))
    return new.select("link") if distinct else _copies(new, "n_snapshot")


def removed_links_of(diff: DataFrame, distinct: bool = False) -> DataFrame:
    """The removed links of a computed diff."""
    removed = diff.where((F.col("status") == REMOVED) & F.col("link").isNotNull())
    return removed.select("link") if distinct else _copies(removed, "n_registry")


def withheld_links(removed: DataFrame, seen: DataFrame, unread: DataFrame) -> DataFrame:
    """Every removed link with ``withheld``: may it stand on a listing page that was not read?

    ``seen`` has the pages on which each link was last seen (``link``, ``page``),
    ``unread`` the pages without a reading (``page``). A link is withheld if one
    of its last pages is unread, or if its pages are not known. One aggregation
    over both sides: neither repeats nor a page of many links need a join of rows.
    """
    missing = unread.select("page").distinct().withColumn("_unread", F.lit(True))
    sightings = seen.join(missing, "page", "left").select(
        "link", F.lit(False).alias("_gone"), F.lit(True).alias("_known"), F.coalesce("_unread", F.lit(False)).alias("_unread")
    )
    gone = removed.select("link", F.lit(True).alias("_gone"), F.lit(False).alias("_known"), F.lit(False).alias("_unread"))
    per_link = gone.unionByName(sightings).groupBy("link").agg(
        *[F.bool_or(c).alias(c) for c in ("_gone", "_known", "_unread")]
    )
    return per_link.where("_gone").select("link", (~F.col("_known") | F.col("_unread")).alias("withheld"))


def new_links(snapshot: DataFrame, registry: DataFrame, distinct: bool = False) -> DataFrame:
    """Snapshot links missing from the registry, repeats kept unless ``distinct``.

    Nulls are dropped, but an empty registry lets every link through, nulls too.
    """
    first_run = ~registry.select("link").exists()
    return new_links_of(link_diff(snapshot, registry), distinct, first_run)


def removed_links(snapshot: DataFrame, registry: DataFrame, distinct: bool = False) -> DataFrame:
    """Registry links missing from the snapshot."""
    return removed_links_of(link_diff(snapshot, registry), distinct)


def link_status(snapshot: DataFrame, registry: DataFrame) -> DataFrame:
    """Every link of either side once, as new, kept or removed."""
    diff = link_diff(snapshot, registry)
    return diff.where(F.col("link").isNotNull()).select("link", "status")


def delete_links(
    registry: DataFrame,
    removed: DataFrame,
    site: str | None = None,
    floor: int = HEAVY_ROWS,
    salts: int = SALTS,
    small: bool = False,
) -> DataFrame:
    """The registry without the removed links, on any site unless one is named.

    ``small`` broadcasts ``removed``; set it only after checking its size.
    """
    if site is None:
        return keep_unlisted(registry, removed, "link", floor, salts, small)
    own = F.col("page_name") == site
    kept = keep_unlisted(registry.where(own), removed, "link", floor, salts, small)
    return kept.unionByName(registry.where(~own))


def deactivate_offers(
    offers: DataFrame,
    removed: DataFrame,
    run_date: str | Column,
    site: str | None = None,
    only_active: bool = False,
    floor: int = HEAVY_ROWS,
    salts: int = SALTS,
    small: bool = False,
) -> DataFrame:
    """Mark every offer row of a removed link inactive as of ``run_date``.

    Rows that were inactive before get the new date too, unless ``only_active``.
    ``small`` broadcasts ``removed``; set it only after checking its size.
    """
    hit = F.col("_gone")
    if site is not None:
        hit = hit & (F.col("page_name") == site)
    if only_active:
        hit = hit & (F.col("active") == "Yes")
    run_date = F.lit(run_date) if isinstance(run_date, str) else run_date
    return (
        mark_listed(offers, removed, "link", "_gone", floor, salts, small)
        .withColumn("inactive_date", F.when(hit, run_date).otherwise(F.col("inactive_date")))
        .withColumn("active", F.when(hit, "No").otherwise(F.col("active")))
        .select(*offers.columns)
    )


def attempt_counters(queue: DataFrame, attempts: DataFrame) -> DataFrame:
    """Per link: ``queued``, the run it was last queued in, ``n`` attempts since, and whether one was ``ok``.

    ``attempts`` has ``link`` and a boolean ``ok``. Where both sides have a
    ``run``, only attempts of a later run than the link's last queueing count:
    a link that vanished and was listed again starts anew. Rows are combined
    map-side, per link and run where there are runs; nothing is gathered per link.
    """
    timed = "run" in queue.columns and "run" in attempts.columns
    queued = queue.select(
        "link", (F.col("run") if timed else F.lit(0)).cast("long").alias("run"),
        F.lit(True).alias("q"), F.lit(0).cast("long").alias("n"), F.lit(False).alias("ok"),
    )
    tried = attempts.select(
        "link", (F.col("run") if timed else F.lit(0)).cast("long").alias("run"),
        F.lit(False).alias("q"), F.lit(1).cast("long").alias("n"), F.coalesce("ok", F.lit(False)).alias("ok"),
    )
    counted = [F.bool_or("q").alias("q"), F.sum("n").alias("n"), F.bool_or("ok").alias("ok")]
    both = queued.unionByName(tried)
    if not timed:
        per_link = both.groupBy("link").agg(*counted).where("q AND link IS NOT NULL")
        return per_link.select("link", F.lit(0).cast("long").alias("queued"), "n", "ok")
    per_run = both.groupBy("link", "run").agg(*counted)
    # Tries in the run that queues a link are tries of what was queued before.
    return merged_counters(per_run.select(
        "link", "run", "q", F.when(F.col("q"), 0).otherwise(F.col("n")).alias("n"), (F.col("ok") & ~F.col("q")).alias("ok")
    ))


def merged_counters(parts: DataFrame) -> DataFrame:
    """Counters of several runs (link, run, q, n, ok) as one row per queued link.

    The last queueing is the newest run with ``q``; what came before it does not
    count. Counters so far take part as rows of their last queueing, so that a
    run adds its own rows to them and older runs are not read again.
    """
    last = F.max(F.when(F.col("q"), F.col("run"))).over(Window.partitionBy("link"))
    since = parts.withColumn("queued", last).where("link IS NOT NULL AND run >= queued")
    return since.groupBy("link", "queued").agg(F.sum("n").alias("n"), F.bool_or("ok").alias("ok"))


def link_attempts(queue: DataFrame, attempts: DataFrame) -> DataFrame:
    """Per queued link: ``attempts`` made since it was last queued, and whether one was ``ok``."""
    return attempt_counters(queue, attempts).select("link", F.col("n").alias("attempts"), "ok")


def pending_links(queue: DataFrame, attempts: DataFrame, limit: int = ATTEMPTS) -> DataFrame:
    """Queued links not yet read, with the attempts made, while any are left."""
    made = link_attempts(queue, attempts)
    return made.where(~F.col("ok") & (F.col("attempts") < limit)).select("link", "attempts")


def exhausted_links(queue: DataFrame, attempts: DataFrame, limit: int = ATTEMPTS) -> DataFrame:
    """Queued links that no attempt could read and that have no attempts left."""
    made = link_attempts(queue, attempts)
    return made.where(~F.col("ok") & (F.col("attempts") >= limit)).select("link", "attempts")
