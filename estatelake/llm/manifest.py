"""Merkle manifest of a table: a content-addressed DAG of digests, and proofs by descent.

Rows become leaves; per group (a language) every eight consecutive nodes become
their parent until one node, the subroot, remains; the subroots in order become
the root likewise. What is stored are records: a node's digest and the digests
of its children. A proof asks for a leaf by its rank: the request descends from
the root by the digits of the rank, looks every node up by its digest, collects
the children it does not take, and reverses what it has collected.

Requests that share a node share its lookup, so a level looks up its nodes once
and not once per leaf. All digests are lowercase hex of SHA-256.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estatelake.llm.common import in_order, scratch, stored

FANOUT = 8
#: Columns of a row that its leaf covers, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_ROOTS = "roots"  # the group of the subroots


def digest_of(*parts: Column | str) -> Column:
    """H: SHA-256 of the parts put together, in lowercase hex."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the value's UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(*values: Column) -> Column:
    return digest_of(*[field(v) for v in values])


def above(position: str) -> Column:
    """The position of a node's parent."""
    return F.expr(f"{position} div {FANOUT}")


def grow(nodes: DataFrame, folder: str) -> tuple[list[DataFrame], DataFrame]:
    """The records of every level above ``nodes`` (group, n, pos, digest), and the tops (group, height, digest).

    A record is (group, n, pos, digest, children), n being its group's nodes on
    that level; a group of one node is its own top, of height 0. Every level is a
    stored table an eighth of the one below.
    """
    levels, tops = [], [nodes.where("n = 1").select("group", F.lit(0).alias("height"), "digest")]
    most = nodes.agg(F.max("n")).first()[0] or 0
    while most > 1:
        runs = nodes.where("n > 1").groupBy("group", "n", above("pos").alias("pos")).agg(
            F.array_sort(F.collect_list(F.struct(F.col("pos").alias("at"), "digest"))).alias("run")
        )
        records = runs.select(
            "group", F.expr(f"(n + {FANOUT - 1}) div {FANOUT}").alias("n"), "pos",
            F.transform("run", lambda x: x["digest"]).alias("children"),
        ).withColumn("digest", F.sha2(F.array_join("children", ""), 256))
        levels.append(stored(records, f"{folder}/records-{len(levels) + 1}"))
        most = -(-most // FANOUT)
        nodes = levels[-1].select("group", "n", "pos", "digest")
        tops.append(nodes.where("n = 1").select("group", F.lit(len(levels)).alias("height"), "digest"))
    return levels, reduce(DataFrame.unionByName, tops)


def child(i: Column) -> Column:
    """Step at child ``i`` of ``children``: the digests before it and after it, put together."""
    rest = F.greatest(F.size("children") - i - 1, F.lit(0))
    return F.struct(
        F.array_join(F.slice("children", F.lit(1), i), "").alias("left"),
        F.array_join(F.slice("children", i + 2, rest), "").alias("right"),
    )


def descend(
    levels: list[DataFrame], starts: DataFrame, wanted: DataFrame, folder: str, carry: tuple[str, ...] = ()
) -> DataFrame:
    """Descend to the wanted leaves (group, rank): adds ``digest`` and ``path``, the steps from leaf to root.

    ``starts`` has group, height, digest, ``steps`` (those taken above so far) and
    the columns to carry along. ``levels[h - 1]`` holds the records of height h; a
    node is looked up by its digest only, equal nodes are one record. Requests
    for ranks that a group does not have find nothing.
    """
    # Who is asked for on a level is known from the level below.
    ask = [wanted.select("group", F.col("rank").alias("pos"))]
    for height in range(1, len(levels)):
        asked = ask[-1].select("group", above("pos").alias("pos")).distinct()
        ask.append(stored(asked, f"{folder}/asked-{height}"))
    at, opened = None, None
    for height in range(len(levels), 0, -1):
        here = starts.where(F.col("height") == height).select(
            "group", F.lit(0).cast("long").alias("pos"), "digest", "steps", *carry
        )
        at = here if at is None else at.unionByName(here)
        store = levels[height - 1].groupBy("digest").agg(F.first("children").alias("children"))
        opened = at.join(store, "digest").select("group", "pos", "children", "steps", *carry)
        if height > 1:
            i = F.col("i")
            below = opened.select("*", F.explode(F.sequence(F.lit(0), F.size("children") - 1)).alias("i")).select(
                "group", (F.col("pos") * FANOUT + i).alias("pos"), F.get("children", i).alias("digest"),
                F.concat("steps", F.array(child(i))).alias("steps"), *carry,
            )
            # Nodes of height h - 1 that have a wanted leaf below them.
            kept = below.join(ask[height - 1], ["group", "pos"], "left_semi")
            at = stored(kept, f"{folder}/at-{height - 1}")
    # The last run of eight is opened beside each request, so that the long steps move once per run.
    alone = starts.where("height = 0").select("group", F.lit(0).cast("long").alias("rank"), "digest", "steps", *carry)
    found = wanted.join(alone, ["group", "rank"]).select(
        *wanted.columns, "digest", F.reverse("steps").alias("path"), *carry
    )
    if opened is not None:
        i = F.pmod("rank", F.lit(FANOUT)).cast("int")
        leaves = wanted.withColumn("pos", above("rank")).join(opened, ["group", "pos"])
        leaf = F.get("children", i)
        found = found.unionByName(leaves.where(leaf.isNotNull()).select(
            *wanted.columns, leaf.alias("digest"), F.concat(F.array(child(i)), F.reverse("steps")).alias("path"), *carry
        ))
    return found


def fold(leaf: Column, path: Column) -> Column:
    """The root that follows from a leaf and its path."""
    return F.aggregate(path, leaf, lambda own, step: digest_of(step["left"], own, step["right"]))


def proof_of(path: Column) -> Column:
    """The digest of all siblings of a path, from the leaf's run to the root's, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda x: F.concat(x["left"], x["right"])), ""), 256)


class Manifest:
    """The stored records of a table's rows; ``leaves`` is group, rank, n, digest and the columns given."""

    def __init__(self, leaves: DataFrame, folder: str):
        self.folder, self.leaves = folder, leaves
        self.levels, tops = grow(leaves.select("group", "n", F.col("rank").alias("pos"), "digest"), f"{folder}/leaves")
        tops = tops.select(F.lit(_ROOTS).alias("_all"), "group", "height", "digest")
        self.subroots = in_order(tops, "_all", ["group"], f"{folder}/subroots")
        roots = self.subroots.select(F.col("_all").alias("group"), "n", F.col("rank").alias("pos"), "digest")
        self.root_levels, top = grow(roots, f"{folder}/roots")
        self.root = stored(top, f"{folder}/root")

    def proofs(self, wanted: DataFrame) -> DataFrame:
        """``wanted`` (group, rank and other columns) with leaf ``digest``, ``path``, ``subroot`` and ``root``."""
        no_steps = F.array().cast("array<struct<left:string,right:string>>")
        start = self.root.select("group", "height", "digest", no_steps.alias("steps"), F.col("digest").alias("root"))
        asked = self.subroots.select(
            F.col("_all").alias("group"), "rank", F.col("group").alias("_group"), F.col("height").alias("_height")
        )
        found = descend(self.root_levels, start, asked, f"{self.folder}/root-descent", ("root",))
        tops = found.select(
            F.col("_group").alias("group"), F.col("_height").alias("height"), "digest",
            F.reverse("path").alias("steps"), F.col("digest").alias("subroot"), "root",
        )
        tops = stored(tops, f"{self.folder}/tops")
        return descend(self.levels, tops, wanted, f"{self.folder}/descent", ("subroot", "root"))


def tampered_text(doc_id: Column, text: Column) -> Column:
    """The check's tampering: A-Z lower-cased where three divides the unsigned crc32 of the id in decimal."""
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    hit = F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 3 == 0, F.lit(False))
    return F.when(hit, lower).otherwise(text)


def build(docs: DataFrame, folder: str | None = None, tampered: Column | None = None) -> Manifest:
    """The manifest of documents (doc_id, source, lang, n_chars, text); other columns are not read.

    Groups are languages, a null one comes first and is not the empty one. Leaves
    stand by doc_id, null first, rows of one id by their digests: rows that repeat
    are leaves each. Nulls in any column are part of the leaf. Whole texts are read
    once, only digests move. An empty table has no leaves and no root.

    ``tampered`` is a changed text; its leaves come along as ``changed``.
    """
    folder = folder or scratch(docs.sparkSession, "manifest")
    values = [F.col(name) for name in FIELDS]
    group = F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit(""))
    digest = leaf_of(*values)
    if tampered is not None:
        other = F.when(tampered.eqNullSafe(F.col("text")), F.lit(None).cast("string")).otherwise(leaf_of(*values[:-1], tampered))
    else:
        other = F.lit(None).cast("string")
    slim = docs.select(group.alias("group"), F.col("doc_id").alias("id"), digest.alias("digest"), other.alias("_other"))
    slim = stored(slim.withColumn("changed", F.coalesce("_other", "digest")).drop("_other"), f"{folder}/slim")
    # Rows alike in all columns are told apart by where they stand, so that many of them spread over tasks.
    slim = slim.withColumn("_row", F.monotonically_increasing_id())
    return Manifest(in_order(slim, "group", ["id", "digest", "_row"], folder), folder)


def verify(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """Every document's leaf, subroot, root and proof, and what its tampered text folds to."""
    made = build(docs, folder, tampered_text(F.col("doc_id"), F.col("text")))
    wanted = made.leaves.select("group", "rank", "id", "changed")
    proofs = made.proofs(wanted)
    return proofs.select(
        F.col("id").alias("doc_id"), F.col("digest").alias("leaf"), "subroot", "root",
        proof_of(F.col("path")).alias("proof_sha256"),
        fold(F.col("changed"), F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
