"""URL filters: a sorted array of 64-bit digests, probed by binary search.

The rules of a list become files of digests in ascending order with the rules'
full strings beside them. Every executor gets the files once, lays them down as
arrays and memory-maps these, so that a list takes disk and not memory. Urls
never move: a batch builds the strings that a rule could have for its urls,
digests them, finds all of them by one vectorised binary search and confirms
the string behind every equal digest.
"""

from __future__ import annotations

import os
import string
import uuid
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from estatelake.llm.common import scratch

ALLOW, BLOCK = "allow", "block"
SEED = 42
#: Rules of one file of the list.
FILE_RULES = 1 << 20
#: Bytes of a list that every executor lays down on its disk; a larger one is refused before any work.
LIST_BYTES = 16 << 30


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(_part(url, 1), string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return _part(url, 2)


def _part(url: Column, group: int) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)([^?#]*)", group)


class UrlList:
    """A written list: its files, ready on every executor, and the lengths its hosts and paths have."""

    def __init__(self, files: list[str], hosts: list[int], paths: list[int]):
        self.files, self.hosts, self.paths = files, hosts, paths
        self.name = f"url-list-{uuid.uuid4().hex}"
        self._open = None

    def __getstate__(self):
        return self.__dict__ | {"_open": None}

    def opened(self) -> SortedDigests:
        if self._open is None:
            self._open = SortedDigests.laid_down(Path(SparkFiles.getRootDirectory()), self.name, self.files)
        return self._open


class SortedDigests:
    """The memory-mapped arrays of a list: digests, ends of the strings, strings, verdicts."""

    KINDS = {"digests": np.int64, "ends": np.int64, "strings": np.uint8, "blocks": np.bool_}

    def __init__(self, folder: Path):
        for kind, dtype in self.KINDS.items():
            file = folder / kind
            some = file.stat().st_size > 0
            setattr(self, kind, np.memmap(file, dtype, "r") if some else np.empty(0, dtype))

    @classmethod
    def laid_down(cls, root: Path, name: str, files: list[str]) -> SortedDigests:
        """Open the arrays; the executor's first worker writes them from the files, one file at a time."""
        folder = root / name
        if not folder.exists():
            mine = root / f"{name}-{os.getpid()}-{uuid.uuid4().hex}"
            mine.mkdir()
            cls._write(mine, files)
            try:
                mine.rename(folder)
            except OSError:  # another worker was first; its arrays are the same
                if not folder.exists():
                    raise
        return cls(folder)

    @classmethod
    def _write(cls, folder: Path, files: list[str]) -> None:
        import pyarrow.parquet as pq

        outs = {kind: (folder / kind).open("wb") for kind in cls.KINDS}
        end = 0
        for name in files:
            table = pq.read_table(SparkFiles.get(name))
            sizes = pa.compute.binary_length(table["key"].cast(pa.binary())).to_numpy()
            ends = end + np.cumsum(sizes, dtype=np.int64)
            end = int(ends[-1]) if len(ends) else end
            outs["digests"].write(table["digest"].to_numpy().astype("<i8").tobytes())
            outs["ends"].write(ends.tobytes())
            for key in table["key"].to_pylist():
                outs["strings"].write(key.encode())
            outs["blocks"].write(table["blocks"].to_numpy(zero_copy_only=False).astype(bool).tobytes())
        for out in outs.values():
            out.close()

    def string_at(self, i: int) -> bytes:
        return self.strings[int(self.ends[i - 1]) if i else 0 : int(self.ends[i])].tobytes()

    def find(self, keys: list[bytes]) -> list[bool | None]:
        """For every key: whether its rule blocks, or None without a rule."""
        import xxhash

        found: list[bool | None] = [None] * len(keys)
        if not keys or not len(self.digests):
            return found
        asked = np.array([xxhash.xxh64_intdigest(k, SEED) for k in keys], np.uint64).view(np.int64)
        first = np.searchsorted(self.digests, asked, "left")
        inside = np.minimum(first, len(self.digests) - 1)
        for i in np.flatnonzero(self.digests[inside] == asked).tolist():
            at = int(first[i])
            # Different strings of one digest stand side by side.
            while at < len(self.digests) and self.digests[at] == asked[i]:
                if self.string_at(at) == keys[i]:
                    found[i] = bool(self.blocks[at])
                    break
                at += 1
        return found


def write_list(rules: DataFrame, folder: str | None = None, max_bytes: int = LIST_BYTES) -> UrlList:
    """Write rules (host, path, verdict) as sorted digests and hand their files to every executor.

    A null host or path is empty, hosts are lower-cased (A-Z). Rules that no url
    can meet (a host with ``/``, ``?`` or ``#``, a path that does not start with
    ``/`` and is not empty) and rules of another verdict than ``allow`` and
    ``block`` are left out. Rules that repeat count once; of both verdicts for
    one rule, ``block`` holds. An empty table is a list that fits nothing.

    The list is measured first; one beyond ``max_bytes`` is refused.
    """
    spark = rules.sparkSession
    host = F.translate(F.coalesce("host", F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    rules = rules.select(host.alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict")
    usable = (
        F.col("verdict").isin(ALLOW, BLOCK) & ~F.col("host").rlike("[/?#]")
        & ((F.col("path") == "") | F.col("path").startswith("/")) & ~F.col("path").rlike("[?#]")
    )
    listed = rules.where(usable).groupBy("host", "path").agg(F.max(F.col("verdict") == BLOCK).alias("blocks"))
    keyed = listed.select(
        F.concat("host", "path").alias("key"), "blocks", F.length("host").alias("hosts"), F.length("path").alias("paths")
    ).withColumn("digest", F.xxhash64("key"))
    measured = keyed.agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("key") + 17), F.lit(0)).alias("bytes"),
        # Different lengths: no more than the longest rule has characters.
        F.array_sort(F.collect_set("hosts")).alias("hosts"), F.array_sort(F.collect_set("paths")).alias("paths"),
    ).first()
    if measured["bytes"] > max_bytes:
        raise ValueError(f"the list takes {measured['bytes']} bytes, more than max_bytes={max_bytes}")
    folder = folder or scratch(spark, "url-list")
    parts = -(-measured["n"] // FILE_RULES) or 1
    ordered = keyed.select("digest", "key", "blocks").repartitionByRange(parts, "digest")
    ordered.sortWithinPartitions("digest", "key").write.mode("overwrite").parquet(folder)
    files = sorted(spark.read.parquet(folder).inputFiles(), key=lambda f: f.rsplit("/", 1)[-1]) if measured["n"] else []
    for file in files:
        spark.sparkContext.addFile(file)
    return UrlList([f.rsplit("/", 1)[-1] for f in files], measured["hosts"], measured["paths"])


def longest_rules(listed: UrlList, hosts: list[str], paths: list[str]) -> tuple[list, list]:
    """The longest rule that fits each url of a batch and whether it blocks, or None and None."""
    widest, deepest = max(listed.hosts, default=0), max(listed.paths, default=0)
    ask: dict[tuple, int] = {}
    which = [ask.setdefault((host[-widest - 1 :], path[:deepest]), len(ask)) for host, path in zip(hosts, paths, strict=True)]
    keys: dict[str, int] = {}
    tried: list[list[int]] = []
    for host, path in ask:
        ends = [n for n in listed.hosts if n == len(host) or (n < len(host) and host[len(host) - n - 1] == ".")]
        fits = [(n + m, n, host[len(host) - n :] + path[:m]) for n in ends for m in listed.paths if m <= len(path)]
        tried.append([keys.setdefault(key, len(keys)) for _, _, key in sorted(fits, reverse=True)])
    names = list(keys)
    blocks = listed.opened().find([k.encode() for k in names])
    best = [next((k for k in some if blocks[k] is not None), None) for some in tried]
    rule = [None if best[i] is None else names[best[i]] for i in which]
    return rule, [None if best[i] is None else blocks[best[i]] for i in which]


def judge(
    pages: DataFrame, listed: UrlList, id_col: str = "page_id", url_col: str = "url", default: str = ALLOW
) -> DataFrame:
    """One row per page: its id, host, path, the rule that holds and the verdict.

    A rule fits its host and all subdomains where the url's path starts with the
    rule's path; the longest rule (host and path, in characters; of equal ones the
    one with the longer host) gives the verdict. Urls that no rule fits have a null
    rule and the verdict ``default``. A null url, or one without ``://``, has an
    empty host and path. Rows that repeat, ids that repeat or are null stay as they
    are; other columns are not read, whatever their names. An empty table gives an
    empty result. Nothing is shuffled.
    """
    parts = pages.select(
        F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path")
    )

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rule, blocks = longest_rules(listed, batch["host"].to_pylist(), batch["path"].to_pylist())
            verdict = [default if b is None else BLOCK if b else ALLOW for b in blocks]
            columns = [*batch.columns, pa.array(rule, pa.string()), pa.array(verdict, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "host", "path", "rule", "verdict"])

    kind = parts.schema["page_id"].dataType.simpleString()
    return parts.mapInArrow(judged, f"page_id {kind}, host string, path string, rule string, verdict string")


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Rules (host, path, verdict) as a table."""
    return spark.createDataFrame(rules, "host string, path string, verdict string")
