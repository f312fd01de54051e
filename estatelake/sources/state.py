"""The state tables as Parquet, with all tables of a run published together.

Plain Parquet has no UPDATE or DELETE, so a changed table is written to a new
folder. A commit is one small JSON file naming the folders that make up every
table; it is written last, so readers see all of a run or nothing of it, and a
run that dies half way leaves only folders nobody points to. Appends add a
folder and rewrite nothing. There is one commit file per version, created only
if no other writer has created it, and readers open the newest one only. A
commit may carry a key; the same key published again changes nothing, so a run
that is played again after a failure leaves one copy.

Tables with a site are partitioned by it, offers also by the month they were
read in. Vanished links rewrite nothing: a run appends them to
``deactivations``, and reading resolves them, as the end of registry links and
as the retirement of offers. Registry, offers and deactivations are bucketed by
link alike, so that they meet bucket by bucket without a shuffle. A commit
knows the first and last link of every folder; folders that no later
deactivation can hit are read as they are. ``compact`` folds deactivations in.
"""

from __future__ import annotations

import hashlib
import json
import re
import time
import uuid
from collections.abc import Mapping
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from estatelake.schemas import STATE_TABLES, empty

PARTITIONS = {
    "active_links": ("page_name",),
    "preprocessing_offers": ("page_name", "scrape_month"),
    "to_scrape": ("page_name",),
    "missing_links": ("page_name",),
    "process_stage": (),
    "stage_events": (),
    "deactivations": (),
    "description_rest": ("page_name",),
    "link_pages": ("page_name",),
    "retry_counters": ("page_name",),
}
OFFERS, REGISTRY, GONE = "preprocessing_offers", "active_links", "deactivations"
# Tables in buckets of their link, all of them in as many.
BUCKETED = (OFFERS, REGISTRY, GONE)
# Least buckets of a state. The links of its first snapshot give the number, and ``compact``
# chooses anew from the bytes it finds.
BUCKETS = 8
# Links of the first snapshot for one bucket.
BUCKET_LINKS = 1 << 17
# Bytes and rows of one file that compaction aims at. Repeated links take next to no bytes, but
# the task that writes them sorts them as rows.
FILE_BYTES = 128 << 20
FILE_ROWS = 1 << 19
# Characters of a folder's first and last link that its commit keeps.
SPAN_CHARS = 128
SITE_NAME = re.compile(r"[\w .-]+\Z", re.ASCII)
COMMIT_NAME = re.compile(r"[0-9]{12}[.]json\Z")
_COMMITS = (
    "version BIGINT, tables MAP<STRING, ARRAY<STRING>>, buckets INT, "
    "spans MAP<STRING, ARRAY<STRING>>, key STRING, notes MAP<STRING, STRING>"
)


def scrape_month() -> Column:
    """Partition value of an offer; dates of another form share one partition."""
    date = F.coalesce("scrape_date", F.lit(""))
    return F.when(date.rlike("^[0-9]{4}-[0-9]{2}-"), F.left(date, F.lit(7))).otherwise("other")


def check_site(name: str) -> str:
    """Site names become folder names, so they must not need escaping."""
    if not SITE_NAME.match(name):
        raise ValueError(f"site name {name!r} may hold only letters, digits, space, dot, dash")
    return name


def _part(folder: str) -> str:
    """``table/v=1-ab/page_name=P`` to ``page_name=P``."""
    return folder.split("/", 2)[-1]


def _version(folder: str) -> int:
    """``table/v=1-ab/page_name=P`` to 1."""
    return int(folder.split("/")[1][2:].split("-")[0])


def _quoted(text: str) -> str:
    """A text as a SQL literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _site(folder: str) -> str | None:
    return next((x.removeprefix("page_name=") for x in folder.split("/") if x.startswith("page_name=")), None)


class State:
    """One published version of the state tables under ``base``."""

    def __init__(self, spark: SparkSession, base: str, at: dict | None = None, buckets: int = BUCKETS):
        self.spark = spark
        self.base = base.rstrip("/")
        at = at or self._latest()
        self.version, self.tables = at["version"], at["tables"]
        self.buckets, self.spans = at["buckets"] or buckets, at["spans"]
        self._declared: set[str] = set()

    def _latest(self) -> dict:
        """The newest commit. Only names are listed, and one file is read."""
        names = self._commit_names()
        none = {name: [] for name in STATE_TABLES}
        if not names:
            return {"version": 0, "tables": none, "buckets": None, "spans": {}}
        return self._commits(names[-1:])[0]

    def _commit_names(self) -> list[str]:
        fs, folder = self._files("commits")
        names = [f.getPath().getName() for f in fs.listStatus(folder)] if fs.exists(folder) else []
        return sorted(n for n in names if COMMIT_NAME.match(n))

    def _commits(self, names: list[str]) -> list[dict]:
        """Some commits, oldest first."""
        none = {name: [] for name in STATE_TABLES}
        rows = self.spark.read.schema(_COMMITS).json([f"{self.base}/commits/{n}" for n in names]).collect()
        return [
            row.asDict() | {"tables": none | {k: list(v) for k, v in row["tables"].items()}, "spans": row["spans"] or {}}
            for row in sorted(rows, key=lambda r: r["version"])
        ]

    def _files(self, place: str):
        """The file system of the state and a path below it, as the driver's Spark sees them."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.base}/{place}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    # --- reading ---------------------------------------------------------------

    def read(self, table: str, site: str | None = None) -> DataFrame:
        """A table of this version (A1: only one site's partition when ``site`` is given).

        Registry and offers come with all later deactivations resolved, the run
        log with its stage flags.
        """
        folders = self.tables[table] if site is None else self.site_folders(table, site)
        hit = [f for f in folders if self._hits(f)] if table in (OFFERS, REGISTRY) else []
        if table == "process_stage" and self.tables["stage_events"]:
            return self._flagged(self.read_folders(table, folders, versions=True))
        parts = [self.read_folders(table, [f for f in folders if f not in hit])]
        if hit:
            events = self._bucketed(GONE, sorted({d for f in hit for d in self._hits(f)}))
            resolve = self._retired if table == OFFERS else self._alive
            parts.append(resolve(self._bucketed(table, hit), events).select(*STATE_TABLES[table].names))
        rows = reduce(DataFrame.unionByName, parts[1:] if hit and len(hit) == len(folders) else parts)
        return rows if site is None else rows.where(F.col("page_name") == site)

    def _hits(self, folder: str) -> list[str]:
        """The deactivation folders of later runs that may hold a link of a folder."""
        low, high, _ = self.spans.get(folder) or (None, None, None)
        if low is None:
            return []
        found = []
        for gone in self.tables[GONE]:
            first, last, site = self.spans[gone]
            if _version(gone) > _version(folder) and first <= high and low <= last and site in ("*", _site(folder)):
                found.append(gone)
        return found

    def _bucketed(self, table: str, folders: list[str]) -> DataFrame:
        """Rows of some folders as a relation that is bucketed by link, with ``_version``.

        Spark knows buckets of catalog tables only, so the folders are declared as
        the partitions of an external one. A set of folders has one name, whoever
        reads it; ``forget`` drops the names.
        """
        schema, columns = STATE_TABLES[table], ("v", *PARTITIONS[table])
        fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema if f.name not in columns]
        name = f"state_{hashlib.sha256('|'.join([self.base, str(self.buckets), *sorted(folders)]).encode()).hexdigest()[:32]}"
        if not self.spark.catalog.tableExists(name):
            self.spark.sql(
                f"CREATE TABLE {name} ({', '.join(fields)}, {', '.join(f'`{c}` string' for c in columns)}) USING parquet "
                f"PARTITIONED BY ({', '.join(columns)}) CLUSTERED BY (link) INTO {self.buckets} BUCKETS "
                f"LOCATION {_quoted(f'{self.base}/{table}')}"
            )
            parts = []
            for folder in folders:
                values = ", ".join(f"{c}={_quoted(x.split('=', 1)[1])}" for c, x in zip(columns, folder.split("/")[1:], strict=True))
                parts.append(f"PARTITION ({values}) LOCATION {_quoted(f'{self.base}/{folder}')}")
            self.spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(parts)}")
        self._declared.add(name)
        version = F.split_part(F.col("v"), F.lit("-"), F.lit(1)).cast("long").alias("_version")
        return self.spark.table(name).select(*schema.names, version)

    def forget(self) -> None:
        """Drop the names under which this state has declared folders; no file goes."""
        while self._declared:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._declared.pop()}")

    def _retired(self, offers: DataFrame, gone: DataFrame) -> DataFrame:
        """C31 on read: the deactivations of each link in the order of runs, for rows that are older."""
        event = F.struct("run", "run_date", "every_site", "only_active", F.col("page_name").alias("site"))
        events = gone.groupBy("link").agg(F.array_sort(F.collect_set(event)).alias("_events"))
        begin = F.struct(F.col("active").alias("active"), F.col("inactive_date").alias("inactive_date"))

        def fold(row: Column, e: Column) -> Column:
            hit = (
                (e["run"] > F.col("_version"))
                & (e["every_site"] | e["site"].eqNullSafe(F.col("page_name")))
                & (~e["only_active"] | F.coalesce(row["active"] == "Yes", F.lit(False)))
            )
            return F.struct(
                F.when(hit, "No").otherwise(row["active"]).alias("active"),
                F.when(hit, e["run_date"]).otherwise(row["inactive_date"]).alias("inactive_date"),
            )

        none = F.array().cast(events.schema["_events"].dataType)
        state = F.aggregate(F.coalesce("_events", none), begin, fold)
        return (
            offers.join(events, "link", "left")
            .withColumn("_state", state)
            .withColumn("active", F.col("_state.active"))
            .withColumn("inactive_date", F.col("_state.inactive_date"))
        )

    def _alive(self, links: DataFrame, gone: DataFrame) -> DataFrame:
        """C30 on read: the registry without links that a later run dropped, on every site or on their own."""
        later = gone.select("link", F.col("run").alias("_run"), F.when(~F.col("every_site"), F.col("page_name")).alias("_site"))
        ends = (later["_run"] > links["_version"]) & (later["_site"].isNull() | (later["_site"] == links["page_name"]))
        return links.join(later, (links["link"] == later["link"]) & ends, "left_anti")

    def _flagged(self, log: DataFrame) -> DataFrame:
        """C38 on read: a stage is done for the rows of a date that the log had before the event."""
        events = self.read("stage_events")
        stages = [c for c in STATE_TABLES["process_stage"].names if c.startswith("scraping_")]
        last = events.groupBy("curr_date").agg(
            *[F.max(F.when(F.col("stage") == c, F.col("run"))).alias(f"_{c}") for c in stages]
        )
        flags = {c: F.when(F.col(f"_{c}") > F.col("_version"), "T").otherwise(F.col(c)) for c in stages}
        return log.join(last, "curr_date", "left").withColumns(flags).select(*STATE_TABLES["process_stage"].names)

    def site_folders(self, table: str, site: str) -> list[str]:
        """Folders with rows of a site; every one of them holds at least one row."""
        wanted = f"page_name={check_site(site)}"
        return [f for f in self.tables[table] if not PARTITIONS[table] or wanted in f.split("/")]

    def read_folders(self, table: str, folders: list[str], versions: bool = False) -> DataFrame:
        """Rows of some folders as written; with ``versions`` also the version that wrote them, as ``_version``."""
        schema = STATE_TABLES[table]
        if not folders:
            return empty(self.spark, schema)
        reader = self.spark.read.schema(schema).option("basePath", f"{self.base}/{table}")
        rows = reader.parquet(*(f"{self.base}/{f}" for f in folders))
        own = [F.split_part(F.col("v"), F.lit("-"), F.lit(1)).cast("long").alias("_version")] if versions else []
        return rows.select(*schema.names, *own)

    def fit_buckets(self, links: int) -> None:
        """Choose the buckets of a state that has no bucketed folder yet, for so many links."""
        if not any(self.tables[name] for name in BUCKETED):
            self.buckets = max(self.buckets, 1 << (-(-links // BUCKET_LINKS) - 1).bit_length())

    def partition_of(self, table: str, rows: DataFrame) -> DataFrame:
        """Rows with their partition columns in place."""
        if "scrape_month" in PARTITIONS[table]:
            rows = rows.withColumn("scrape_month", scrape_month())
        return rows

    # --- writing ---------------------------------------------------------------

    def _write(self, table: str, rows: DataFrame, files: Mapping[str, int] | None = None) -> list[str]:
        """Rows in a fresh folder per attempt, so that nothing being read is ever overwritten.

        ``files`` are the files wanted per partition, for tables without buckets.
        """
        folder = f"{table}/v={self.version + 1}-{uuid.uuid4().hex[:8]}"
        path = f"{self.base}/{folder}"
        columns = PARTITIONS[table]
        rows = self.partition_of(table, rows.select(*STATE_TABLES[table].names))
        if table in BUCKETED:
            rows = rows.repartition(self.buckets, "link")  # a task per bucket, a file per bucket and partition
        elif files:
            want = reduce(lambda w, p: F.when(F.concat_ws("/", *columns) == p[0], p[1]).otherwise(w), files.items(), F.lit(1))
            rows = rows.repartition(sum(files.values()), *columns, F.pmod(F.xxhash64(*rows.columns), want)) if columns else rows.repartition(sum(files.values()))
        writer = rows.write.partitionBy(*columns) if columns else rows.write
        if table in BUCKETED:
            name = f"state_{uuid.uuid4().hex}"
            writer.format("parquet").bucketBy(self.buckets, "link").sortBy("link").option("path", path).saveAsTable(name)
            self.spark.sql(f"DROP TABLE {name}")  # external: the files stay
        else:
            writer.parquet(path)
        found = [folder]
        if columns:
            # The folders that were written: as many as sites and months in these rows.
            fs, pattern = self._files("/".join([folder, *(f"{c}=*" for c in columns)]))
            depth = len(columns)
            found = [str(f.getPath().toString()) for f in fs.globStatus(pattern) or []]
            found = sorted(f"{folder}/" + unquote("/".join(f.split("/")[-depth:])) for f in found)
        if table in BUCKETED and found:
            self._measure(table, found)
        return found

    def _measure(self, table: str, folders: list[str]) -> None:
        """Keep the first and last link of folders just written; only the links are read."""
        columns = PARTITIONS[table]
        written = self.partition_of(table, self.read_folders(table, folders))
        every = F.bool_or("every_site") if table == GONE else F.lit(False)
        site = F.when(every, "*").otherwise(F.max("page_name"))
        for row in written.groupBy(*columns).agg(F.min("link").alias("low"), F.max("link").alias("high"), site.alias("site")).collect():
            part = "/".join([folders[0].split("/")[0], folders[0].split("/")[1], *(f"{c}={row[c]}" for c in columns)])
            high = row["high"]
            if high is not None and len(high) > SPAN_CHARS:
                high = high[:SPAN_CHARS] + chr(0x10FFFF)  # above all that begins so
            self.spans = {**self.spans, part: [row["low"] and row["low"][:SPAN_CHARS], high, row["site"]]}

    def append(self, table: str, rows: DataFrame, site: str | None = None) -> list[str]:
        """Folders of the table after adding rows, all of one site."""
        if PARTITIONS[table]:
            rows = rows.withColumn("page_name", F.lit(check_site(site)))
        return self.tables[table] + self._write(table, rows)

    def rewrite_parts(self, table: str, rows: DataFrame, parts: list[str]) -> list[str]:
        """Folders of the table after replacing the given partitions; the others stay."""
        return [f for f in self.tables[table] if _part(f) not in parts] + self._write(table, rows)

    def published(self, key: str) -> dict | None:
        """The commit that carries a key, or None. All commits are read, one small line each."""
        names = self._commit_names()
        if not names:
            return None
        lines = self.spark.read.schema(_COMMITS).json([f"{self.base}/commits/{n}" for n in names])
        found = lines.where(F.col("key") == key).select("version", "notes").head()
        return found.asDict() if found else None

    def publish(
        self, changes: Mapping[str, list[str]], key: str | None = None, notes: Mapping[str, str] | None = None
    ) -> State:
        """Commit the changed tables as the next version and return it.

        The commit file is written aside and renamed to its name only if that
        name is free, so of two writers of a version the second one fails and
        readers never see two. With a ``key`` that has been published before,
        nothing is committed and the newest version comes back.
        """
        if key is not None and self.published(key):
            return State(self.spark, self.base)
        latest = self._latest()["version"]
        if latest != self.version:
            raise RuntimeError(f"version {latest} was published after {self.version} was read")
        version, tables = self.version + 1, {**self.tables, **changes}
        spans = {f: self.spans[f] for name in BUCKETED for f in tables[name] if f in self.spans}
        entry = {"version": version, "tables": tables, "buckets": self.buckets, "spans": spans, "key": key, "notes": notes or {}}
        fs, aside = self._files(f"commits/_{uuid.uuid4().hex}")
        out = fs.create(aside, False)
        out.write(bytearray(json.dumps(entry).encode()))
        out.close()
        _, final = self._files(f"commits/{version:012d}.json")
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        options = self.spark._sc._gateway.new_array(hadoop.Options.Rename, 0)
        context = hadoop.FileContext.getFileContext(fs.getUri(), self.spark._jsc.hadoopConfiguration())
        try:
            context.rename(aside, final, options)
        except Exception as problem:
            fs.delete(aside, False)
            if not fs.exists(final):
                raise
            raise RuntimeError(f"another writer published version {version}") from problem
        return State(self.spark, self.base, entry)

    def bytes_of(self, folder: str) -> int:
        fs, path = self._files(folder)
        return fs.getContentSummary(path).getLength()

    def _row_counts(self, table: str) -> dict[str, int]:
        """Rows of every partition as written, by its values; only file footers are read."""
        if not self.tables[table]:
            return {}
        rows = self.read_folders(table, self.tables[table]).groupBy(*PARTITIONS[table]).count()
        return {"/".join(str(x) for x in row[:-1]): row[-1] for row in rows.collect()}

    def compact(self, *names: str) -> State:
        """Publish tables as one folder per partition, with deactivations and stage events folded in.

        File counts follow from the bytes and rows found. Where all bucketed tables are
        compacted, so does the number of buckets: the largest partition's files
        come to about FILE_BYTES.
        """
        names = names or tuple(n for n in STATE_TABLES if n not in (GONE, "stage_events"))
        sizes: dict[str, dict[str, int]] = {}
        for name in names:
            for folder in self.tables[name]:
                part = "/".join(x.split("=", 1)[1] for x in folder.split("/")[2:])
                sizes.setdefault(name, {})[part] = sizes.get(name, {}).get(part, 0) + self.bytes_of(folder)
        rows = {name: self.read(name) for name in names}
        next_ = State(self.spark, self.base, vars(self) | {"spans": dict(self.spans)})
        if {OFFERS, REGISTRY} <= set(names):
            most = max([0, *sizes.get(OFFERS, {}).values(), *sizes.get(REGISTRY, {}).values()])
            next_.buckets = max(self.buckets, 1 << (-(-most // FILE_BYTES) - 1).bit_length()) if most else self.buckets
        changed = {}
        for name in names:
            files = {part: -(-size // FILE_BYTES) for part, size in sizes.get(name, {}).items()}
            if name not in BUCKETED:
                for part, n in self._row_counts(name).items():
                    files[part] = max(files.get(part, 1), -(-n // FILE_ROWS))
            changed[name] = next_._write(name, rows[name], files or {"": 1}) if self.tables[name] else []
        if "process_stage" in names:
            changed["stage_events"] = []
        if {OFFERS, REGISTRY} <= set(names):
            changed[GONE] = []
        return next_.publish(changed)

    def vacuum(self, keep: int = 2, grace_seconds: float = 7 * 86400) -> list[str]:
        """Delete folders that none of the newest ``keep`` commits names and return them.

        References are counted over the retained commits, so a reader of any of
        them goes on. Folders younger than ``grace_seconds`` stay: they may belong
        to a run that has not committed yet. Work tables go by age alone. Commits
        stay, with their keys.
        """
        names = self._commit_names()[-max(keep, 1):]
        used = {"/".join(f.split("/")[:2]) for c in (self._commits(names) if names else []) for folders in c["tables"].values() for f in folders}
        limit = (time.time() - grace_seconds) * 1000
        gone = []
        for table in (*STATE_TABLES, "work"):
            fs, place = self._files(table)
            for entry in fs.listStatus(place) if fs.exists(place) else []:
                folder = f"{table}/{entry.getPath().getName()}"
                if entry.isDirectory() and folder not in used and entry.getModificationTime() < limit:
                    fs.delete(entry.getPath(), True)
                    gone.append(folder)
        return gone

    def work_path(self, name: str) -> str:
        """A fresh folder for an intermediate result of the version being made."""
        return f"{self.base}/work/{name}-{self.version + 1}-{uuid.uuid4().hex[:8]}"

    def work_table(self, name: str, rows: DataFrame, path: str | None = None) -> DataFrame:
        """Write an intermediate result once and read it back, cutting its lineage."""
        path = path or self.work_path(name)
        rows.write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """A2: the links now on a site, one column named ``link``."""
    return spark.read.parquet(path).select("link")
