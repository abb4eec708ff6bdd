"""The incremental build: source files to candle table, only what changed.

Folders under the database: `candles` (the result, in versions: `sources.versions`), `cache`
(normalised rows per source), `universe`, `state/build=N` (manifest; its `meta` is written
last and is the commit), `runs`, `work` (written tables that several steps of one build
share).

New sources add folders with their own rows to `candles`. Only where rows of changed or
deleted sources are to go, or an output is lost, the year they are in is written again.

With `consumer_dir` configured, a build also keeps one file per symbol and timeframe there.

Before a build changes the cache it notes, under its own number, which sources and
outputs it is about to touch. If it dies, the next build starts from the last committed
manifest, takes those sources as unread and those outputs as dirty.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.functions.names import cache_id, source_key
from barloom.operators.sets import set_digest, universe
from barloom.plans import changes
from barloom.plans.config import BuildConfig
from barloom.schema import CANDLE_COLUMNS
from barloom.session import delete, exists, hadoop_path
from barloom.sources import tables, versions
from barloom.sources.adapters import ADAPTERS
from barloom.sources.files import file_name
from barloom.sources.streams import put

# Manifest version and the name of its fingerprints.
VERSION = 2
SCHEME = "sha256-content-v1"
# Mark of a consumer layout that was written whole once.
WHOLE = "_WHOLE"

CACHE_SCHEMA = (
    "source_key string, timeframe string, symbol string, timestamp timestamp_ntz, open double, high double, "
    "low double, close double, volume bigint, delivery bigint, del_percent double, kind string, cache_id string"
)
MANIFEST_SCHEMA = "source_key string, kind string, cache_id string, fingerprint string, rows bigint"
META_SCHEMA = "version int, scheme string, universe string"


@dataclass(frozen=True)
class BuildReport:
    state: str
    rows: int
    files: int
    actions: dict[str, int]
    rewritten: int
    removed: int


class Database:
    """Names and reads of the folders of one database."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self.candles, self.cache = f"{self.root}/candles", f"{self.root}/cache"
        self.universe, self.runs = f"{self.root}/universe", f"{self.root}/runs"

    def work(self, name: str) -> str:
        return f"{self.root}/work/{name}"

    def builds(self) -> list[int]:
        """Committed builds: their `meta` folder was written completely."""
        fs, path = hadoop_path(self.spark, f"{self.root}/state")
        if not fs.exists(path):
            return []
        names = [status.getPath().getName() for status in fs.listStatus(path)]
        numbers = [int(name.split("=")[1]) for name in names if name.startswith("build=")]
        return sorted(n for n in numbers if exists(self.spark, f"{self.root}/state/build={n}/meta/_SUCCESS"))

    def cache_folders(self) -> DataFrame:
        """(kind, cache_id) of the cached sources, from the folders' names; no file is opened."""
        names = versions.children(self.spark, self.cache, "kind=*/cache_id=*")
        rows = [tuple(part.split("=", 1)[1] for part in name.split("/")) for name in names]
        return self.spark.createDataFrame(rows, "kind string, cache_id string")

    def meta(self) -> dict:
        builds = self.builds()
        if not builds:
            return {"version": VERSION, "scheme": SCHEME, "universe": None}
        path = f"{self.root}/state/build={builds[-1]}/meta"
        return self.spark.read.schema(META_SCHEMA).parquet(path).first().asDict()

    def manifest(self) -> DataFrame:
        builds = self.builds()
        if not builds:
            return self.spark.createDataFrame([], MANIFEST_SCHEMA)
        return self.spark.read.schema(MANIFEST_SCHEMA).parquet(f"{self.root}/state/build={builds[-1]}/sources")

    def live(self) -> DataFrame:
        """The list of the table's newest version."""
        return versions.listed(self.spark, self.candles, versions.current(self.spark, self.candles))

    def next_build(self) -> str:
        builds = self.builds()
        return f"{self.root}/state/build={builds[-1] + 1 if builds else 1}"

    def touch(self, name: str, frame: DataFrame) -> None:
        frame.write.mode("append").parquet(f"{self.next_build()}/touched_{name}")

    def has_touched(self, name: str) -> bool:
        return exists(self.spark, f"{self.next_build()}/touched_{name}")

    def touched(self, name: str, schema: str) -> DataFrame:
        path = f"{self.next_build()}/touched_{name}"
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path).distinct()

    def cached(self) -> DataFrame:
        if not exists(self.spark, self.cache):
            return self.spark.createDataFrame([], CACHE_SCHEMA)
        return self.spark.read.schema(CACHE_SCHEMA).parquet(self.cache)

    def members(self) -> DataFrame:
        return self.spark.read.schema("symbol string").parquet(self.universe)

    def stored(self) -> DataFrame:
        if versions.current(self.spark, self.candles) is None:
            return self.spark.createDataFrame([], tables.TABLE_SCHEMA)
        return tables.read_candles(self.spark, self.candles)

    def cache_folder(self, kind: str, cache: str) -> str:
        return f"{self.cache}/kind={kind}/cache_id={cache}"

    def written(self, name: str, frame: DataFrame) -> DataFrame:
        """Write a shared intermediate and read it back: it is computed once, and a lost
        executor does not repeat the work before it."""
        frame.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(self.work(name))
        return self.spark.read.schema(frame.schema).parquet(self.work(name))


def build(spark: SparkSession, config: BuildConfig, refresh: bool = False, verify_only: bool = False) -> BuildReport:
    """Bring the database up to date with its source folders."""
    if refresh and verify_only:
        raise ValueError("refresh and verify_only exclude each other")
    db = Database(spark, config.database_dir)
    if verify_only:
        rows, files = verify(db, versions.folders(db.live()))
        return BuildReport("VERIFIED", rows, files, {}, 0, 0)
    meta = db.meta()
    for adapter in ADAPTERS.values():
        folder = config.folder(adapter.kind)
        found = adapter.optional if folder is None else adapter.folder_may_be_missing or exists(spark, folder)
        if not found:
            raise FileNotFoundError(f"Missing {adapter.kind} source folder: {folder}")
    if refresh or meta["version"] != VERSION:
        for name in ("candles", "cache", "universe", "state", "work"):
            delete(spark, f"{db.root}/{name}")
        if config.consumer_dir:
            delete(spark, f"{config.consumer_dir}/{WHOLE}")
        meta = db.meta()
    started = now()
    record_run(db, "RUNNING", started, None, "build in progress")
    try:
        report = run(spark, config, db, meta)
    except Exception as error:
        record_run(db, "FAILED", started, now(), str(error))
        raise
    record_run(db, "SUCCESS", started, now(), report.state)
    return report


def run(spark: SparkSession, config: BuildConfig, db: Database, meta: dict) -> BuildReport:
    drop_orphans(db)
    actions = actions_of(spark, config, db, with_cache_state(db), meta["scheme"] != SCHEME)
    counts = action_counts(actions)
    daily_kinds, intraday_kinds = ["day", "day_idx"], ["minute", "minute_idx"]
    if has_work(counts, daily_kinds):
        replace_rows(spark, db, actions, daily_kinds, None)

    digest = meta["universe"]
    if has_work(counts, daily_kinds) or digest is None:
        members = universe(db.cached().where(F.col("kind") == "day"))
        members.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(db.universe)
        digest = set_digest(db.members(), "symbol").first()["digest"]
    forced = [a.kind for a in ADAPTERS.values() if a.needs_universe and digest != meta["universe"]]
    if forced:
        actions = db.written("forced_actions", changes.reprocessed(actions, forced))
        counts = action_counts(actions)
    if has_work(counts, intraday_kinds):
        replace_rows(spark, db, actions, intraday_kinds, db.members())

    live = db.live()
    chosen = versions.folders(live)
    rewritten = removed = 0
    dirty = None
    if has_work(counts) or db.has_touched("outputs") or versions.gone(spark, db.candles, chosen) or (db.builds() and not chosen):
        dirty = dirty_outputs(db, actions, chosen)
        rewritten, removed, live = export(db, dirty, actions, config.compression)
        chosen = versions.folders(live)
    rows, files = verify(db, chosen)
    if config.consumer_dir:
        export_flat(db, config, dirty, live, chosen)
    changed = bool(rewritten or removed or has_work(counts))
    totals: dict[str, int] = {}
    for (_, action), number in counts.items():
        totals[action] = totals.get(action, 0) + number
    if changed or changes.UPGRADED in totals or digest != meta["universe"]:
        commit(db, actions, digest, live if rewritten or removed else None)
    return BuildReport("UPDATED" if changed else "NO SOURCE CHANGES", rows, files, totals, rewritten, removed)


def action_counts(actions: DataFrame) -> dict[tuple[str, str], int]:
    """Sources by kind and action; one row a source is little enough for one task."""
    rows = actions.coalesce(1).groupBy("kind", "action").count().collect()
    return {(row["kind"], row["action"]): row["count"] for row in rows}


def has_work(counts: dict[tuple[str, str], int], kinds: list[str] | None = None) -> bool:
    return any(action in changes.WORK and (kinds is None or kind in kinds) for kind, action in counts)


def drop_orphans(db: Database) -> None:
    """Remove cached rows no committed manifest knows (a build died after writing them)."""
    orphans = db.cache_folders().join(db.manifest(), ["kind", "cache_id"], "left_anti")
    folders = orphans.collect()
    if not folders:
        return
    db.touch("outputs", outputs_of(in_folders(db.cached(), orphans)))
    for row in folders:
        delete(db.spark, db.cache_folder(row["kind"], row["cache_id"]))


def with_cache_state(db: Database) -> DataFrame:
    """The manifest with `has_cache`: a source's rows are still there (or there were none
    to keep) and no unfinished build touched them."""
    held = db.cache_folders().withColumn("_held", F.lit(True))
    pending = db.touched("sources", "source_key string").withColumn("_pending", F.lit(True))
    joined = db.manifest().join(held, ["kind", "cache_id"], "left").join(pending, "source_key", "left")
    has_cache = F.coalesce(F.col("_held"), F.col("rows") == 0, F.lit(False)) & F.col("_pending").isNull()
    return joined.withColumn("has_cache", has_cache).drop("_held", "_pending")


def actions_of(spark: SparkSession, config: BuildConfig, db: Database, manifest: DataFrame, old_scheme: bool) -> DataFrame:
    """All classified sources, written down: hashing reads every file once."""
    found = [a.discover(spark, config.folder(a.kind), config.fingerprint) for a in ADAPTERS.values()]
    return db.written("actions", changes.classify(reduce(DataFrame.unionByName, found), manifest, old_scheme))


def replace_rows(
    spark: SparkSession, db: Database, actions: DataFrame, kinds: list[str], members: DataFrame | None
) -> None:
    """Bring the cache up to date, after noting what that touches."""
    actions = actions.where(F.col("kind").isin(kinds))
    work = actions.where(F.col("action").isin(*changes.WORK))
    folders = work.where(F.col("old_cache_id").isNotNull()).select("kind", F.col("old_cache_id").alias("cache_id"))
    db.touch("outputs", outputs_of(in_folders(db.cached(), folders)))
    db.touch("sources", work.select("source_key"))
    refresh_cache(spark, db, actions, kinds, members)


def in_folders(cached: DataFrame, folders: DataFrame) -> DataFrame:
    """Cached rows of some sources. The keys are partition columns, so Spark prunes the
    other sources' files at run time."""
    return cached.join(folders, ["kind", "cache_id"], "left_semi")


def refresh_cache(
    spark: SparkSession, db: Database, actions: DataFrame, kinds: list[str], members: DataFrame | None
) -> None:
    """Drop the cached rows of replaced and removed sources, then read the changed files,
    one job per kind."""
    gone = actions.where(F.col("action").isin(*changes.WORK) & F.col("old_cache_id").isNotNull())
    for row in gone.select("kind", "old_cache_id").collect():
        delete(spark, db.cache_folder(row["kind"], row["old_cache_id"]))
    for kind in kinds:
        changed = actions.where((F.col("kind") == kind) & (F.col("action") == changes.PROCESSED))
        paths = sorted(row["path"] for row in changed.select("path").collect())
        if not paths:
            continue
        rows = ADAPTERS[kind].read(spark, paths, members)
        (
            rows.withColumn("source_key", source_key(kind, file_name(F.col("path"))))
            .withColumn("kind", F.lit(kind))
            .withColumn("cache_id", cache_id(F.col("path")))
            .select("source_key", "timeframe", "symbol", *CANDLE_COLUMNS, "kind", "cache_id")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("kind", "cache_id")
            .parquet(db.cache)
        )


OUTPUT = ["timeframe", "period", "symbol"]
OUTPUT_SCHEMA = "timeframe string, period string, symbol string"


def outputs_of(rows: DataFrame) -> DataFrame:
    return rows.select("timeframe", versions.period_of(F.col("timestamp")).alias("period"), "symbol").distinct()


def dirty_outputs(db: Database, actions: DataFrame, chosen: list[versions.Folder]) -> DataFrame:
    """(timeframe, period, symbol, again): what changed sources held before and hold now, and
    what the table's list names but isn't there. `again` is false for what only gets new rows."""
    if db.builds() and versions.current(db.spark, db.candles) is None:
        missing = outputs_of(db.cached())
    else:
        missing = versions.of_folders(db.live(), versions.gone(db.spark, db.candles, chosen)).select(*OUTPUT)
    before = db.touched("outputs", OUTPUT_SCHEMA).unionByName(missing).withColumn("again", F.lit(True))
    work = actions.where(F.col("action") == changes.PROCESSED).select("kind", "cache_id")
    after = outputs_of(in_folders(db.cached(), work)).withColumn("again", F.lit(False))
    return db.written("dirty", before.unionByName(after).groupBy(*OUTPUT).agg(F.max("again").alias("again")))


def export(db: Database, dirty: DataFrame, actions: DataFrame, compression: str) -> tuple[int, int, DataFrame]:
    """Write new folders for the dirty outputs: outputs written, outputs without any row left,
    and the list of the version to come. Nothing that a reader may be reading changes."""
    spark, live = db.spark, db.live()
    # One row for each year and timeframe.
    periods = {(row["timeframe"], row["period"]): row["again"] for row in dirty.groupBy("timeframe", "period").agg(F.max("again").alias("again")).collect()}
    if not periods:
        return 0, 0, live
    again = [key for key, whole in periods.items() if whole]
    added = {key for key, whole in periods.items() if not whole}
    merged = versions.mergeable(versions.folders(live), added)

    of_period = ["timeframe", "period"]
    keys = spark.createDataFrame(again, "timeframe string, period string")
    cached = db.cached().withColumn("period", versions.period_of(F.col("timestamp")))
    if again:  # bounds that the scan can hold against the files' statistics
        years = sorted(period for _, period in again)
        kinds = [a.kind for a in ADAPTERS.values() if a.timeframe in {frame for frame, _ in again}]
        first, last = (F.lit(f"{year}-{day}").cast("timestamp_ntz") for year, day in ((years[0], "01-01 00:00:00"), (years[-1], "12-31 23:59:59.999999")))
        whole = cached.where(F.col("kind").isin(kinds) & F.col("timestamp").between(first, last)).join(keys, of_period, "left_semi")
    else:
        whole = cached.limit(0)
    work = actions.where(F.col("action") == changes.PROCESSED).select("kind", "cache_id")
    fresh = in_folders(cached, work).join(keys, of_period, "left_anti")
    columns = ["timeframe", "symbol", *CANDLE_COLUMNS]
    rows = whole.select(*columns).unionByName(fresh.select(*columns))
    if merged:
        rows = rows.unionByName(versions.read_folders(spark, db.candles, merged).select(*columns))

    new = versions.write(rows, db.candles, tables.codec(compression), tables.ROWS_PER_FILE)
    kept = live.join(keys, of_period, "left_anti")
    if merged:
        kept = versions.of_folders(kept, merged, "left_anti")
    live = db.written("live", kept.unionByName(new))
    pairs = live.select("timeframe", "symbol").distinct().withColumn("held", F.lit(True))
    outputs = dirty.select("timeframe", "symbol").distinct().join(pairs, ["timeframe", "symbol"], "left")
    counts = {row["held"]: row["count"] for row in outputs.groupBy("held").count().collect()}
    return counts.get(True, 0), counts.get(None, 0), live


def export_flat(db: Database, config: BuildConfig, dirty: DataFrame | None, live: DataFrame, chosen: list[versions.Folder]) -> None:
    """Bring the consumer layout up to date with the version to come: the files of dirty outputs
    are replaced or, without any row left, deleted. A layout without its mark is written whole, and
    files of the layout's form that it shouldn't have go; other files in the folder stay.

    It happens before the commit, so a build that dies here finds the same outputs dirty again.
    """
    spark, target = db.spark, config.consumer_dir
    pair = ["timeframe", "symbol"]
    rows = versions.read_folders(spark, db.candles, chosen)
    held = tables.flat_files(live.select(*pair).distinct())
    if not exists(spark, f"{target}/{WHOLE}"):
        tables.write_flat(rows, target, config.compression)
        tables.drop_files(target, tables.listed_flat(spark, target).join(held, "file", "left_anti"))
        put(f"{target}/{WHOLE}", b"")
    elif dirty is not None:
        outputs = dirty.select(*pair).distinct()
        tables.write_flat(rows.join(outputs, pair, "left_semi"), target, config.compression)
        tables.drop_files(target, tables.flat_files(outputs).join(held, "file", "left_anti"))


def verify(db: Database, chosen: list[versions.Folder]) -> tuple[int, int]:
    """(rows, files) of a version, from its files' footers; an empty table or a file that
    doesn't hold what the list says is an error."""
    listed = sum(folder.rows for folder in chosen)
    found = tables.totals(tables.footers(db.spark, [folder.path(db.candles) for folder in chosen])).first() if chosen else None
    if not found or not found["files"]:
        raise RuntimeError("No candle files found")
    if found["rows"] != listed:
        raise RuntimeError(f"The files hold {found['rows']} rows, their list says {listed}")
    return found["rows"], found["files"]


def commit(db: Database, actions: DataFrame, digest: str, live: DataFrame | None) -> None:
    """Publish the table's new version, if any, and write the manifest of this build; `meta`
    comes last and makes it count. A build that dies between the two is made again."""
    target = db.next_build()
    listed = actions.where(F.col("action") != changes.DELETED)
    read = listed.where(F.col("action") == changes.PROCESSED).select("kind", "cache_id")
    counted = in_folders(db.cached(), read).groupBy("kind", "cache_id").agg(F.count(F.lit(1)).alias("new_rows"))
    fresh = F.col("action") == changes.PROCESSED
    rows = F.when(fresh, F.coalesce("new_rows", F.lit(0))).otherwise(F.col("old_rows"))
    folder = F.when(fresh, F.col("cache_id")).otherwise(F.col("old_cache_id"))
    sources = listed.join(counted, ["kind", "cache_id"], "left").select(
        "source_key", "kind", folder.alias("cache_id"), "fingerprint", rows.alias("rows")
    )
    sources.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{target}/sources")
    if live is not None:
        versions.publish(db.spark, db.candles, live)
    meta = one_row(db.spark, META_SCHEMA, VERSION, SCHEME, digest)
    meta.write.mode("overwrite").parquet(f"{target}/meta")
    for number in db.builds()[: -versions.KEPT]:
        delete(db.spark, f"{db.root}/state/build={number}")
    if live is not None:
        versions.vacuum(db.spark, db.candles)


def now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def record_run(db: Database, state: str, started: datetime, finished: datetime | None, message: str) -> None:
    schema = "state string, message string, started_at timestamp_ntz, finished_at timestamp_ntz"
    stamps = [None if stamp is None else stamp.isoformat(sep=" ") for stamp in (started, finished)]
    one_row(db.spark, schema, state, message, *stamps).write.mode("append").parquet(db.runs)


def one_row(spark: SparkSession, schema: str, *values) -> DataFrame:
    pairs = [column.rsplit(" ", 1) for column in schema.split(", ")]
    return spark.range(1).coalesce(1).select(*[F.lit(x).cast(kind).alias(name) for x, (name, kind) in zip(values, pairs)])


def last_run(db: Database) -> DataFrame:
    """State of the latest run and when a build last succeeded."""
    order = F.struct("started_at", F.coalesce(F.col("finished_at"), F.col("started_at")))
    success = F.max(F.when(F.col("state") == "SUCCESS", F.col("finished_at")))
    return db.spark.read.parquet(db.runs).agg(
        F.max_by(F.struct("state", "message", "started_at", "finished_at"), order).alias("run"),
        success.alias("last_successful_build_at"),
    ).select("run.*", "last_successful_build_at")
