"""Incremental processing (INC) and configuration (EXT): builds over derived sources."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from barloom.functions.names import source_key
from barloom.operators import sets
from barloom.plans import build as builds
from barloom.plans import changes
from barloom.plans.config import BuildConfig, resolve
from barloom.queries import views as v
from barloom.queries.files import DAILY_SQL, folder, listed, page_files, page_number, raw_daily, write_csv
from barloom.queries.registry import query
from barloom.queries.relational import ACTIONS_SQL, SOURCES_SQL, sources
from barloom.session import delete, hadoop_path
from barloom.sources import files, tables
from barloom.sources.adapters import ADAPTERS


@query(
    "inc01_content_fingerprint",
    r"""SELECT 'page:' || page_id AS source_key, sha256(encode('adapter:3') || '\x00'::BLOB || encode(html)) AS fingerprint FROM pages""",
)
def inc01(spark, sf_dir):
    found = files.fingerprints(files.list_files(spark, page_files(spark, sf_dir, "inc01"), "*.html"), 3)
    return found.select(source_key("page", page_number(F.col("path")).cast("string")).alias("source_key"), "fingerprint")


@query("inc02_source_actions", f"WITH {ACTIONS_SQL} SELECT action, kind, count(*) AS n FROM actions GROUP BY 1, 2")
def inc02(spark, sf_dir):
    actions = changes.classify(*sources(spark, sf_dir))
    return actions.groupBy("action", "kind").agg(F.count(F.lit(1)).alias("n"))


@query(
    "inc05_dirty_timeframes",
    f"""WITH {ACTIONS_SQL} SELECT DISTINCT CASE WHEN kind = 'day' THEN 'day' ELSE '1m' END AS timeframe
        FROM actions WHERE action IN ('processed', 'deleted')""",
)
def inc05(spark, sf_dir):
    return changes.dirty_timeframes(changes.classify(*sources(spark, sf_dir)))


@query(
    "inc06_universe_change_reprocesses",
    f"""WITH {ACTIONS_SQL} SELECT source_key, CASE WHEN action <> 'deleted' AND kind = 'minute' THEN 'processed' ELSE action END AS action
        FROM actions""",
)
def inc06(spark, sf_dir):
    """The symbols of the last two years against all: the set's digest changed."""
    rows = v.table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("string").alias("symbol"))
    old, new = sets.universe(rows.where(F.col("symbol") < "2000")), sets.universe(rows)
    digests = [sets.set_digest(s, "symbol").first()["digest"] for s in (old, new)]
    forced = ("minute",) if digests[0] != digests[1] else ()
    return changes.classify(*sources(spark, sf_dir), reprocess_kinds=forced).select("source_key", "action")


@query(
    "inc07_affected_outputs",
    f"""{v.WITH_CANDLES}, touched AS (SELECT timeframe, symbol FROM candles WHERE timeframe = 'day' AND symbol < '3'
          UNION ALL SELECT timeframe, symbol FROM candles WHERE symbol = 'view')
        SELECT DISTINCT timeframe, symbol FROM touched""",
)
def inc07(spark, sf_dir):
    rows = v.candles(spark, sf_dir)
    before = rows.where((F.col("timeframe") == "day") & (F.col("symbol") < "3"))
    return changes.affected_symbols(before, rows.where(F.col("symbol") == "view"))


@query(
    "inc08_scheme_upgrade",
    f"""WITH {SOURCES_SQL} SELECT coalesce(d.source_key, m.source_key) AS source_key,
          CASE WHEN d.source_key IS NULL THEN 'deleted' WHEN m.has_cache THEN 'cache fingerprint upgraded' ELSE 'processed' END AS action
        FROM discovered d FULL JOIN manifest m ON d.source_key = m.source_key""",
)
def inc08(spark, sf_dir):
    return changes.classify(*sources(spark, sf_dir), old_scheme=True).select("source_key", "action")


# Whole builds. Daily sources are CSV files of a few priorities each, derived from `orders`.

#: Orders for each file of a group of symbols.
SOURCE_ROWS = 1_000_000


def write_sources(spark, sf_dir, root, rows):
    """Daily CSV files named as the adapter expects, at `root/day`; an empty minute folder.

    Symbols make four groups, and a group has a file for each SOURCE_ROWS orders. A line's file
    depends on the line and the number of orders, and lines are sorted, so a file changes only
    where its own lines do.
    """
    staging = f"{root}/staging"
    slices = max(1, -(-v.table(spark, sf_dir, "orders").count() // SOURCE_ROWS))
    number = F.pmod(F.hash("SYMBOL"), F.lit(4)) * slices + F.pmod(F.xxhash64(*rows.columns), F.lit(slices))
    write_csv(rows.repartitionById(4 * slices, number.cast("int")).sortWithinPartitions(*rows.columns), staging)
    fs, target = hadoop_path(spark, f"{root}/day")
    delete(spark, f"{root}/day")
    delete(spark, f"{root}/minute")
    fs.mkdirs(target)
    fs.mkdirs(hadoop_path(spark, f"{root}/minute")[1])
    for part in listed(spark, staging):
        number = int(re.search(r"part-(\d+)", part).group(1))
        fs.rename(hadoop_path(spark, part)[1], hadoop_path(spark, f"{root}/day/delivery_{number}.csv")[1])
    return BuildConfig(f"{root}/database", f"{root}/day", f"{root}/minute")


def fresh(spark, sf_dir, name):
    root = folder(spark, sf_dir, name)
    delete(spark, f"{root}/database")
    return root


def built(spark, sf_dir):
    """Configuration of a database that one build has filled; made on first use."""
    root = folder(spark, sf_dir, "built")
    config = BuildConfig(f"{root}/database", f"{root}/day", f"{root}/minute")
    if not builds.Database(spark, config.database_dir).builds():
        builds.build(spark, write_sources(spark, sf_dir, root, raw_daily(spark, sf_dir)))
    return config


def shifted(rows):
    """The same lines with another closing price for 2-HIGH."""
    changed = F.trim("SYMBOL") == "2-HIGH"
    return rows.withColumn(" CLOSE_PRICE", F.when(changed, F.lit(" 1.5")).otherwise(F.col(" CLOSE_PRICE")))


CANDLE_LIST = "symbol, timestamp, open, high, low, close, volume, delivery, del_percent"


def result(spark, config):
    return tables.read_candles(spark, f"{config.database_dir}/candles").drop("timeframe", "symbol_group")


@query(
    "inc03_changed_sources_replaced",
    f"""WITH {DAILY_SQL} SELECT symbol, timestamp, open, high, low, CASE WHEN symbol = '2-HIGH' THEN 1.5::DOUBLE ELSE close END AS close,
        volume, delivery, del_percent FROM daily""",
)
def inc03(spark, sf_dir):
    root = fresh(spark, sf_dir, "inc03")
    rows = raw_daily(spark, sf_dir)
    builds.build(spark, write_sources(spark, sf_dir, root, rows))
    config = write_sources(spark, sf_dir, root, shifted(rows))
    builds.build(spark, config)
    return result(spark, config)


@query("inc04_deleted_sources_removed", f"WITH {DAILY_SQL} SELECT {CANDLE_LIST} FROM daily WHERE symbol <> '2-HIGH'")
def inc04(spark, sf_dir):
    root = fresh(spark, sf_dir, "inc04")
    rows = raw_daily(spark, sf_dir)
    builds.build(spark, write_sources(spark, sf_dir, root, rows))
    config = write_sources(spark, sf_dir, root, rows.where(F.trim("SYMBOL") != "2-HIGH"))
    builds.build(spark, config)
    return result(spark, config)


@query("inc11_full_refresh", f"WITH {DAILY_SQL} SELECT {CANDLE_LIST} FROM daily")
def inc11(spark, sf_dir):
    config = write_sources(spark, sf_dir, fresh(spark, sf_dir, "inc11"), raw_daily(spark, sf_dir))
    builds.build(spark, config)
    builds.build(spark, config, refresh=True)
    return result(spark, config)


ONE_ROW_SQL = f"WITH {DAILY_SQL} SELECT count(*) AS rows"


def as_row(spark, report, **more):
    """One row about a build, counted from its table."""
    values = {"state": report.state, "rewritten": report.rewritten, **more}
    kinds = {str: "string", int: "bigint", bool: "boolean"}
    schema = "rows bigint, " + ", ".join(f"{k} {kinds[type(x)]}" for k, x in values.items())
    return spark.createDataFrame([(report.rows, *values.values())], schema)


@query(
    "inc09_version_migration",
    f"{ONE_ROW_SQL}, 'UPDATED' AS state, count(DISTINCT symbol) AS rewritten, 2 AS version FROM daily",
)
def inc09(spark, sf_dir):
    """State of another version is thrown away and everything is built again."""
    config = write_sources(spark, sf_dir, fresh(spark, sf_dir, "inc09"), raw_daily(spark, sf_dir))
    builds.build(spark, config)
    db = builds.Database(spark, config.database_dir)
    old = spark.createDataFrame([(1, builds.SCHEME, "")], builds.META_SCHEMA)
    old.write.mode("overwrite").parquet(f"{db.root}/state/build=9/meta")
    report = builds.build(spark, config)
    return as_row(spark, report, version=db.meta()["version"])


@query(
    "inc10_uncommitted_build_is_retried",
    f"{ONE_ROW_SQL}, 'UPDATED' AS state, count(DISTINCT symbol) AS rewritten FROM daily",
)
def inc10(spark, sf_dir):
    """Outputs without a committed manifest are written again."""
    config = write_sources(spark, sf_dir, fresh(spark, sf_dir, "inc10"), raw_daily(spark, sf_dir))
    builds.build(spark, config)
    db = builds.Database(spark, config.database_dir)
    delete(spark, f"{db.root}/state/build={db.builds()[-1]}/meta/_SUCCESS")
    return as_row(spark, builds.build(spark, config))


@query("inc12_verify_only", f"{ONE_ROW_SQL}, 'VERIFIED' AS state, 0::BIGINT AS rewritten FROM daily")
def inc12(spark, sf_dir):
    config = built(spark, sf_dir)
    return as_row(spark, builds.build(spark, config, verify_only=True))


@query("inc13_no_change_no_export", f"{ONE_ROW_SQL}, 'NO SOURCE CHANGES' AS state, 0::BIGINT AS rewritten FROM daily")
def inc13(spark, sf_dir):
    config = built(spark, sf_dir)
    return as_row(spark, builds.build(spark, config))


@query(
    "inc14_version_state",
    f"{ONE_ROW_SQL}, 2 AS version, 'sha256-content-v1' AS scheme FROM daily",
)
def inc14(spark, sf_dir):
    config = built(spark, sf_dir)
    db = builds.Database(spark, config.database_dir)
    meta = db.meta()
    counted = db.manifest().agg(F.sum("rows").alias("rows"))
    return counted.select("rows", F.lit(meta["version"]).alias("version"), F.lit(meta["scheme"]).alias("scheme"))


@query(
    "inc15_run_record",
    f"WITH {DAILY_SQL} SELECT 'SUCCESS' AS state, true AS finished, true AS ever_succeeded, count(*) AS rows FROM daily",
)
def inc15(spark, sf_dir):
    config = built(spark, sf_dir)
    report = builds.build(spark, config)
    run = builds.last_run(builds.Database(spark, config.database_dir))
    return run.select(
        "state",
        F.col("finished_at").isNotNull().alias("finished"),
        F.col("last_successful_build_at").isNotNull().alias("ever_succeeded"),
        F.lit(report.rows).cast("bigint").alias("rows"),
    )


@query("ext02_registered_kinds", f"WITH {DAILY_SQL} SELECT 'day' AS kind, timeframe, 2 AS version, count(*) AS rows FROM daily GROUP BY timeframe")
def ext02(spark, sf_dir):
    """What each registered kind contributed to a build."""
    config = built(spark, sf_dir)
    kinds = spark.createDataFrame([(a.kind, a.version) for a in ADAPTERS.values()], "kind string, version int")
    held = builds.Database(spark, config.database_dir).cached().groupBy("kind", "timeframe")
    return held.agg(F.count(F.lit(1)).alias("rows")).join(kinds, "kind").select("kind", "timeframe", "version", "rows")


@query("ext03_configured_build", f"WITH {DAILY_SQL} SELECT symbol, count(*) AS rows, 'snappy' AS codec FROM daily GROUP BY 1")
def ext03(spark, sf_dir):
    """Relative folders and compression come from the configuration, settings from the profile."""
    config = write_sources(spark, sf_dir, fresh(spark, sf_dir, "ext03"), raw_daily(spark, sf_dir))
    raw = {"database_dir": "database", "day_source": "day", "minute_source": "minute", "compression": "zstd"}
    raw["profiles"] = {"ci": {"compression": "snappy", "spark.sql.shuffle.partitions": "4"}}
    chosen = resolve(raw, config.day_source.rsplit("/", 1)[0], "ci")
    builds.build(spark, chosen)
    db = builds.Database(spark, chosen.database_dir)
    named = db.stored().select("symbol", F.regexp_extract(tables.file_path(), r"\.(\w+)\.parquet$", 1).alias("codec"))
    return named.groupBy("symbol", "codec").agg(F.count(F.lit(1)).alias("rows"))
