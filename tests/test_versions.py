"""The versioned table: readers keep their version, new days add their own rows, small folders merge."""

import glob
import os
from datetime import datetime, timedelta

import pytest
import raw
from pyspark.sql import functions as F
from test_build import contents, world  # noqa: F401

from barloom.plans.build import Database, build
from barloom.plans.config import load_config
from barloom.session import delete
from barloom.sources import tables, versions

SCHEMA = "symbol string, timeframe string, timestamp timestamp_ntz, open double, high double, low double, close double, volume bigint, delivery bigint, del_percent double"


def day(number, symbols=("A", "B/C", "50%"), close=1.5):
    stamp = datetime(2024, 1, 1) + timedelta(days=number)
    return [(s, "day", stamp, 1.0, 2.0, 0.5, close, 10, 5, 50.0) for s in symbols]


def add(spark, path, rows):
    """What a build does for new sources: merge what is mergeable, write, publish, clean up."""
    live = versions.listed(spark, path, versions.current(spark, path))
    frame = spark.createDataFrame(rows, SCHEMA)
    merged = versions.mergeable(versions.folders(live), {("day", str(r[2].year)) for r in rows})
    if merged:
        frame = frame.unionByName(versions.read_folders(spark, path, merged).select(*frame.columns))
        live = versions.of_folders(live, merged, "left_anti")
    before = set(glob.glob(f"{path}/**/*.parquet", recursive=True))
    new = versions.write(frame, path, "zstd", 1000)
    written = sum(os.path.getsize(p) for p in set(glob.glob(f"{path}/**/*.parquet", recursive=True)) - before)
    versions.publish(spark, path, spark.createDataFrame(live.unionByName(new).collect(), versions.LIST_SCHEMA))
    versions.vacuum(spark, path)
    return written


def stored(spark, path):
    return sorted(map(str, tables.read_candles(spark, path).select("symbol", "timestamp", "close").collect()))


def test_new_days_add_their_rows_and_small_folders_merge(spark, tmp_path):
    path = str(tmp_path / "candles")
    rows, written, held = [], [], []
    for number in range(20):
        rows += day(number)
        written.append(add(spark, path, day(number)))
        held.append(len(versions.folders(versions.listed(spark, path, versions.current(spark, path)))))
    assert stored(spark, path) == sorted(map(str, spark.createDataFrame(rows, SCHEMA).select("symbol", "timestamp", "close").collect()))
    plain = [w for w, before, now in zip(written[1:], held, held[1:]) if now > before]
    assert max(plain) <= 1.1 * min(plain)  # bytes of a day, whatever lies there already
    assert max(held) <= 2 * versions.MERGE and any(now < before for before, now in zip(held, held[1:]))
    on_disk = versions.children(spark, path, "timeframe=*/period=*/build=*")
    assert len(on_disk) <= held[-1] + held[-2] and len(versions.numbers(spark, path)) == versions.KEPT
    assert tables.read_symbol(spark, path, "B/C", "day").count() == 20
    assert tables.read_symbol(spark, path, "none", "day").count() == 0


def test_sizes_decide_what_is_merged():
    small = [versions.Folder("day", "2024", str(i), 10) for i in range(7)]
    large = [versions.Folder("day", "2024", f"l{i}", 10_000) for i in range(6)]
    other = [versions.Folder("day", "2023", f"o{i}", 10) for i in range(9)]
    assert versions.mergeable([*small, *large, *other], {("day", "2024")}) == small
    assert versions.mergeable(small[:6], {("day", "2024")}) == []


def test_one_symbol_opens_only_folders_that_hold_it(spark, tmp_path):
    path = str(tmp_path / "candles")
    add(spark, path, day(0, ("A", "B")))
    add(spark, path, day(400, ("B",)))
    frame = tables.read_symbol(spark, path, "A", "day")
    assert all("period=2024" in p for p in frame.inputFiles()) and frame.count() == 1
    assert len(tables.read_candles(spark, path).inputFiles()) == 3


def test_a_reader_keeps_the_version_it_started_with(spark, world):  # noqa: F811
    config = load_config(str(world / "config.json"))
    build(spark, config)
    reader = tables.read_candles(spark, f"{config.database_dir}/candles")
    before = sorted(tuple(map(str, r)) for r in reader.collect())
    raw.write_day(world / "day" / "delivery_01-Jan-2025.csv", [raw.day_row(close="107"), raw.day_row("NEW")])
    build(spark, config)
    assert sorted(tuple(map(str, r)) for r in reader.collect()) == before
    after = contents(spark, config)
    assert after != before and {r[10] for r in after} == {"ABC", "NEW", "NIFTY 50"}


def test_a_new_day_leaves_the_others_files_and_state_stays_bounded(spark, world):  # noqa: F811
    config = load_config(str(world / "config.json"))
    db = Database(spark, config.database_dir)
    build(spark, config)
    old = {p for p in glob.glob(f"{db.candles}/timeframe=day/**/*.parquet", recursive=True)}
    for number in (2, 3, 6):
        raw.write_day(world / "day" / f"delivery_{number:02}-Jan-2025.csv", [raw.day_row(date=f" {number:02}-Jan-2025")])
        report = build(spark, config)
        assert (report.rewritten, report.removed) == (1, 0)
    files = {p for p in glob.glob(f"{db.candles}/timeframe=day/**/*.parquet", recursive=True)}
    assert old < files and len(files) == len(old) + 3
    assert len(glob.glob(f"{db.root}/state/build=*")) <= versions.KEPT + 1
    assert len(versions.numbers(spark, db.candles)) == versions.KEPT
    raw.write_day(world / "day" / "delivery_03-Jan-2025.csv", [raw.day_row(date=" 03-Jan-2025", close="109")])
    assert build(spark, config).rewritten == 1  # the year is written again, from the cache
    closes = {str(r.timestamp)[:10]: r.close for r in tables.read_symbol(spark, db.candles, "ABC", "day").collect()}
    assert closes == {"2025-01-01": 105.0, "2025-01-02": 105.0, "2025-01-03": 109.0, "2025-01-06": 105.0}


def test_a_build_without_changes_opens_no_row_group(spark, world):  # noqa: F811
    config = load_config(str(world / "config.json"))
    build(spark, config)
    context = spark.sparkContext
    context.setJobGroup("no change", "")
    try:
        assert build(spark, config).state == "NO SOURCE CHANGES"
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert len(context.statusTracker().getJobIdsForGroup("no change")) <= 18
    # Row groups can be cut away: only the footers are read.
    for path in glob.glob(f"{config.database_dir}/c*/**/*.parquet", recursive=True):
        if "/_versions/" not in path:
            with open(path, "r+b") as stream:
                stream.seek(4)
                stream.write(b"\0" * 16)
    assert build(spark, config).state == "NO SOURCE CHANGES"


def test_files_that_miss_rows_are_an_error(spark, world):  # noqa: F811
    config = load_config(str(world / "config.json"))
    build(spark, config)
    one = glob.glob(f"{config.database_dir}/candles/timeframe=1m/**/*.parquet", recursive=True)[0]
    os.remove(one)
    with pytest.raises(RuntimeError, match="rows"):
        build(spark, config, verify_only=True)
    delete(spark, f"{config.database_dir}/candles")
    with pytest.raises(RuntimeError, match="No candle files"):
        build(spark, config, verify_only=True)


def test_periods_are_years(spark):
    stamps = spark.createDataFrame([("2024-02-29 10:00:00",), ("0999-12-31 00:00:00",)], "t string").select(F.col("t").cast("timestamp_ntz"))
    assert [r[0] for r in stamps.select(versions.period_of(F.col("t"))).collect()] == ["2024", "0999"]
