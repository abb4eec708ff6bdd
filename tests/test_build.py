import json
import os

import pytest
import raw

from barloom.plans.build import Database, build, last_run
from barloom.plans.config import load_config
from barloom.sources import tables


@pytest.fixture
def world(tmp_path):
    for name in ("day", "index", "minute", "minute_index"):
        (tmp_path / name).mkdir()
    raw.write_day(tmp_path / "day" / "delivery_01-Jan-2025.csv", [raw.day_row(), raw.day_row("BOND1", " BE")])
    raw.write_index(tmp_path / "index" / "ind_close_all_01012025.csv", [raw.index_row()])
    rows = ["ABC.NC.NSE,01/01/2025,09:15:59,100,101,99,100.5,10,0", "BOND1.NC.NSE,01/01/2025,09:15:59,1,1,1,1,1,0"]
    raw.write_zip(tmp_path / "minute" / "01012025.zip", [("minute.csv", raw.minute_csv(rows))])
    config = {
        "database_dir": "database",
        "day_source": "day",
        "day_index_source": "index",
        "minute_source": "minute",
        "compression": "zstd",
        "profiles": {"ci": {"spark.sql.shuffle.partitions": "4"}},
    }
    (tmp_path / "config.json").write_text(json.dumps(config))
    return tmp_path


def candle(spark, config, symbol, timeframe):
    return tables.read_symbol(spark, f"{config.database_dir}/candles", symbol, timeframe).collect()


def contents(spark, config):
    rows = tables.read_candles(spark, f"{config.database_dir}/candles").collect()
    return sorted(tuple(map(str, r)) for r in rows)


def test_build_update_refresh(spark, world):
    config = load_config(str(world / "config.json"), "ci")
    assert config.spark_conf == {"spark.sql.shuffle.partitions": "4"}
    first = build(spark, config)
    assert (first.files, first.rows, first.actions) == (3, 3, {"processed": 3})
    assert candle(spark, config, "ABC", "day")[0]["close"] == 105
    assert candle(spark, config, "ABC", "day")[0]["delivery"] == 500
    assert candle(spark, config, "ABC", "1m")[0]["delivery"] is None
    assert candle(spark, config, "NIFTY 50", "day")[0]["close"] == 24000

    second = build(spark, config)
    assert (second.state, second.rewritten, second.actions) == ("NO SOURCE CHANGES", 0, {"cached": 3})

    raw.write_day(world / "day" / "delivery_01-Jan-2025.csv", [raw.day_row(close="106"), raw.day_row("BOND1", " BE")])
    third = build(spark, config)
    assert third.actions == {"processed": 1, "cached": 2}
    assert third.rewritten == 1
    assert candle(spark, config, "ABC", "day")[0]["close"] == 106

    before = contents(spark, config)
    assert build(spark, config, refresh=True).actions == {"processed": 3}
    assert contents(spark, config) == before
    assert build(spark, config, verify_only=True).rows == 3
    with pytest.raises(ValueError):
        build(spark, config, refresh=True, verify_only=True)
    run = last_run(Database(spark, config.database_dir)).first()
    assert run["state"] == "SUCCESS" and run["last_successful_build_at"] is not None


def test_universe_change_reprocesses_minutes_and_deletes(spark, world):
    config = load_config(str(world / "config.json"))
    build(spark, config)
    second_day = world / "day" / "delivery_02-Jan-2025.csv"
    raw.write_day(second_day, [raw.day_row("BOND1", " EQ", " 02-Jan-2025")])
    report = build(spark, config)
    assert report.actions == {"processed": 2, "cached": 2}
    assert len(candle(spark, config, "BOND1", "1m")) == 1

    incremental = contents(spark, config)
    build(spark, config, refresh=True)
    assert contents(spark, config) == incremental

    second_day.unlink()
    report = build(spark, config)
    assert report.actions == {"deleted": 1, "processed": 1, "cached": 2}
    assert report.removed == 2
    assert candle(spark, config, "BOND1", "day") == [] and candle(spark, config, "BOND1", "1m") == []
    assert report.rows == 3


def test_lost_output_is_written_again(spark, world):
    from barloom.session import delete

    config = load_config(str(world / "config.json"))
    build(spark, config)
    delete(spark, f"{config.database_dir}/candles/timeframe=day")
    report = build(spark, config)
    assert (report.state, report.rewritten, report.rows) == ("UPDATED", 2, 3)


def test_source_without_rows_is_not_read_again(spark, world):
    config = load_config(str(world / "config.json"))
    raw.write_day(world / "day" / "delivery_03-Jan-2025.csv", [raw.day_row("BOND1", " BE")])
    build(spark, config)
    assert build(spark, config).actions == {"cached": 4}


def fail_at(step, spark, config, monkeypatch):
    """Run a build that dies when it reaches `step`."""
    from barloom.plans import build as module

    with monkeypatch.context() as patch:
        patch.setattr(module, step, lambda *args: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            build(spark, config)
    assert last_run(Database(spark, config.database_dir)).first()["state"] == "FAILED"


@pytest.mark.parametrize("step", ["export", "commit"])
def test_interrupted_build_is_retried(spark, world, monkeypatch, step):
    config = load_config(str(world / "config.json"))
    day = world / "day" / "delivery_01-Jan-2025.csv"
    raw.write_day(day, [raw.day_row(), raw.day_row("GONE")])
    build(spark, config)
    raw.write_day(day, [raw.day_row(close="107"), raw.day_row("NEW")])
    raw.write_day(world / "day" / "delivery_02-Jan-2025.csv", [raw.day_row("SHORT", date=" 02-Jan-2025")])
    fail_at(step, spark, config, monkeypatch)
    # Meanwhile the new file disappears.
    (world / "day" / "delivery_02-Jan-2025.csv").unlink()
    build(spark, config)
    retried = contents(spark, config)
    assert {r[8] for r in retried} == {"1m", "day"} and candle(spark, config, "ABC", "day")[0]["close"] == 107
    build(spark, config, refresh=True)
    assert contents(spark, config) == retried


def test_interrupted_build_then_reverted_source(spark, world, monkeypatch):
    config = load_config(str(world / "config.json"))
    day = world / "day" / "delivery_01-Jan-2025.csv"
    build(spark, config)
    before, original = contents(spark, config), day.read_bytes()
    raw.write_day(day, [raw.day_row("OTHER", close="1")])
    fail_at("commit", spark, config, monkeypatch)
    day.write_bytes(original)
    build(spark, config)
    assert contents(spark, config) == before


def test_moved_sources_keep_their_cache(spark, world):
    config = load_config(str(world / "config.json"))
    build(spark, config)
    (world / "day").rename(world / "moved")
    text = (world / "config.json").read_text().replace('"day_source": "day"', '"day_source": "moved"')
    (world / "config.json").write_text(text)
    moved = load_config(str(world / "config.json"))
    assert build(spark, moved).actions == {"cached": 3}
    raw.write_day(world / "moved" / "delivery_01-Jan-2025.csv", [raw.day_row(close="108")])
    assert build(spark, moved).rows == 3
    assert [r["close"] for r in candle(spark, moved, "ABC", "day")] == [108.0]


def test_old_scheme_is_upgraded_without_reading(spark, world, monkeypatch):
    from barloom.plans import build as module

    config = load_config(str(world / "config.json"))
    with monkeypatch.context() as patch:
        patch.setattr(module, "SCHEME", "older")
        build(spark, config)
    report = build(spark, config)
    assert report.actions == {"cache fingerprint upgraded": 2, "cached": 1}
    assert report.rewritten == 0


def test_other_version_starts_over(spark, world, monkeypatch):
    from barloom.plans import build as module

    config = load_config(str(world / "config.json"))
    with monkeypatch.context() as patch:
        patch.setattr(module, "VERSION", 1)
        build(spark, config)
    assert build(spark, config).actions == {"processed": 3}


def test_missing_folder_and_bad_codec(spark, world):
    raw_config = json.loads((world / "config.json").read_text())
    for key in ("day_source", "minute_source", "minute_index_source"):
        (world / "bad.json").write_text(json.dumps(raw_config | {key: "nowhere"}))
        with pytest.raises(FileNotFoundError):
            build(spark, load_config(str(world / "bad.json")))
    (world / "bad.json").write_text(json.dumps(raw_config | {"day_index_source": "nowhere"}))
    assert build(spark, load_config(str(world / "bad.json"))).actions == {"processed": 2}
    (world / "bad.json").write_text(json.dumps(raw_config | {"compression": "rar"}))
    with pytest.raises(ValueError):
        load_config(str(world / "bad.json"))


def flat_files(config):
    root = config.consumer_dir
    found = [os.path.relpath(os.path.join(folder, f), root) for folder, _, names in os.walk(root) for f in names]
    return {f: os.stat(os.path.join(root, f)).st_mtime_ns for f in found if f.endswith(".parquet") and not os.path.basename(f).startswith(".")}


def test_build_keeps_the_consumer_layout(spark, world):
    raw_config = json.loads((world / "config.json").read_text())
    build(spark, load_config(str(world / "config.json"), "ci"))
    # Named later: a build without changes writes the whole layout.
    (world / "config.json").write_text(json.dumps({**raw_config, "consumer_dir": "flat"}))
    config = load_config(str(world / "config.json"), "ci")
    assert build(spark, config).state == "NO SOURCE CHANGES"
    first = flat_files(config)
    assert set(first) == {"a/ABC/day.parquet", "a/ABC/1m.parquet", "n/NIFTY%2050/day.parquet"}
    assert spark.read.parquet(f"{config.consumer_dir}/a/ABC/day.parquet").first()["close"] == 105
    build(spark, config)
    assert flat_files(config) == first

    # Another year and another symbol: only the files of symbols with new rows are replaced, whole.
    raw.write_day(world / "day" / "delivery_02-Jan-2026.csv", [raw.day_row(date=" 02-Jan-2026"), raw.day_row("NEW", date=" 02-Jan-2026")])
    build(spark, config)
    second = flat_files(config)
    assert {f for f in second if second[f] != first.get(f)} >= {"a/ABC/day.parquet", "n/NEW/day.parquet"}
    assert second["n/NIFTY%2050/day.parquet"] == first["n/NIFTY%2050/day.parquet"]
    stamps = [str(r["timestamp"])[:10] for r in spark.read.parquet(f"{config.consumer_dir}/a/ABC/day.parquet").collect()]
    assert stamps == ["2025-01-01", "2026-01-02"]

    # The source goes: so does the symbol that only it held.
    (world / "day" / "delivery_02-Jan-2026.csv").unlink()
    build(spark, config)
    assert set(flat_files(config)) == set(first)

    # A refresh forgets what was dirty: it drops what the layout shouldn't hold, and nothing else.
    stale = world / "flat" / "z" / "ZZZ"
    stale.mkdir(parents=True)
    (stale / "day.parquet").write_bytes(b"old")
    (world / "flat" / "notes.txt").write_text("mine")
    build(spark, config, refresh=True)
    assert (world / "flat" / "notes.txt").exists()
    assert set(flat_files(config)) == set(first)
    assert spark.read.parquet(f"{config.consumer_dir}/a/ABC/day.parquet").count() == 1

    flat = tables.read_flat(spark, config.consumer_dir, "day").unionByName(tables.read_flat(spark, config.consumer_dir, "1m"))
    assert sorted(tuple(map(str, r)) for r in flat.select(*tables.read_candles(spark, f"{config.database_dir}/candles").columns[:8]).collect()) == sorted(
        tuple(map(str, r[:8])) for r in tables.read_candles(spark, f"{config.database_dir}/candles").collect()
    )
