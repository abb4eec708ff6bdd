"""The stored table: layout, pruning, odd symbols, splitting of busy symbols, specs."""

import glob
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from barloom.plans.specs import DEFAULT_CONFIG, load_specs, with_higher_timeframe
from barloom.sources import tables

SCHEMA = "symbol string, timeframe string, timestamp timestamp_ntz, open double, high double, low double, close double, volume bigint, delivery bigint, del_percent double"
SCHEMA_NAMES = [part.split(" ")[0] for part in SCHEMA.split(", ")]
ODD = ["M&M", "NIFTY 50", "A/B", "007", "50%", "x~y(z)", "Ä", "A+B", "-DASH"]


def rows_for(symbols, count=3, timeframe="day"):
    base = datetime(2024, 1, 1)
    return [(s, timeframe, base + timedelta(days=i), 1.0 + i, 2.0 + i, 0.5, 1.5, 10, 5, 50.0) for s in symbols for i in range(count)]


def test_odd_symbols_survive_both_layouts(spark, tmp_path):
    rows = spark.createDataFrame(rows_for(ODD), SCHEMA)
    tables.write_candles(rows, str(tmp_path / "t"))
    back = tables.read_candles(spark, str(tmp_path / "t"))
    assert {r["symbol"] for r in back.select("symbol").distinct().collect()} == set(ODD)
    for symbol in ODD:
        assert tables.read_symbol(spark, str(tmp_path / "t"), symbol, "day").count() == 3
    tables.write_flat(rows, str(tmp_path / "flat"))
    assert os.path.isfile(tmp_path / "flat" / "n" / "NIFTY%2050" / "day.parquet")
    flat = tables.read_flat(spark, str(tmp_path / "flat"), "day")
    assert {r["symbol"] for r in flat.select("symbol").distinct().collect()} == set(ODD)
    tables.drop_partitions(spark, str(tmp_path / "t"), spark.createDataFrame([("day", "A/B"), ("day", "50%")], "timeframe string, symbol string"))
    left = {r["symbol"] for r in tables.read_candles(spark, str(tmp_path / "t")).select("symbol").distinct().collect()}
    assert left == set(ODD) - {"A/B", "50%"}


def test_flat_files_are_whole_sorted_and_replaced(spark, tmp_path):
    path = str(tmp_path / "flat")
    rows = rows_for(ODD, 30) + rows_for(["AA"], 25_000) + rows_for(ODD, 4, "1m")
    tables.write_flat(spark.createDataFrame(rows, SCHEMA).repartition(7), path)
    files = {os.path.relpath(f, path) for f in glob.glob(f"{path}/**/*", recursive=True) if os.path.isfile(f)}
    assert len(files) == 2 * len(ODD) + 1 and not any(os.path.basename(f).startswith("_") for f in files)
    stamps = [r[0] for r in spark.read.parquet(f"{path}/a/AA/day.parquet").select("timestamp").collect()]
    assert len(stamps) == 25_000 and stamps == sorted(stamps)
    assert sorted(map(tuple, tables.read_flat(spark, path, "1m").select(*SCHEMA_NAMES).collect())) == sorted(rows_for(ODD, 4, "1m"))
    # Written again with fewer rows: that file is replaced, the others stay.
    tables.write_flat(spark.createDataFrame(rows_for(["AA"], 2), SCHEMA), path, "lz4")
    assert spark.read.parquet(f"{path}/a/AA/day.parquet").count() == 2
    assert tables.read_flat(spark, path, "day").count() == 30 * len(ODD) + 2
    pairs = spark.createDataFrame([("day", "AA"), ("day", "never there")], "timeframe string, symbol string")
    assert {r["file"] for r in tables.listed_flat(spark, path).collect()} == files
    tables.drop_files(path, tables.flat_files(pairs))
    assert tables.read_flat(spark, path, "day").count() == 30 * len(ODD)
    tables.write_flat(spark.createDataFrame([], SCHEMA), str(tmp_path / "none"))
    assert not glob.glob(str(tmp_path / "none" / "*"))


def test_a_failed_file_leaves_the_old_one(tmp_path):
    import pyarrow as pa

    from barloom.sources.flat import FlatWriter

    def batches(n, fails):
        yield pa.RecordBatch.from_pydict({"file": ["a/A/day.parquet"] * n, "close": [1.0] * n})
        if fails:
            raise RuntimeError("lost")

    writer = FlatWriter(str(tmp_path), "zstd")
    assert (writer.write(batches(3, False)).files, writer.write(batches(5, False)).rows) == (1, 5)
    with pytest.raises(RuntimeError):
        writer.write(batches(9, True))
    assert os.listdir(tmp_path / "a" / "A") == ["day.parquet"]
    import pyarrow.parquet as pq

    assert pq.read_metadata(tmp_path / "a" / "A" / "day.parquet").num_rows == 5


def test_symbol_read_prunes_folders(spark, tmp_path):
    tables.write_candles(spark.createDataFrame(rows_for(["AA", "BB"]), SCHEMA), str(tmp_path))
    plan = tables.read_symbol(spark, str(tmp_path), "AA", "day").where(F.col("timestamp") >= F.lit("2024-01-02").cast("timestamp_ntz"))
    text = plan.select("close")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in text and "symbol" in text.split("PartitionFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(timestamp" in text and "ReadSchema: struct<timestamp:timestamp_ntz,close:double>" in text


def test_small_symbols_get_one_sorted_file_and_busy_ones_are_split(spark, tmp_path):
    base = F.lit("2024-01-01").cast("timestamp_ntz")
    stamp = base + F.make_dt_interval(F.lit(0), F.lit(0), F.col("id").cast("int"))
    busy = spark.range(0, 300_000, 1, 4).select(F.lit("BUSY").alias("symbol"), stamp.alias("timestamp"))
    calm = spark.range(0, 50, 1, 4).select(F.lit("CALM").alias("symbol"), stamp.alias("timestamp"))
    rows = busy.union(calm).withColumns(
        {"timeframe": F.lit("1m"), **{c: F.rand(1) for c in ("open", "high", "low", "close")}, "volume": F.lit(1).cast("bigint"),
         "delivery": F.lit(None).cast("bigint"), "del_percent": F.lit(None).cast("double")}
    )
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "2m")
    try:
        tables.write_candles(rows, str(tmp_path / "t"))
    finally:
        spark.conf.unset(size)
    files = {s: glob.glob(f"{tmp_path}/t/timeframe=1m/*/symbol={s}/*.parquet") for s in ("BUSY", "CALM")}
    assert len(files["CALM"]) == 1 and len(files["BUSY"]) > 1
    for path in (*files["CALM"], *files["BUSY"]):
        stamps = [r[0] for r in spark.read.parquet(path).select("timestamp").collect()]
        assert stamps == sorted(stamps)
    assert tables.totals(tables.inventory(spark, str(tmp_path / "t"))).first()["rows"] == 300_050


def test_rows_per_file(spark, tmp_path):
    tables.write_candles(spark.createDataFrame(rows_for(["A"], 10), SCHEMA), str(tmp_path / "t"), rows_per_file=4)
    assert len(glob.glob(f"{tmp_path}/t/*/*/*/*.parquet")) == 3


def test_unknown_compression(spark, tmp_path):
    with pytest.raises(ValueError):
        tables.write_candles(spark.createDataFrame(rows_for(["A"]), SCHEMA), str(tmp_path / "t"), "brotli")


def test_default_specs():
    specs = load_specs(DEFAULT_CONFIG)
    assert [s.name for s in specs.specs] == [
        "ema_5", "ema_9", "ema_20", "ema_36", "ema_100", "ema_200", "ama_10_2_30", "supertrend_10_3", "rsi_14",
        "vwap_year", "vwap_quarter", "vwap_month", "vwap_week", "vwap_day",
    ]
    assert specs.relative == [("nifty", "N Close %"), ("sector", "S Close %")]


def test_senseless_specs_are_left_out():
    config = {
        "indicators": [
            {"type": "ema", "periods": [0, -3, 7]},
            {"type": "AMA", "fast_period": 30, "slow_period": 2},
            {"type": "AMA", "efficiency_period": 0},
            {"type": "MACD"},
        ],
        "rsi": {"period": 0},
        "anchored_vwap": {"anchors": ["Decade", "Week"]},
        "relative_close": {"series": [{"source": "gold"}, {"source": "sector"}]},
    }
    specs = load_specs(config)
    assert [s.name for s in specs.specs] == ["ema_7", "rsi_1", "vwap_week"]
    assert specs.relative == [("sector", "Sector Close %")]


def test_higher_timeframe_must_apply(spark):
    with pytest.raises(ValueError):
        with_higher_timeframe(spark.createDataFrame([], "symbol string, bucket timestamp_ntz"), [], "Week", "Day")
