"""Window functions and indicators (WIN), no-lookahead slicing (TS-10)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from barloom.functions import calendar as cal
from barloom.operators import align as al
from barloom.operators import bars as ops
from barloom.operators import indicators as ind
from barloom.operators import sets
from barloom.plans import specs as sp
from barloom.plans.chart import chart
from barloom.queries import views as v
from barloom.queries.registry import query

END = datetime(2024, 1, 17, 13, 30, 0)
END_SQL = "TIMESTAMP '2024-01-17 13:30:00'"


def minute_bars(spark, sf_dir):
    return ops.aggregate_bars(v.m1(spark, sf_dir), "1m")


def day_bars(spark, sf_dir):
    return ops.aggregate_bars(v.d1(spark, sf_dir), "Day")


def rounded(rows, *names, digits=6):
    return rows.select("symbol", "bucket", *[v.settled(F.col(n), digits).alias(n) for n in names])


def numbered(interval: str, source: str = "m1") -> str:
    """CTEs `b` (bars) and `n` (bars with position, previous close and price)."""
    prefix = v.M1 if source == "m1" else v.D1
    return f"""WITH RECURSIVE {prefix}, b AS ({v.sql_bars(source, interval)}), {NUMBERED}"""


NUMBERED = """n AS MATERIALIZED (
  SELECT *, row_number() OVER w AS i, coalesce(lag(close) OVER w, close) AS prev_close,
         (open + high + low + close) / 4.0::DOUBLE AS price
  FROM b WINDOW w AS (PARTITION BY symbol ORDER BY bucket))"""


def sql_ema(name: str, value: str, period: int, source: str = "n") -> str:
    a = f"CAST({2.0 / (period + 1)!r} AS DOUBLE)"
    return f"""{name} AS (
  SELECT symbol, i, bucket, CAST({value} AS DOUBLE) AS y FROM {source} WHERE i = 1
  UNION ALL
  SELECT t.symbol, t.i, t.bucket, {a} * ({value}) + (1 - {a}) * p.y
  FROM {name} p JOIN {source} t ON t.symbol = p.symbol AND t.i = p.i + 1)"""


def sql_rsi(period: int, source: str = "n") -> str:
    """CTEs `gain`, `loss` and the RSI rows `r` (symbol, bucket, value)."""
    gain = sql_ema("gain", "greatest(close - prev_close, 0)", period, source)
    loss = sql_ema("loss", "greatest(prev_close - close, 0)", period, source)
    return f"""{gain}, {loss}, r AS (
  SELECT symbol, bucket, g.i AS i,
         CASE WHEN l.y = 0 THEN 100 ELSE (1 - 1 / (1 + g.y / l.y)) * 100 END AS value
  FROM gain g JOIN loss l USING (symbol, bucket))"""


@query("win01_surrogate_ids", f"{v.WITH_CANDLES} SELECT symbol, row_number() OVER (ORDER BY symbol) - 1 AS id FROM (SELECT DISTINCT symbol FROM candles)")
def win01(spark, sf_dir):
    return sets.surrogate_ids(sets.universe(v.candles(spark, sf_dir)))


@query("win02_previous_close", f"{numbered('1m')} SELECT symbol, bucket, prev_close FROM n")
def win02(spark, sf_dir):
    return ind.with_atr(minute_bars(spark, sf_dir), 1, "1m").select("symbol", "bucket", "prev_close")


TR_SQL = "greatest(high - low, abs(high - prev_close), abs(low - prev_close))"


@query("win03_true_range", f"{numbered('1m')} SELECT symbol, bucket, round({TR_SQL} + 2.345678e-7, 6) AS true_range FROM n")
def win03(spark, sf_dir):
    return rounded(ind.with_atr(minute_bars(spark, sf_dir), 1, "1m"), "true_range")


@query(
    "win04_atr",
    f"""{numbered('1m')}, t AS (SELECT *, {TR_SQL} AS tr FROM n)
        SELECT symbol, bucket, round(avg(tr) OVER (PARTITION BY symbol ORDER BY bucket
               ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) + 2.345678e-7, 6) AS atr FROM t""",
)
def win04(spark, sf_dir):
    return rounded(ind.with_atr(minute_bars(spark, sf_dir), 10, "1m"), "atr")


PERIODS = (5, 9, 20, 36, 100, 200)


def ema_sql(source: str, interval: str, digits: int = 6) -> str:
    parts = ", ".join(sql_ema(f"e{p}", "close", p) for p in PERIODS)
    joins = " ".join(f"JOIN e{p} USING (symbol, bucket)" for p in PERIODS[1:])
    columns = ", ".join(f"{v.sql_settled(f'e{p}.y', digits)} AS ema_{p}" for p in PERIODS)
    return f"{numbered(interval, source)}, {parts} SELECT symbol, bucket, {columns} FROM e5 {joins}"


@query("win05_ema_minute", ema_sql("m1", "1m"))
def win05_minute(spark, sf_dir):
    specs = [ind.Ema(p) for p in PERIODS]
    return rounded(ind.with_indicators(minute_bars(spark, sf_dir), specs, "1m"), *[s.name for s in specs])


@query("win05_ema_day", ema_sql("d1", "Day", 2))
def win05_day(spark, sf_dir):
    specs = [ind.Ema(p) for p in PERIODS]
    return rounded(ind.with_indicators(day_bars(spark, sf_dir), specs, "Day"), *[s.name for s in specs], digits=2)


@query("win06_rsi", f"{numbered('1m')}, {sql_rsi(14)} SELECT symbol, bucket, round(value + 2.345678e-7, 6) AS rsi_14 FROM r")
def win06(spark, sf_dir):
    return rounded(ind.with_indicators(minute_bars(spark, sf_dir), [ind.Rsi(14)], "1m"), "rsi_14")


AMA_SQL = """delta AS (SELECT *, abs(price - lag(price) OVER (PARTITION BY symbol ORDER BY i)) AS d FROM n),
ratio AS MATERIALIZED (
  SELECT *, CASE WHEN sum(d) OVER w > 0 THEN abs(price - first_value(price) OVER w) / sum(d) OVER w ELSE 0 END AS er
  FROM delta WINDOW w AS (PARTITION BY symbol ORDER BY i ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)),
weighted AS MATERIALIZED (SELECT *, (er * (2/3::DOUBLE - 2/31::DOUBLE) + 2/31::DOUBLE) ** 2 AS s FROM ratio),
ama AS (
  SELECT symbol, i, bucket, price AS y FROM weighted WHERE i = 1
  UNION ALL
  SELECT t.symbol, t.i, t.bucket, t.s * (t.price - p.y) + p.y
  FROM ama p JOIN weighted t ON t.symbol = p.symbol AND t.i = p.i + 1)"""


@query("win07_ama", f"{numbered('1m')}, {AMA_SQL} SELECT symbol, bucket, round(y + 2.345678e-7, 6) AS ama_10_2_30 FROM ama")
def win07(spark, sf_dir):
    return rounded(ind.with_indicators(minute_bars(spark, sf_dir), [ind.Ama()], "1m"), "ama_10_2_30")


TREND_SQL = f"""ranges AS (SELECT *, {TR_SQL} AS tr FROM n),
atr AS (SELECT *, avg(tr) OVER (PARTITION BY symbol ORDER BY i ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS a,
               count(*) OVER (PARTITION BY symbol) AS n_bars FROM ranges),
basic AS MATERIALIZED (SELECT *, (high + low) / 2 + 3 * a AS bu, (high + low) / 2 - 3 * a AS bl FROM atr),
trend AS (
  SELECT symbol, i, bucket, n_bars, bu AS u, bl AS l, NOT (close < bl) AS up FROM basic WHERE i = 1
  UNION ALL
  SELECT symbol, i, bucket, n_bars, u, l, CASE WHEN was_up THEN NOT (close < l) ELSE close > u END FROM (
    SELECT t.symbol, t.i, t.bucket, t.n_bars, t.close, p.up AS was_up,
           CASE WHEN t.bu < p.u OR t.prev_close > p.u THEN t.bu ELSE p.u END AS u,
           CASE WHEN t.bl > p.l OR t.prev_close < p.l THEN t.bl ELSE p.l END AS l
    FROM trend p JOIN basic t ON t.symbol = p.symbol AND t.i = p.i + 1))"""


def trend_sql(source: str, interval: str, digits: int = 6) -> str:
    line = v.sql_settled("CASE WHEN up THEN l ELSE u END", digits)
    return f"""{numbered(interval, source)}, {TREND_SQL}
SELECT symbol, bucket, CASE WHEN n_bars >= 10 THEN {line} END AS supertrend_10_3 FROM trend"""


@query("win08_supertrend_minute", trend_sql("m1", "1m"))
def win08_minute(spark, sf_dir):
    return rounded(ind.with_indicators(minute_bars(spark, sf_dir), [ind.SuperTrend()], "1m"), "supertrend_10_3")


@query("win08_supertrend_day", trend_sql("d1", "Day", 2))
def win08_day(spark, sf_dir):
    return rounded(ind.with_indicators(day_bars(spark, sf_dir), [ind.SuperTrend()], "Day"), "supertrend_10_3", digits=2)


def vwap_sql(anchors, digits: int = 6) -> str:
    typical = "(high + low + close) / 3.0::DOUBLE"
    parts = []
    for anchor in anchors:
        window = f"""(PARTITION BY symbol, {v.sql_period('bucket', anchor)} ORDER BY bucket
          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""
        total = f"sum(coalesce(volume, 0)) OVER {window}"
        value = f"""CASE WHEN {total} <> 0 THEN sum({typical} * coalesce(volume, 0)) OVER {window} / {total}
            ELSE {typical} END"""
        parts.append(f"{v.sql_settled(value, digits)} AS vwap_{anchor.lower()}")
    return ", ".join(parts)


@query("win09_anchored_vwap_minute", f"{numbered('1m')} SELECT symbol, bucket, {vwap_sql(ind.ANCHORS)} FROM n")
def win09_minute(spark, sf_dir):
    rows = ind.with_vwap(minute_bars(spark, sf_dir))
    return rounded(rows, *[f"vwap_{a.lower()}" for a in ind.ANCHORS])


@query(
    "win09_anchored_vwap_day",
    f"{numbered('Day', 'd1')} SELECT symbol, bucket, {vwap_sql(('Year', 'Quarter', 'Month', 'Week'), 2)} FROM n",
)
def win09_day(spark, sf_dir):
    anchors = ("Year", "Quarter", "Month", "Week")
    return rounded(ind.with_vwap(day_bars(spark, sf_dir), anchors), *[f"vwap_{a.lower()}" for a in anchors], digits=2)


@query(
    "win10_relative_close",
    f"""{v.WITH_M1}, b AS ({v.sql_bars('m1', '15m')}),
    back AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY bucket DESC) AS k FROM b WHERE bucket <= {END_SQL}),
    shown AS (SELECT s.symbol, s.bucket, x.close AS x, y.close AS y FROM (SELECT * FROM back WHERE k <= 280) s
      LEFT JOIN b x ON x.symbol = 'view' AND x.bucket = s.bucket
      LEFT JOIN b y ON y.symbol = 'click' AND y.bucket = s.bucket),
    based AS (SELECT *, first_value(CASE WHEN x <> 0 THEN x END IGNORE NULLS) OVER w AS bx,
                     first_value(CASE WHEN y <> 0 THEN y END IGNORE NULLS) OVER w AS byy FROM shown
      WINDOW w AS (PARTITION BY symbol ORDER BY bucket ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
    SELECT symbol, bucket, round((x / bx - 1) * 100 + 2.345678e-7, 6) AS nifty_percent, round((y / byy - 1) * 100 + 2.345678e-7, 6) AS sector_percent
    FROM based""",
)
def win10(spark, sf_dir):
    chart = ops.aggregate_bars(v.m1(spark, sf_dir), "15m")
    nifty = al.relative_close(chart, chart.where(F.col("symbol") == "view"), "nifty_percent", end=END)
    sector = al.relative_close(chart, chart.where(F.col("symbol") == "click"), "sector_percent", end=END)
    both = nifty.join(sector.select("symbol", "bucket", "sector_percent"), ["symbol", "bucket"])
    return rounded(both, "nifty_percent", "sector_percent")


@query(
    "win11_latest_finite",
    f"""{v.WITH_D1} SELECT symbol, arg_max(delivery, timestamp) AS delivery,
        arg_max(CASE WHEN isfinite(del_percent) THEN del_percent END, timestamp) AS del_percent FROM d1 GROUP BY 1""",
)
def win11(spark, sf_dir):
    rows = v.d1(spark, sf_dir)
    latest = al.latest_finite(
        rows.withColumn("delivery", F.col("delivery").cast("double")), ["delivery", "del_percent"], "timestamp"
    )
    return latest.withColumn("delivery", F.col("delivery").cast("bigint"))


@query(
    "win12_higher_timeframe",
    f"""WITH RECURSIVE {v.D1}, c AS ({v.sql_bars('d1', 'Day')}), b AS ({v.sql_roll_up('c', 'Week')}),
        {NUMBERED}, {sql_ema('e', 'close', 9)}, {sql_rsi(14)}
        SELECT c.symbol, c.bucket, round(e.y + 2.345678e-3, 2) AS ema_9, round(r.value + 2.345678e-3, 2) AS rsi_14
        FROM c LEFT JOIN e ON e.symbol = c.symbol AND e.bucket = date_trunc('week', c.bucket)
               LEFT JOIN r ON r.symbol = c.symbol AND r.bucket = date_trunc('week', c.bucket)""",
)
def win12(spark, sf_dir):
    specs = [ind.Ema(9), ind.Rsi(14)]
    return rounded(sp.with_higher_timeframe(day_bars(spark, sf_dir), specs, "Day", "Week"), "ema_9", "rsi_14", digits=2)


@query(
    "win13_comparison_rsi",
    f"""WITH RECURSIVE {v.M1}, bars AS ({v.sql_bars('m1', '15m')}),
        b AS (SELECT * FROM bars WHERE symbol = 'view' AND bucket <= {END_SQL}), {NUMBERED}, {sql_rsi(14)}
        SELECT c.symbol, c.bucket, round(r.value + 2.345678e-7, 6) AS rsi_14
        FROM bars c LEFT JOIN r ON r.bucket = c.bucket WHERE c.bucket <= {END_SQL}""",
)
def win13(spark, sf_dir):
    chart = ops.aggregate_bars(v.m1(spark, sf_dir), "15m")
    view = chart.where(F.col("symbol") == "view")
    return rounded(al.comparison_rsi(chart, view, ind.Rsi(14), "15m", END), "rsi_14")


@query(
    "win14_rsi_bands",
    f"""{numbered('Day', 'd1')}, {sql_rsi(14)}
        SELECT symbol, bucket, CASE WHEN value >= 70 THEN 'overbought' WHEN value <= 30 THEN 'oversold' END AS band FROM r""",
)
def win14(spark, sf_dir):
    rows = ind.with_indicators(day_bars(spark, sf_dir), [ind.Rsi(14)], "Day")
    return rows.select("symbol", "bucket", ind.rsi_band(F.col("rsi_14")).alias("band"))


ALL_NAMES = ["ema_5", "ema_20", "ema_200", "ama_10_2_30", "rsi_14", "supertrend_10_3", "vwap_year", "vwap_week"]


@query(
    "win15_configured_indicators",
    f"""{numbered('1m')}, {", ".join(sql_ema(f"e{p}", "close", p) for p in (5, 20, 200))}, {AMA_SQL}, {sql_rsi(14)},
        {TREND_SQL}, vw AS (SELECT symbol, bucket, {vwap_sql(('Year', 'Week'))} FROM n)
        SELECT symbol, bucket, round(e5.y + 2.345678e-7, 6) AS ema_5, round(e20.y + 2.345678e-7, 6) AS ema_20, round(e200.y + 2.345678e-7, 6) AS ema_200,
               round(ama.y + 2.345678e-7, 6) AS ama_10_2_30, round(r.value + 2.345678e-7, 6) AS rsi_14,
               CASE WHEN trend.n_bars >= 10 THEN round(CASE WHEN trend.up THEN trend.l ELSE trend.u END + 2.345678e-7, 6) END AS supertrend_10_3,
               vwap_year, vwap_week
        FROM e5 JOIN e20 USING (symbol, bucket) JOIN e200 USING (symbol, bucket) JOIN ama USING (symbol, bucket)
        JOIN r USING (symbol, bucket) JOIN trend USING (symbol, bucket) JOIN vw USING (symbol, bucket)""",
)
def win15(spark, sf_dir):
    specs = sp.load_specs().specs
    return rounded(ind.with_indicators(minute_bars(spark, sf_dir), specs, "1m"), *ALL_NAMES)


CHART_CONFIG = {
    "indicators": [{"type": "EMA", "periods": [20]}],
    "market_symbols": {"nifty_symbol": "view", "default_sector_symbol": "error"},
    "relative_close": {"series": [{"source": "nifty"}, {"source": "sector"}]},
}


@query(
    "win15_chart_view",
    f"""{numbered('15m')}, cut AS MATERIALIZED (SELECT * FROM n WHERE bucket <= {END_SQL}),
        {sql_ema('e', 'close', 20, 'cut')}, {sql_rsi(14, 'cut')},
        back AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY bucket DESC) AS k FROM cut),
        shown AS (SELECT s.*, x.close AS x, y.close AS y FROM (SELECT * FROM back WHERE k <= 280) s
          LEFT JOIN cut x ON x.symbol = 'view' AND x.bucket = s.bucket
          LEFT JOIN cut y ON y.symbol = 'error' AND y.bucket = s.bucket),
        based AS (SELECT *, first_value(CASE WHEN x <> 0 THEN x END IGNORE NULLS) OVER w AS bx,
                         first_value(CASE WHEN y <> 0 THEN y END IGNORE NULLS) OVER w AS byy FROM shown
          WINDOW w AS (PARTITION BY symbol ORDER BY bucket ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
        SELECT symbol, bucket, round(e.y + 2.345678e-7, 6) AS ema_20, round(r.value + 2.345678e-7, 6) AS rsi_14,
               round((x / bx - 1) * 100 + 2.345678e-7, 6) AS nifty_percent,
               round((based.y / byy - 1) * 100 + 2.345678e-7, 6) AS sector_percent
        FROM based JOIN e USING (symbol, bucket) JOIN r USING (symbol, bucket)""",
)
def win15_chart(spark, sf_dir):
    shown = chart(v.candles(spark, sf_dir), "15m", end=END, specs=sp.load_specs(CHART_CONFIG))
    return rounded(shown, "ema_20", "rsi_14", "nifty_percent", "sector_percent")


@query(
    "ts10_no_lookahead",
    f"""{numbered('1m')}, cut AS MATERIALIZED (SELECT * FROM n WHERE bucket <= {END_SQL}), {sql_ema('e', 'close', 20, 'cut')}
        SELECT symbol, bucket, round(y + 2.345678e-7, 6) AS ema_20 FROM e""",
)
def ts10(spark, sf_dir):
    known = ops.up_to(minute_bars(spark, sf_dir), END)
    return rounded(ind.with_indicators(known, [ind.Ema(20)], "1m"), "ema_20")


@query(
    "join06_align_series",
    f"""{v.WITH_M1}, b AS ({v.sql_bars('m1', '5m')})
        SELECT t.symbol, t.bucket, t.close, s.close AS view_close FROM b t
        LEFT JOIN b s ON s.symbol = 'view' AND s.bucket = t.bucket""",
)
def join06(spark, sf_dir):
    rows = ops.aggregate_bars(v.m1(spark, sf_dir), "5m")
    source = rows.where(F.col("symbol") == "view").select("bucket", F.col("close").alias("view_close"))
    return al.align(rows.select("symbol", "bucket", "close"), source, "view_close")


@query(
    "join06_align_last_of_repeated_stamps",
    f"""{v.WITH_M1}, s AS (SELECT date_trunc('minute', timestamp) AS bucket, arg_max(close, event_id) AS last_close
          FROM m1 WHERE symbol = 'view' GROUP BY 1), b AS ({v.sql_bars('m1', '1m')})
        SELECT b.symbol, b.bucket, s.last_close FROM b LEFT JOIN s USING (bucket)""",
)
def join06_repeated(spark, sf_dir):
    rows = v.m1(spark, sf_dir, with_id=True)
    bucket = cal.period_start(F.col("timestamp"), "1m").alias("bucket")
    source = rows.where(F.col("symbol") == "view").select(bucket, F.col("close").alias("last_close"), "event_id")
    target = ops.aggregate_bars(rows, "1m").select("symbol", "bucket")
    return al.align(target, source, "last_close", order="event_id")


@query(
    "join07_broadcast_back",
    f"""{v.WITH_D1}, c AS ({v.sql_bars('d1', 'Day')}), m AS ({v.sql_roll_up('c', 'Month')})
        SELECT c.symbol, c.bucket, m.close AS month_close, m.volume AS month_volume
        FROM c LEFT JOIN m ON m.symbol = c.symbol AND m.bucket = date_trunc('month', c.bucket)""",
)
def join07(spark, sf_dir):
    rows = day_bars(spark, sf_dir)
    months = ops.roll_up(rows, "Month").select(
        "symbol", "bucket", F.col("close").alias("month_close"), F.col("volume").alias("month_volume")
    )
    kept = rows.select("symbol", "bucket")
    return sp.broadcast_back(kept, months, "Month", ["month_close", "month_volume"])
