"""Indicators over bars: every symbol at once, one added column each."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.calendar import period_start
from barloom.operators.recurrences import Smooth, Total, Trend
from barloom.operators.scan import run_scans
from barloom.operators.slabs import CHUNK, CHUNK_BARS, FIRST, drop_halo, slab, slab_days, with_halo

ANCHORS = ("Year", "Quarter", "Month", "Week", "Day")
OVERBOUGHT, OVERSOLD = 70, 30


def alpha_of(period: int) -> float:
    return 2.0 / (period + 1)


@dataclass(frozen=True)
class Ema:
    period: int

    @property
    def name(self) -> str:
        return f"ema_{self.period}"


@dataclass(frozen=True)
class Rsi:
    period: int = 14

    @property
    def name(self) -> str:
        return f"rsi_{self.period}"


@dataclass(frozen=True)
class Ama:
    efficiency_period: int = 10
    fast_period: int = 2
    slow_period: int = 30

    @property
    def name(self) -> str:
        return f"ama_{self.efficiency_period}_{self.fast_period}_{self.slow_period}"


@dataclass(frozen=True)
class SuperTrend:
    period: int = 10
    multiplier: float = 3.0

    @property
    def name(self) -> str:
        multiplier = f"{self.multiplier:g}".replace(".", "p")
        return f"supertrend_{self.period}_{multiplier}"


@dataclass(frozen=True)
class Vwap:
    anchor: str

    @property
    def name(self) -> str:
        return f"vwap_{self.anchor.lower()}"


Spec = Ema | Rsi | Ama | SuperTrend | Vwap


def frame(count: int) -> Window:
    """The current bar and the `count - 1` bars before it."""
    return slab().rowsBetween(-(count - 1), 0)


def previous_close() -> Column:
    return F.coalesce(F.lag("close").over(slab()), F.col("close"))


def true_range(previous: str = "prev_close") -> Column:
    high, low, before = F.col("high"), F.col("low"), F.col(previous)
    return F.greatest(high - low, F.abs(high - before), F.abs(low - before))


def typical_price() -> Column:
    return (F.col("high") + F.col("low") + F.col("close")) / F.lit(3.0)


def ohlc4() -> Column:
    return (F.col("open") + F.col("high") + F.col("low") + F.col("close")) / F.lit(4.0)


def mid_price() -> Column:
    return (F.col("high") + F.col("low")) / F.lit(2.0)


def traded() -> Column:
    return F.coalesce(F.col("volume").cast("double"), F.lit(0.0))


def rsi_value(gain: Column, loss: Column) -> Column:
    return F.when(loss == 0, F.lit(100.0)).otherwise((1.0 - 1.0 / (1.0 + gain / loss)) * 100.0)


def rsi_band(rsi: Column) -> Column:
    return F.when(rsi >= OVERBOUGHT, F.lit("overbought")).when(rsi <= OVERSOLD, F.lit("oversold"))


def vwap_value(worth: Column, volume: Column) -> Column:
    """Before any volume in the period: the bar's own typical price."""
    return F.when(volume != 0, worth / volume).otherwise(typical_price())


def with_atr(rows: DataFrame, period: int, interval: str, chunk_bars: int = CHUNK_BARS) -> DataFrame:
    """Adds `prev_close`, `true_range` and `atr`, the mean of the last (up to) `period` ranges."""
    framed = (
        with_halo(rows, period, slab_days(interval, chunk_bars))
        .withColumn("prev_close", previous_close())
        .withColumn("true_range", true_range())
        .withColumn("atr", F.avg("true_range").over(frame(period)))
    )
    return drop_halo(framed).drop(CHUNK)


def with_vwap(rows: DataFrame, anchors: tuple[str, ...] = ANCHORS) -> DataFrame:
    """Adds `vwap_<anchor>`: volume-weighted typical price since the period began.

    Windows only. A group is one symbol's period, at most a year of bars. Year,
    quarter, month and day windows all start with (symbol, year), so one shuffle
    serves the four; weeks straddle years and need their own.
    """
    out = rows.withColumn("_volume", traded()).withColumn("_worth", typical_price() * F.col("_volume"))
    out = out.withColumn("_year", period_start(F.col("bucket"), "Year"))
    for anchor in anchors:
        keys = {"Week": ["_week"], "Year": ["_year"]}.get(anchor, ["_year", "_period"])
        out = out.withColumn(keys[-1], period_start(F.col("bucket"), anchor))
        window = Window.partitionBy("symbol", *keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
        value = vwap_value(F.sum("_worth").over(window), F.sum("_volume").over(window))
        out = out.withColumn(Vwap(anchor).name, value)
    return out.select(*rows.columns, *[Vwap(a).name for a in anchors])


def lookback(specs: list[Spec]) -> int:
    """How many earlier bars the windows of these indicators reach back."""
    spans = {Ama: "efficiency_period", SuperTrend: "period"}
    return max([1, *[getattr(s, spans[type(s)]) for s in specs if type(s) in spans]])


def has(specs: list[Spec], kind: type) -> bool:
    return any(isinstance(s, kind) for s in specs)


def window_columns(framed: DataFrame, specs: list[Spec]) -> DataFrame:
    """What the recurrences read, in three layers, each built on the one before.

    All windows share the partitioning (symbol, slab).
    """
    bars = {FIRST: F.lag(F.lit(True)).over(slab()).isNull()}
    if has(specs, Rsi) or has(specs, SuperTrend):
        bars["prev_close"] = previous_close()
    if has(specs, Ama):
        bars["_price"] = ohlc4()
    if has(specs, Vwap):
        bars |= {"_volume": traded(), "_worth": typical_price() * traded()}
    for spec in specs:
        if isinstance(spec, Vwap):
            start = period_start(F.col("bucket"), spec.anchor)
            bars[f"_starts_{spec.name}"] = ~start.eqNullSafe(F.lag(start).over(slab()))

    changes: dict[str, Column] = {}
    if has(specs, Rsi):
        change = F.col("close") - F.col("prev_close")
        changes |= {"_gain": F.greatest(change, F.lit(0.0)), "_loss": F.greatest(-change, F.lit(0.0))}
    if has(specs, Ama):
        changes["_delta"] = F.abs(F.col("_price") - F.lag("_price").over(slab()))
    if has(specs, SuperTrend):
        changes["_range"] = true_range()

    sliding: dict[str, Column] = {}
    for spec in specs:
        if isinstance(spec, Ama):
            window = frame(spec.efficiency_period)
            moved, path = F.abs(F.col("_price") - F.first("_price").over(window)), F.sum("_delta").over(window)
            ratio = F.when(path > 0, moved / path).otherwise(F.lit(0.0))
            fast, slow = alpha_of(spec.fast_period), alpha_of(spec.slow_period)
            sliding[f"_weight_{spec.name}"] = F.pow(ratio * F.lit(fast - slow) + F.lit(slow), F.lit(2.0))
        elif isinstance(spec, SuperTrend):
            distance = F.avg("_range").over(frame(spec.period)) * F.lit(spec.multiplier)
            sliding[f"_above_{spec.name}"] = mid_price() + distance
            sliding[f"_below_{spec.name}"] = mid_price() - distance

    out = framed
    for layer in (bars, changes, sliding):
        out = out.withColumns(layer) if layer else out
    return out.drop("_delta", "_range")


def recurrences(specs: list[Spec]) -> tuple[list[Smooth | Total], list[Trend]]:
    scans: list[Smooth | Total] = []
    trends: list[Trend] = []
    for s in specs:
        if isinstance(s, Ema):
            scans.append(Smooth(s.name, "close", alpha_of(s.period)))
        elif isinstance(s, Rsi):
            scans += [Smooth(f"_{x}_{s.period}", f"_{x}", alpha_of(s.period)) for x in ("gain", "loss")]
        elif isinstance(s, Ama):
            scans.append(Smooth(s.name, "_price", f"_weight_{s.name}"))
        elif isinstance(s, Vwap):
            scans += [Total(f"_{x}_{s.name}", f"_{x}", f"_starts_{s.name}") for x in ("worth", "volume")]
        else:
            trends.append(Trend(s.name, f"_above_{s.name}", f"_below_{s.name}", s.period))
    return scans, trends


def value_of(spec: Spec) -> Column:
    if isinstance(spec, Rsi):
        return rsi_value(F.col(f"_gain_{spec.period}"), F.col(f"_loss_{spec.period}"))
    if isinstance(spec, Vwap):
        return vwap_value(F.col(f"_worth_{spec.name}"), F.col(f"_volume_{spec.name}"))
    return F.col(spec.name)


def with_indicators(rows: DataFrame, specs: list[Spec], interval: str, chunk_bars: int = CHUNK_BARS) -> DataFrame:
    """Adds a column per indicator: one shuffle by (symbol, slab) for all of them."""
    if not specs:
        return rows
    days = slab_days(interval, chunk_bars)
    inputs = drop_halo(window_columns(with_halo(rows, lookback(specs), days), specs))
    scanned = run_scans(inputs, *recurrences(specs), days)
    return scanned.select(*rows.columns, *[value_of(s).alias(s.name) for s in specs])
