"""Everything one chart shows, for all symbols at once."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.operators.align import relative_move
from barloom.operators.bars import DEFAULT_VISIBLE_BARS, bars, comparison_bars, up_to, visible
from barloom.operators.indicators import with_indicators
from barloom.plans.specs import IndicatorSet, load_specs


def chart(
    candles: DataFrame,
    interval: str,
    as_of: datetime | None = None,
    end: datetime | None = None,
    count: int = DEFAULT_VISIBLE_BARS,
    specs: IndicatorSet | None = None,
) -> DataFrame:
    """Bars known at `as_of`, cut at `end`, with indicators, then the last `count` of them.

    Indicators see all earlier bars, but none after `end`. Comparison series named by
    the configuration's `market_symbols` become percent columns.
    """
    specs = specs or load_specs()
    rows = bars(candles, interval, as_of)
    if end is not None:
        rows = up_to(rows, end)
    shown = visible(with_indicators(rows, specs.specs, interval), count)
    symbols = {"nifty": specs.market.get("nifty_symbol"), "sector": specs.market.get("default_sector_symbol")}
    for source, _ in specs.relative:
        other = comparison_bars(candles.where(F.col("symbol") == symbols[source]), interval, as_of)
        shown = relative_move(shown, other, f"{source}_percent")
    return shown
