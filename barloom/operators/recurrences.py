"""Recurrences over the ordered bars of one slab, in NumPy.

Each is described twice: as a function of the state before the slab (so that slabs
can be summed up in parallel) and as values per bar once that state is known.
"""

from __future__ import annotations

from collections import deque
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from barloom.operators.slabs import FIRST


def numbers(table: pa.Table, name: str) -> np.ndarray:
    return table[name].to_numpy().astype(np.float64, copy=True)


@dataclass(frozen=True)
class Smooth:
    """y = alpha*value + (1-alpha)*y_previous; the first y is the value itself.

    `alpha` is a number or the name of a column with one weight per bar.
    """

    output: str
    value: str
    alpha: float | str

    def steps(self, table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        value = numbers(table, self.value)
        alpha = numbers(table, self.alpha) if isinstance(self.alpha, str) else np.full(len(value), self.alpha)
        alpha[table[FIRST].to_numpy()] = 1.0
        return 1.0 - alpha, alpha * value


@dataclass(frozen=True)
class Total:
    """Running sum of `value` that starts over where the `restart` column is true."""

    output: str
    value: str
    restart: str

    def steps(self, table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        restart = table[self.restart].to_numpy() | table[FIRST].to_numpy()
        return np.where(restart, 0.0, 1.0), numbers(table, self.value)


def compose(factor: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix compositions of the steps y -> factor*y + term, by doubling."""
    factor, term = factor.copy(), term.copy()
    step = 1
    while step < len(term):
        term[step:] += factor[step:] * term[:-step]
        factor[step:] = factor[step:] * factor[:-step]
        step *= 2
    return factor, term


def compose_all(factor: np.ndarray, term: np.ndarray) -> tuple[float, float]:
    """The last of `compose`, in one sweep from the end."""
    after = np.append(np.cumprod(factor[:0:-1])[::-1], 1.0)
    return float(factor[0] * after[0]), float(term @ after)


@dataclass(frozen=True)
class Trend:
    """Bands that only tighten until the price crosses them, and the side it is on.

    With previous close p and basic upper band b, the upper band keeps its value u if
    p <= u <= b and else takes b. The lower band is the same rule on negated prices.
    """

    output: str
    basic_upper: str
    basic_lower: str
    period: int

    def upper_steps(self, table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        first = table[FIRST].to_numpy()
        return np.where(first, np.inf, numbers(table, "prev_close")), numbers(table, self.basic_upper)

    def lower_steps(self, table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        first = table[FIRST].to_numpy()
        return np.where(first, np.inf, -numbers(table, "prev_close")), -numbers(table, self.basic_lower)


def band_pieces(before: np.ndarray, basic: np.ndarray) -> list[float]:
    """The band at the end of a slab as a function of the band u before it.

    Returns [low, high, edge1, value1, edge2, value2, ...]: u within low..high is
    kept, u above high ends at high, and u below low ends at the value of the first
    edge greater than u. If nothing is kept, low is infinite.

    Bands that left low..high form groups of equal value, held in ascending order. A
    step moves the groups outside p..b to b, above all others, so it only touches the
    two ends: the whole slab takes time in proportion to its bars.
    """
    low, high = -np.inf, np.inf
    edges: list[float] = []
    leader: list[int] = []
    groups: deque[tuple[float, int]] = deque()
    for p, b in zip(before.tolist(), basic.tolist()):
        moved = []
        while groups and groups[0][0] < p:
            moved.append(groups.popleft()[1])
        while groups and groups[-1][0] >= b:
            moved.append(groups.pop()[1])
        if low <= high:
            dies = max(low, p) > min(high, b)
            if dies or p > low:
                edges.append(np.inf if dies else p)
                leader.append(len(leader))
                moved.append(leader[-1])
            low, high = (np.inf, -np.inf) if dies else (max(low, p), min(high, b))
        if moved:
            for piece in moved:
                leader[piece] = moved[0]
            groups.append((b, moved[0]))
    value_of = {piece: value for value, piece in groups}
    pieces: list[float] = []
    for piece, edge in enumerate(edges):
        while piece != leader[piece]:
            leader[piece] = piece = leader[leader[piece]]
        if pieces and pieces[-1] == value_of[piece]:
            pieces[-2] = edge
        else:
            pieces += [edge, value_of[piece]]
    return [low, high, *pieces]


def apply_pieces(pieces: list[float], u: float) -> float:
    low, high = pieces[0], pieces[1]
    if low <= u <= high:
        return u
    if low <= high < u:
        return high
    return next(value for edge, value in zip(pieces[2::2], pieces[3::2]) if u < edge)


def compose_pieces(first: list[float], then: list[float]) -> list[float]:
    """The pieces of `then` after `first`: one slab's bands after an earlier slab's."""
    (low, high), (below, above) = first[:2], then[:2]
    found = [(edge, apply_pieces(then, value)) for edge, value in zip(first[2::2], first[3::2])]
    kept = max(low, below), min(high, above)
    if low <= high:  # what the first slab keeps meets the second one's edges
        ends = high if kept[0] > kept[1] else np.inf
        found += [(edge, value) for edge, value in zip(then[2::2], then[3::2]) if low < edge <= ends]
        if kept[0] > kept[1]:
            found.append((np.inf, apply_pieces(then, high)))
    pieces: list[float] = []
    for edge, value in found:
        if pieces and pieces[-1] == value:
            pieces[-2] = edge
        else:
            pieces += [edge, value]
    return [*(kept if kept[0] <= kept[1] else (np.inf, -np.inf)), *pieces]


def run_band(before: np.ndarray, basic: np.ndarray, u: float) -> np.ndarray:
    out = np.empty(len(basic))
    for i, (p, b) in enumerate(zip(before.tolist(), basic.tolist())):
        if not p <= u <= b:
            u = b
        out[i] = u
    return out


def run_sides(close: np.ndarray, upper: np.ndarray, lower: np.ndarray, rising: bool) -> np.ndarray:
    """Rising or not after each bar: a close below the lower band falls, one above the
    upper band rises, both at once swap."""
    fall, rise = close < lower, close > upper
    last = np.maximum.accumulate(np.where(fall ^ rise, np.arange(len(close)), -1))
    swaps = np.cumsum(fall & rise)
    known = last >= 0
    start = np.where(known, rise[last], rising)
    since = swaps - np.where(known, swaps[last], 0)
    return start ^ (since % 2 == 1)
