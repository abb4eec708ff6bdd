"""Operator 13: periodic runs of words, by a sparse dynamic program over diagonals.

A diagonal is a lag q; the word at i lengthens it if it occurred at i - q as well. A run of
period q is a diagonal that matched long enough, its first q words included. Words are taken
in order; a word's earlier occurrences open diagonals, an open diagonal's match length grows
until its first mismatch, and the diagonal is then emitted or forgotten.

What makes the table of diagonals sparse, without losing a run:

* a run of at least 24 words and three periods matches 16 words in a row, so an occurrence
  counts as earlier only if the 15 words before it agree as well;
* a run of period q >= 16 matches so over more than q words in a row, so lags from 2**k to
  2**(k+1) - 1 are looked up at every 2**k-th word only: n lookups for each k, whatever the text;
  of its 2q matches, q lie before or after that word, so q words equal the q before them there;
* a lag q whose window lies in a known run of period d, d a proper divisor of q, is a multiple
  of that run's period wherever it goes on matching (q words of period d fix all others), so
  it isn't opened.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Least words and least periods of a run.
LEAST_WORDS, LEAST_PERIODS = 24, 3

Run = tuple[int, int, int]
Alter = Callable[[int, list[bytes]], list[bytes]]

_ODD = np.uint64(0x9E3779B97F4A7C15)


def _context(words: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of the `size` (a power of two) words that end at each word from `size` - 1 on."""
    h = (words.astype(np.uint64) + np.uint64(1)) * _ODD
    h ^= h >> np.uint64(29)
    step = 1
    while step < size:
        h = (h[:-step] * np.uint64(0xBF58476D1CE4E5B9)) ^ (h[step:] * np.uint64(0x94D049BB133111EB))
        h ^= h >> np.uint64(31)
        step *= 2
    return h


def _agree(words: np.ndarray, i: int, q: int, step: int) -> int:
    """Words from i on (upwards or downwards by `step`) that equal the words q before them."""
    total, size = 0, 64
    room = len(words) - i if step > 0 else i - q + 1
    while total < room:
        n = min(size, room - total)
        at = i + total if step > 0 else i - total - n + 1
        same = words[at : at + n] == words[at - q : at - q + n]
        if step < 0:
            same = same[::-1]
        if not same.all():
            return total + int(same.argmin())
        total, size = total + n, size * 2
    return total


def _is_smallest(words: np.ndarray, run: Run) -> bool:
    """Whether no proper divisor of the period is one; three periods leave no other candidates."""
    start, length, q = run
    rest, prime = q, 2
    while rest > 1:
        if prime * prime > rest:
            prime = rest
        if rest % prime == 0:
            d = q // prime
            if (words[start + d : start + length] == words[start : start + length - d]).all():
                return False
            while rest % prime == 0:
                rest //= prime
        prime += 1
    return True


class _Squares:
    """Finds lags at which q words equal the q words before them, by a running polynomial sum.

    Equal words give equal sums, so nothing is missed; unequal ones that agree by chance are
    found out when the words themselves are compared.
    """

    def __init__(self, words: np.ndarray):
        self.n = len(words)
        self.power = np.full(self.n + 1, _ODD, np.uint64)
        self.power[0] = 1
        np.multiply.accumulate(self.power, out=self.power)
        mixed = (words.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
        mixed ^= mixed >> np.uint64(32)
        self.sums = np.zeros(self.n + 1, np.uint64)
        np.cumsum(mixed * self.power[:-1], out=self.sums[1:])

    def at(self, middle: np.ndarray, q: np.ndarray) -> np.ndarray:
        inside = (middle - q >= 0) & (middle + q <= self.n)
        m, q = np.where(inside, middle, 0), np.where(inside, q, 0)
        return inside & (self.sums[m + q] - self.sums[m] == (self.sums[m] - self.sums[m - q]) * self.power[q])

    def touch(self, i: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Whether a match of 2q words at lag q could hold i: q of them lie up to i or from i on."""
        return self.at(i, q) | self.at(i - q + 1, q)


def _multiples(known: list[Run], i: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Whether the window of q words up to i lies in a known run whose period divides q."""
    out = np.zeros(len(i), bool)
    for start, length, d in known:
        a, b = np.searchsorted(i, [start + 2 * d - 1, start + length])
        out[a:b] |= (q[a:b] % d == 0) & (q[a:b] > d) & (i[a:b] - q[a:b] + 1 >= start)
    return out


def runs_of(words: np.ndarray, least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS) -> list[Run]:
    """(start, length, period) of all runs of a sequence of word numbers, by start and period.

    A run has period q but no smaller one, at least `least_words` words and `least_periods`
    (3 or more) periods, and no neighbouring word continues it with period q.
    """
    n, size = len(words), 16
    if least_periods < 3 or least_words < 24:
        raise ValueError("Runs of fewer than 24 words or three periods are not found")
    if n < least_words:
        return []
    context = _context(words, size)
    order = np.argsort(context, kind="stable")
    ranked = context[order]
    again = ranked[1:] == ranked[:-1]
    if not again.any():
        return []
    group = np.zeros(len(order), np.int64)
    group[order[1:]] = np.cumsum(~again)
    occurrences = group[order] * n + order  # ascending: by context, then by place
    repeated = np.sort(order[1:][again])  # places with an earlier occurrence

    known: list[Run] = []
    squares = _Squares(words)
    scale = 1
    while scale * least_periods <= n:
        places = repeated if scale < size else repeated[(repeated + size - 1) % scale == 0]
        if len(places):
            key = group[places] * n + places
            low = np.searchsorted(occurrences, np.maximum(key - 2 * scale + 1, group[places] * n))
            count = np.searchsorted(occurrences, np.maximum(key - scale, group[places] * n - 1), "right") - low
            count = np.maximum(count, 0)
            i = np.repeat(places, count)
            nth = np.arange(len(i)) - np.repeat(np.cumsum(count) - count, count)
            q = i - occurrences[np.repeat(low, count) + nth] % n
            i = i + size - 1
            keep = np.flatnonzero(squares.touch(i, q)) if scale >= size else np.arange(len(i))
            i, q = i[keep], q[keep]
            keep = (q * least_periods <= n) & ~_multiples([r for r in known if r[1] >= scale], i, q)
            ends: dict[int, int] = {}  # open diagonals: lag, first word after its matches
            new = []
            for at, lag in zip(i[keep].tolist(), q[keep].tolist()):
                if ends.get(lag, 0) > at:
                    continue
                back, on = _agree(words, at, lag, -1), _agree(words, at, lag, 1)
                ends[lag] = at + max(on, 1)
                run = (at - back - lag + 1, back + on - 1 + lag, lag)
                if on and run[1] >= max(least_words, least_periods * lag) and _is_smallest(words, run):
                    new.append(run)
            known += new
        scale *= 2
    return sorted(known, key=lambda r: (r[0], r[2]))


def kept(n: int, runs: list[Run]) -> np.ndarray:
    """Whether each word stays when of every run only its first period does."""
    edges = np.zeros(n + 1, np.int64)
    for start, length, q in runs:
        edges[start + q] += 1
        edges[start + length] -= 1
    return np.cumsum(edges[:n]) == 0


_SCHEMA = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
_RUN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def periodic_runs(docs: DataFrame, alter: Alter | None = None, least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS) -> DataFrame:
    """doc_id, n_words, runs (by start, then period) and collapsed text of every document.

    Words are `[^\\x20\\x09-\\x0D]+` of the whole text, numbered from 0. `collapsed` joins by one
    blank the words that no run holds after its first period. `alter(doc_id, words)` may replace
    the words first; it isn't called for a null id. One pass without a shuffle: a document is
    worked on alone, in memory of about its words and in about n log n steps.

    Null and empty texts have no words, no runs and an empty collapsed text. Every row gives one
    row, repeated and null ids included; further columns of `docs` are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = (text.as_py() or "").encode().split()  # bytes split at x09-x0D and x20 only
                if alter and doc_id is not None:
                    words = alter(doc_id, words)
                numbers: dict[bytes, int] = {}
                found = runs_of(np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64), least_words, least_periods)
                n = len(words)
                if found:
                    words = [w for w, stays in zip(words, kept(n, found).tolist()) if stays]
                out.append((n, [dict(zip(("start", "length", "period"), r)) for r in found], b" ".join(words).decode()))
            columns = [batch.column(0), pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], _RUN), pa.array([r[2] for r in out], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "runs", "collapsed"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, _SCHEMA)
