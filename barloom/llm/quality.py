"""Operator 4: quality classifier, histogram gradient-boosted trees over document statistics.

Statistics are computed for every whole text, vectorised over many documents. The trees are
fitted on a bounded sample of labelled rows (`MAX_TRAINING_ROWS`) and flattened into arrays of
complete binary trees, which scoring walks for all rows and trees at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.words import flat, slices, word_bounds, word_hashes

#: Labelled rows that a model is fitted on at most; beyond it, those of the smallest hashed ids.
MAX_TRAINING_ROWS = 40_000

TREES, DEPTH, BINS, RATE, L2, LEAF = 80, 4, 64, 0.15, 1.0, 5.0

_SYMBOLS = b"#*$%&!|<>{}=@_~^+/\\"
_MARKS = b".,;:?"

FEATURES = (
    ["log_bytes", "log_words", "log_lines", "bytes_a_word", "words_a_line", "upper", "digits", "high", "symbols", "marks", "short_words", "long_words"]
    + ["symbol_words", "upper_words", "distinct_words", "top_word", "equal_neighbours", "distinct_pairs", "distinct_lines"]
    + [f"byte_{b:02x}" for b in b"#*$%&!|.,"]
)


def _classes() -> dict[str, np.ndarray]:
    out = {name: np.zeros(256, np.float64) for name in ("upper", "digits", "high", "symbols", "marks", "line")}
    out["upper"][65:91] = out["digits"][48:58] = out["high"][128:] = out["line"][10] = 1
    out["symbols"][list(_SYMBOLS)] = out["marks"][list(_MARKS)] = 1
    return out


_CLASS = _classes()


def statistics(column) -> np.ndarray:
    """One row of `FEATURES` for each text; null counts as empty, whose shares are all 0."""
    data, offsets = flat(column)
    n = len(offsets) - 1
    starts, ends, before = word_bounds(data, offsets)
    hashes = word_hashes(data, starts, ends)

    def total(values: np.ndarray, at: np.ndarray) -> np.ndarray:
        return np.diff(np.r_[0.0, np.cumsum(values, dtype=np.float64)][at])

    size, words = np.diff(offsets).astype(float), np.diff(before).astype(float)
    each, of_word = np.maximum(size, 1), np.maximum(words, 1)
    lines = total(_CLASS["line"][data], offsets) + 1
    lengths = (ends - starts).astype(float)
    upper = np.r_[0.0, np.cumsum(_CLASS["upper"][data])]
    out = {
        "log_bytes": np.log1p(size),
        "log_words": np.log1p(words),
        "log_lines": np.log1p(lines),
        "bytes_a_word": size / of_word,
        "words_a_line": words / lines,
        "short_words": total(lengths <= 2, before) / of_word,
        "long_words": total(lengths >= 15, before) / of_word,
        "symbol_words": total(_CLASS["symbols"][data[ends - 1]], before) / of_word if len(ends) else words,
        "upper_words": total((upper[ends] - upper[starts]) * 2 > lengths, before) / of_word,
    }
    for name in ("upper", "digits", "high", "symbols", "marks"):
        out[name] = total(_CLASS[name][data], offsets) / each
    for b in b"#*$%&!|.,":
        out[f"byte_{b:02x}"] = total(data == b, offsets) / each
    same = np.r_[hashes[1:] == hashes[:-1], False] if len(hashes) else np.zeros(0, bool)
    last = before[1:][np.diff(before) > 0] - 1
    same[last] = False
    out["equal_neighbours"] = total(same, before) / of_word
    pairs = hashes + np.roll(hashes, -1) * np.uint64(0x9E3779B97F4A7C15)
    feeds = np.flatnonzero(data == 10)
    bounds = np.searchsorted(feeds, offsets)
    distinct, top, two, rows = (np.zeros(n) for _ in range(4))
    for i in range(n):
        own = hashes[before[i] : before[i + 1]]
        if len(own):
            counts = np.unique(own, return_counts=True)[1]
            distinct[i], top[i] = len(counts) / len(own), counts.max() / len(own)
            two[i] = len(np.unique(pairs[before[i] : before[i + 1] - 1])) / (len(own) - 1) if len(own) > 1 else 1
        cuts = np.searchsorted(starts, np.r_[offsets[i], feeds[bounds[i] : bounds[i + 1]], offsets[i + 1]])
        filled = np.diff(cuts) > 0
        # A line's first word and its number of words stand for the line.
        keys = hashes[cuts[:-1][filled]] + np.diff(cuts)[filled].astype(np.uint64)
        rows[i] = len(np.unique(keys)) / len(keys) if len(keys) else 0
    out |= {"distinct_words": distinct, "top_word": top, "distinct_pairs": two, "distinct_lines": rows}
    return np.stack([out[name] for name in FEATURES], axis=1)


class Trees:
    """Boosted trees as flat arrays: node i of a tree has the children 2i + 1 and 2i + 2."""

    def __init__(self, feature: np.ndarray, threshold: np.ndarray, value: np.ndarray, bias: float):
        self.feature, self.threshold, self.value, self.bias = feature, threshold, value, bias

    def score(self, x: np.ndarray) -> np.ndarray:
        out = np.empty(len(x))
        trees = np.arange(len(self.feature))[None, :]
        for at in range(0, len(x), 2048):
            part = x[at : at + 2048]
            node = np.zeros((len(part), len(self.feature)), np.int64)
            rows = np.arange(len(part))[:, None]
            for _ in range(DEPTH):
                node = 2 * node + 1 + (part[rows, self.feature[trees, node]] > self.threshold[trees, node])
            total = self.value[trees, node].sum(1) + self.bias
            out[at : at + 2048] = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
        return out


def fit(x: np.ndarray, y: np.ndarray) -> Trees:
    """Logistic boosting on binned statistics. Without rows of both classes, a constant score."""
    inner = 2**DEPTH - 1
    feature = np.zeros((TREES, 2 * inner + 1), np.int64)
    threshold = np.full((TREES, 2 * inner + 1), np.inf)
    value = np.zeros((TREES, 2 * inner + 1))
    share = (y.sum() + 0.5) / (len(y) + 1)
    bias = float(np.log(share / (1 - share)))
    if not len(y) or y.min() == y.max():
        return Trees(feature[:1], threshold[:1], value[:1], bias)
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, j]) for j, e in enumerate(edges)], axis=1)
    margin = np.full(len(y), bias)
    for t in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = p - y, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        for depth in range(DEPTH):
            first, count = 2**depth - 1, 2**depth
            best = np.full(count, 1e-9)
            local = node - first
            for j, e in enumerate(edges):
                if not len(e):
                    continue
                cell = local * BINS + binned[:, j]
                g = np.bincount(cell, grad, count * BINS).reshape(count, BINS)
                h = np.bincount(cell, hess, count * BINS).reshape(count, BINS)
                gl, hl = g.cumsum(1), h.cumsum(1)
                ga, ha = gl[:, -1:], hl[:, -1:]
                gr, hr = ga - gl, ha - hl
                gain = gl**2 / (hl + L2) + gr**2 / (hr + L2) - ga**2 / (ha + L2)
                gain[(hl < LEAF / 4) | (hr < LEAF / 4)] = 0
                gain = gain[:, : len(e)]
                at = gain.argmax(1)
                top = gain[np.arange(count), at]
                for k in np.flatnonzero(top > best):
                    best[k] = top[k]
                    feature[t, first + k], threshold[t, first + k] = j, e[at[k]]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[t, node]] > threshold[t, node])
        g = np.bincount(node, grad, 2 * inner + 1)
        h = np.bincount(node, hess, 2 * inner + 1)
        value[t] = -RATE * g / (h + L2)
        margin += value[t, node]
    return Trees(feature, threshold, value, bias)


def held_out(doc_id: str):
    """Whether crc32 of the id as text leaves 1 modulo 3; a null id is held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(True))


def document_statistics(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, stats array<double>) for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                x = statistics(part.column(1))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(list(x), pa.list_(pa.float64()))], names=["doc_id", "stats"])

    return docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text")).mapInArrow(run, "doc_id long, stats array<double>")


def train(stats: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAINING_ROWS) -> Trees:
    """Trees fitted on the labelled rows that are not held out.

    An id with several labels counts once, with their majority (a tie is good); null labels
    and ids are left out. At most `max_rows` rows reach the driver.
    """
    marked = labels.where(~held_out("doc_id") & F.col("quality").isNotNull()).groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("y"))
    rows = stats.join(marked, "doc_id").select("stats", "y", F.xxhash64("doc_id").alias("h"), "doc_id")
    sample = rows.orderBy("h", "doc_id").limit(max_rows).select("stats", "y").toArrow()
    x = np.array(sample.column(0).combine_chunks().flatten()).reshape(-1, len(FEATURES)) if len(sample) else np.zeros((0, len(FEATURES)))
    return fit(x, np.array(sample.column(1), dtype=float))


def score(stats: DataFrame, model: Trees) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of `stats`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column(1).flatten()).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(x))], names=["doc_id", "score"])

    scored = stats.mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: Trees, text_column: str = "text") -> DataFrame:
    """The rows of `docs` with a score of 0.5 or more, with all their columns."""
    at = docs.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_column):
                yield part.filter(pa.array(model.score(statistics(part.column(at))) >= 0.5))

    return docs.mapInArrow(run, docs.schema)
