"""Operator 10: line deduplication by chunks of lines.

A text is its lines between line feeds; lines without words don't count. A rolling hash over the
hashes of two successive lines names the chunk that opens at the first of them, so the same lines
give the same chunks wherever they stand. A line of `LONG_WORDS` words or more fills several
lines of a page and is a chunk of its own. Chunks whose bytes occurred before, in the order of
doc_id and position, lose their lines.

Every line opens a chunk. Boundaries that a hash picks sparsely depend on the foreign lines around
a passage, and passages of a few lines fell between them; overlapping chunks reach a repeated
passage's first and last line without looking at its neighbours.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.store import Store
from barloom.llm.words import flat, mix, slices, word_bounds, word_hashes

LONG_WORDS = 20


class Lines:
    """Lines of a column of texts; those with words are numbered through all texts.

    A chunk's place is twice the number of its first line in its text, plus one if it has two lines.
    """

    def __init__(self, column):
        self.data, offsets = flat(column)
        self.texts = len(offsets) - 1
        feeds = np.flatnonzero(self.data == 10)
        # Every text has one line more than line feeds; the feed ends its line.
        of_text = np.diff(np.searchsorted(feeds, offsets)) + 1
        ends = np.sort(np.concatenate([feeds + 1, offsets[1:]]), kind="stable")
        text = np.repeat(np.arange(self.texts), of_text)
        last = np.zeros(len(ends), bool)
        last[np.cumsum(of_text) - 1] = True
        self.all_start = np.concatenate([np.zeros(1, ends.dtype), ends])[: len(ends)]
        self.all_stop = ends - ~last
        self.all_first = np.concatenate([np.zeros(1, np.int64), np.cumsum(of_text)])
        words = word_bounds(self.data, offsets)[0]
        count = np.searchsorted(words, self.all_stop) - np.searchsorted(words, self.all_start)
        filled = count > 0
        #: The last line with words up to each line.
        self.owner = np.cumsum(filled) - 1
        self.text, self.start, self.stop = text[filled], self.all_start[filled], self.all_stop[filled]
        self.first = np.searchsorted(self.text, np.arange(self.texts + 1))
        self.hash = word_hashes(self.data, self.start, self.stop)
        long = count[filled] >= LONG_WORDS
        self.single = np.flatnonzero(long)
        self.double = np.flatnonzero((self.text[1:] == self.text[:-1]) & ~(long[1:] & long[:-1]))

    def keys(self, line: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two hashes of the chunks that open at `line`, of one line or of two."""
        second = self.hash[np.minimum(line + two, len(self.hash) - 1)]
        rolled = [mix(self.hash[line], s) * np.uint64(3) + np.where(two, mix(second, s + 1), np.uint64(0)) for s in (21, 23)]
        return mix(rolled[0], 25).view(np.int64), mix(rolled[1], 26).view(np.int64)

    def bytes(self, line: int, two: bool) -> bytes:
        return b"\n".join(self.data[self.start[i] : self.stop[i]].tobytes() for i in range(line, line + 1 + two))

    def without(self, text: int, places: list[int]) -> bytes:
        """A text without the lines of the chunks at `places` and the blank lines after each of them."""
        place = np.asarray(places, np.int64)
        gone = np.zeros(len(self.text) + 1, bool)  # the last one stands for no line
        line = self.first[text] + (place >> 1)
        gone[line] = True
        gone[line + (place & 1)] = True
        rows = np.arange(self.all_first[text], self.all_first[text + 1])
        owner = self.owner[rows]
        kept = rows[~gone[np.where(owner < self.first[text], len(self.text), owner)]]
        return b"\n".join(self.data[self.all_start[i] : self.all_stop[i]].tobytes() for i in kept)


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            c = Lines(part.column(2))
            line = np.concatenate([c.single, c.double])
            two = np.arange(len(line)) >= len(c.single)
            h1, h2 = c.keys(line, two)
            rows = c.text[line]
            place = 2 * (line - c.first[rows]) + two
            rows = pa.array(rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(h1), pa.array(h2), part.column(0).take(rows), part.column(1).take(rows), pa.array(place)],
                names=["h1", "h2", "id", "row", "pos"],
            )


def _repeated_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h1, h2, bytes) of the chunks at the listed places, each text once a slice."""
    for batch in batches:
        for part in slices(batch, "text"):
            c = Lines(part.column(0))
            lists = part.column(1).to_pylist()
            place = np.array([p for places in lists for p in places], np.int64)
            line = np.repeat(c.first[:-1], [len(places) for places in lists]) + (place >> 1)
            two = (place & 1).astype(bool)
            h1, h2 = c.keys(line, two)
            out = {(a, b, c.bytes(i, t)): None for a, b, i, t in zip(h1.tolist(), h2.tolist(), line.tolist(), two.tolist())}
            columns = list(zip(*out)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.binary())], names=["h1", "h2", "bytes"])


def _without(text: int, schema: pa.Schema):
    """Rewrites texts without the chunks at the places in the last column; other columns pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, f"c{text}"):
                column, lists = part.column(text), part.column(len(schema)).to_pylist()
                touched = [i for i, places in enumerate(lists) if places]
                if touched:
                    c = Lines(column.take(pa.array(touched)))
                    values = column.to_pylist()
                    for j, i in enumerate(touched):
                        values[i] = c.without(j, lists[i]).decode("utf-8", "replace")
                    column = pa.array(values, schema.field(text).type)
                yield pa.RecordBatch.from_arrays([column if i == text else part.column(i) for i in range(len(schema))], schema=schema)

    return run


def line_dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """`docs` without the lines of later copies of repeated chunks; all rows stay.

    The copy of the smallest (doc_id, position) stays; a null id comes last. So the first occurrence
    of any line stays. Blank lines go with the line before them. Rows of equal id and text count
    as one document and come back alike. Null and empty texts pass; a text whose lines all go
    becomes empty. Further columns, whatever their names, pass unchanged.
    """
    spark = docs.sparkSession
    store = Store(spark, "line_dedup")
    at = docs.columns.index(text_column)
    # Columns by number: no name of the user's meets one of the operator's.
    plain = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    text = F.col(f"c{at}")
    keyed = plain.withColumns({"id": F.coalesce(F.col(f"c{docs.columns.index(id_column)}").cast("long"), F.lit(2**63 - 1)), "row": F.xxhash64(text)})
    found = store.put("found", keyed.select("id", "row", text.alias("text")).mapInArrow(_found, "h1 long, h2 long, id long, row long, pos long").distinct())
    place = F.struct("id", "row", "pos")
    groups = found.groupBy("h1", "h2").agg(F.count("*").alias("copies"), F.min(place).alias("kept")).where("copies > 1")
    groups = store.put("groups", groups.select("h1", "h2", "kept"))
    repeated = store.put("repeated", found.join(groups, ["h1", "h2"]).select("h1", "h2", "id", "row", "pos", (place != F.col("kept")).alias("later")))

    def with_places(name: str, places: DataFrame) -> DataFrame:
        """Rows with the sorted places `later` (later copies) and `all` of their repeated chunks."""
        lists = places.groupBy("id", "row").agg(
            F.sort_array(F.collect_list("pos")).alias("all"), F.sort_array(F.collect_list(F.when(F.col("later"), F.col("pos")))).alias("later")
        )
        return store.put(name, keyed.join(lists, ["id", "row"], "left").select(*plain.columns, "later", "all"))

    marked = with_places("marked", repeated)
    texts = marked.where("`all` IS NOT NULL").select(text.alias("text"), "all").mapInArrow(_repeated_texts, "h1 long, h2 long, bytes binary")
    # Equal hashes of different bytes: such groups keep all their copies.
    different = store.put("different", texts.distinct().groupBy("h1", "h2").count().where("count > 1").select("h1", "h2"))
    if not different.isEmpty():
        marked = with_places("again", repeated.join(different, ["h1", "h2"], "left_anti"))
    arrow = pa.schema([(f.name, t) for f, t in zip(docs.schema.fields, _arrow_types(docs))])
    return marked.select(*plain.columns, "later").mapInArrow(_without(at, arrow), docs.schema)


def _arrow_types(frame: DataFrame) -> list[pa.DataType]:
    from pyspark.sql.pandas.types import to_arrow_type

    return [to_arrow_type(f.dataType) for f in frame.schema.fields]
