"""Operator 7: packing documents into token sequences by lexical retrieval.

Every task packs its rows in shards of bounded text. A shard has a BM25 inverted index over its
words; a seed document opens a window, and the unused documents that score best against the
seed fill it. A document is cut where a window is full and goes on in the next one, as its
seed. The window left open at the end of a task is cut into powers of two, so nothing is padded.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.tokens import Encoder, word_bpe
from barloom.llm.words import slices

SEQUENCE = 4096
SEPARATOR = 2

#: Text of one shard of the index.
SHARD_BYTES = 3 << 20

#: BM25's two parameters.
K1, B = 1.2, 0.75

_PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


class Index:
    """A BM25 inverted index of one shard: postings sorted by word, weights ready to add."""

    def __init__(self, word: np.ndarray, before: np.ndarray):
        docs = len(before) - 1
        lengths = np.diff(before)
        doc = np.repeat(np.arange(docs), lengths)
        pair, tf = np.unique(word.astype(np.int64) * max(docs, 1) + doc, return_counts=True)
        word_of, self.doc = np.divmod(pair, max(docs, 1))
        words = int(word.max()) + 1 if len(word) else 0
        df = np.bincount(word_of, minlength=words)
        self.first = np.r_[0, np.cumsum(df)]
        idf = np.log1p((docs - df + 0.5) / (df + 0.5))
        norm = K1 * (1 - B + B * lengths / max(1.0, lengths.mean() if docs else 1.0))
        self.weight = idf[word_of] * tf * (K1 + 1) / (tf + norm[self.doc])
        # A document's words that another document has too.
        useful = np.flatnonzero(df[word_of] > 1)
        order = useful[np.argsort(self.doc[useful], kind="stable")]
        self.words = word_of[order]
        self.own = np.searchsorted(self.doc[order], np.arange(docs + 1))
        self.docs = docs

    def neighbours(self, doc: int, used: np.ndarray) -> np.ndarray:
        """Unused documents that share a word with `doc`, best first, looked up by all its words."""
        words = self.words[self.own[doc] : self.own[doc + 1]]
        n = self.first[words + 1] - self.first[words]
        at = np.arange(n.sum()) + np.repeat(self.first[words] - np.cumsum(n) + n, n)
        total = np.bincount(self.doc[at], self.weight[at], self.docs)
        total[used] = 0
        found = np.flatnonzero(total)
        return found[np.argsort(-total[found], kind="stable")]


def order_of(index: Index, sizes: np.ndarray, room: int) -> Iterator[int]:
    """Documents of a shard in packing order, where the open window has `room` ids left."""
    used = np.zeros(index.docs, bool)
    unseen = 0
    seed = None
    queue: deque[int] = deque()
    while True:
        if seed is None or not queue:
            while unseen < index.docs and used[unseen]:
                unseen += 1
            if unseen == index.docs:
                return
            doc = unseen
        else:
            doc = queue.popleft()
        used[doc] = True
        yield doc
        over = int(sizes[doc]) - room
        room = -over if over < 0 else SEQUENCE - over % SEQUENCE
        if seed is None or not queue or over >= 0:
            # It begins or continues a window: what follows is sought by it.
            seed, queue = doc, deque(index.neighbours(doc, used).tolist())


class Windows:
    """Cuts documents, in the order they come, into pieces of successive windows."""

    def __init__(self, first_sequence: int):
        self.sequence, self.at = first_sequence, 0
        self.open: list[list] = []

    def add(self, doc_id, ids: np.ndarray) -> Iterator[list]:
        start = 0
        while start < len(ids):
            n = min(SEQUENCE - self.at, len(ids) - start)
            self.open.append([doc_id, start, n, ids[start : start + n].tobytes(), len(ids), self.sequence, self.at])
            start, self.at = start + n, self.at + n
            if self.at == SEQUENCE:
                yield from self.open
                self.open, self.at, self.sequence = [], 0, self.sequence + 1

    def close(self) -> Iterator[list]:
        """The open window as sequences of a power of two of ids each, largest first."""
        left, at = self.at, 0
        pieces = self.open
        while left:
            size = 1 << (left.bit_length() - 1)
            filled = 0
            while filled < size:
                doc_id, start, n, ids, total, _, _ = pieces[0]
                m = min(n, size - filled)
                yield [doc_id, start, m, ids[: 4 * m], total, self.sequence, filled]
                filled += m
                pieces = pieces[1:] if m == n else [[doc_id, start + m, n - m, ids[4 * m :], total, 0, 0], *pieces[1:]]
            left -= size
            self.sequence += 1


def pack(docs: DataFrame, tokenizer_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Pieces (doc_id, start, length, ids, doc_tokens, sequence_id, offset) of all documents.

    A document is the ids of its text and then id 2; `ids` are a piece's as little-endian 32-bit
    numbers. Each id lies in one piece, pieces of a sequence have gapless offsets, a sequence
    holds 4096 ids or, at the end of a task, a smaller power of two. Null texts count as empty
    and give id 2 alone; every row counts, repeated ones too, with null ids as they are; an
    empty table gives no piece. Further columns are ignored.
    """

    def rows(pieces: list[list]) -> pa.RecordBatch:
        columns = list(zip(*pieces))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(word_bpe(tokenizer_path), folds=True)
        windows = Windows(TaskContext.get().partitionId() << 40)
        for batch in batches:
            for part in slices(batch, "text", SHARD_BYTES):
                ids, ends, word, before = encoder(part.column(1))
                sizes = np.diff(ends) + 1
                names = part.column(0).to_pylist()
                out: list[list] = []
                for i in order_of(Index(word, before), sizes, SEQUENCE - windows.at):
                    own = np.empty(sizes[i], "<u4")
                    own[:-1], own[-1] = ids[ends[i] : ends[i + 1]], SEPARATOR
                    out += windows.add(names[i], own)
                if out:
                    yield rows(out)
        if out := list(windows.close()):
            yield rows(out)

    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")).mapInArrow(run, _PIECES)
