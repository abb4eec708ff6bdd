"""Operator 5: token counts of the documents in flat, unindexed token files.

A file is nothing but fixed-width ids, an end-of-document id after each document. Blocks are
searched for that id at once; a block reports the whole documents inside it, the ids before its
first and after its last separator. A prefix scan over a file's blocks stitches what spans them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barloom.llm.tokens import Encoder, piece_bpe
from barloom.llm.words import slices

#: The separator of the written files, and the ids' type.
SEPARATOR, ID_TYPE = 2, "<u2"

#: Ids of one block of the scan.
BLOCK = 1 << 18

#: A written record has about this many ids, a file so many records.
RECORD, RECORDS = 1 << 21, 8


def write_token_files(docs: DataFrame, path: str, model_path: str, text_column: str = "text") -> None:
    """Flat files of 16-bit ids under `path`, id 2 after each document.

    Every word is encoded for itself by a sentencepiece model, which makes id 2 of no text. The
    text sink writes raw bytes and the separator's two bytes as line end: nothing else is in the
    files. Null and empty texts leave a separator alone. Files hold a bounded number of records.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(piece_bpe(model_path))
        held: list[np.ndarray] = []
        size = 0

        def record() -> pa.RecordBatch:
            # The sink adds the last separator.
            return pa.RecordBatch.from_arrays([pa.array([np.concatenate(held)[:-1].tobytes()], pa.binary())], names=["value"])

        for batch in batches:
            for part in slices(batch, "text"):
                ids, ends, _, _ = encoder(part.column(0))
                held.append(np.insert(ids, ends[1:], SEPARATOR).astype(ID_TYPE))
                size += len(held[-1])
                if size >= RECORD:
                    yield record()
                    held, size = [], 0
        if held:
            yield record()

    raw = docs.select(F.col(text_column).alias("text")).mapInArrow(run, "value binary")
    raw.select(F.col("value").cast("string")).write.mode("overwrite").option("lineSep", "\u0002\u0000").option("maxRecordsPerFile", RECORDS).text(path)


def count_tokens(spark: SparkSession, path: str, separator: int = SEPARATOR, id_type: str = ID_TYPE, block: int = BLOCK) -> DataFrame:
    """(file, document, start, n_tokens) of every document in the flat files under `path`.

    `document` counts from 0 in its file, `start` is its first id's place there, `n_tokens` leaves
    the separator out. Ids after a file's last separator are a document too; an empty file has
    none. A file may have up to 2 GB, what one row can hold. Bytes past the last whole id raise.
    """
    width = np.dtype(id_type).itemsize

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1)):
                raw = content.as_buffer()
                if raw is None or raw.size == 0:
                    continue
                if raw.size % width:
                    raise ValueError(f"{name}: {raw.size} bytes are no whole number of ids")
                ids = np.frombuffer(raw, id_type)
                for k, at in enumerate(range(0, len(ids), block)):
                    part = ids[at : at + block]
                    ends = np.flatnonzero(part == separator)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([name.as_py()]),
                            pa.array([k], pa.int64()),
                            pa.array([at], pa.int64()),
                            pa.array([len(part)], pa.int64()),
                            pa.array([at + len(part) == len(ids)]),
                            pa.array([ends], pa.list_(pa.int64())),
                        ],
                        names=["file", "block", "at", "n", "final", "ends"],
                    )

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")
    blocks = files.mapInArrow(search, "file string, block long, at long, n long, final boolean, ends array<long>")
    # Before each block: how many documents have ended, and where the open one began.
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    last_end = F.when(F.size("ends") > 0, F.col("at") + F.element_at("ends", -1) + 1)
    scanned = blocks.select(
        "file",
        "at",
        F.coalesce(F.sum(F.size("ends")).over(earlier), F.lit(0)).alias("done"),
        F.coalesce(F.max(last_end).over(earlier), F.lit(0)).alias("open"),
        F.when(F.col("final") & (F.coalesce(F.element_at("ends", F.when(F.size("ends") > 0, -1)), F.lit(-1)) != F.col("n") - 1), F.concat("ends", F.array("n")))
        .otherwise(F.col("ends"))
        .alias("ends"),
    )
    each = scanned.select(
        "file",
        "done",
        "open",
        F.posexplode(F.transform("ends", lambda e, i: F.struct(F.when(i > 0, F.col("at") + F.element_at("ends", i) + 1).alias("begin"), (F.col("at") + e).alias("end")))).alias("i", "d"),
    )
    start = F.coalesce("d.begin", "open")
    return each.select("file", (F.col("done") + F.col("i")).alias("document"), start.alias("start"), (F.col("d.end") - start).alias("n_tokens"))
