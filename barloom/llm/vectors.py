"""Vectors of an embeddings table as binary doubles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Whether a vector is not null, not zero and has finite components only."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(good & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrix(blobs: pa.Array) -> np.ndarray:
    """Rows of a binary column of doubles; all have one length."""
    if not len(blobs):
        return np.zeros((0, 0))
    return np.frombuffer(b"".join(blobs.to_pylist()), np.float64).reshape(len(blobs), -1)


def as_doubles(embeddings: DataFrame, id_column: str, vector_column: str, unit: bool) -> DataFrame:
    """(vec_id, vector) of the usable rows, as bytes of doubles; of length 1 if `unit`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for v in batch.column(1):
                x = np.asarray(v.values, dtype=np.float64)
                if unit:
                    x = x / np.abs(x).max()
                    x = x / np.sqrt((x * x).sum())
                rows.append(x.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], names=["vec_id", "vector"])

    rows = embeddings.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("v"))
    return rows.where(F.col("vec_id").isNotNull() & usable(F.col("v"))).dropDuplicates(["vec_id"]).mapInArrow(run, "vec_id long, vector binary")
