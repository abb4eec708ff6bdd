"""The consumer layout as a Spark sink: one Parquet file per symbol and timeframe, put in place by tasks."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from barloom.sources.streams import located

ROWS_PER_GROUP = 1 << 20


@dataclass
class Placed(WriterCommitMessage):
    files: int
    rows: int


class OpenFile:
    """A Parquet file under a hidden name next to its own, moved there once it is whole."""

    def __init__(self, path: str, schema: pa.Schema, compression: str) -> None:
        self.system, self.name = located(path)
        folder, _, last = self.name.rpartition("/")
        self.system.create_dir(folder, recursive=True)
        self.hidden = f"{folder}/_{uuid.uuid4().hex}-{last}"
        self.stream = self.system.open_output_stream(self.hidden)
        self.writer = pq.ParquetWriter(self.stream, schema, compression=compression)
        self.waiting: list[pa.RecordBatch] = []
        self.rows = 0

    def add(self, batch: pa.RecordBatch) -> None:
        self.waiting.append(batch)
        if sum(b.num_rows for b in self.waiting) >= ROWS_PER_GROUP:
            self.flush()

    def flush(self) -> None:
        if self.waiting:
            self.writer.write_table(pa.Table.from_batches(self.waiting), row_group_size=ROWS_PER_GROUP)
            self.rows += sum(b.num_rows for b in self.waiting)
            self.waiting = []

    def place(self) -> int:
        self.flush()
        self.writer.close()
        self.stream.close()
        self.system.move(self.hidden, self.name)
        return self.rows

    def drop(self) -> None:
        self.writer.close()
        self.stream.close()
        self.system.delete_file(self.hidden)


class FlatWriter(DataSourceArrowWriter):
    """Writes each run of rows with equal `file` (first column, a path below the target) as that file.

    A file is replaced in one step, so readers see the old one or the new one. Two attempts of a
    task write under names of their own, and the later one replaces the earlier with the same rows.
    """

    def __init__(self, path: str, compression: str) -> None:
        self.path, self.compression = path.rstrip("/"), compression

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Placed:
        current, out, done = None, None, Placed(0, 0)
        try:
            for batch in iterator:
                rows = batch.select(batch.schema.names[1:])
                runs = pc.run_end_encode(batch.column(0))
                start = 0
                for name, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist()):
                    if name != current:
                        if out:
                            done = Placed(done.files + 1, done.rows + out.place())
                        out, current = OpenFile(f"{self.path}/{name}", rows.schema, self.compression), name
                    out.add(rows.slice(start, end - start))
                    start = end
            if out:
                done = Placed(done.files + 1, done.rows + out.place())
            return done
        except BaseException:
            if out:
                out.drop()
            raise

    def commit(self, messages: list[Placed | None]) -> None:
        """Every file is in place already."""

    def abort(self, messages: list[Placed | None]) -> None:
        """Files in place stay, each whole; failed tasks have dropped their hidden ones."""


class FlatFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "barloom_flat"

    def writer(self, schema, overwrite: bool) -> FlatWriter:
        return FlatWriter(self.options["path"], self.options["compression"])
