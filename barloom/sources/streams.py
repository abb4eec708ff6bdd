"""Files as seekable streams inside tasks.

Rows carry paths, never contents: a task opens the file that its row names, through the
file system of the path's scheme, and reads it in blocks. A file may be of any size.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame

BLOCK = 8 << 20
#: A header longer than this is none.
HEADER_LIMIT = 1 << 20


def located(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and name of a path as Spark lists it (not URI-encoded)."""
    scheme, sign, rest = path.partition(":")
    if not sign or "/" in scheme or not rest.startswith("/"):
        return pafs.LocalFileSystem(), path
    if scheme == "file":
        return pafs.LocalFileSystem(), "/" + rest.lstrip("/")
    authority, _, name = rest.lstrip("/").partition("/")
    system, root = pafs.FileSystem.from_uri(f"{'s3' if scheme in ('s3a', 's3n') else scheme}://{authority}/")
    return system, f"{root.rstrip('/')}/{name}"


def opened(path: str) -> pa.NativeFile:
    system, name = located(path)
    return system.open_input_file(name)


def sha256_of(stream: pa.NativeFile, prefix: bytes = b"") -> str:
    """Hex digest of `prefix` and the whole stream, a block at a time."""
    found = hashlib.sha256(prefix)
    stream.seek(0)
    while block := stream.read(BLOCK):
        found.update(block)
    return found.hexdigest()


def first_line(stream: Any) -> bytes:
    """The bytes before the first line end outside quotes, or all of them; leaves the rest unread."""
    head, searched, quotes = b"", 0, 0
    while True:
        block = stream.read(1 << 16)
        head += block
        while (end := head.find(b"\n", searched)) >= 0:
            quotes += head.count(b'"', searched, end)
            if quotes % 2 == 0:
                return head[:end]
            searched = end + 1
        if not block:
            return head
        if len(head) > HEADER_LIMIT:
            raise ValueError(f"No line end in the first {HEADER_LIMIT} bytes")


def with_columns(files: DataFrame, look: Callable[[str], dict], schema: str) -> DataFrame:
    """`files` (path and more) with the columns of `schema` that `look(path)` gives, one call a file.

    Spark's listing deals files to tasks by their size, so tasks hold about equal bytes.
    """
    added = [part.split(" ")[0] for part in schema.split(", ")]
    kinds = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_()}
    types = [kinds[part.split(" ")[1]] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [look(path) for path in batch.column("path").to_pylist()]
            extra = [pa.array([row[name] for row in found], kind) for name, kind in zip(added, types)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], names=[*batch.schema.names, *added])

    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in files.schema)
    return files.mapInArrow(run, f"{own}, {schema}")


def put(path: str, content: bytes) -> None:
    """Write a file under another name and move it into place: readers see all of it or nothing."""
    system, name = located(path)
    folder, _, last = name.rpartition("/")
    system.create_dir(folder, recursive=True)
    hidden = f"{folder}/_{uuid.uuid4().hex}-{last}"
    with system.open_output_stream(hidden) as stream:
        stream.write(content)
    system.move(hidden, name)
