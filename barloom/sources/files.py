"""Source files as rows: discovery, fingerprints, archives, workbooks, headers."""

from __future__ import annotations

import csv
import re
import zipfile
from collections.abc import Iterator
from functools import cache, reduce
from itertools import islice
from xml.etree import ElementTree

import pyarrow as pa
import pyarrow.csv as pacsv
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.functions.names import HEADER_KEYWORDS, content_prefix, stat_fingerprint
from barloom.session import exists, hadoop_path
from barloom.sources.streams import first_line, opened, sha256_of, with_columns

# The first bytes of every ZIP file, workbooks included.
ZIP_MAGIC = bytes([0x50, 0x4B, 0x03, 0x04])
#: Rows of a workbook that are held at once.
SHEET_BATCH = 10_000
#: Named files of a task at most, where there are enough files for all cores.
TASK_FILES = 16


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, "[^/]*$", 0)


def list_files(spark: SparkSession, folder: str | None, glob: str, optional: bool = False) -> DataFrame:
    """path, name, length and modificationTime of the files in a folder; nothing is read."""
    if folder is None or not exists(spark, folder):
        if not optional:
            raise FileNotFoundError(f"Missing source folder: {folder}")
        files = spark.createDataFrame([], "path string, modificationTime timestamp, length long")
    else:
        files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)
    return files.select("path", file_name(F.col("path")).alias("name"), "length", "modificationTime")


def fingerprints(files: DataFrame, version: int, by: str = "content") -> DataFrame:
    """Files with `fingerprint`.

    `by="content"` hashes every byte, whatever the size: right whatever happens to
    modification times. `by="stat"` hashes size and time and opens no file.
    """
    if by not in ("content", "stat"):
        raise ValueError(f"Unknown fingerprint: {by}")
    if by == "stat":
        return files.withColumn("fingerprint", stat_fingerprint(F.lit(version), F.col("length"), F.col("modificationTime")))
    prefix = content_prefix(version)

    def look(path: str) -> dict:
        with opened(path) as stream:
            return {"fingerprint": sha256_of(stream, prefix)}

    return with_columns(files, look, "fingerprint string")


def full_path(spark: SparkSession, path: str) -> str:
    """A path as listings write it, with its scheme."""
    if ":" in path.partition("/")[0]:
        return path
    fs, named = hadoop_path(spark, path)
    return fs.makeQualified(named).toString()


def read_paths(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The named files as rows (path), dealt to tasks. They come from a listing, so none is listed again."""
    tasks = max(1, min(len(paths), max(4 * spark.sparkContext.defaultParallelism, -(-len(paths) // TASK_FILES))))
    named = pa.table({"path": pa.array([full_path(spark, p) for p in paths], pa.string()), "task": pa.array([i % tasks for i in range(len(paths))], pa.int32())})
    return spark.createDataFrame(named).repartitionById(tasks, "task").select("path")


def checksums(files: DataFrame) -> DataFrame:
    def look(path: str) -> dict:
        with opened(path) as stream:
            return {"sha256": sha256_of(stream)}

    return with_columns(files.select("path", "length"), look, "sha256 string")


def header_text(line: bytes) -> str:
    """A header line as text, byte-order mark and line end removed."""
    return line.decode("utf-8-sig", "replace").rstrip("\r\n")


def sniffed(files: DataFrame) -> DataFrame:
    """Files with `workbook` (a ZIP file, whatever its name) and, for text, its `header`.

    Only the head of a file is read.
    """

    def look(path: str) -> dict:
        with opened(path) as stream:
            if stream.read(len(ZIP_MAGIC)) == ZIP_MAGIC:
                return {"workbook": True, "header": None}
            stream.seek(0)
            return {"workbook": False, "header": header_text(first_line(stream))}

    return with_columns(files, look, "workbook boolean, header string")


def normalize(raw: str) -> str:
    """`functions.names.normalized_name` for one header text."""
    name = re.sub(r"\s+", "_", re.sub(r"[^0-9a-z_\s]", "", raw.strip().lower()).strip())
    return f"_{name}" if name in HEADER_KEYWORDS or name[:1].isdigit() else name


def normalize_header(line: str) -> list[str]:
    """Column names of a CSV header line, whose cells may be quoted and hold commas."""
    return [normalize(cell) for cell in next(csv.reader([line], skipinitialspace=True), [])]


def require(names: list[str], columns: list[str], path: str) -> None:
    """A source without a needed column is an error, not a column of NULLs."""
    missing = [c for c in columns if c not in names]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}; its header gives {', '.join(names)}")


def csv_members(archive: zipfile.ZipFile) -> list[zipfile.ZipInfo]:
    return [member for member in archive.infolist() if not member.is_dir()]


def read_archive(path: str, columns: list[str]) -> Iterator[pa.RecordBatch]:
    """The named columns (as text, empty cells NULL) of the one CSV in an archive, in batches.

    The archive is sought and the member decompressed as a stream: neither is held.
    """
    with opened(path) as source, zipfile.ZipFile(source) as archive:
        members = csv_members(archive)
        if len(members) != 1:
            raise ValueError(f"Expected one CSV member in {path}; found {len(members)}")
        with archive.open(members[0]) as stream:
            header = first_line(stream)
        names = normalize_header(header_text(header))
        require(names, columns, path)
        with archive.open(members[0]) as stream:
            stream.read(len(header) + 1)
            if not stream.peek(1):
                return
            reader = pacsv.open_csv(
                stream,
                read_options=pacsv.ReadOptions(column_names=names, block_size=8 << 20),
                convert_options=pacsv.ConvertOptions(
                    column_types={c: pa.string() for c in names},
                    include_columns=columns,
                    null_values=[""],
                    strings_can_be_null=True,
                ),
            )
            for batch in reader:
                texts = [batch.column(i).cast(pa.string()) for i in range(len(columns))]
                yield pa.RecordBatch.from_arrays([pa.array([path] * batch.num_rows, pa.string()), *texts], ["path", *columns])


def archive_rows(archives: DataFrame, columns: list[str]) -> DataFrame:
    """Archives (path) to (path, text columns) rows, decompressed as a stream."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch["path"].to_pylist():
                yield from read_archive(path, columns)

    schema = ", ".join(f"`{c}` string" for c in ["path", *columns])
    return archives.select("path").mapInArrow(unpack, schema)


def archive_members(archives: DataFrame) -> DataFrame:
    """path, number of file members, the first CSV member's header line."""

    def look(path: str) -> dict:
        with opened(path) as source, zipfile.ZipFile(source) as archive:
            members = csv_members(archive)
            named = [m for m in members if m.filename.lower().endswith(".csv")]
            header = None
            if named:
                with archive.open(named[0]) as stream:
                    header = header_text(first_line(stream))
            return {"members": len(members), "header": header}

    return with_columns(archives.select("path"), look, "members long, header string")


def derivatives_gate(archives: DataFrame) -> DataFrame:
    """Does a derivatives archive hold a CSV with a symbol and an open-price column?"""
    header = F.col("header")
    ok = header.rlike("(?i)TckrSymb|SYMBOL") & header.rlike("(?i)OpnPric|OPEN")
    return archive_members(archives).select(
        "path", header.isNotNull().alias("has_csv"), "header", F.coalesce(ok, F.lit(False)).alias("header_ok")
    )


SHEET = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
ROW, CELL, VALUE, TEXT = f"{SHEET}row", f"{SHEET}c", f"{SHEET}v", f"{SHEET}t"
RELATION = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


@cache
def column_number(letters: str) -> int:
    """`'AB'` -> 27."""
    number = 0
    for letter in letters:
        number = number * 26 + ord(letter) - ord("A") + 1
    return number - 1


def active_sheet(book: zipfile.ZipFile) -> str:
    """Member name of the sheet that was open when the workbook was saved."""
    root = ElementTree.fromstring(book.read("xl/workbook.xml"))
    view = root.find(f"{SHEET}bookViews/{SHEET}workbookView")
    index = int(view.get("activeTab", "0")) if view is not None else 0
    wanted = root.findall(f"{SHEET}sheets/{SHEET}sheet")[index].get(RELATION)
    links = ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
    target = next(link.get("Target") for link in links if link.get("Id") == wanted)
    return target.lstrip("/") if target.startswith("/") else f"xl/{target}"


def inline_text(cell: ElementTree.Element) -> str:
    """The text of a cell that holds it itself, most often in one element."""
    if len(cell) == 1 and len(cell[0]) == 1 and cell[0][0].tag == TEXT and not len(cell[0][0]):
        return cell[0][0].text or ""
    return "".join(t.text or "" for t in cell.iter(TEXT))


def sheet_rows(book: zipfile.ZipFile) -> Iterator[list[str | None]]:
    """Cell values (of formulas, their last result) of the active sheet, row by row."""
    shared: list[str] = []
    if "xl/sharedStrings.xml" in book.namelist():
        strings = ElementTree.fromstring(book.read("xl/sharedStrings.xml"))
        shared = ["".join(t.text or "" for t in item.iter(TEXT)) for item in strings]
    with book.open(active_sheet(book)) as stream:
        for _, row in ElementTree.iterparse(stream):
            if row.tag != ROW:
                continue
            cells: list[str | None] = []
            for cell in row:
                if cell.tag != CELL:
                    continue
                reference, kind = cell.get("r"), cell.get("t")
                if reference:
                    position = column_number(reference.rstrip("0123456789"))
                    if position > len(cells):
                        cells += [None] * (position - len(cells))
                if kind == "inlineStr":
                    cells.append(inline_text(cell))
                    continue
                value = cell.find(VALUE)
                if value is None:
                    cells.append(None)
                else:
                    cells.append(shared[int(value.text)] if kind == "s" else value.text)
            yield cells
            row.clear()


def workbook_rows(workbooks: DataFrame, columns: list[str]) -> DataFrame:
    """Workbooks (path) to (path, text columns) rows; the first row names the columns."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema([(c, pa.string()) for c in ["path", *columns]])
        for batch in batches:
            for path in batch["path"].to_pylist():
                with opened(path) as source, zipfile.ZipFile(source) as book:
                    rows = sheet_rows(book)
                    names = [normalize(cell or "") for cell in next(rows, [])]
                    require(names, columns, path)
                    while some := list(islice(rows, SHEET_BATCH)):
                        yield pa.RecordBatch.from_pylist([dict(zip(names, row)) | {"path": path} for row in some], kinds)

    schema = ", ".join(f"`{c}` string" for c in ["path", *columns])
    return workbooks.select("path").mapInArrow(unpack, schema)


def clean_path(path: Column) -> Column:
    """A metadata path as listings write it: URI encoding undone, one slash after `file:`."""
    plain = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(plain, "^file:/+", "file:/")


def inspect(spark: SparkSession, paths: list[str]) -> tuple[list[str], list[tuple[str, list[str]]]]:
    """Workbooks, and text files grouped by header line: (paths, [(header, paths)]).

    One job; only paths and the few distinct first lines come to the driver.
    """
    if not paths:
        return [], []
    seen = sniffed(read_paths(spark, paths))
    grouped = seen.groupBy("header").agg(F.sort_array(F.collect_list("path")).alias("paths")).collect()
    found = {row["header"]: row["paths"] for row in grouped}
    workbooks = found.pop(None, [])
    return workbooks, sorted(found.items())


def csv_rows(spark: SparkSession, groups: list[tuple[str, list[str]]], columns: list[str]) -> DataFrame:
    """CSV files to (path, text columns) rows, columns found by name, empty cells NULL.

    Each group of files with the same header is one native CSV scan, which splits
    large files and prunes columns; only files whose header has a line end inside quotes
    are read whole by a task each.
    """
    scans = []
    for header, paths in groups:
        names = normalize_header(header)
        require(names, columns, paths[0])
        unique = [n if n and n not in names[:i] else f"_unused_{i}" for i, n in enumerate(names)]
        schema = ", ".join(f"`{n}` string" for n in unique)
        reader = spark.read.schema(schema).option("header", True).option("enforceSchema", True).option("escape", '"')
        rows = reader.option("multiLine", "\n" in header).csv(paths)
        picked = [F.nullif(F.col(c), F.lit("")).alias(c) for c in columns]
        scans.append(rows.select(clean_path(F.col("_metadata.file_path")).alias("path"), *picked))
    if not scans:
        return spark.createDataFrame([], ", ".join(f"`{c}` string" for c in ["path", *columns]))
    return reduce(DataFrame.unionByName, scans)
