import hashlib
import io
import zipfile

import pytest
import raw

from barloom.sources import files, streams
from barloom.sources.adapters import ADAPTERS

GIANT = (2 << 30) + (100 << 20)


def giant(path, tail):
    """A file above 2 GB that takes hardly any disk: a hole, then `tail`."""
    with path.open("wb") as stream:
        stream.truncate(GIANT)
        stream.seek(GIANT)
        stream.write(tail)


def giant_digest(prefix, tail):
    found = hashlib.sha256(prefix)
    zeros = bytes(8 << 20)
    for at in range(0, GIANT, len(zeros)):
        found.update(zeros[: min(len(zeros), GIANT - at)])
    found.update(tail)
    return found.hexdigest()


def test_files_above_two_gigabytes_are_hashed_and_read(spark, tmp_path):
    raw.write_zip(tmp_path / "small.zip", [("m.csv", raw.minute_csv(["ABC.NC.NSE,01/01/2025,09:15:59,100,101,99,100.5,10,0"]))])
    small = (tmp_path / "small.zip").read_bytes()
    giant(tmp_path / "giant.zip", small)  # archives may follow anything: they are read from their end
    found = ADAPTERS["minute"].discover(spark, str(tmp_path)).collect()
    hashes = {r.path.rsplit("/", 1)[1]: r.fingerprint for r in found}
    assert hashes["giant.zip"] == giant_digest(b"adapter:3\0", small)
    assert hashes["small.zip"] == hashlib.sha256(b"adapter:3\0" + small).hexdigest()
    universe = spark.createDataFrame([("ABC",)], "symbol string")
    rows = ADAPTERS["minute"].read(spark, [str(tmp_path / "giant.zip")], universe).collect()
    assert [(r.symbol, r.close) for r in rows] == [("ABC", 100.5)]
    sums = {r.path.rsplit("/", 1)[1]: (r.length, r.sha256) for r in files.checksums(files.list_files(spark, str(tmp_path), "*.zip")).collect()}
    assert sums["giant.zip"] == (GIANT + len(small), giant_digest(b"", small))


def test_no_plan_reads_contents(spark, tmp_path):
    raw.write_day(tmp_path / "delivery_a.csv", [raw.day_row()])
    listed = files.list_files(spark, str(tmp_path), "*.csv")
    for frame in (files.fingerprints(listed, 1), files.checksums(listed), files.sniffed(listed)):
        assert "content" not in frame._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1]


def test_large_csv_files_are_split(spark, tmp_path):
    path = tmp_path / "delivery_a.csv"
    raw.write_day(path, [raw.day_row(f"S{i}") for i in range(3000)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(path.stat().st_size // 6))
    try:
        rows = ADAPTERS["day"].read(spark, [str(path)], None)
        assert rows.rdd.getNumPartitions() >= 6
        assert rows.select("symbol").distinct().count() == 3000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_names_are_taken_as_they_are(spark, tmp_path):
    for name in ("delivery_a b.csv", "delivery_100%25.csv", "delivery_ü+#.csv"):
        raw.write_day(tmp_path / name, [raw.day_row(name[9:10].upper())])
    found = ADAPTERS["day"].discover(spark, str(tmp_path)).collect()
    assert {r.source_key for r in found} == {"day:delivery_a b.csv", "day:delivery_100%25.csv", "day:delivery_ü+#.csv"}
    assert ADAPTERS["day"].read(spark, [r.path for r in found if "%" not in r.path], None).count() == 2


def test_a_line_end_inside_a_quoted_header(spark, tmp_path):
    text = 'a,"TTL\nTRD",SYMBOL\n1,2,ABC\n3,"4\n5",XYZ\n'
    (tmp_path / "w.csv").write_text(text)
    workbooks, groups = files.inspect(spark, [str(tmp_path / "w.csv")])
    assert workbooks == [] and groups[0][0] == 'a,"TTL\nTRD",SYMBOL'
    assert [(r.ttl_trd, r.symbol) for r in files.csv_rows(spark, groups, ["ttl_trd", "symbol"]).collect()] == [("2", "ABC"), ("4\n5", "XYZ")]


@pytest.mark.parametrize(
    "text, line",
    [(b"", b""), (b"a,b", b"a,b"), (b"a\r\nb", b"a\r"), (b'"x\ny",z\nnext', b'"x\ny",z'), (b'"a""\n",b\n', b'"a""\n",b'), (b"x" * 200_000 + b"\ny", b"x" * 200_000)],
)
def test_first_lines(text, line):
    assert streams.first_line(io.BytesIO(text)) == line


def test_a_header_without_end_is_refused():
    with pytest.raises(ValueError):
        streams.first_line(io.BytesIO(b"x" * (3 << 20)))


def test_workbooks_of_many_rows_come_in_batches(spark, tmp_path, monkeypatch):
    book = [["SYMBOL", "SERIES"], *([f"S{i}", "EQ"] for i in range(25))]
    (tmp_path / "delivery_1.csv").write_bytes(raw.workbook(book))
    monkeypatch.setattr(files, "SHEET_BATCH", 10)
    rows = files.workbook_rows(files.read_paths(spark, [str(tmp_path / "delivery_1.csv")]), ["symbol", "series"])
    assert sorted(r.symbol for r in rows.collect()) == sorted(f"S{i}" for i in range(25))


def test_put_replaces_whole_files(tmp_path):
    for content in (b"one", b"two, longer"):
        streams.put(f"file:{tmp_path}/deep/er/x.bin", content)
    assert [p.read_bytes() for p in (tmp_path / "deep" / "er").iterdir()] == [b"two, longer"]


def test_located():
    for path in ("/a/b c.zip", "file:/a/b c.zip", "file:///a/b c.zip"):
        assert streams.located(path)[1] == "/a/b c.zip"


def test_a_damaged_archive_is_an_error(spark, tmp_path):
    (tmp_path / "x.zip").write_bytes(b"PK\x03\x04 no archive")
    with pytest.raises(Exception, match="zip"):
        files.archive_members(files.list_files(spark, str(tmp_path), "*.zip")).collect()
    assert not zipfile.is_zipfile(tmp_path / "x.zip")
