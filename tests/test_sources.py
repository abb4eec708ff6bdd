from datetime import datetime

import pytest
import raw

from barloom.sources import files
from barloom.sources.adapters import ADAPTERS


def rows_of(frame):
    return {(r["symbol"], r["timestamp"]): r for r in frame.collect()}


def test_daily_equity_text_and_workbook(spark, tmp_path):
    raw.write_day(
        tmp_path / "delivery_1.csv",
        [
            raw.day_row(),
            raw.day_row("BOND1", " BE"),
            raw.day_row(" DASH", " eq ", qty=" -", per=" -"),
            raw.day_row("  ", " EQ"),
            raw.day_row("HALF", volume=" 1000.6", date=" 1-JAN-2025"),
        ],
    )
    book = [[h.strip() for h in raw.DAY_HEADER], ["XL", "EQ", "02-Jan-2025", 9, 10, 11, 9, 10, 10.5, 1, 1234, 1, 5, None, 12.5]]
    (tmp_path / "delivery_2.csv").write_bytes(raw.workbook(book))
    shuffled = [raw.DAY_HEADER[1], raw.DAY_HEADER[0], *raw.DAY_HEADER[2:]]
    (tmp_path / "delivery_3.csv").write_text(",".join(shuffled) + "\nEQ,ABC,03-Jan-2025,1,2,3,1,2,2,1,7,1,5,1,14\n")
    paths = [str(p) for p in sorted(tmp_path.glob("*.csv"))]
    found = rows_of(ADAPTERS["day"].read(spark, paths, None))
    assert {s for s, _ in found} == {"ABC", "DASH", "HALF", "XL"}
    first = found["ABC", datetime(2025, 1, 1)]
    assert (first["close"], first["volume"], first["delivery"], first["del_percent"]) == (105.0, 1000, 500, 50.0)
    assert found["DASH", datetime(2025, 1, 1)]["delivery"] is None
    assert found["HALF", datetime(2025, 1, 1)]["volume"] == 1001
    sheet = found["XL", datetime(2025, 1, 2)]
    assert (sheet["close"], sheet["volume"], sheet["delivery"], sheet["del_percent"]) == (10.5, 1234, None, 12.5)
    assert found["ABC", datetime(2025, 1, 3)]["volume"] == 7


def test_empty_cells_are_unknown(spark, tmp_path):
    raw.write_day(tmp_path / "delivery_1.csv", [raw.day_row("A", volume="", qty="", per="")])
    text = (tmp_path / "delivery_1.csv").read_text(encoding="utf-8")
    extra = '"Q""X", EQ, 01-Jan-2025, 1, 1, 1, 1, 1, 1, 1,"",1,1,,\n'
    # A byte that is no UTF-8 beyond the header must not matter to finding the header.
    (tmp_path / "delivery_1.csv").write_bytes((text + extra).encode() + b"\xe9, BE, x\n")
    found = rows_of(ADAPTERS["day"].read(spark, [str(tmp_path / "delivery_1.csv")], None))
    assert {s for s, _ in found} == {"A", 'Q"X'}
    assert all(r["volume"] is None and r["delivery"] is None for r in found.values())
    lines = ["ABC.NSE,01/01/2025,09:15:59,100,101,99,100.5,,0"]
    raw.write_zip(tmp_path / "a.zip", [("m.csv", raw.minute_csv(lines))])
    minute = ADAPTERS["minute_idx"].read(spark, [str(tmp_path / "a.zip")], None).first()
    assert minute["volume"] is None and minute["close"] == 100.5


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("bad", [{"close": "abc"}, {"volume": "many"}, {"date": " 2025-01-01"}])
def test_bad_value_stops_the_source(spark, tmp_path, ansi, bad):
    raw.write_day(tmp_path / "delivery_1.csv", [raw.day_row(**bad)])
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="Not a |CANNOT_PARSE_TIMESTAMP"):
            ADAPTERS["day"].read(spark, [str(tmp_path / "delivery_1.csv")], None).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_daily_index(spark, tmp_path):
    raw.write_index(
        tmp_path / "ind_close_all_1.csv",
        [
            raw.index_row(),
            raw.index_row("Nifty Bank", "02-Jan-2025", "-,-,-,50000", '"1,000"'),
            raw.index_row("Nifty IT", "3/1/2025", "1,2,0.5,1.5", "-"),
            raw.index_row("Bad date", "2025.01.01"),
            raw.index_row("No close", prices="1,2,3,-"),
            raw.index_row("  "),
        ],
    )
    found = rows_of(ADAPTERS["day_idx"].read(spark, [str(tmp_path / "ind_close_all_1.csv")], None))
    assert set(found) == {
        ("NIFTY 50", datetime(2025, 1, 1)),
        ("NIFTY BANK", datetime(2025, 1, 2)),
        ("NIFTY IT", datetime(2025, 1, 3)),
    }
    bank = found["NIFTY BANK", datetime(2025, 1, 2)]
    assert (bank["open"], bank["low"], bank["volume"], bank["delivery"]) == (50000.0, 50000.0, 1000, None)
    assert found["NIFTY IT", datetime(2025, 1, 3)]["volume"] is None


def test_minutes(spark, tmp_path):
    rows = ["ABC.NC.NSE,01/01/2025,09:15:59,100,101,99,100.5,10,0", "XYZ.NSE,01/01/2025,09:15:59,1,1,1,1,1,0"]
    other = ["BOND1.NC.NSE,01/01/2025,09:15:59,1,1,1,1,1,0"]
    raw.write_zip(tmp_path / "a.zip", [("folder/", ""), ("folder/m.csv", raw.minute_csv(rows + other))])
    raw.write_zip(tmp_path / "b.zip", [("m.csv", raw.minute_csv(["IX.NSE_IDX,02/01/2025,09:16:59,1,1,1,1,1,0"]))])
    raw.write_zip(tmp_path / "empty.zip", [("m.csv", raw.MINUTE_HEADER + "\n")])
    universe = spark.createDataFrame([("ABC",), ("XYZ",)], "symbol string")
    paths = [str(tmp_path / "a.zip"), str(tmp_path / "empty.zip")]
    found = rows_of(ADAPTERS["minute"].read(spark, paths, universe))
    assert set(found) == {("ABC", datetime(2025, 1, 1, 9, 15, 59)), ("XYZ", datetime(2025, 1, 1, 9, 15, 59))}
    assert found["ABC", datetime(2025, 1, 1, 9, 15, 59)]["close"] == 100.5
    index = rows_of(ADAPTERS["minute_idx"].read(spark, [str(tmp_path / "b.zip")], None))
    assert set(index) == {("IX", datetime(2025, 1, 2, 9, 16, 59))}


def test_archive_needs_exactly_one_member(spark, tmp_path):
    raw.write_zip(tmp_path / "two.zip", [("a.csv", raw.minute_csv([])), ("b.csv", raw.minute_csv([]))])
    path = str(tmp_path / "two.zip")
    with pytest.raises(Exception, match="Expected one CSV member"):
        ADAPTERS["minute"].read(spark, [path], None).collect()
    assert files.archive_members(files.read_paths(spark, [path])).first()["members"] == 2


def test_derivatives_gate(spark, tmp_path):
    raw.write_zip(tmp_path / "good.zip", [("x.txt", "n"), ("fo.CSV", "TradDt,TckrSymb,OpnPric\n1,2,3\n")])
    raw.write_zip(tmp_path / "old.zip", [("fo.csv", "instrument,symbol,open\n")])
    raw.write_zip(tmp_path / "bad.zip", [("fo.csv", "a,b,c\n")])
    raw.write_zip(tmp_path / "none.zip", [("readme.txt", "symbol open")])
    archives = files.list_files(spark, str(tmp_path), "*.zip")
    found = {r["path"].rsplit("/", 1)[1]: (r["has_csv"], r["header_ok"]) for r in files.derivatives_gate(archives).collect()}
    assert found == {
        "good.zip": (True, True),
        "old.zip": (True, True),
        "bad.zip": (True, False),
        "none.zip": (False, False),
    }


def test_discovery(spark, tmp_path):
    raw.write_day(tmp_path / "delivery_b.csv", [raw.day_row()])
    raw.write_day(tmp_path / "delivery_a.csv", [raw.day_row()])
    (tmp_path / "other.csv").write_text("x")
    found = ADAPTERS["day"].discover(spark, str(tmp_path)).orderBy("path").collect()
    assert [r["source_key"] for r in found] == ["day:delivery_a.csv", "day:delivery_b.csv"]
    assert found[0]["fingerprint"] == found[1]["fingerprint"]
    with pytest.raises(FileNotFoundError):
        files.list_files(spark, str(tmp_path / "missing"), "*")
    assert files.list_files(spark, str(tmp_path / "missing"), "*", optional=True).count() == 0


def test_stat_fingerprint_reads_no_content(spark, tmp_path):
    import os

    path = tmp_path / "delivery_a.csv"
    raw.write_day(path, [raw.day_row()])

    def seen(by):
        return ADAPTERS["day"].discover(spark, str(tmp_path), by).first()["fingerprint"]

    content, stat = seen("content"), seen("stat")
    os.utime(path, (1, 1))
    assert seen("content") == content and seen("stat") != stat
    found = ADAPTERS["day"].discover(spark, str(tmp_path), "stat")
    assert "content" not in found._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1]
    with pytest.raises(ValueError):
        seen("name")


def test_header_names_agree(spark):
    from pyspark.sql import functions as F

    from barloom.functions.names import normalized_name

    texts = [" DELIV_QTY", "Change(%)", "P/E", "Turnover (Rs. Cr.)", "Close", "Div Yield", "52W High", "Index Name"]
    frame = spark.createDataFrame([(t,) for t in texts], "raw string")
    found = [r[0] for r in frame.select(normalized_name(F.col("raw"))).collect()]
    assert found == [files.normalize(t) for t in texts]
    assert found == ["deliv_qty", "change", "pe", "turnover_rs_cr", "_close", "div_yield", "_52w_high", "index_name"]


def test_a_source_without_a_needed_column_is_an_error(spark, tmp_path):
    kept = [i for i, name in enumerate(raw.DAY_HEADER) if name.strip() != "CLOSE_PRICE"]
    lines = [",".join(row[i] for i in kept) for row in (raw.DAY_HEADER, raw.day_row())]
    (tmp_path / "delivery_1.csv").write_text("\n".join(lines) + "\n")
    with pytest.raises(ValueError, match="delivery_1.csv has no column close_price"):
        ADAPTERS["day"].read(spark, [str(tmp_path / "delivery_1.csv")], None)
    raw.write_zip(tmp_path / "m.zip", [("a.csv", "Ticker,Date,Time,Open,High,Low,Close\nABC.NC.NSE,01/01/2025,09:15:59,1,1,1,1\n")])
    with pytest.raises(Exception, match="has no column volume"):
        files.archive_rows(files.read_paths(spark, [str(tmp_path / "m.zip")]), ["ticker", "volume"]).collect()


def test_quoted_headers_and_wide_headers(spark, tmp_path):
    assert files.normalize_header('"A, B",SYMBOL, "V"') == ["a_b", "symbol", "v"]
    wide = ",".join(f"column_{i:06d}" for i in range(6000))
    (tmp_path / "w.csv").write_text(f'"A, B",{wide},SYMBOL\nx,{"," * 6000}ABC\n')
    workbooks, groups = files.inspect(spark, [str(tmp_path / "w.csv")])
    assert workbooks == []
    assert [r.symbol for r in files.csv_rows(spark, groups, ["symbol"]).collect()] == ["ABC"]


def test_named_files_are_dealt_to_tasks_without_listing_them(spark, tmp_path, monkeypatch):
    from pyspark.sql import functions as F

    for i in range(100):
        raw.write_day(tmp_path / f"delivery_{i}.csv", [raw.day_row(f"S{i}")])
    paths = [r["path"] for r in files.list_files(spark, str(tmp_path), "*.csv").collect()]
    monkeypatch.setattr(files, "TASK_FILES", 3)
    named = files.read_paths(spark, paths)
    assert "binaryFile" not in named._jdf.queryExecution().executedPlan().toString()
    held = named.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in held) == 100 and max(r["count"] for r in held) <= 3
    assert {r["path"] for r in files.read_paths(spark, [p.removeprefix("file:") for p in paths]).collect()} == set(paths)
    assert files.read_paths(spark, []).count() == 0


def test_cells_of_a_workbook(spark, tmp_path):
    import zipfile

    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    names = "".join(f'<c t="inlineStr"><is><t>{c}</t></is></c>' for c in ("A", "B", "C"))
    rich = '<c r="A2" t="inlineStr"><is><r><t>ri</t></r><r><t>ch</t></r></is></c><c r="C2" t="inlineStr"><is><t/></is></c>'
    far = '<c r="B3"><v>7</v></c><c><f>1</f></c><c r="AB3"><v>8</v></c>'
    rows = f"<row>{names}</row><row>{rich}</row><row>{far}</row><row/>"
    with zipfile.ZipFile(tmp_path / "w.csv", "w") as book:
        book.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="s" sheetId="1" r:id="r1"/></sheets></workbook>')
        book.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="r1" Target="worksheets/sheet1.xml"/></Relationships>')
        book.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{main}"><sheetData>{rows}</sheetData></worksheet>')
    found = files.workbook_rows(files.read_paths(spark, [str(tmp_path / "w.csv")]), ["a", "b", "c"]).collect()
    assert [(r.a, r.b, r.c) for r in found] == [("rich", None, ""), (None, "7", None), (None, None, None)]
    with zipfile.ZipFile(tmp_path / "w.csv") as book:
        assert [len(r) for r in files.sheet_rows(book)] == [3, 3, 28, 0]
