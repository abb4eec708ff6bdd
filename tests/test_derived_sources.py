import os

import pyarrow.csv as pacsv
from conftest import DATA

from barloom.queries import incremental
from barloom.queries.files import raw_daily


def day_files(path):
    return {f: open(f"{path}/day/{f}", "rb").read() for f in os.listdir(f"{path}/day") if f.endswith(".csv") and not f.startswith(".")}


def test_files_of_a_build_stay_small_and_change_only_with_their_lines(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(incremental, "SOURCE_ROWS", 100)
    rows = raw_daily(spark, DATA)
    total = rows.count()
    incremental.write_sources(spark, DATA, str(tmp_path), rows)
    first = day_files(tmp_path)
    sizes = [pacsv.read_csv(f"{tmp_path}/day/{f}").num_rows for f in first]
    assert sum(sizes) == total and max(sizes) <= 150

    incremental.write_sources(spark, DATA, str(tmp_path), rows.repartition(7))
    assert day_files(tmp_path) == first

    incremental.write_sources(spark, DATA, str(tmp_path), incremental.shifted(rows))
    second = day_files(tmp_path)
    for name in first.keys() | second.keys():
        assert first.get(name) == second.get(name) or b"2-HIGH" in first.get(name, b"") + second.get(name, b"")
    assert first != second
