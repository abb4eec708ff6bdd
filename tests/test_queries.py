"""Every registered query against its SQL on the smallest tables.

Whole builds have their own tests; here they would only repeat them slowly.
"""

import duckdb
import pytest
from conftest import DATA

from __spark_entry__ import entry
from barloom.queries import ORACLES, QUERIES
from check import compare, connect

SLOW = ("inc03", "inc04", "inc09", "inc10", "inc11", "ext03")


@pytest.fixture(scope="module")
def oracle() -> duckdb.DuckDBPyConnection:
    return connect(DATA)


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith(SLOW)])
def test_query_equals_sql(spark, oracle, name):
    assert compare(spark, oracle, DATA, name) == ""


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", ["sc06_lenient_day", "ts07_period_start", "ts02_as_of_day", "ts01_resample_5m", "flt07_bound_range"])
def test_results_do_not_depend_on_the_session_time_zone(spark, oracle, name):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        assert compare(spark, oracle, DATA, name) == ""
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_small_result_stays_off_the_driver(spark, monkeypatch):
    def refused(*_):
        raise AssertionError("rows went to the driver")

    for name in ("toPandas", "toArrow", "collect"):
        monkeypatch.setattr(type(spark.range(0)), name, refused)
    QUERIES["snk12_small_result"](spark, DATA)
