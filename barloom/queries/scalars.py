"""Scalar functions (SC) on text and numbers derived from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from barloom.functions import calendar as cal
from barloom.functions import casts, names
from barloom.operators import indicators as ind
from barloom.operators.align import finite
from barloom.queries import views as v
from barloom.queries.registry import query

# Number text in the forms raw files use, and some they should not.
TEXT_SQL = """texts AS (
  SELECT o_orderkey, CASE o_orderkey % 8 WHEN 0 THEN CAST(o_custkey AS VARCHAR) WHEN 1 THEN o_custkey || '.0'
    WHEN 2 THEN o_custkey || '.6' WHEN 3 THEN ' ' || o_custkey || ' ' WHEN 4 THEN o_custkey || '.5'
    WHEN 5 THEN '-' WHEN 6 THEN '' ELSE '1,' || o_custkey END AS text
  FROM orders)"""


def texts(spark, sf_dir):
    key, number = F.col("o_orderkey") % 8, F.col("o_custkey").cast("string")
    text = (
        F.when(key == 0, number)
        .when(key == 1, F.concat(number, F.lit(".0")))
        .when(key == 2, F.concat(number, F.lit(".6")))
        .when(key == 3, F.concat(F.lit(" "), number, F.lit(" ")))
        .when(key == 4, F.concat(number, F.lit(".5")))
        .when(key == 5, F.lit("-"))
        .when(key == 6, F.lit(""))
        .otherwise(F.concat(F.lit("1,"), number))
    )
    return v.table(spark, sf_dir, "orders").select("o_orderkey", text.alias("text"))


DATES_SQL = """dates AS (
  SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN strftime(o_orderdate, '%d-%m-%Y')
    WHEN 1 THEN strftime(o_orderdate, '%-d-%b-%Y') WHEN 2 THEN strftime(o_orderdate, '%d/%m/%Y')
    WHEN 3 THEN strftime(o_orderdate, '%Y%m%d') ELSE upper(strftime(o_orderdate, '%d-%b-%Y')) END AS text
  FROM orders)"""


def dates(spark, sf_dir):
    key, day = F.col("o_orderkey") % 5, "o_orderdate"
    text = (
        F.when(key == 0, F.date_format(day, "dd-MM-yyyy"))
        .when(key == 1, F.date_format(day, "d-MMM-yyyy"))
        .when(key == 2, F.date_format(day, "dd/MM/yyyy"))
        .when(key == 3, F.date_format(day, "yyyyMMdd"))
        .otherwise(F.upper(F.date_format(day, "dd-MMM-yyyy")))
    )
    return v.table(spark, sf_dir, "orders").select("o_orderkey", text.alias("text"))


@query(
    "sc01_trim_upper_lower",
    """SELECT o_orderkey, upper(trim(' ' || o_orderpriority || '  ')) AS upper, lower(substr(trim(' ' || o_orderstatus), 1, 1)) AS first
       FROM orders""",
)
def sc01(spark, sf_dir):
    padded = F.concat(F.lit(" "), "o_orderpriority", F.lit("  "))
    first = F.lower(F.substring(F.trim(F.concat(F.lit(" "), "o_orderstatus")), 1, 1))
    return v.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.upper(F.trim(padded)).alias("upper"), first.alias("first")
    )


@query("sc02_replace_commas", f"WITH {TEXT_SQL} SELECT o_orderkey, replace(text, ',', '') AS text FROM texts")
def sc02(spark, sf_dir):
    return texts(spark, sf_dir).withColumn("text", F.replace("text", F.lit(","), F.lit("")))


@query(
    "sc03_concat_date_time",
    "SELECT event_id, strftime(ts, '%d/%m/%Y') || ' ' || CASE WHEN event_id % 7 > 0 THEN strftime(ts, '%H:%M:%S') END AS text FROM events",
)
def sc03(spark, sf_dir):
    time = F.when(F.col("event_id") % 7 > 0, F.date_format("ts", "HH:mm:ss"))
    text = F.concat(F.date_format("ts", "dd/MM/yyyy"), F.lit(" "), time)
    return v.table(spark, sf_dir, "events").select("event_id", text.alias("text"))


@query(
    "sc04_strip_ticker",
    r"""SELECT event_id, regexp_replace(trim(' ' || event_type || CASE event_id % 3 WHEN 0 THEN '.NC.NSE' WHEN 1 THEN '.NSE' ELSE '.BO' END),
        '(\.NC)?\.NSE$', '') AS symbol FROM events""",
)
def sc04(spark, sf_dir):
    event = F.col("event_id") % 3
    suffix = F.when(event == 0, ".NC.NSE").when(event == 1, ".NSE").otherwise(".BO")
    symbol = names.strip_ticker(F.concat(F.lit(" "), "event_type", suffix))
    return v.table(spark, sf_dir, "events").select("event_id", symbol.alias("symbol"))


@query(
    "sc05_strict_day",
    "SELECT o_orderkey, strptime(trim(' ' || strftime(o_orderdate, '%d-%b-%Y')), '%d-%b-%Y') AS day FROM orders",
)
def sc05(spark, sf_dir):
    text = F.trim(F.concat(F.lit(" "), F.date_format("o_orderdate", "dd-MMM-yyyy")))
    day = casts.strict_timestamp(text, casts.DAY_PATTERN)
    return v.table(spark, sf_dir, "orders").select("o_orderkey", day.alias("day"))


@query(
    "sc06_lenient_day",
    f"WITH {DATES_SQL} SELECT o_orderkey, try_strptime(text, ['%d-%m-%Y', '%d-%b-%Y', '%d/%m/%Y']) AS day FROM dates",
)
def sc06(spark, sf_dir):
    return dates(spark, sf_dir).select("o_orderkey", casts.lenient_day(F.col("text")).alias("day"))


@query(
    "sc07_strict_minute",
    "SELECT event_id, strptime(strftime(ts, '%d/%m/%Y') || ' ' || strftime(ts, '%H:%M:%S'), '%d/%m/%Y %H:%M:%S') AS stamp FROM events",
)
def sc07(spark, sf_dir):
    text = F.concat(F.date_format("ts", "dd/MM/yyyy"), F.lit(" "), F.date_format("ts", "HH:mm:ss"))
    stamp = casts.strict_timestamp(text, casts.MINUTE_PATTERN)
    return v.table(spark, sf_dir, "events").select("event_id", stamp.alias("stamp"))


GOOD = "o_orderkey % 8 < 5"


@query(
    "sc08_strict_numbers",
    f"WITH {TEXT_SQL} SELECT o_orderkey, CAST(text AS DOUBLE) AS d, CAST(text AS BIGINT) AS i FROM texts WHERE {GOOD}",
)
def sc08(spark, sf_dir):
    good = texts(spark, sf_dir).where(GOOD)
    text = F.col("text")
    return good.select("o_orderkey", casts.strict_double(text).alias("d"), casts.strict_bigint(text).alias("i"))


@query(
    "sc09_lenient_numbers",
    f"WITH {TEXT_SQL} SELECT o_orderkey, TRY_CAST(text AS DOUBLE) AS d, TRY_CAST(text AS BIGINT) AS i FROM texts",
)
def sc09(spark, sf_dir):
    text = F.col("text")
    return texts(spark, sf_dir).select(
        "o_orderkey", casts.lenient_double(text).alias("d"), casts.lenient_bigint(text).alias("i")
    )


def _buckets(name: str, table: str, key: str, stamp: str, intervals: list[str]):
    columns = ", ".join(f"{v.BUCKETS[i].replace('timestamp)', stamp + ')', 1)} AS b_{i.lower()}" for i in intervals)

    @query(name, f"SELECT {key}, {columns} FROM {table}")
    def run(spark, sf_dir):
        starts = [cal.period_start(F.col(stamp), i).alias(f"b_{i.lower()}") for i in intervals]
        return v.table(spark, sf_dir, table).select(key, *starts)


_buckets("sc10_truncate", "orders", "o_orderkey", "o_orderdate", ["Day", "Week", "Month", "Quarter", "Year"])
_buckets("sc10_truncate_minute", "events", "event_id", "ts", ["1m"])
_buckets("sc11_time_bucket", "events", "event_id", "ts", ["5m", "15m"])


@query(
    "sc12_coalesce_close",
    "SELECT event_id, coalesce(CASE WHEN event_id % 3 > 0 THEN value END, value + 1) AS open FROM events",
)
def sc12(spark, sf_dir):
    opened = F.when(F.col("event_id") % 3 > 0, F.col("value"))
    return v.table(spark, sf_dir, "events").select(
        "event_id", F.coalesce(opened, F.col("value") + 1).alias("open")
    )


@query(
    "sc13_greatest_least",
    "SELECT event_id, greatest(CASE WHEN event_id % 3 > 0 THEN value END, 50.0::DOUBLE) AS g, least(value, 50.0::DOUBLE, NULL) AS l FROM events",
)
def sc13(spark, sf_dir):
    known = F.when(F.col("event_id") % 3 > 0, F.col("value"))
    return v.table(spark, sf_dir, "events").select(
        "event_id",
        F.greatest(known, F.lit(50.0)).alias("g"),
        F.least(F.col("value"), F.lit(50.0), F.lit(None).cast("double")).alias("l"),
    )


@query("sc14_case", "SELECT event_id, CASE WHEN value > 50 THEN 'high' WHEN value > 10 THEN 'mid' END AS level FROM events")
def sc14(spark, sf_dir):
    level = F.when(F.col("value") > 50, "high").when(F.col("value") > 10, "mid")
    return v.table(spark, sf_dir, "events").select("event_id", level.alias("level"))


@query("sc15_md5", "SELECT event_id, md5(event_type || ':' || event_id) AS digest FROM events")
def sc15(spark, sf_dir):
    text = F.concat_ws(":", "event_type", F.col("event_id").cast("string"))
    return v.table(spark, sf_dir, "events").select("event_id", F.md5(text.cast("binary")).alias("digest"))


@query(
    "sc16_content_fingerprint",
    r"SELECT doc_id, sha256(encode('adapter:2') || '\x00'::BLOB || encode(text)) AS fingerprint FROM documents",
)
def sc16(spark, sf_dir):
    fingerprint = names.content_fingerprint(F.lit(2), F.encode("text", "utf-8"))
    return v.table(spark, sf_dir, "documents").select("doc_id", fingerprint.alias("fingerprint"))


@query(
    "sc17_stat_fingerprint",
    "SELECT event_id, sha256('v1:' || user_id || ':' || epoch_us(ts) * 1000) AS fingerprint FROM events",
)
def sc17(spark, sf_dir):
    # Stamps are zone-less here; read them as UTC whatever the session's zone is.
    modified = F.from_utc_timestamp(F.col("ts").cast("timestamp"), F.current_timezone())
    fingerprint = names.stat_fingerprint(F.lit(1), F.col("user_id"), modified)
    return v.table(spark, sf_dir, "events").select("event_id", fingerprint.alias("fingerprint"))


@query("sc18_cache_name", "SELECT page_id, sha1(url) AS cache_id FROM pages")
def sc18(spark, sf_dir):
    return v.table(spark, sf_dir, "pages").select("page_id", names.cache_id(F.col("url")).alias("cache_id"))


@query(
    "sc19_hash_buckets",
    """SELECT count(*) AS n, count(DISTINCT event_type) AS symbols, true AS one_bucket_each FROM events""",
)
def sc19(spark, sf_dir):
    bucket = F.pmod(F.xxhash64("event_type"), F.lit(128))
    per_symbol = (
        v.table(spark, sf_dir, "events")
        .groupBy("event_type")
        .agg(F.count(F.lit(1)).alias("rows"), F.min(bucket).alias("low"), F.max(bucket).alias("high"))
    )
    fits = (F.col("low") == F.col("high")) & F.col("low").between(0, 127)
    return per_symbol.agg(
        F.sum("rows").alias("n"), F.count(F.lit(1)).alias("symbols"), F.min(fits).alias("one_bucket_each")
    )


# Symbols with blanks and signs: pieces of page addresses and order priorities.
ENCODE_SQL = """odd AS (SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 'M&M ' || o_orderpriority WHEN 1 THEN 'A+B*' || o_orderkey
  WHEN 2 THEN 'x~y(' || o_orderstatus || ')' WHEN 3 THEN '50% ' || o_orderpriority WHEN 4 THEN '/' || o_orderpriority
  ELSE 'Ä' || o_orderkey END AS symbol FROM orders)"""


def odd(spark, sf_dir):
    key = F.col("o_orderkey")
    symbol = (
        F.when(key % 6 == 0, F.concat(F.lit("M&M "), "o_orderpriority"))
        .when(key % 6 == 1, F.concat(F.lit("A+B*"), key.cast("string")))
        .when(key % 6 == 2, F.concat(F.lit("x~y("), "o_orderstatus", F.lit(")")))
        .when(key % 6 == 3, F.concat(F.lit("50% "), "o_orderpriority"))
        .when(key % 6 == 4, F.concat(F.lit("/"), "o_orderpriority"))
        .otherwise(F.concat(F.lit("Ä"), key.cast("string")))
    )
    return v.table(spark, sf_dir, "orders").select("o_orderkey", symbol.alias("symbol"))


@query(
    "sc20_encode_symbol",
    f"""WITH {ENCODE_SQL} SELECT o_orderkey, replace(replace(replace(url_encode(symbol), '%26', '&'), '%28', '('), '%29', ')') AS folder
        FROM odd""",
)
def sc20(spark, sf_dir):
    return odd(spark, sf_dir).select("o_orderkey", names.encode_symbol(F.col("symbol")).alias("folder"))


@query("sc21_decode_symbol", f"WITH {ENCODE_SQL} SELECT o_orderkey, url_decode(url_encode(symbol)) AS symbol FROM odd")
def sc21(spark, sf_dir):
    folder = names.encode_symbol(F.col("symbol"))
    return odd(spark, sf_dir).select("o_orderkey", names.decode_symbol(folder).alias("symbol"))


@query(
    "sc22_symbol_group",
    f"""WITH {ENCODE_SQL} SELECT o_orderkey, CASE WHEN regexp_matches(lower(substr(symbol, 1, 1)), '^[a-z0-9]$')
        THEN lower(substr(symbol, 1, 1)) ELSE '_' END AS symbol_group FROM odd""",
)
def sc22(spark, sf_dir):
    return odd(spark, sf_dir).select("o_orderkey", names.symbol_group(F.col("symbol")).alias("symbol_group"))


@query("sc23_source_key", "SELECT page_id, 'day:' || regexp_extract(url, '[^/]*$') AS source_key FROM pages")
def sc23(spark, sf_dir):
    name = F.regexp_extract("url", "[^/]*$", 0)
    return v.table(spark, sf_dir, "pages").select("page_id", names.source_key("day", name).alias("source_key"))


@query(
    "sc24_price_arithmetic",
    f"""{v.WITH_M1} SELECT event_id, (open + high + low + close) / 4.0::DOUBLE AS ohlc4,
        (high + low + close) / 3.0::DOUBLE AS typical, (high + low) / 2.0::DOUBLE AS mid, abs(close - open) AS body FROM m1""",
)
def sc24(spark, sf_dir):
    return v.m1(spark, sf_dir, with_id=True).select(
        "event_id",
        ind.ohlc4().alias("ohlc4"),
        ind.typical_price().alias("typical"),
        ind.mid_price().alias("mid"),
        F.abs(F.col("close") - F.col("open")).alias("body"),
    )


ODD_NUMBERS_SQL = """numbers AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'nan'::DOUBLE WHEN 1 THEN 'inf'::DOUBLE
  WHEN 2 THEN NULL ELSE value END AS x FROM events)"""


@query(
    "sc25_finite",
    f"WITH {ODD_NUMBERS_SQL} SELECT event_id, coalesce(isfinite(x), false) AS ok, CASE WHEN isfinite(x) THEN x END AS x FROM numbers",
)
def sc25(spark, sf_dir):
    event = F.col("event_id") % 4
    x = F.when(event == 0, float("nan")).when(event == 1, float("inf")).when(event == 3, F.col("value"))
    rows = v.table(spark, sf_dir, "events").select("event_id", x.alias("x"))
    ok = finite(F.col("x"))
    return rows.select("event_id", ok.alias("ok"), F.when(ok, F.col("x")).alias("x"))


@query(
    "sc26_header_names",
    r"""WITH h AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN ' ' || upper(o_orderpriority) || '(%)' WHEN 1 THEN 'Close'
          WHEN 2 THEN 'Turnover (Rs. Cr.) ' || o_orderstatus ELSE ' P/E ' || lower(o_orderstatus) END AS raw FROM orders),
        n AS (SELECT *, regexp_replace(trim(regexp_replace(lower(trim(raw)), '[^0-9a-z_\s]', '', 'g')), '\s+', '_', 'g') AS name FROM h)
        SELECT o_orderkey, CASE WHEN name IN ('close') OR regexp_matches(name, '^[0-9]') THEN '_' || name ELSE name END AS name FROM n""",
)
def sc26(spark, sf_dir):
    key = F.col("o_orderkey") % 4
    raw = (
        F.when(key == 0, F.concat(F.lit(" "), F.upper("o_orderpriority"), F.lit("(%)")))
        .when(key == 1, F.lit("Close"))
        .when(key == 2, F.concat(F.lit("Turnover (Rs. Cr.) "), "o_orderstatus"))
        .otherwise(F.concat(F.lit(" P/E "), F.lower("o_orderstatus")))
    )
    return v.table(spark, sf_dir, "orders").select("o_orderkey", names.normalized_name(raw).alias("name"))
