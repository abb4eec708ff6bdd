"""Sources (SRC), sinks (SNK) and extension points (EXT) on files derived from the tables.

Raw files are written by Spark from `orders`, `events` and `pages`, in the formats the
adapters read, and then read through the adapters.
"""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import functions as F

from barloom.functions.names import cache_id, decode_symbol, source_key, symbol_group
from barloom.operators import sets
from barloom.queries import views as v
from barloom.queries.registry import query
from barloom.schema import CANDLE_COLUMNS, PARTITION_COLUMNS
from barloom.session import delete, scratch
from barloom.sources import files, streams, tables
from barloom.sources.adapters import ADAPTERS

CANDLE_LIST = "timeframe, symbol, timestamp, open, high, low, close, volume, delivery, del_percent"


def folder(spark, sf_dir, name):
    return scratch(spark, "queries", sf_dir, name)


def text_of(name):
    return F.concat(F.lit(" "), F.col(name).cast("string"))


def write_csv(rows, path):
    """CSV with a header and the cells exactly as they are, blanks included."""
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static").option("header", True)
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def listed(spark, path, glob="*.csv"):
    return [row["path"] for row in files.list_files(spark, path, glob).select("path").collect()]


def put_files(spark, sf_dir, name, rows):
    """Rows (name, content) as files of a folder, each written by the task that holds its row."""
    path = folder(spark, sf_dir, name)
    delete(spark, path)

    def put(batches):
        for batch in batches:
            for title, content in zip(batch["name"].to_pylist(), batch["content"].to_pylist()):
                streams.put(f"{path}/{title}", content)
            yield batch.select(["name"])

    rows.select("name", "content").mapInArrow(put, "name string").write.format("noop").mode("overwrite").save()
    return path


def raw_daily(spark, sf_dir):
    """`orders` in the shape of a daily equity file: one line per order."""
    key, price, customer = F.col("o_orderkey"), F.col("o_totalprice"), F.col("o_custkey").cast("string")
    series = F.when(key % 4 == 0, " EQ").when(key % 4 == 1, "eq ").when(key % 4 == 2, " BE").otherwise("EQ")
    quantity = F.when(key % 5 == 0, " -").when(key % 5 == 1, "1,000").otherwise(F.concat(F.lit(" "), customer))
    share = F.when(key % 3 == 0, " -").otherwise(F.concat(F.lit(" "), (key % 100).cast("string"), F.lit(".5")))
    volume = F.when(key % 2 == 0, F.concat(F.lit(" "), customer)).otherwise(F.concat(F.lit(" "), customer, F.lit(".6")))
    return v.table(spark, sf_dir, "orders").select(
        F.when(key % 50 == 0, "  ").otherwise(F.concat(F.lit(" "), "o_orderpriority")).alias("SYMBOL"),
        series.alias(" SERIES"),
        F.concat(F.lit(" "), F.date_format("o_orderdate", "dd-MMM-yyyy")).alias(" DATE1"),
        F.lit(" 1").alias(" PREV_CLOSE"),
        text_of("o_totalprice").alias(" OPEN_PRICE"),
        F.concat(F.lit(" "), (price + 10).cast("string")).alias(" HIGH_PRICE"),
        F.concat(F.lit(" "), (price - 10).cast("string")).alias(" LOW_PRICE"),
        F.lit(" 1").alias(" LAST_PRICE"),
        F.concat(F.lit(" "), (price + 5).cast("string")).alias(" CLOSE_PRICE"),
        volume.alias(" TTL_TRD_QNTY"),
        quantity.alias(" DELIV_QTY"),
        share.alias(" DELIV_PER"),
    )


DAILY_SQL = """daily AS (
  SELECT 'day' AS timeframe, o_orderpriority AS symbol, o_orderdate AS timestamp, o_totalprice AS open,
         o_totalprice + 10 AS high, o_totalprice - 10 AS low, o_totalprice + 5 AS close,
         CASE WHEN o_orderkey % 2 = 0 THEN o_custkey ELSE o_custkey + 1 END AS volume,
         CASE WHEN o_orderkey % 5 > 1 THEN o_custkey END AS delivery,
         CASE WHEN o_orderkey % 3 > 0 THEN CAST((o_orderkey % 100) || '.5' AS DOUBLE) END AS del_percent
  FROM orders WHERE o_orderkey % 4 <> 2 AND o_orderkey % 50 <> 0)"""


def daily_files(spark, sf_dir, name):
    path = folder(spark, sf_dir, name)
    write_csv(raw_daily(spark, sf_dir), path)
    return listed(spark, path)


@query("src01_daily_equity_csv", f"WITH {DAILY_SQL} SELECT {CANDLE_LIST} FROM daily")
def src01(spark, sf_dir):
    return ADAPTERS["day"].read(spark, daily_files(spark, sf_dir, "src01"), None).drop("path")


SHEET_ROWS = 500


def workbooks(spark, sf_dir):
    """Daily lines as workbooks of at most 500 rows, (name, content) rows."""
    cells = plain_daily(spark, sf_dir)
    names = [c for c in cells.columns if c != "book"]

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        content = sheet_bytes(names, group[names].values.tolist())
        return pd.DataFrame({"name": [f"delivery_{group['book'].iloc[0]}.csv"], "content": [content]})

    return cells.groupBy("book").applyInPandas(pack, "name string, content binary")


def plain_daily(spark, sf_dir):
    """Daily lines without blanks, with the number of the workbook they go to."""
    key = F.col("o_orderkey")
    price = F.col("o_totalprice")
    return v.table(spark, sf_dir, "orders").select(
        F.floor(key / SHEET_ROWS).alias("book"),
        F.col("o_orderpriority").alias("SYMBOL"),
        F.when(key % 4 == 2, "BE").otherwise("EQ").alias("SERIES"),
        F.date_format("o_orderdate", "dd-MMM-yyyy").alias("DATE1"),
        F.lit("1").alias("PREV_CLOSE"),
        price.cast("string").alias("OPEN_PRICE"),
        (price + 10).cast("string").alias("HIGH_PRICE"),
        (price - 10).cast("string").alias("LOW_PRICE"),
        F.lit("1").alias("LAST_PRICE"),
        (price + 5).cast("string").alias("CLOSE_PRICE"),
        F.col("o_custkey").cast("string").alias("TTL_TRD_QNTY"),
        F.when(key % 5 > 1, F.col("o_custkey").cast("string")).otherwise("-").alias("DELIV_QTY"),
        F.lit("").alias("DELIV_PER"),
    )


def sheet_bytes(names, rows):
    """A workbook with one sheet of inline text."""
    from xml.sax.saxutils import escape

    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    lines = []
    for number, row in enumerate([names, *rows], 1):
        cells = "".join(
            f'<c r="{chr(65 + i)}{number}" t="inlineStr"><is><t>{escape(str(x))}</t></is></c>' for i, x in enumerate(row)
        )
        lines.append(f'<row r="{number}">{cells}</row>')
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        book.writestr(
            "xl/workbook.xml",
            f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets><sheet name="s" sheetId="1" r:id="r1"/></sheets></workbook>',
        )
        book.writestr(
            "xl/_rels/workbook.xml.rels",
            '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
            '<Relationship Id="r1" Target="worksheets/sheet1.xml"/></Relationships>',
        )
        book.writestr(
            "xl/worksheets/sheet1.xml", f'<worksheet xmlns="{main}"><sheetData>{"".join(lines)}</sheetData></worksheet>'
        )
    return out.getvalue()


@query(
    "src02_workbook_named_csv",
    """SELECT 'day' AS timeframe, o_orderpriority AS symbol, o_orderdate AS timestamp, o_totalprice AS open,
              o_totalprice + 10 AS high, o_totalprice - 10 AS low, o_totalprice + 5 AS close, o_custkey AS volume,
              CASE WHEN o_orderkey % 5 > 1 THEN o_custkey END AS delivery, CAST(NULL AS DOUBLE) AS del_percent
       FROM orders WHERE o_orderkey % 4 <> 2""",
)
def src02(spark, sf_dir):
    path = put_files(spark, sf_dir, "src02", workbooks(spark, sf_dir))
    return ADAPTERS["day"].read(spark, listed(spark, path), None).drop("path")


@query(
    "src03_daily_index_csv",
    """SELECT 'day' AS timeframe, upper('Nifty ' || o_orderpriority) AS symbol, o_orderdate AS timestamp,
              CASE WHEN o_orderkey % 4 = 0 THEN o_totalprice + 5 ELSE o_totalprice END AS open, o_totalprice + 10 AS high,
              o_totalprice - 10 AS low, o_totalprice + 5 AS close, 1000 + o_custkey % 1000 AS volume,
              CAST(NULL AS BIGINT) AS delivery, CAST(NULL AS DOUBLE) AS del_percent
       FROM orders WHERE o_orderkey % 7 <> 0 AND o_orderkey % 5 <> 3""",
)
def src03(spark, sf_dir):
    key, price, day = F.col("o_orderkey"), F.col("o_totalprice"), "o_orderdate"
    date = (
        F.when(key % 5 == 0, F.date_format(day, "dd-MM-yyyy"))
        .when(key % 5 == 1, F.date_format(day, "d-MMM-yyyy"))
        .when(key % 5 == 2, F.date_format(day, "dd/MM/yyyy"))
        .when(key % 5 == 3, F.date_format(day, "yyyyMMdd"))
        .otherwise(F.date_format(day, "dd-MM-yyyy"))
    )
    rows = v.table(spark, sf_dir, "orders").select(
        F.concat(F.lit("Nifty "), "o_orderpriority").alias("Index Name"),
        date.alias("Index Date"),
        F.when(key % 4 == 0, "-").otherwise(price.cast("string")).alias("Open Index Value"),
        (price + 10).cast("string").alias("High Index Value"),
        (price - 10).cast("string").alias("Low Index Value"),
        F.when(key % 7 == 0, "-").otherwise((price + 5).cast("string")).alias("Closing Index Value"),
        F.lit("0.1").alias("Change(%)"),
        F.format_string("1,%03d", F.col("o_custkey") % 1000).alias("Volume"),
        F.lit("1").alias("P/E"),
    )
    path = folder(spark, sf_dir, "src03")
    write_csv(rows, path)
    return ADAPTERS["day_idx"].read(spark, listed(spark, path), None).drop("path")


ARCHIVE_ROWS = 5_000
MINUTE_HEADER = "Ticker,Date,Time,Open,High,Low,Close,Volume,Open Interest"


DERIVATIVES_HEADER = "TradDt,TckrSymb,OpnPric,HghPric,LwPric,ClsPric"


def archives(spark, sf_dir, name, suffix, extra_members=0, other_header=MINUTE_HEADER):
    """Files of minute lines as ZIP archives of at most 5,000 rows each.

    The member is in a folder, which does not count as a member. Every second archive has
    `extra_members` more and `other_header`.
    """
    event = F.col("event_id")
    line = F.concat_ws(
        ",",
        F.concat(F.col("symbol"), F.when(event % 2 == 0, F.lit(suffix)).otherwise(F.lit(suffix.replace(".NC", "")))),
        F.date_format("timestamp", "dd/MM/yyyy"),
        F.date_format("timestamp", "HH:mm:ss"),
        *[F.col(c).cast("string") for c in ("open", "high", "low", "close", "volume")],
        F.lit("0"),
    )
    rows = v.m1(spark, sf_dir, with_id=True)
    lines = rows.select(F.floor(event / ARCHIVE_ROWS).alias("archive"), line.alias("line"))

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        number = int(group["archive"].iloc[0])
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
            archive.writestr("data/", "")
            header = other_header if number % 2 else MINUTE_HEADER
            archive.writestr("data/minute.csv", "\n".join([header, *group["line"]]) + "\n")
            for i in range(extra_members if number % 2 else 0):
                archive.writestr(f"more_{i}.csv", MINUTE_HEADER + "\n")
        return pd.DataFrame({"name": [f"{number}.zip"], "content": [out.getvalue()]})

    return put_files(spark, sf_dir, name, lines.groupBy("archive").applyInPandas(pack, "name string, content binary"))


def minutes_sql(symbol: str, where: str = "true") -> str:
    return f"""{v.WITH_CANDLES} SELECT '1m' AS timeframe, {symbol} AS symbol, date_trunc('second', timestamp) AS timestamp,
        open, high, low, close, volume, delivery, del_percent FROM m1 WHERE {where}"""


@query("src04_minute_zip", minutes_sql("symbol", "symbol IN (SELECT symbol FROM dm)"))
def src04(spark, sf_dir):
    paths = listed(spark, archives(spark, sf_dir, "src04", ".NC.NSE"), "*.zip")
    return ADAPTERS["minute"].read(spark, paths, sets.universe(v.dm(spark, sf_dir))).drop("path")


@query("src05_minute_index_zip", minutes_sql("symbol"))
def src05(spark, sf_dir):
    paths = listed(spark, archives(spark, sf_dir, "src05", ".NSE_IDX"), "*.zip")
    return ADAPTERS["minute_idx"].read(spark, paths, None).drop("path")


@query(
    "src06_archive_member_gate",
    f"""SELECT CAST(event_id // {ARCHIVE_ROWS} AS VARCHAR) || '.zip' AS path,
        CASE WHEN (event_id // {ARCHIVE_ROWS}) % 2 = 0 THEN 1::BIGINT ELSE 3 END AS members,
        (event_id // {ARCHIVE_ROWS}) % 2 = 0 AS accepted FROM events GROUP BY event_id // {ARCHIVE_ROWS}""",
)
def src06(spark, sf_dir):
    path = archives(spark, sf_dir, "src06", ".NSE", extra_members=2)
    seen = files.archive_members(files.list_files(spark, path, "*.zip"))
    return seen.select(files.file_name(F.col("path")).alias("path"), "members", (F.col("members") == 1).alias("accepted"))


def table_path(spark, sf_dir, name, rows, compression="zstd"):
    path = folder(spark, sf_dir, name)
    tables.write_candles(rows, path, compression)
    return path


def stored(spark, sf_dir, name):
    """The candle views as a stored table."""
    return table_path(spark, sf_dir, name, v.candles(spark, sf_dir))


PARTITION_SQL = f"{v.WITH_CANDLES}, parts AS (SELECT DISTINCT timeframe, symbol FROM candles)"


@query(
    "src07_source_discovery",
    r"""WITH found AS (SELECT o_orderpriority AS name, string_agg(o_orderkey::VARCHAR, chr(10) ORDER BY o_orderkey) AS content
                       FROM orders GROUP BY 1)
        SELECT 'day:delivery_' || name || '.csv' AS source_key, 'day' AS kind,
               sha256(encode('adapter:2') || '\x00'::BLOB || encode(content)) AS fingerprint FROM found""",
)
def src07(spark, sf_dir):
    # One file per priority, so that the listing depends on the data, and one that the glob leaves out.
    lines = F.array_join(F.transform(F.array_sort(F.collect_list("o_orderkey")), lambda k: k.cast("string")), "\n")
    orders = v.table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.encode(lines, "utf-8").alias("content"))
    names = F.explode(F.array(F.concat(F.lit("delivery_"), "o_orderpriority", F.lit(".csv")), F.lit("other.csv")))
    path = put_files(spark, sf_dir, "src07", orders.select(names.alias("name"), "content"))
    return ADAPTERS["day"].discover(spark, path).select("source_key", "kind", "fingerprint")


@query(
    "src08_single_symbol",
    f"""{v.WITH_CANDLES} SELECT {', '.join(CANDLE_COLUMNS)} FROM candles
        WHERE timeframe = 'day' AND symbol = '4-NOT SPECIFIED' ORDER BY timestamp""",
)
def src08(spark, sf_dir):
    path = stored(spark, sf_dir, "src08")
    return tables.read_symbol(spark, path, "4-NOT SPECIFIED", "day").orderBy("timestamp")


@query(
    "src09_multi_symbol_scan",
    f"""{v.WITH_CANDLES} SELECT symbol, min(timestamp) AS first_date, max(timestamp) AS last_date, count(*) AS trading_days
        FROM candles WHERE timeframe = 'day' GROUP BY 1""",
)
def src09(spark, sf_dir):
    path = stored(spark, sf_dir, "src09")
    rows = spark.read.option("mergeSchema", True).parquet(f"{path}/timeframe=day/*/*")
    name = decode_symbol(F.regexp_extract(tables.file_path(), "symbol=([^/]+)/", 1))
    return rows.groupBy(name.alias("symbol")).agg(
        F.min("timestamp").alias("first_date"),
        F.max("timestamp").alias("last_date"),
        F.count(F.lit(1)).alias("trading_days"),
    )


@query(
    "src10_flat_layout",
    f"{v.WITH_CANDLES} SELECT {CANDLE_LIST} FROM candles",
)
def src10(spark, sf_dir):
    path = folder(spark, sf_dir, "src10")
    tables.write_flat(v.candles(spark, sf_dir), path)
    return tables.read_flat(spark, path, "day").unionByName(tables.read_flat(spark, path, "1m")).drop("filename")


@query(
    "src11_file_inventory",
    f"{v.WITH_CANDLES} SELECT timeframe, symbol, count(*) AS rows FROM candles GROUP BY 1, 2",
)
def src11(spark, sf_dir):
    files_of = tables.inventory(spark, stored(spark, sf_dir, "src11"))
    return files_of.groupBy("timeframe", "symbol").agg(F.sum("rows").alias("rows"))


@query(
    "src12_describe_schema",
    """SELECT * FROM (VALUES ('timestamp', 'timestamp_ntz'), ('open', 'double'), ('high', 'double'), ('low', 'double'),
        ('close', 'double'), ('volume', 'bigint'), ('delivery', 'bigint'), ('del_percent', 'double'))
        AS t(column_name, column_type) WHERE (SELECT count(*) FROM events) > 0""",
)
def src12(spark, sf_dir):
    # The footers of the written files, not the declared schema.
    path = stored(spark, sf_dir, "src12")
    return tables.describe(spark.read.parquet(f"{path}/timeframe=day/*/*")).select("column_name", "column_type")


@query(
    "src13_symbol_catalog",
    f"{PARTITION_SQL} SELECT symbol, string_agg(timeframe, ',' ORDER BY timeframe) AS timeframes FROM parts GROUP BY 1",
)
def src13(spark, sf_dir):
    listed_symbols = tables.catalog(tables.read_candles(spark, stored(spark, sf_dir, "src13")))
    return listed_symbols.select("symbol", F.concat_ws(",", "timeframes").alias("timeframes")).orderBy("symbol")


@query(
    "src14_derivatives_gate",
    f"""SELECT *, regexp_matches(header, '(?i)TckrSymb|SYMBOL') AND regexp_matches(header, '(?i)OpnPric|OPEN') AS header_ok FROM (
          SELECT CAST(event_id // {ARCHIVE_ROWS} AS VARCHAR) || '.zip' AS path, true AS has_csv,
                 CASE WHEN (event_id // {ARCHIVE_ROWS}) % 2 = 0 THEN '{MINUTE_HEADER}' ELSE '{DERIVATIVES_HEADER}' END AS header
          FROM events GROUP BY event_id // {ARCHIVE_ROWS})""",
)
def src14(spark, sf_dir):
    path = archives(spark, sf_dir, "src14", ".NSE", other_header=DERIVATIVES_HEADER)
    found = files.derivatives_gate(files.list_files(spark, path, "*.zip"))
    return found.withColumn("path", files.file_name(F.col("path")))


@query("snk01_source_cache", f"WITH {DAILY_SQL} SELECT 'day' AS kind, count(*) AS rows, min(timestamp) AS first, max(timestamp) AS last FROM daily")
def snk01(spark, sf_dir):
    rows = ADAPTERS["day"].read(spark, daily_files(spark, sf_dir, "snk01_raw"), None)
    path = folder(spark, sf_dir, "snk01")
    keyed = rows.withColumn("source_key", source_key("day", files.file_name(F.col("path"))))
    keyed = keyed.withColumn("kind", F.lit("day")).withColumn("cache_id", cache_id(F.col("path"))).drop("path")
    keyed.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("kind", "cache_id").parquet(path)
    return spark.read.parquet(path).groupBy("kind").agg(
        F.count(F.lit(1)).alias("rows"), F.min("timestamp").alias("first"), F.max("timestamp").alias("last")
    )


@query(
    "snk02_rows_brought_together",
    f"{v.WITH_CANDLES} SELECT timeframe, symbol, count(*) AS rows FROM candles GROUP BY 1, 2",
)
def snk02(spark, sf_dir):
    """The layout step of the sink: rows by (timeframe, symbol), large ones split."""
    return tables.arranged(v.candles(spark, sf_dir)).groupBy("timeframe", "symbol").agg(F.count(F.lit(1)).alias("rows"))


@query("snk03_partitioned_write", f"{v.WITH_CANDLES} SELECT lower(substr(symbol, 1, 1)) AS symbol_group, {CANDLE_LIST} FROM candles")
def snk03(spark, sf_dir):
    return tables.read_candles(spark, stored(spark, sf_dir, "snk03"))


@query("snk04_piece_compaction", f"{v.WITH_CANDLES} SELECT {CANDLE_LIST} FROM candles")
def snk04(spark, sf_dir):
    """Many small pieces per symbol become few sorted files."""
    pieces, path = folder(spark, sf_dir, "snk04_pieces"), folder(spark, sf_dir, "snk04")
    rows = v.candles(spark, sf_dir).withColumn("symbol_group", symbol_group(F.col("symbol")))
    scattered = rows.repartition(8, "timestamp").write.mode("overwrite").option("partitionOverwriteMode", "static")
    scattered.partitionBy(*PARTITION_COLUMNS).parquet(pieces)
    tables.write_candles(tables.read_candles(spark, pieces), path)
    return tables.read_candles(spark, path).drop("symbol_group")


DOUBLED_SQL = f"{v.WITH_CANDLES} SELECT symbol, timeframe, timestamp, "


@query(
    "snk05_timeframe_rewrite",
    f"{DOUBLED_SQL} CASE WHEN timeframe = 'day' THEN close * 2 ELSE close END AS close FROM candles",
)
def snk05(spark, sf_dir):
    path = stored(spark, sf_dir, "snk05")
    day = v.candles(spark, sf_dir).where(F.col("timeframe").isin(["day"]))
    tables.write_candles(day.withColumn("close", F.col("close") * 2), path)
    return tables.read_candles(spark, path).select("symbol", "timeframe", "timestamp", "close")


@query(
    "snk06_affected_symbols_rewrite",
    f"{DOUBLED_SQL} CASE WHEN symbol IN ('view', '2-HIGH') THEN close * 2 ELSE close END AS close FROM candles",
)
def snk06(spark, sf_dir):
    path = stored(spark, sf_dir, "snk06")
    rows = v.candles(spark, sf_dir)
    affected = sets.universe(rows).where(F.col("symbol").isin("view", "2-HIGH"))
    changed = sets.join_symbols(rows, affected, "left_semi").withColumn("close", F.col("close") * 2)
    tables.write_candles(changed, path)
    return tables.read_candles(spark, path).select("symbol", "timeframe", "timestamp", "close")


@query("snk07_remove_empty_outputs", f"{PARTITION_SQL} SELECT timeframe, symbol FROM parts WHERE NOT (timeframe = 'day' AND symbol = 'view')")
def snk07(spark, sf_dir):
    path = stored(spark, sf_dir, "snk07")
    left = v.candles(spark, sf_dir).where(~((F.col("timeframe") == "day") & (F.col("symbol") == "view")))
    stale = tables.partitions(tables.read_candles(spark, path)).join(
        tables.partitions(left), ["timeframe", "symbol"], "left_anti"
    )
    tables.drop_partitions(spark, path, stale)
    return tables.partitions(tables.read_candles(spark, path))


@query("snk08_published_whole", f"{v.WITH_CANDLES} SELECT timeframe, symbol, count(*) AS rows FROM candles GROUP BY 1, 2")
def snk08(spark, sf_dir):
    """Files put in place twice leave exactly the second rows."""
    path = folder(spark, sf_dir, "snk08")
    rows = v.candles(spark, sf_dir)
    tables.write_flat(rows.where(F.col("timeframe") == "day"), path)
    tables.write_flat(rows, path)
    both = tables.read_flat(spark, path, "day").unionByName(tables.read_flat(spark, path, "1m"))
    return both.groupBy("timeframe", "symbol").agg(F.count(F.lit(1)).alias("rows"))


for _codec in tables.CODECS:

    def _compressed(name: str):
        @query(f"snk09_compression_{name}", f"{v.WITH_CANDLES} SELECT {CANDLE_LIST} FROM candles WHERE timeframe = 'day'")
        def run(spark, sf_dir):
            day = v.candles(spark, sf_dir).where(F.col("timeframe") == "day")
            path = table_path(spark, sf_dir, f"snk09_{name}", day, name)
            return tables.read_candles(spark, path).drop("symbol_group")

    _compressed(_codec)


@query("snk10_universe_file", f"WITH {DAILY_SQL} SELECT DISTINCT symbol FROM daily")
def snk10(spark, sf_dir):
    path = folder(spark, sf_dir, "snk10")
    rows = ADAPTERS["day"].read(spark, daily_files(spark, sf_dir, "snk10_raw"), None)
    sets.universe(rows).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    return spark.read.parquet(path)


def page_files(spark, sf_dir, name):
    """The pages as files named by their number."""
    named = F.concat(F.col("page_id").cast("string"), F.lit(".html")).alias("name")
    return put_files(spark, sf_dir, name, v.table(spark, sf_dir, "pages").select(named, F.encode("html", "utf-8").alias("content")))


def page_number(path):
    return F.regexp_extract(path, r"(\d+)\.html$", 1).cast("bigint")


@query("snk11_checksums", "SELECT page_id AS path, octet_length(encode(html)) AS length, sha256(html) AS sha256 FROM pages")
def snk11(spark, sf_dir):
    path = page_files(spark, sf_dir, "snk11")
    found = files.checksums(files.list_files(spark, path, "*.html"))
    return found.withColumn("path", page_number(F.col("path")))


@query(
    "snk12_small_result",
    f"""{v.WITH_D1} SELECT symbol, timestamp, close FROM (
          SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY timestamp DESC) AS k FROM d1) WHERE k <= 5""",
)
def snk12(spark, sf_dir):
    """The last five rows of every symbol; the rank limit acts before the shuffle."""
    from barloom.operators.bars import last_rows

    return last_rows(v.d1(spark, sf_dir).select("symbol", "timestamp", "close"), 5, "timestamp")


@query("ext01_custom_adapter", "SELECT o_orderpriority AS symbol, count(*) AS n, sum(o_custkey)::BIGINT AS volume FROM orders GROUP BY 1")
def ext01(spark, sf_dir):
    """A new source kind: a parquet folder read by a few lines of DataFrame code."""
    from barloom.sources.adapters import Adapter

    def read(session, paths, universe):
        rows = session.read.parquet(*paths)
        return rows.select(F.col("o_orderpriority").alias("symbol"), F.col("o_custkey").alias("volume"))

    orders = Adapter("orders", "orders.parquet", 1, "day", read)
    paths = [row["path"] for row in files.list_files(spark, sf_dir, orders.glob).select("path").collect()]
    return orders.read(spark, paths, None).groupBy("symbol").agg(
        F.count(F.lit(1)).alias("n"), F.sum("volume").alias("volume")
    )
