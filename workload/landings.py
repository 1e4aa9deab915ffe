"""Sources and sinks: the tables are landed in a source's format and read back through its reader."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ecometrics.operators.joins import enrich
from ecometrics.session import scratch_path
from ecometrics.sources import documents, files, large_documents, tables
from ecometrics.sources.schemas import COMPANY_FOOTPRINT, NETWORK_RECORD
from workload.registry import query
from workload.star import money

SUPPLIER = T.StructType(
    [
        T.StructField("s_suppkey", T.LongType()),
        T.StructField("s_name", T.StringType()),
        T.StructField("s_nationkey", T.IntegerType()),
        T.StructField("s_acctbal", T.DoubleType()),
    ]
)


def _landed_suppliers(star) -> str:
    path = scratch_path(star.spark, "csv")
    star.supplier.write.option("header", True).csv(path)
    return path


@query("SELECT * FROM supplier")
def csv_fixed_schema(star):
    return files.read_csv(star.spark, _landed_suppliers(star), SUPPLIER)


@query("SELECT s_suppkey::INT AS s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def csv_inferred_schema(star):
    return files.read_csv(star.spark, _landed_suppliers(star))


@query(
    """SELECT 'row' AS kind, count(*) AS n, sum(c_custkey)::BIGINT AS keys FROM customer WHERE c_custkey % 9 <> 0
       UNION ALL SELECT 'rejected', count(*), CAST(NULL AS BIGINT) FROM customer WHERE c_custkey % 9 = 0"""
)
def csv_quarantine(star):
    """Every ninth line is a merge marker instead of a record."""
    quoted = F.format_string('"%d","%s","T%d","1.5","2.5","3.5"', "c_custkey", "c_name", "c_custkey")
    path = scratch_path(star.spark, "csv")
    marker = F.concat(F.lit("<<<<<<< "), "c_name")
    star.customer.select(F.when(F.col("c_custkey") % 9 == 0, marker).otherwise(quoted)).write.text(path)
    lines = files.read_lines(star.spark, path, COMPANY_FOOTPRINT, header=False)
    kind = F.when(files.is_malformed("company"), "rejected").otherwise("row")
    key = F.when(~files.is_malformed("company"), F.col("id").cast("bigint"))
    return lines.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"), F.sum(key).alias("keys"))


def _landed_prices(star) -> str:
    """Two dated landings; the later one lacks every third coin."""
    root = scratch_path(star.spark, "json")
    coins = star.customer.select("c_custkey", F.lower("c_name").alias("coin"), F.col("c_acctbal").alias("price_usd"))
    coins.select("coin", "price_usd").write.json(f"{root}/coin_price_2025-01-01.json")
    later = coins.filter(F.col("c_custkey") % 3 != 0).select("coin", (F.col("price_usd") - 1).alias("price_usd"))
    later.write.json(f"{root}/coin_price_2025-02-01.json")
    return root


PRICE = T.StructType([T.StructField("coin", T.StringType()), T.StructField("price_usd", T.DoubleType())])


@query(
    """SELECT lower(c_name) AS coin, CASE WHEN c_custkey % 3 = 0 THEN c_acctbal ELSE c_acctbal - 1 END AS price_usd
       FROM customer"""
)
def json_latest_snapshot(star):
    root = _landed_prices(star)
    return files.read_json_glob(star.spark, f"{root}/*_price_*.json", PRICE, key="coin", snapshot="latest")


@query(
    """SELECT lower(c_name) AS coin, c_acctbal AS price_usd, '2025-01-01' AS day FROM customer
       UNION ALL SELECT lower(c_name), c_acctbal - 1, '2025-02-01' FROM customer WHERE c_custkey % 3 <> 0"""
)
def json_all_snapshots(star):
    root = _landed_prices(star)
    rows = files.read_json_glob(star.spark, f"{root}/*_price_*.json", PRICE)
    return rows.withColumn("day", F.date_format(files.file_date(), "yyyy-MM-dd"))


CALENDAR = T.StructType(
    [T.StructField("date", T.StringType()), T.StructField("symbol", T.StringType()), T.StructField("price", T.DoubleType())]
)
NEWS = T.ArrayType(T.StructType([T.StructField("day", T.StringType()), T.StructField("headline", T.StringType())]))
SECTION = T.StructType(
    [
        T.StructField("profile", T.StructType([T.StructField("name", T.StringType())])),
        T.StructField("quote", T.StructType([T.StructField("c", T.DoubleType())])),
        T.StructField("news", NEWS),
    ]
)


def _nested(star):
    """One document per customer; every fifth customer has no news."""
    item = F.struct(F.lit("2025-01-05").alias("day"), F.concat(F.lit("About "), "c_name").alias("headline"))
    other = F.struct(F.lit("2025-01-06").alias("day"), F.col("c_mktsegment").alias("headline"))
    news = F.when(F.col("c_custkey") % 5 != 0, F.array(item, other))
    section = F.struct(
        F.struct(F.col("c_name").alias("name")).alias("profile"),
        F.struct(F.col("c_acctbal").alias("c")).alias("quote"),
        news.alias("news"),
    )
    symbol = F.concat(F.lit("C"), F.col("c_custkey").cast("string"))
    document = F.to_json(F.struct(F.create_map(symbol, section).alias("stocks"), F.lit(None).cast("string").alias("ipo_calendar")))
    return star.customer.select(document.alias("document"))


@query("SELECT 'C' || c_custkey AS symbol, c_name AS name, c_acctbal AS price FROM customer")
def nested_documents(star):
    path = scratch_path(star.spark, "documents")
    _nested(star).write.text(path)
    landed = star.spark.read.text(path).withColumnRenamed("value", "document")
    rows = documents.explode_documents(landed, SECTION)
    return rows.select("symbol", F.col("profile.name").alias("name"), F.col("quote.c").alias("price"))


@query(
    """SELECT 'C' || c_custkey AS symbol, v.day, CASE WHEN v.day IS NULL THEN NULL WHEN v.n = 1 THEN 'About ' || c_name ELSE c_mktsegment END AS headline
       FROM customer JOIN (VALUES (1, '2025-01-05'), (2, '2025-01-06'), (0, NULL)) v(n, day)
       ON CASE WHEN c_custkey % 5 = 0 THEN n = 0 ELSE n > 0 END"""
)
def nested_news(star):
    rows = documents.explode_documents(_nested(star), SECTION)
    return documents.explode_items(rows.select("symbol", "news"), "news")


@query("SELECT 'C' || c_custkey AS symbol, c_name AS name, c_acctbal AS price FROM customer")
def large_document(star):
    """All customers as entries of a single indented file, which is read by byte ranges."""
    entry = F.regexp_extract("document", r'^\{"stocks":\{(.*)\}\}$', 1)
    lines = _nested(star).select(F.lit(1).alias("n"), F.concat(F.lit("    "), entry, F.lit(",")).alias("value"))
    ends = [(0, '{"version": 1, "stocks": {'), (2, '    "last": {}'), (3, '  }, "ipo_calendar": {"a": {"profile": {"name": "}\\\\"}}}}')]
    whole = lines.unionByName(star.spark.createDataFrame(ends, "n int, value string"))
    path = scratch_path(star.spark, "document")
    whole.coalesce(1).sortWithinPartitions("n").select("value").write.text(path)
    rows = large_documents.explode_large_document(star.spark, path, SECTION).filter("symbol <> 'last'")
    return rows.select("symbol", F.col("profile.name").alias("name"), F.col("quote.c").alias("price"))


def _payloads(star):
    symbol = F.concat(F.lit("C"), F.col("c_custkey").cast("string"))
    good = F.to_json(F.create_map(symbol, F.create_map(F.lit("price"), F.col("c_acctbal").cast("string"))))
    error = F.to_json(F.create_map(symbol, F.create_map(F.lit("Information"), F.lit("limit reached"))))
    return star.customer.select(F.when(F.col("c_custkey") % 3 == 0, error).otherwise(good).alias("document"))


@query(
    """SELECT 'C' || c_custkey AS symbol, c_custkey % 3 = 0 AS rejected,
       CASE WHEN c_custkey % 3 <> 0 THEN c_acctbal END AS price FROM customer"""
)
def payload_split(star):
    rows = documents.flag_payloads(_payloads(star))
    return rows.select("symbol", "rejected", F.element_at("payload", "price").try_cast("double").alias("price"))


@query("SELECT s_name AS symbol FROM supplier WHERE s_suppkey % 4 <> 0")
def symbol_lines(star):
    path = scratch_path(star.spark, "symbols")
    line = F.when(F.col("s_suppkey") % 4 == 0, F.lit("  ")).otherwise(F.concat(F.lit("\t"), "s_name", F.lit(" ")))
    star.supplier.select(line).write.text(path)
    return files.read_symbols(star.spark, path)


@query(
    """SELECT 's' || s_suppkey AS ticker, s_name AS power, 'N' || s_nationkey AS electricity,
       CASE WHEN s_suppkey % 3 <> 0 THEN 'none' END AS emissions FROM supplier"""
)
def quoted_records(star):
    path = scratch_path(star.spark, "records")
    missing = F.when(F.col("s_suppkey") % 3 == 0, F.lit("None")).otherwise(F.lit("{'detail': 'none'}"))
    record = F.format_string(
        "{'ticker': 's%d', 'power': {'detail': '%s'}, 'electricity': {'detail': 'N%d'}, 'emissions': %s}",
        F.col("s_suppkey"),
        F.col("s_name"),
        F.col("s_nationkey"),
        missing,
    )
    star.supplier.select(record).write.text(path)
    rows = files.read_quoted_records(star.spark, path, NETWORK_RECORD)
    sections = ("power", "electricity", "emissions")
    return rows.select("ticker", *[F.col(f"{section}.detail").alias(section) for section in sections])


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events WHERE event_id % 4 <> 0")
def valid_shape(star):
    """Every fourth document is no JSON object."""
    broken = F.when(F.col("event_id") % 4 == 0, F.lit("[1, 2")).otherwise(F.col("props"))
    shape = T.StructType([T.StructField("k", T.LongType())])
    return documents.of_shape(star.events.select("event_id", broken.alias("document")), shape)


@query(
    """SELECT event_type, sum(CAST(json_extract(props, '$.k') AS BIGINT))::BIGINT AS total,
       count(*) FILTER (WHERE json_extract(props, '$.absent') IS NOT NULL) AS absent FROM events GROUP BY 1"""
)
def json_field(star):
    fields = star.events.select(
        "event_type",
        documents.field("props", "$.k", "bigint").alias("k"),
        documents.field("props", "$.absent", "double").alias("absent"),
    )
    return fields.groupBy("event_type").agg(F.sum("k").alias("total"), F.count("absent").alias("absent"))


@query("SELECT * FROM nation JOIN region ON r_regionkey = n_regionkey")
def published_table(star):
    """Published twice: the second run replaces the first."""
    path = scratch_path(star.spark, "table")
    nations = enrich(star.nation, star.region, {"n_regionkey": "r_regionkey"}, ["r_regionkey", "r_name"], how="inner")
    for _ in range(2):
        tables.publish(nations, path)
    return tables.read_table(star.spark, path)


@query("SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'first' ELSE 'second' END AS batch FROM customer")
def accumulated_table(star):
    """The second batch brings every key twice and rows without a key; known keys stay as they were.  It comes twice."""
    path = scratch_path(star.spark, "table")
    keys = star.customer.select("c_custkey")
    first = keys.filter(F.col("c_custkey") % 2 == 0).withColumn("batch", F.lit("first"))
    tables.publish(first, path)
    again = keys.withColumn("batch", F.explode(F.array(F.lit("third"), F.lit("second"))))
    unkeyed = keys.select(F.lit(None).cast("bigint").alias("c_custkey"), F.lit("none").alias("batch"))
    for _ in range(2):
        grown = tables.accumulate(again.unionByName(unkeyed), path, "c_custkey", first.schema)
    return grown


@query("SELECT c_custkey::VARCHAR AS coin, c_name AS price_usd, (c_custkey % 3)::INT AS drift FROM customer")
def drifting_headers(star):
    """Company footprints land under three generations of headers and meet under the logical ones."""
    landed = []
    for drift in range(3):
        names = [headers[min(drift, len(headers) - 1)] for headers in COMPANY_FOOTPRINT.columns.values()]
        values = ["c_custkey", "c_name", "c_mktsegment", "c_acctbal", "c_nationkey", "c_custkey"]
        part = star.customer.filter(F.col("c_custkey") % 3 == drift)
        path = scratch_path(star.spark, f"drift-{drift}")
        part.select(*[F.col(v).cast("string").alias(n) for v, n in zip(values, names, strict=True)]).write.parquet(path)
        landed.append(COMPANY_FOOTPRINT.unify(star.spark.read.parquet(path)).withColumn("drift", F.lit(drift)))
    rows = reduce(DataFrame.unionByName, landed)
    return rows.select(F.col("id").alias("coin"), F.col("company").alias("price_usd"), "drift")


@query(
    """SELECT strftime(o_orderdate, '%Y-%m-%d') AS date, 'O' || o_orderkey AS symbol, o_totalprice AS price FROM orders
       WHERE o_orderstatus = 'P'"""
)
def calendar_section(star):
    """The second section of nested documents: one document per day, a list of offerings."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd").alias("date")
    symbol = F.concat(F.lit("O"), F.col("o_orderkey").cast("string")).alias("symbol")
    offers = star.orders.filter(F.col("o_orderstatus") == "P").select(day, symbol, F.col("o_totalprice").alias("price"))
    listed = offers.groupBy("date").agg(F.collect_list(F.struct("date", "symbol", "price")).alias("ipoCalendar"))
    section = F.struct(F.struct("ipoCalendar").alias("ipo_calendar"))
    path = scratch_path(star.spark, "calendar")
    listed.select(F.to_json(section)).write.text(path)
    landed = star.spark.read.text(path).withColumnRenamed("value", "document")
    return documents.explode_calendar(landed, CALENDAR)


@query(
    f"""SELECT o_orderpriority AS ticker, strftime(o_orderdate, '%Y') AS date, count(*) AS n,
        sum(CAST(o_totalprice AS DECIMAL(18,2)))::DOUBLE AS total FROM orders GROUP BY 1, 2"""
)
def json_sink(star):
    path = scratch_path(star.spark, "json")
    cents = "CAST(round(o_totalprice * 100) AS BIGINT)"
    rows = star.orders.select(
        F.col("o_orderpriority").alias("ticker"),
        F.date_format("o_orderdate", "yyyy").alias("date"),
        F.expr(money(cents)).alias("amount"),
    )
    tables.write_json(rows, path, ["ticker", "date"])
    back = star.spark.read.schema("amount string, ticker string, date string").json(path)
    return back.groupBy("ticker", "date").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("amount").cast("decimal(18,2)")).cast("double").alias("total")
    )
