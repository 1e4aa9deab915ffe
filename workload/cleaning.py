"""Cleaners over text built from the tables' own columns, on both sides by the same expression."""

from __future__ import annotations

from pyspark.sql import functions as F

from ecometrics.functions import calendar as c
from ecometrics.functions import numbers as n
from ecometrics.functions import text as t
from workload.models import sql_integer, sql_number, sql_stripped, sql_suffixed, sql_text
from workload.registry import query
from workload.star import money

CODES = (
    "CASE s_suppkey % 7 WHEN 0 THEN '  ' WHEN 1 THEN '' WHEN 2 THEN ' Not Listed ' WHEN 3 THEN 'not listed' "
    "ELSE chr(9) || s_name || '  ' END"
)


@query(
    f"""SELECT s_suppkey, {sql_text('code')} AS kept, lower({sql_text('code')}) AS lowered,
        CASE WHEN {sql_text('code')} = 'Not Listed' THEN 'UNLISTED' ELSE upper({sql_text('code')}) END AS listed,
        upper({sql_text('code')}) AS uppered
        FROM (SELECT *, {CODES} AS code FROM supplier)"""
)
def clean_codes(star):
    return star.supplier.withColumn("code", F.expr(CODES)).select(
        "s_suppkey",
        t.clean_text("code").alias("kept"),
        t.clean_lower("code").alias("lowered"),
        t.clean_upper("code", {"Not Listed": "UNLISTED"}).alias("listed"),
        t.clean_upper("code").alias("uppered"),
    )


CENTS = "CAST(round(o_totalprice * 100) AS BIGINT)"
PLAIN = (
    f"CASE o_orderkey % 12 WHEN 0 THEN '' WHEN 1 THEN '0' WHEN 2 THEN '5d' WHEN 3 THEN 'NaN' WHEN 4 THEN '1_000' "
    f"WHEN 5 THEN CAST(o_orderkey AS STRING) || '.5e-07' WHEN 6 THEN ' -' || {money(CENTS)} || ' ' "
    f"WHEN 7 THEN '1.5E-7' ELSE {money(CENTS)} END"
)


@query(f"SELECT o_orderkey, {sql_number('amount')} AS amount FROM (SELECT o_orderkey, {PLAIN} AS amount FROM orders)")
def clean_plain_number(star):
    return star.orders.select("o_orderkey", n.plain_number(F.expr(PLAIN)).alias("amount"))


DECORATED = (
    f"CASE o_orderkey % 9 WHEN 0 THEN 'USD ' || {money(CENTS)} WHEN 1 THEN '' WHEN 2 THEN 'free' "
    f"WHEN 3 THEN CAST(o_orderkey AS STRING) || '.5E-7 GWh' WHEN 4 THEN '~' || CAST(o_orderkey AS STRING) || '.25e-05' "
    f"WHEN 5 THEN '$-' || {money(CENTS)} WHEN 6 THEN '1-2' ELSE {money(CENTS)} || ' t' END"
)
STRICT = r"regexp_replace(amount, '[^0-9.\-e]', '', 'g')"


@query(
    f"""SELECT o_orderkey, {sql_stripped('amount')} AS lenient, {sql_number(STRICT)} AS strict
        FROM (SELECT o_orderkey, {DECORATED} AS amount FROM orders)"""
)
def clean_stripped_number(star):
    text = F.expr(DECORATED)
    return star.orders.select(
        "o_orderkey",
        n.stripped_number(text).alias("lenient"),
        n.stripped_number(text, strict=True).alias("strict"),
    )


CURRENCY = (
    f"CASE o_orderkey % 6 WHEN 0 THEN '$' || {money(CENTS)} WHEN 1 THEN '-5' WHEN 2 THEN '3.6e-05' WHEN 3 THEN '0' "
    f"WHEN 4 THEN 'N/A' ELSE '$1,' || lpad(CAST(o_orderkey % 1000 AS STRING), 3, '0') || ',000.50' END"
)
UNSIGNED = "regexp_replace(amount, '[^0-9.]', '', 'g')"


@query(
    f"""SELECT o_orderkey, {sql_number(UNSIGNED)} AS unsigned, {sql_stripped('amount')} AS signed
        FROM (SELECT o_orderkey, {CURRENCY} AS amount FROM orders)"""
)
def clean_currency_text(star):
    text = F.expr(CURRENCY)
    return star.orders.select(
        "o_orderkey", n.unsigned_amount(text).alias("unsigned"), n.stripped_number(text).alias("signed")
    )


SIZES = (
    "CASE p_partkey % 9 WHEN 0 THEN CAST(p_size AS STRING) || '.5k' WHEN 1 THEN CAST(p_size AS STRING) || 'M' "
    "WHEN 2 THEN CAST(p_size AS STRING) || 'b' WHEN 3 THEN '$' || CAST(p_size AS STRING) || '.5B' WHEN 4 THEN '1,5k' "
    "WHEN 5 THEN 'k' WHEN 6 THEN CAST(p_size AS STRING) || 'kb' WHEN 7 THEN CAST(p_size AS STRING) || 'k ' "
    "ELSE CAST(p_size AS STRING) END"
)


@query(
    f"""SELECT p_partkey, {sql_suffixed('size', k=10**3, m=10**6, b=10**9)} AS any_suffix,
        {sql_suffixed('size', b=10**9)} AS billions_only FROM (SELECT p_partkey, {SIZES} AS size FROM part)"""
)
def clean_suffix_kmb(star):
    text = F.expr(SIZES)
    return star.part.select(
        "p_partkey",
        n.currency_amount(text).alias("any_suffix"),
        n.currency_amount(text, n.BILLIONS).alias("billions_only"),
    )


PERCENT = "CAST(CAST(round(l_discount * 100) AS BIGINT) - 5 AS STRING) || CASE WHEN l_linenumber % 2 = 0 THEN '%' ELSE '' END"


@query(
    f"""SELECT l_returnflag, CAST(count(pct) AS BIGINT) AS known, min(pct) AS lowest, max(pct) AS highest, sum(pct) AS total
        FROM (SELECT l_returnflag, {sql_number("replace(text, '%', '')")} AS pct
              FROM (SELECT l_returnflag, {PERCENT} AS text FROM lineitem)) GROUP BY l_returnflag"""
)
def clean_percent_text(star):
    parsed = star.lineitem.select("l_returnflag", n.percent_number(F.expr(PERCENT)).alias("pct"))
    return parsed.groupBy("l_returnflag").agg(
        F.count("pct").alias("known"),
        F.min("pct").alias("lowest"),
        F.max("pct").alias("highest"),
        F.sum("pct").alias("total"),
    )


EXPONENTS = (
    "CASE p_partkey % 5 WHEN 0 THEN CAST(p_size AS STRING) || '.6e-05' WHEN 1 THEN CAST(p_size AS STRING) || 'e-05' "
    "WHEN 2 THEN CAST(p_size AS STRING) || '.5E+02' WHEN 3 THEN CAST(p_size AS STRING) || '.25e+1' ELSE 'n/a' END"
)


@query(
    f"""SELECT p_partkey, regexp_matches(amount, '^[0-9]+\\.[0-9]+e[+-][0-9]+$') AS scientific, {sql_number('amount')} AS amount
        FROM (SELECT p_partkey, {EXPONENTS} AS amount FROM part)"""
)
def scientific_text(star):
    text = F.expr(EXPONENTS)
    return star.part.select(
        "p_partkey", n.is_scientific(text).alias("scientific"), n.plain_number(text).alias("amount")
    )


WHOLE = (
    "CASE p_partkey % 7 WHEN 0 THEN ' ' || CAST(p_size AS STRING) || ' ' WHEN 1 THEN '12.5' WHEN 2 THEN 'abc' "
    "WHEN 3 THEN '-' || CAST(p_size AS STRING) WHEN 4 THEN '99999999999999999999' WHEN 5 THEN '' ELSE '+7' END"
)


@query(f"SELECT p_partkey, {sql_integer('size')} AS size FROM (SELECT p_partkey, {WHOLE} AS size FROM part)")
def safe_integer(star):
    return star.part.select("p_partkey", n.whole_number(F.expr(WHOLE)).alias("size"))


@query("SELECT p_partkey, CAST(round((p_partkey - 50) / 2.0::DOUBLE) AS BIGINT) AS half FROM part")
def rounded_integer(star):
    return star.part.select("p_partkey", n.rounded_long((F.col("p_partkey") - 50) / 2).alias("half"))


FREE = (
    "CASE p_partkey % 4 WHEN 0 THEN '< 0.' || lpad(CAST(p_size AS STRING), 2, '0') || ' kW' "
    "WHEN 1 THEN 'about ' || CAST(p_size AS STRING) || ' of 50' WHEN 2 THEN 'none' ELSE CAST(p_size AS STRING) || '.5k' END"
)


@query(f"SELECT p_partkey, {sql_number('regexp_extract(free, $$([0-9.]+)$$, 1)')} AS number FROM (SELECT p_partkey, {FREE} AS free FROM part)")
def number_in_text(star):
    return star.part.select("p_partkey", n.first_number(F.expr(FREE)).alias("number"))


@query(
    """SELECT c_custkey, c_mktsegment || ' - ' || c_name AS label, c_mktsegment AS first_part, c_name AS second_part,
       CAST(NULL AS VARCHAR) AS third_part FROM customer"""
)
def composed_label(star):
    labelled = star.customer.select("c_custkey", t.label("c_mktsegment", "c_name").alias("label"))
    parts = {"first_part": 1, "second_part": 2, "third_part": 3}
    return labelled.withColumns({name: t.label_part("label", i) for name, i in parts.items()})


@query(
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day,
       CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_orderdate AS DATE) END AS parsed FROM orders"""
)
def day_text_and_back(star):
    days = star.orders.select("o_orderkey", c.day_text("o_orderdate").alias("day"))
    text = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("day "), "day")).otherwise(F.col("day"))
    return days.withColumn("parsed", c.parsed_day(text))
