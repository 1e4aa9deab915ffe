"""Screens, look-ups, facets, peers, filters and data-quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ecometrics.functions.bands import coin_class
from ecometrics.functions.numbers import first_number
from ecometrics.operators import quality, screening
from ecometrics.operators.joins import enrich
from ecometrics.operators.ranking import top
from ecometrics.session import scratch_path
from ecometrics.sources import tables
from workload.registry import query


@query(
    """SELECT s_suppkey, n_name, r_name, s_acctbal FROM supplier JOIN nation ON n_nationkey = s_nationkey
       JOIN region ON r_regionkey = n_regionkey
       WHERE r_name IN ('ASIA', 'EUROPE') AND n_name IN ('NATION_2', 'NATION_3', 'NATION_7', 'NATION_8') AND s_acctbal >= 1000"""
)
def facet_screen(star):
    nations = enrich(star.nation, star.region, {"n_regionkey": "r_regionkey"}, ["r_name"], how="inner")
    suppliers = enrich(star.supplier, nations, {"s_nationkey": "n_nationkey"}, ["n_name", "r_name"], how="inner")
    members = {"r_name": ["ASIA", "EUROPE"], "n_name": ["NATION_2", "NATION_3", "NATION_7", "NATION_8"]}
    chosen = screening.screen(suppliers, members=members, at_least={"s_acctbal": 1000})
    return chosen.select("s_suppkey", "n_name", "r_name", "s_acctbal")


@query("SELECT count(*) AS n FROM part WHERE p_type IN ('LARGE', 'ECONOMY') AND p_size >= 10 AND p_retailprice <= 1000")
def screened_count(star):
    members = {"p_type": ["LARGE", "ECONOMY"]}
    chosen = screening.screen(star.part, members, at_least={"p_size": 10}, at_most={"p_retailprice": 1000})
    return chosen.agg(F.count(F.lit(1)).alias("n"))


@query("SELECT p_partkey, p_type, p_size / 1000.0::DOUBLE AS power FROM part WHERE p_type IN ('SMALL', 'LARGE') AND p_size <= 25")
def text_number_screen(star):
    written = F.format_string("< 0.%03d kW", "p_size")
    parts = star.part.withColumn("power", first_number(written))
    chosen = screening.screen(parts, {"p_type": ["SMALL", "LARGE"]}, at_most={"power": 0.025})
    return chosen.select("p_partkey", "p_type", "power")


@query("SELECT o_orderpriority FROM orders WHERE o_orderkey = 42")
def key_lookup(star):
    return screening.look_up(star.orders, "o_orderkey", 42, "o_orderpriority")


@query("SELECT DISTINCT 'p_type' AS facet, p_type AS value FROM part UNION ALL SELECT DISTINCT 'p_brand', p_brand FROM part")
def facet_values(star):
    return screening.facet_values(star.part, "p_type", "p_brand")


PEERS_SQL = """SELECT p_partkey, peer, position FROM (
  SELECT a.p_partkey, b.p_partkey AS peer, row_number() OVER (PARTITION BY a.p_partkey ORDER BY b.p_name, b.p_partkey) AS position
  FROM part a JOIN (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_name, p_partkey) AS pos FROM part) b
  ON a.p_brand = b.p_brand AND a.p_partkey <> b.p_partkey AND pos <= 4) WHERE position <= 3"""


@query(PEERS_SQL)
def peers_top3(star):
    return screening.peers(star.part, "p_partkey", "p_brand", "p_name")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def top_orders(star):
    return top(star.orders.select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), F.asc("o_orderkey")], 10)


@query("SELECT s_suppkey, s_acctbal FROM supplier ORDER BY s_acctbal, s_suppkey")
def sorted_listing(star):
    return star.supplier.select("s_suppkey", "s_acctbal").orderBy("s_acctbal", "s_suppkey")


@query(
    """SELECT c_custkey, CASE WHEN c_mktsegment IN ('btc', 'eth', 'ltc', 'xrp', 'bch') THEN 'Crypto Majeure' ELSE 'Crypto Alternative' END AS class,
       CASE WHEN c_custkey % 6 = 0 THEN 'btc' ELSE c_mktsegment END AS symbol,
       CASE WHEN c_custkey % 6 = 0 THEN 'Crypto Majeure' ELSE 'Crypto Alternative' END AS symbol_class
       FROM customer WHERE c_name LIKE 'Customer#%1' AND (c_acctbal < 0 OR c_mktsegment <> 'BUILDING') AND c_mktsegment IS NOT NULL"""
)
def compound_predicates(star):
    kept = star.customer.filter(
        F.col("c_name").like("Customer#%1")
        & ((F.col("c_acctbal") < 0) | (F.col("c_mktsegment") != "BUILDING"))
        & F.col("c_mktsegment").isNotNull()
    )
    symbol = F.when(F.col("c_custkey") % 6 == 0, "btc").otherwise(F.col("c_mktsegment"))
    return kept.select(
        "c_custkey",
        coin_class("c_mktsegment").alias("class"),
        symbol.alias("symbol"),
        coin_class(symbol).alias("symbol_class"),
    )


GAPS = "CASE WHEN p_partkey % 5 = 0 THEN '  ' WHEN p_partkey % 11 = 0 THEN chr(9) || chr(10) WHEN p_partkey % 13 = 0 THEN '\u202f' WHEN p_partkey % 7 = 0 THEN NULL ELSE p_name END"


@query(f"SELECT p_partkey, name FROM (SELECT p_partkey, {GAPS} AS name FROM part) WHERE name IS NOT NULL AND NOT regexp_full_match(name, '[\\s\\p{{Z}}]*')")
def known_and_not_blank(star):
    named = star.part.select("p_partkey", F.expr(GAPS).alias("name"))
    return screening.not_blank(screening.present(named, "name"), "name")


PATCHY = "CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_custkey END"


def _check_sql(check: str, column: str, count: str) -> str:
    return f"SELECT '{check}' AS \"check\", '{column}' AS \"column\", CAST(({count}) AS BIGINT) AS failures"


@query(
    _check_sql("not_null", "o_custkey", f"SELECT count(*) FROM orders WHERE ({PATCHY}) IS NULL")
    + " UNION ALL "
    + _check_sql("not_null", "o_orderkey", "0")
)
def quality_not_null(star):
    return quality.not_null(star.orders.withColumn("o_custkey", F.expr(PATCHY)), "o_custkey", "o_orderkey")


@query(
    _check_sql("unique", "c_custkey", "0")
    + " UNION ALL "
    + _check_sql("unique", "l_orderkey", "SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1)")
)
def quality_unique(star):
    return quality.unique(star.customer, "c_custkey").unionByName(quality.unique(star.lineitem, "l_orderkey"))


@query(_check_sql("accepted_values", "o_orderstatus", "SELECT count(*) FROM orders WHERE o_orderstatus NOT IN ('F', 'O')"))
def quality_accepted_values(star):
    return quality.accepted_values(star.orders, "o_orderstatus", ["F", "O"])


@query(
    _check_sql("relationships", "l_orderkey", "SELECT count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')")
)
def quality_relationships(star):
    settled = star.orders.filter(F.col("o_orderstatus") != "P")
    return quality.relationship(star.lineitem, "l_orderkey", settled, "o_orderkey")


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def quality_duplicates(star):
    return quality.duplicates(star.lineitem, "l_orderkey", "l_linenumber")


@query(
    """SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
       QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_extendedprice DESC) = 1"""
)
def keep_first_duplicate(star):
    lines = star.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice")
    return quality.keep_first(lines, ["l_orderkey", "l_linenumber"], [F.desc("l_extendedprice")])


@query("SELECT 'orders' AS name, count(*) AS n FROM orders UNION ALL SELECT 'part', count(*) FROM part")
def loaded_counts(star):
    """Counted by the writes that load them."""
    loads = {"orders": star.orders.select("o_orderkey"), "part": star.part}
    counts = [(name, tables.publish_counted(df, scratch_path(star.spark, name))) for name, df in loads.items()]
    return tables.literal_table(star.spark, counts, ["name", "n"])
