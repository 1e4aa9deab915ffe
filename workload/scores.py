"""Enrichment, ratios, scores, bands, class statistics, ranks and roll-ups on the star schema."""

from __future__ import annotations

from pyspark.sql import functions as F

from ecometrics.functions import bands as b
from ecometrics.functions import measures as m
from ecometrics.functions.numbers import rounded_long
from ecometrics.functions.text import join_key
from ecometrics.operators import ranking, sketches, statistics
from ecometrics.operators.joins import enrich, filled, highest, merge_sections, not_yet_in
from ecometrics.operators.rollup import multi_grain
from ecometrics.plans import marts
from ecometrics.session import settle
from ecometrics.sources.tables import literal_table
from workload import models
from workload.registry import agreed, agreed_sql, query
from workload.star import BASE_SQL, QUANTITY, REVENUE_CENTS, customer_base, supplier_base

POSITIVE = models.sql_positive


@query(
    f"""WITH {BASE_SQL}
    SELECT c_custkey, n_name, qty, revenue AS revenue, coalesce(revenue, c_acctbal) AS worth,
           {POSITIVE('revenue', 'qty')} AS revenue_per_unit,
           CASE WHEN qty > 0 THEN qty * 1000000.0::DOUBLE END AS qty_scaled
    FROM customer LEFT JOIN customer_base ON k = c_custkey LEFT JOIN nation ON n_nationkey = c_nationkey"""
)
def customer_metrics(star):
    known = enrich(star.customer, customer_base(star), {"c_custkey": "k"}, ["qty", "revenue"])
    placed = enrich(known, star.nation, {"c_nationkey": "n_nationkey"}, ["n_name"])
    return filled(placed, "worth", "revenue", "c_acctbal").select(
        "c_custkey",
        "n_name",
        "qty",
        "revenue",
        "worth",
        m.positive_ratio("revenue", "qty").alias("revenue_per_unit"),
        m.scaled_if_positive("qty", 1e6).alias("qty_scaled"),
    )


@query(
    """SELECT s_suppkey, n_nationkey, n_name FROM (
         SELECT s_suppkey, CASE WHEN s_suppkey % 6 <> 0 THEN 'nation_' || s_nationkey END AS place FROM supplier)
       LEFT JOIN nation ON lower(n_name) = place"""
)
def messy_key_join(star):
    written = F.expr("CASE WHEN s_suppkey % 6 <> 0 THEN chr(9) || upper('nation_') || CAST(s_nationkey AS STRING) || ' ' END")
    suppliers = star.supplier.select("s_suppkey", written.alias("place"))
    met = enrich(suppliers, star.nation, {"place": "n_name"}, {"n_nationkey": "n_nationkey", "n_name": "n_name"}, join_key)
    return met.drop("place")


@query(
    f"""WITH {BASE_SQL} SELECT k, qty, CASE WHEN k = 1 THEN 1.0 ELSE qty / nullif(m, 0) END::DOUBLE AS to_benchmark
    FROM supplier_base, (SELECT max(qty)::DOUBLE AS m FROM supplier_base WHERE k = 1)"""
)
def relative_to_benchmark(star):
    base = settle(supplier_base(star).select("k", "qty"))
    benchmark = highest(base, "qty", F.col("k") == 1)
    return base.withColumn("to_benchmark", m.share_of_benchmark("qty", F.col("k") == 1, benchmark))


@query(
    f"""WITH {BASE_SQL} SELECT k, CASE WHEN qty = 0 THEN 100.0 ELSE 100.0::DOUBLE * (1.0::DOUBLE - qty / top_qty) END::DOUBLE AS inverse_score,
      100.0::DOUBLE * (revenue / top_revenue) AS share_score
    FROM supplier_base, (SELECT max(qty)::DOUBLE AS top_qty, max(revenue)::DOUBLE AS top_revenue FROM supplier_base)"""
)
def scores_against_highest(star):
    base = supplier_base(star).select("k", "qty", "revenue")
    base = settle(base)
    return base.select(
        "k",
        m.inverse_share_score("qty", highest(base, "qty")).alias("inverse_score"),
        m.share_of_highest("revenue", highest(base, "revenue")).alias("share_score"),
    )


PARTS_SQL = f"""parts AS (SELECT p_partkey, p_size AS esg_score, p_retailprice * 10 AS market_cap,
    coalesce(qty, 0) / 100.0::DOUBLE AS co2_emissions_mt
  FROM part LEFT JOIN (SELECT l_partkey, sum({QUANTITY}) AS qty FROM lineitem GROUP BY l_partkey) ON l_partkey = p_partkey)"""


def measured_parts(star):
    sold = star.lineitem.groupBy("l_partkey").agg(F.sum(F.expr(QUANTITY)).alias("qty"))
    parts = enrich(star.part, sold, {"p_partkey": "l_partkey"}, ["qty"])
    return parts.select(
        "p_partkey",
        F.col("p_size").alias("esg_score"),
        (F.col("p_retailprice") * 10).alias("market_cap"),
        (F.coalesce("qty", F.lit(0)) / 100.0).alias("co2_emissions_mt"),
    )


PENALTY = "CASE WHEN co2_emissions_mt / 10 < 0.5 THEN co2_emissions_mt / 10 ELSE 0.5 END"


@query(
    f"""WITH {PARTS_SQL}, scored AS (
      SELECT *, esg_score::DOUBLE * (1.0::DOUBLE - ({PENALTY})::DOUBLE) AS combined_environmental_score FROM parts)
    SELECT p_partkey, {models.SIZE_SQL} AS size_band, {models.ESG_SQL} AS esg_band, {models.PERFORMANCE_SQL} AS performance_band,
      CASE WHEN co2_emissions_mt = 0 THEN 'Zéro émission' ELSE {models.EMISSION_SQL} END AS emission_band,
      CASE WHEN esg_score >= 40 THEN 'tier 1' WHEN esg_score >= 35 THEN 'tier 2' WHEN esg_score >= 30 THEN 'tier 3' ELSE 'tier 4' END AS tier,
      combined_environmental_score AS combined, combined_environmental_score * 2 AS normalised
    FROM scored"""
)
def part_bands(star):
    scored = measured_parts(star).withColumn("score", m.penalised_score("esg_score", "co2_emissions_mt"))
    return scored.select(
        "p_partkey",
        b.size_band("market_cap").alias("size_band"),
        b.esg_band("esg_score").alias("esg_band"),
        b.performance_band("score").alias("performance_band"),
        b.emission_band("co2_emissions_mt").alias("emission_band"),
        b.score_tier(F.col("esg_score") * 2).alias("tier"),
        F.col("score").alias("combined"),
        m.scaled("score", 2).alias("normalised"),
    )


@query(
    f"""SELECT n_nationkey, region, {models.REGION_SQL} AS region_group
    FROM (SELECT n_nationkey, CASE r_name WHEN 'AMERICA' THEN CASE n_nationkey % 2 WHEN 0 THEN 'North America' ELSE 'South America' END
            WHEN 'MIDDLE EAST' THEN 'Oceania' ELSE upper(r_name[1]) || lower(r_name[2:]) END AS region
          FROM nation JOIN region ON r_regionkey = n_regionkey)"""
)
def region_groups(star):
    nations = enrich(star.nation, star.region, {"n_regionkey": "r_regionkey"}, ["r_name"], how="inner")
    half = F.when(F.col("n_nationkey") % 2 == 0, "North America").otherwise("South America")
    named = F.when(F.col("r_name") == "AMERICA", half).when(F.col("r_name") == "MIDDLE EAST", "Oceania")
    region = named.otherwise(F.initcap("r_name"))
    return nations.select("n_nationkey", region.alias("region"), b.region_band(region).alias("region_group"))


ASSETS_SQL = f"""assets AS (
  SELECT 'Cryptocurrency' AS asset_type, name AS asset_name, 'C' || k AS asset_symbol, cents / 100.0::DOUBLE AS current_price,
         revenue AS market_cap, CASE WHEN k % 11 = 0 THEN 0 WHEN k % 13 <> 0 THEN qty / 1000.0::DOUBLE END AS co2_emissions_mt,
         qty / 10.0::DOUBLE AS energy_consumption, qty / 7.0::DOUBLE AS environmental_score, segment AS asset_subtype,
         CAST(NULL AS VARCHAR) AS region, CAST(NULL AS BIGINT) AS year_founded, 'Digital Asset' AS main_focus
  FROM customer_base
  UNION ALL
  SELECT 'Stock', name, 'S' || k, cents / 100.0::DOUBLE, revenue, qty / 100.0::DOUBLE, qty / 1000.0::DOUBLE,
         (k % 50)::DOUBLE, n_name, n_name, 1900 + k % 120, 'Focus ' || k % 9
  FROM supplier_base JOIN nation ON n_nationkey = nation),
star_overview AS (
  SELECT asset_type, asset_name, asset_symbol, current_price, market_cap, co2_emissions_mt, energy_consumption,
         {POSITIVE('market_cap', 'co2_emissions_mt')} AS green_efficiency, environmental_score,
         CASE WHEN co2_emissions_mt = 0 THEN 'Impact zéro' ELSE {models.ECOLOGY_SQL} END AS environmental_category,
         asset_subtype, CAST(round(environmental_score) AS BIGINT) AS estimated_esg, region, year_founded, main_focus
  FROM assets)"""
OVERVIEW_SQL = f"WITH {BASE_SQL}, {ASSETS_SQL}"


def overview(star):
    """Customers and suppliers as one table of assets, of the shape of the investment overview."""
    price, cap = (F.col("cents") / 100.0).alias("current_price"), F.col("revenue").alias("market_cap")
    emissions = F.when(F.col("k") % 11 == 0, 0.0).when(F.col("k") % 13 != 0, F.col("qty") / 1000.0)
    coins = customer_base(star).select(
        F.lit(marts.CRYPTO).alias("asset_type"),
        F.col("name").alias("asset_name"),
        F.concat(F.lit("C"), F.col("k").cast("string")).alias("asset_symbol"),
        price,
        cap,
        emissions.alias("co2_emissions_mt"),
        (F.col("qty") / 10.0).alias("energy_consumption"),
        (F.col("qty") / 7.0).alias("environmental_score"),
        F.col("segment").alias("asset_subtype"),
        F.lit(None).cast("string").alias("region"),
        F.lit(None).cast("bigint").alias("year_founded"),
        F.lit("Digital Asset").alias("main_focus"),
    )
    located = enrich(supplier_base(star), star.nation, {"nation": "n_nationkey"}, ["n_name"], how="inner")
    stocks = located.select(
        F.lit(marts.STOCK).alias("asset_type"),
        F.col("name").alias("asset_name"),
        F.concat(F.lit("S"), F.col("k").cast("string")).alias("asset_symbol"),
        price,
        cap,
        (F.col("qty") / 100.0).alias("co2_emissions_mt"),
        (F.col("qty") / 1000.0).alias("energy_consumption"),
        (F.col("k") % 50).cast("double").alias("environmental_score"),
        F.col("n_name").alias("asset_subtype"),
        F.col("n_name").alias("region"),
        (1900 + F.col("k") % 120).alias("year_founded"),
        F.concat(F.lit("Focus "), (F.col("k") % 9).cast("string")).alias("main_focus"),
    )
    return (
        coins.unionByName(stocks)
        .withColumns(
            {
                "green_efficiency": m.positive_ratio("market_cap", "co2_emissions_mt"),
                "environmental_category": b.ecology_band("co2_emissions_mt"),
                "estimated_esg": rounded_long("environmental_score"),
            }
        )
        .select(*marts.OVERVIEW_COLUMNS)
    )


@query(f"{OVERVIEW_SQL} SELECT * FROM star_overview")
def asset_overview(star):
    return overview(star)


@query(
    f"""{OVERVIEW_SQL}, stats AS ({models.stats_sql('star_overview')}),
    middle AS (SELECT asset_type, quantile_disc(green_efficiency, 0.5) AS median_efficiency FROM star_overview GROUP BY asset_type)
    SELECT {agreed_sql('avg_efficiency', 'stddev_efficiency')} FROM (
      SELECT asset_type, mean AS avg_efficiency, high AS max_efficiency, low AS min_efficiency, median_efficiency,
        deviation AS stddev_efficiency, peers AS count_assets FROM stats JOIN middle USING (asset_type))"""
)
def group_stats(star):
    measured = settle(overview(star).select("asset_type", "green_efficiency"), "measured")
    stats = statistics.group_stats(measured, "asset_type", "green_efficiency")
    found = statistics.with_median(stats, measured, "asset_type", "green_efficiency")
    return agreed(found, "avg_efficiency", "stddev_efficiency")


@query(
    """SELECT priority, share, value, n FROM (
      SELECT o_orderpriority AS priority, year(o_orderdate) AS y, unnest([0.1::DOUBLE, 0.5::DOUBLE, 0.9::DOUBLE]) AS share,
        unnest(quantile_disc(o_totalprice, [0.1, 0.5, 0.9])) AS value, count(*) AS n FROM orders GROUP BY 1, 2)
    WHERE y = 1995"""
)
def sketch_quantiles(star):
    """Prices of one year out of monthly sketches, which up to ``k`` values are exact."""
    stored = settle(sketches.period_sketches(star.orders, ["o_orderpriority"], "o_totalprice", "o_orderdate", "month", 8192), "sketches")
    year = stored.filter(F.col("period").between(F.lit("1995-01-01").cast("date"), F.lit("1995-12-31").cast("date")))
    return sketches.quantiles(year, ["o_orderpriority"], [0.1, 0.5, 0.9]).withColumnRenamed("o_orderpriority", "priority")


@query(
    f"""{OVERVIEW_SQL} SELECT asset_type, median(green_efficiency) AS median_efficiency
    FROM star_overview WHERE green_efficiency IS NOT NULL GROUP BY asset_type"""
)
def group_median(star):
    return ranking.exact_median(overview(star), ["asset_type"], "green_efficiency", "median_efficiency")


@query(
    f"""{OVERVIEW_SQL}, {models.metrics_sql('star_overview')}
    SELECT {agreed_sql(*models.METRIC_DIGITS, places=models.METRIC_PLACES)} FROM carbon_efficiency_metrics"""
)
def efficiency_metrics(star):
    found = statistics.efficiency_metrics(settle(overview(star), "overview"))
    return agreed(found, *models.METRIC_DIGITS, places=models.METRIC_PLACES)


@query(
    f"""{OVERVIEW_SQL}, {models.comparison_sql('star_overview')}
    SELECT {agreed_sql(*models.COMPARISON_DIGITS)} FROM environmental_impact_comparison"""
)
def impact_comparison(star):
    return agreed(marts.environmental_impact_comparison(overview(star)), *models.COMPARISON_DIGITS)


@query(
    f"""SELECT coalesce(l_returnflag, l_linestatus, 'all') AS grain, count(*) AS n,
      CAST(sum({REVENUE_CENTS}) AS DOUBLE) / 100 / nullif(CAST(sum({QUANTITY}) AS BIGINT), 0) AS price_per_unit
    FROM lineitem GROUP BY GROUPING SETS ((l_returnflag), (l_linestatus), ())"""
)
def revenue_by_grain(star):
    lines = star.lineitem.select(
        "l_returnflag", "l_linestatus", F.expr(REVENUE_CENTS).alias("cents"), F.expr(QUANTITY).alias("quantity")
    )
    return multi_grain(
        lines,
        grains=["l_returnflag", "l_linestatus"],
        label="grain",
        total_label="all",
        count="n",
        means={},
        sums={"cents": "cents", "quantity": "quantity"},
        ratios={},
    ).select("grain", "n", m.divided(F.col("cents") / 100.0, F.col("quantity")).alias("price_per_unit"))


LINE = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query(
    f"""SELECT l_returnflag, l_extendedprice, {', '.join(LINE)}, row_number() OVER (PARTITION BY l_returnflag
      ORDER BY l_extendedprice DESC NULLS LAST, {', '.join(LINE)}) AS price_rank FROM lineitem"""
)
def rank_in_large_class(star):
    lines = star.lineitem.select("l_returnflag", "l_extendedprice", *LINE)
    return ranking.rank_within(lines, ["l_returnflag"], ranking.descending("l_extendedprice", *LINE), "price_rank")


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def keys_not_yet_fetched(star):
    fetched = star.orders.filter(F.col("o_orderstatus") == "P").select(F.col("o_custkey").alias("c_custkey"))
    return not_yet_in(star.customer, fetched, "c_custkey").select("c_custkey", "c_name")


@query(
    """SELECT c_custkey, o.n AS orders, p.spent AS spending, f.top AS highest
    FROM customer LEFT JOIN (SELECT o_custkey, count(*)::VARCHAR AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) o ON o.o_custkey = c_custkey
    LEFT JOIN (SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(18,2)))::VARCHAR AS spent FROM orders WHERE o_orderstatus = 'P' GROUP BY 1) p ON p.o_custkey = c_custkey
    LEFT JOIN (SELECT o_custkey, max(o_orderpriority) AS top FROM orders WHERE o_orderstatus = 'O' GROUP BY 1) f ON f.o_custkey = c_custkey"""
)
def merged_sections(star):
    def section(status, value):
        rows = star.orders.filter(F.col("o_orderstatus") == status).groupBy(F.col("o_custkey").alias("c_custkey"))
        return rows.agg(value.cast("string").alias("value")), "value"

    return merge_sections(
        star.customer,
        "c_custkey",
        {
            "orders": section("F", F.count(F.lit(1))),
            "spending": section("P", F.sum(F.col("o_totalprice").cast("decimal(18,2)"))),
            "highest": section("O", F.max("o_orderpriority")),
        },
    )


@query(
    """SELECT p_partkey, tier FROM part LEFT JOIN (VALUES (0, 'low'), (1, 'middle'), (2, 'high')) v(step, tier)
       ON step = CAST(floor(p_size / 20.0) AS BIGINT)"""
)
def literal_table_lookup(star):
    tiers = literal_table(star.spark, [(0, "low"), (1, "middle"), (2, "high")], ["step", "tier"])
    stepped = star.part.withColumn("step", F.floor(F.col("p_size") / 20.0))
    return enrich(stepped, tiers, ["step"], ["tier"]).select("p_partkey", "tier")
