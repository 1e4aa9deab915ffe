import math
import random
import statistics as pystats

import pytest
from pyspark.sql import functions as F

from ecometrics.operators import joins, quality, ranking, rollup, screening
from ecometrics.operators import statistics as stats
from ecometrics.plans import marts


def plan_of(df):
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    return df._jdf.queryExecution().explainString(mode)


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows in one class and a third sharing one value, with NULLs in class and value."""
    draw = random.Random(7)
    rows = []
    for i in range(6000):
        name = "hot" if i % 3 == 0 else draw.choice(["a", "b", "c", None])
        value = 5.0 if draw.random() < 0.33 else draw.choice([None, float(draw.randrange(100))])
        rows.append((i, name, value))
    return rows, spark.createDataFrame(rows, "id int, class string, value double").repartition(16).cache()


def brute_ranks(rows):
    ranks = {}
    for name in {r[1] for r in rows}:
        members = [r for r in rows if r[1] == name]
        members.sort(key=lambda r: (r[2] is None, -(r[2] or 0), r[0]))
        ranks.update({r[0]: n for n, r in enumerate(members, 1)})
    return ranks


def test_rank_within_numbers_every_row_of_a_skewed_class(skewed):
    rows, df = skewed
    ranked = ranking.rank_within(df, ["class"], ranking.descending("value", "id"), "rank").collect()
    assert {r.id: r["rank"] for r in ranked} == brute_ranks(rows)


def test_rank_within_uses_several_slices(skewed, spark):
    _, df = skewed
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranked = ranking.rank_within(df, ["class"], ranking.descending("value", "id"), "rank")
        assert {r.id: r["rank"] for r in ranked.collect()} == brute_ranks(skewed[0])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_exact_median(skewed):
    rows, df = skewed
    known = {}
    for _, name, value in rows:
        if value is not None:
            known.setdefault(name, []).append(value)
    found = {r["class"]: r.median for r in ranking.exact_median(df, ["class"], "value").collect()}
    assert found == {name: pystats.median(v) for name, v in known.items()}


def test_first_per_class_trims_before_the_shuffle(skewed):
    rows, df = skewed
    firsts = ranking.first_per_class(df, ["class"], [F.asc("id")], 2)
    expected = {name: sorted(r[0] for r in rows if r[1] == name)[:2] for name in {r[1] for r in rows}}
    found = {}
    for r in firsts.collect():
        found.setdefault(r["class"], []).append(r.id)
    assert {k: sorted(v) for k, v in found.items()} == expected
    assert "WindowGroupLimit" in plan_of(firsts) and "Partial" in plan_of(firsts)


def test_group_stats_against_brute_force(skewed):
    rows, df = skewed
    for r in stats.with_median(stats.group_stats(df, "class", "value"), df, "class", "value").collect():
        known = [v for _, name, v in rows if name == r["class"] and v is not None]
        assert r.count_assets == len(known)
        assert (r.min_efficiency, r.max_efficiency) == (min(known), max(known))
        assert math.isclose(r.avg_efficiency, pystats.fmean(known))
        assert math.isclose(r.stddev_efficiency, pystats.stdev(known))
        assert r.median_efficiency == sorted(known)[math.ceil(len(known) / 2) - 1]


def test_single_member_has_no_deviation(spark):
    row = stats.group_stats(spark.createDataFrame([("a", 1.0)], "k string, x double"), "k", "x").first()
    assert row.stddev_efficiency is None and row.count_assets == 1


def test_invariants_of_class_relative_measures(skewed):
    rows, df = skewed
    joined = stats.with_group_stats(df, "class", "value")
    assert joined.count() == len(rows)
    from ecometrics.functions import measures as m

    scored = joined.filter("class is not null and value is not null").select(
        "class",
        m.z_score("value", "avg_efficiency", "stddev_efficiency").alias("z"),
        m.min_max_score("value", "min_efficiency", "max_efficiency").alias("scaled"),
    )
    for r in scored.groupBy("class").agg(F.avg("z").alias("z"), F.min("scaled").alias("lo"), F.max("scaled").alias("hi")).collect():
        assert abs(r.z) < 1e-9 and (r.lo, r.hi) == (0.0, 100.0)


def overview_rows():
    blank = dict.fromkeys(marts.OVERVIEW_COLUMNS)
    facts = [
        ("Stock", "one", 100.0, 1.0, 100.0, "x"),
        ("Stock", "two", 300.0, 1.0, 300.0, "y"),
        ("Stock", "three", None, 2.0, None, "x"),
        ("Stock", "four", 10.0, None, 50.0, None),
        ("Cryptocurrency", "coin", 5.0, 0.0, None, "z"),
    ]
    return [
        {**blank, "asset_type": t, "asset_name": n, "market_cap": cap, "co2_emissions_mt": co2, "green_efficiency": e, "asset_subtype": s}
        for t, n, cap, co2, e, s in facts
    ]


OVERVIEW = (
    "asset_type string, asset_name string, asset_symbol string, current_price double, market_cap double, "
    "co2_emissions_mt double, energy_consumption double, green_efficiency double, environmental_score double, "
    "environmental_category string, asset_subtype string, estimated_esg bigint, region string, year_founded bigint, main_focus string"
)


@pytest.fixture(scope="module")
def small_overview(spark):
    rows = [tuple(r[c] for c in marts.OVERVIEW_COLUMNS) for r in overview_rows()]
    return spark.createDataFrame(rows, OVERVIEW)


def test_rank_percentile_may_exceed_a_hundred(small_overview):
    found = {r.asset_name: r for r in stats.efficiency_metrics(small_overview).collect()}
    assert set(found) == {"one", "two", "three", "coin"}
    # "four" counts as a peer but is not listed; "three" is ranked without being a peer.
    assert [found[n].efficiency_rank for n in ("two", "one", "three")] == [1, 2, 3]
    assert found["three"].efficiency_rank_percentile == 100.0
    assert found["three"].green_investment_category == "Inefficace"
    assert found["coin"].green_investment_category == "Impact zéro"
    assert found["coin"].efficiency_rank_percentile is None
    assert found["coin"].eco_roi_usd_per_ton_co2 is None
    assert found["two"].relative_efficiency == 2.0


def test_comparison_grains_add_up(small_overview):
    rows = {r.asset_type: r for r in marts.environmental_impact_comparison(small_overview).collect()}
    assert set(rows) == {"Stock", "Cryptocurrency", "x", "y", "z", None, "Tous actifs"}
    assert rows["Tous actifs"].total_assets == 5 == rows["Stock"].total_assets + rows["Cryptocurrency"].total_assets
    assert rows["Tous actifs"].total_market_cap == 415.0
    assert rows["x"].total_assets == 2 and rows["x"].carbon_intensity_per_million_usd == 3.0 / 100.0 * 1e6
    assert rows[None].avg_co2_emissions is None and rows[None].carbon_intensity_per_million_usd == 0.0


def test_comparison_of_nothing_has_one_row(small_overview):
    rows = marts.environmental_impact_comparison(small_overview.filter("false")).collect()
    assert [(r.asset_type, r.total_assets, r.total_market_cap) for r in rows] == [("Tous actifs", 0, None)]


def test_rollup_reads_its_input_once(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).selectExpr("id % 2 AS a", "id % 3 AS b", "CAST(id AS double) AS x").write.parquet(path)
    df = rollup.multi_grain(
        spark.read.parquet(path).selectExpr("string(a) AS a", "string(b) AS b", "x"),
        ["a", "b"], "label", "all", "n", {"mean": "x"}, {"total": "x"}, {},
    )
    assert df.count() == 6
    df.collect()
    final = plan_of(df).split("Initial Plan")[0]
    assert final.count("FileScan") == 1 and "ReusedExchange" in final


def test_enrich_keeps_detail_rows_and_ignores_null_keys(spark):
    detail = spark.createDataFrame([(1, " A"), (2, None), (3, "c")], "id int, k string")
    side = spark.createDataFrame([("a ", 10), (None, 20), ("a", 11)], "key string, v int")
    from ecometrics.functions.text import join_key

    expected = sorted([(1, " A", 10), (1, " A", 11), (2, None, None), (3, "c", None)], key=str)
    plain = joins.enrich(detail, side, {"k": "key"}, ["v"], join_key)
    assert sorted(map(tuple, plain.collect()), key=str) == expected
    repeated = joins.enrich_repeated(detail, side, {"k": "key"}, ["v"], join_key)
    assert sorted(map(tuple, repeated.collect()), key=str) == expected


def test_filtered_maximum_shares_the_scan(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 9.0)], "k int, x double")
    found = df.select(joins.highest(df, "x", F.col("k") == 1).alias("one"), joins.highest(df, "x").alias("all")).first()
    assert tuple(found) == (5.0, 9.0)



def test_slices_of_a_ranking_grow_with_the_input(spark, tmp_path):
    from ecometrics.session import input_bytes, tune

    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.range(50_000).write.parquet(str(tmp_path / "t"))
    size = input_bytes(spark, str(tmp_path / "t"))
    assert size > 100_000 and input_bytes(spark, str(tmp_path / "none")) == 0
    try:
        tune(spark, 40 * 2**30)
        ranked = ranking.rank_within(spark.range(1000).selectExpr("id % 2 AS c", "id"), ["c"], [F.asc("id")])
        assert spark.conf.get("spark.sql.shuffle.partitions") == "160"
        rows = ranked.collect()
        assert sorted(r["rank"] for r in rows if r.c == 1) == list(range(1, 501))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_merge_sections(spark):
    keys = spark.createDataFrame([("a",), ("b",)], "t string")
    power = spark.createDataFrame([("a", "p")], "t string, v string")
    emissions = spark.createDataFrame([("a", "e"), ("b", "f"), ("z", "g")], "t string, v string")
    merged = joins.merge_sections(keys, "t", {"power": (power, "v"), "emissions": (emissions, "v")})
    assert sorted(map(tuple, merged.collect())) == [("a", "p", "e"), ("b", None, "f")]


def test_not_yet_in(spark):
    candidates = spark.createDataFrame([("a",), ("b",)], "k string")
    assert [r.k for r in joins.not_yet_in(candidates, spark.createDataFrame([("a",)], "k string"), "k").collect()] == ["b"]


def test_peers_against_brute_force(skewed):
    rows, df = skewed
    found = {}
    for r in screening.peers(df, "id", "class", "value").orderBy("position").collect():
        found.setdefault(r.id, []).append(r.peer)
    for i, name, _ in rows:
        if name is None:
            assert i not in found
    by_class = {}
    for r in rows:
        by_class.setdefault(r[1], []).append(r)
    for members in by_class.values():
        members.sort(key=lambda r: (r[2] is not None, r[2] or 0, r[0]))
    for i, name, _ in rows[:300]:
        if name is not None:
            assert found[i] == [r[0] for r in by_class[name] if r[0] != i][:3]


def test_screens(spark):
    df = spark.createDataFrame([("NA", "wind", 80, "0.1 kW"), ("EU", "sun", 60, "2 kW"), ("EU", "sun", None, "x")],
                               "region string, focus string, esg int, power string")
    assert screening.screen(df, {"region": ["EU"], "focus": ["sun"]}, {"esg": 60}).count() == 1
    assert screening.screen(df).count() == 3
    assert screening.look_up(df, "region", "NA", "esg").first().esg == 80
    facets = sorted(map(tuple, screening.facet_values(df, "region", "focus").collect()))
    assert facets == [("focus", "sun"), ("focus", "wind"), ("region", "EU"), ("region", "NA")]
    assert screening.present(df, "esg").count() == 2


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, "F", 9), (1, "O", 8), (None, "X", None), (None, None, 7)], "k int, s string, parent int")
    found = {tuple(r)[:2]: r.failures for r in quality.row_checks(df, ["k", "s"], {"s": ["F", "O"]}).collect()}
    assert found == {("not_null", "k"): 2, ("not_null", "s"): 1, ("accepted_values", "s"): 1}
    assert quality.unique(df, "k").first().failures == 1
    parents = spark.createDataFrame([(9,)], "id int")
    assert quality.relationship(df, "parent", parents, "id").first().failures == 2
    kept = quality.keep_first(df, ["k"], [F.asc("s")]).collect()
    assert sorted((str(r.k), str(r.s)) for r in kept) == [("1", "F"), ("None", "None"), ("None", "X")]


def test_checks_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "k int")
    assert quality.not_null(empty, "k").first().failures == 0
    assert quality.unique(empty, "k").first().failures == 0
    assert quality.relationship(empty, "k", empty, "k").first().failures == 0
