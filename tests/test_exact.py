"""Sums, moments, order statistics and sketches against Python's own arithmetic."""

import math
import random
import statistics as pystats
import struct

import pytest
from pyspark.sql import functions as F

from ecometrics.operators import exact, ranking, rollup, sketches, statistics
from ecometrics.sources.tables import read_table

INF, NAN = float("inf"), float("nan")
CASES = {
    "far below": [4e-16] * 3,
    "small": [1.23456789e-12] * 4,
    "beyond longs": [1e19, 1.0],
    "nan": [NAN, 1.0],
    "inf": [INF, 1.0],
    "both infinities": [INF, -INF],
    "down": [-INF, 2.0],
    "wide": [1e300, 1e-300, -1e300, 1.0],
    "cancelled": [1e100, 1.0, -1e100],
    "subnormal": [5e-324] * 3 + [-5e-324],
    "border of normal": [2.2e-308, -1.1e-308],
    "overflow": [1.7e308, 1.7e308],
    "none": [None, None],
    "zeros": [0.0, -0.0],
    "half to even": [1.0, 2.0**-53],
    "above half": [1.0, 2.0**-53, 2.0**-106],
    "negative half": [-1.0, -(2.0**-53)],
    "above negative half": [-1.0, -(2.0**-53), -(2.0**-106)],
    "powers": [2.0**k for k in range(-1074, 1000, 37)],
    None: [0.1] * 10,
}


def random_cases(count, seed):
    rng = random.Random(seed)
    spans = ((-300, 300), (-3, 3), (-20, 20), (-320, -290))
    return {
        f"random {i}": [rng.choice((-1, 1)) * rng.random() * 10.0 ** rng.uniform(*rng.choice(spans)) for _ in range(rng.randint(1, 40))]
        for i in range(count)
    }


def true_sum(values):
    known = [v for v in values if v is not None]
    if not known:
        return None
    if any(map(math.isnan, known)) or (INF in known and -INF in known):
        return NAN
    try:
        return math.fsum(known)
    except OverflowError:
        return INF


def same(a, b):
    return a == b or (a is not None and b is not None and math.isnan(a) and math.isnan(b))


def table(spark, cases, parts=5, seed=1):
    rows = [(k, v) for k, values in cases.items() for v in values]
    random.Random(seed).shuffle(rows)
    return spark.createDataFrame(rows, "k string, x double").repartition(parts)


def test_sums_are_the_nearest_doubles(spark):
    cases = CASES | random_cases(60, 1)
    found = {r.k: r for r in exact.totals(table(spark, cases), ["k"], ["x"]).collect()}
    assert {k for k in cases if not same(found[k].sum_x, true_sum(cases[k]))} == set()
    assert all(found[k].n_x == sum(v is not None for v in values) for k, values in cases.items())
    mean = found["random 3"].mean_x
    assert mean == math.fsum(cases["random 3"]) / len(cases["random 3"])


def test_sums_do_not_depend_on_the_order_or_on_other_measures(spark):
    cases = random_cases(12, 2)
    runs = []
    for parts, seed in ((1, 5), (7, 6)):
        df = table(spark, cases, parts, seed).withColumn("y", F.col("x") * 3)
        found = exact.totals(df, ["k"], ["y", "x"], moments=["x"], keep={"low": (F.min("x"), F.min), "rows": (F.count("*"), F.sum)})
        runs.append({r.k: (r.sum_x, r.sum_y, r.low, r["rows"]) for r in found.collect()})
    assert runs[0] == runs[1]
    expected = {k: (math.fsum(v), math.fsum(x * 3 for x in v), min(v), len(v)) for k, v in cases.items()}
    assert runs[0] == expected


def test_sums_of_nothing(spark):
    empty = spark.createDataFrame([], "k string, x double")
    assert [tuple(r) for r in exact.totals(empty, [], ["x"], moments=["x"]).collect()] == [(None, 0, None, None)]
    assert exact.totals(empty, ["k"], ["x"]).count() == 0


def test_moments_survive_offsets_and_scales(spark):
    cases = {"offset": [1e8, 1e8 + 1, 1e8 + 2], "tiny": [1e-9, 2e-9, 4e-9], "one": [3.0], "across bins": [2.0**20 - 1, 2.0**20 + 1], "wide": [1e-5, 1.0, 1e9]}
    for values in (["x"], ["x", "y"]):
        df = table(spark, cases, 3).withColumn("y", F.col("x") * F.col("x"))
        found = {r.k: r.deviation_x for r in exact.totals(df, ["k"], values, moments=["x"]).collect()}
        assert found["offset"] == 1.0 and found["one"] is None and math.isclose(found["across bins"], math.sqrt(2))
        for name in ("tiny", "wide"):
            assert math.isclose(found[name], pystats.stdev(cases[name]), rel_tol=1e-12)


def test_class_statistics_of_small_values(spark):
    row = statistics.group_stats(spark.createDataFrame([("a", x) for x in (1.1e-13, 2.3e-13, 4.7e-13)], "k string, x double"), "k", "x").first()
    assert math.isclose(row.avg_efficiency, 2.7e-13, rel_tol=1e-15) and math.isclose(row.stddev_efficiency, pystats.stdev([1.1e-13, 2.3e-13, 4.7e-13]))


def test_class_statistics_scan_once(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).selectExpr("id % 2 AS k", "CAST(id AS double) AS x").write.parquet(path)
    df = statistics.group_stats(spark.read.parquet(path), "k", "x")
    df.collect()
    assert df._jdf.queryExecution().toString().split("Initial Plan")[0].split("Final Plan")[-1].count("FileScan") == 1


def test_rollups_add_exactly(spark):
    rng = random.Random(4)
    rows = [(rng.choice("ab"), rng.choice(["s", "t", None]), rng.random() * 10.0 ** rng.uniform(-12, 12), rng.random()) for _ in range(400)]
    df = spark.createDataFrame(rows, "a string, b string, x double, y double").repartition(6)
    found = rollup.multi_grain(df, ["a", "b"], "label", "all", "n", {"mean": "x"}, {"total": "x"}, {"share": ("y", "x", 100.0)}).collect()
    expected = {"all": rows} | {k: [r for r in rows if r[0] == k] for k in "ab"} | {k: [r for r in rows if r[1] == k] for k in ("s", "t", None)}
    assert len(found) == len(expected)
    for r in found:
        x, y = ([row[i] for row in expected[r.label]] for i in (2, 3))
        assert (r.n, r.total, r["mean"]) == (len(x), math.fsum(x), math.fsum(x) / len(x))
        assert r.share == math.fsum(y) / math.fsum(x) * 100.0


def key_of(x):
    if math.isnan(x):
        return (2047 << 52) + 1
    bits = struct.unpack("<q", struct.pack("<d", abs(x)))[0]
    return -bits if x < 0 else bits


def test_ordered_keys_are_the_bits_and_lead_back(spark):
    rng = random.Random(2)
    edges = [0.0, -0.0, 5e-324, -5e-324, 2.0**-1022, math.nextafter(2.0**-1022, 0), 1.0, -1.0, INF, -INF, NAN, 1.7976931348623157e308]
    powers = [y for k in range(-1074, 1024, 13) for y in (2.0**k, math.nextafter(2.0**k, 0), math.nextafter(2.0**k, INF))]
    values = [*edges, *powers, *(rng.choice((1, -1)) * rng.random() * 10.0 ** rng.uniform(-310, 308) for _ in range(2000))]
    df = ranking.with_key(spark.createDataFrame([(x,) for x in values], "x double"), "x", "key")
    rows = df.withColumn("back", ranking.of_key(F.col("key"))).collect()
    assert all(r.key == key_of(r.x) and same(r.x, r.back) for r in rows)


def test_medians_of_any_values_take_six_rounds(spark):
    rng = random.Random(3)
    cases = {
        "inf": [1.0, INF, INF], "wide": [1e-300, 1e300], "equal": [0.5] * 7, "nan": [NAN, 1.0, 2.0], "signs": [-5.0, -0.0, 0.0, 2.0],
        "infinities": [INF, -INF], "large": [1.7e308, 1.6e308], None: [1.0, 4.0], "many": [rng.gauss(0, 100) for _ in range(501)],
    }
    median = ranking.exact_median(table(spark, cases, 3), ["k"], "x")
    found = {r.k: r.median for r in median.collect()}
    for name, values in cases.items():
        ordered = sorted(values, key=lambda x: (x != x, x))
        low, high = ordered[(len(values) - 1) // 2], ordered[len(values) // 2]
        assert same(found[name], low if same(low, high) else low / 2 + high / 2), name
    scans = median._jdf.queryExecution().optimizedPlan().toString().count("Relation [")
    assert len(ranking.ROUNDS) == 6 and scans == 6


def test_selected_ranks(spark):
    df = spark.createDataFrame([(float(x),) for x in range(1, 101)], "x double")
    rows = ranking.selected(df, [], "x", lambda n: [F.lit(1), F.floor(n / 4), n]).collect()
    assert sorted((r["__side"], r.value) for r in rows) == [(0, 1.0), (1, 25.0), (2, 100.0)]


@pytest.fixture(scope="module")
def priced(spark):
    text = "CASE WHEN id % 3 = 0 THEN 'a' WHEN id % 30 = 1 THEN NULL ELSE 'b' END AS k"
    return spark.range(60_000).selectExpr(text, "CAST(hash(id) AS double) AS x", "date_add(date'2024-01-01', int(id % 45)) AS d").repartition(6)


def test_merged_sketches_keep_their_bound(priced):
    k = 256
    stored = sketches.period_sketches(priced, ["k"], "x", "d", "week", k)
    values = {r.k: sorted(r.v) for r in priced.groupBy("k").agg(F.collect_list("x").alias("v")).collect()}
    rows = sketches.quantiles(stored, ["k"], [0.05, 0.25, 0.5, 0.75, 0.99]).collect()
    assert len(rows) == 15
    for r in rows:
        ordered = values[r.k]
        rank = sum(x <= r.value for x in ordered) / len(ordered)
        assert r.n == len(ordered) and abs(rank - r.share) <= 1.5 * sketches.rank_error(k)
    whole = sketches.quantiles(stored, [], [0.5]).first()
    assert whole.n == 60_000
    once = {r.k: r.median for r in sketches.medians(priced, ["k"], "x", k).collect()}
    for name, ordered in values.items():
        assert abs(sum(x <= once[name] for x in ordered) / len(ordered) - 0.5) <= 1.5 * sketches.rank_error(k)


def test_small_sketches_are_exact_and_nothing_has_none(spark, tmp_path):
    rows = [("a", float(i), "2024-01-0%d" % (1 + i % 3)) for i in range(1, 8)] + [("a", NAN, "2024-01-01"), ("a", None, "2024-01-01"), ("a", 9.0, None), ("z", None, "2024-01-02")]
    df = spark.createDataFrame(rows, "k string, x double, d string").withColumn("d", F.to_date("d"))
    path = sketches.store(df, str(tmp_path / "s"), ["k"], "x", "d")
    stored = read_table(spark, path)
    found = [(r.k, r.share, r.value, r.n) for r in sketches.quantiles(stored, ["k"], [0.0, 0.5, 1.0]).collect()]
    assert found == [("a", 0.0, 1.0, 7), ("a", 0.5, 4.0, 7), ("a", 1.0, 7.0, 7)]
    one_day = sketches.quantiles(stored.filter(F.col("period") == F.lit("2024-01-01").cast("date")), ["k"], [1.0])
    assert "PartitionFilters: [isnotnull(period" in one_day._jdf.queryExecution().toString() and one_day.first().value == 6.0
    assert sketches.quantiles(stored.filter("false"), [], [0.5]).count() == 0
    stats = statistics.with_median(statistics.group_stats(df, "k", "x"), df.filter("x IS NOT NULL AND NOT isnan(x)"), "k", "x", k=64)
    assert [(r.k, r.median_efficiency) for r in stats.collect()] == [("a", 4.0)]
