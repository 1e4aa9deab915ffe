"""Windows over chunks of a series against windows over the whole of it."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ecometrics.operators import long_series as long

ROWS = 4000


@pytest.fixture(scope="module")
def ticks(spark):
    """Most rows have one key, some none; values are missing now and then, moments repeat."""
    key = "CASE WHEN id % 10 < 7 THEN 'hot' WHEN id % 10 = 7 THEN NULL ELSE concat('k', id % 5) END AS k"
    value = "CASE WHEN id % 37 <> 0 THEN CAST(100 + pmod(hash(id), 41) AS double) END AS x"
    change = "CASE WHEN id % 11 <> 0 THEN (pmod(hash(id, 7), 201) - 100) / 5000.0D END AS c"
    return spark.range(ROWS).selectExpr("id", f"{key}", "timestamp_seconds(id DIV 3) AS t", value, change).repartition(7)


@pytest.mark.parametrize("chunk_rows", [20, 97, 100_000])
def test_frames_equal_plain_windows(ticks, chunk_rows):
    placed = long.chunked(ticks, "k", ["t", "id"], chunk_rows)
    columns = {"ma": long.moving_average(20, "x"), "d": long.change("x"), "up": long.is_rise("x")}
    found = long.plain(long.with_frames(placed, "k", columns, 19, chunk_rows))
    whole = Window.partitionBy("k").orderBy("t", "id")
    wanted = ticks.withColumns({name: made(whole) for name, made in columns.items()})
    assert found.columns == wanted.columns
    assert sorted(map(tuple, found.collect()), key=lambda r: r[0]) == sorted(map(tuple, wanted.collect()), key=lambda r: r[0])


@pytest.mark.parametrize("chunk_rows", [1, 64, 100_000])
def test_running_products_and_first_values_equal_plain_windows(ticks, chunk_rows):
    placed = long.chunked(ticks, "k", ["t", "id"], chunk_rows)
    found = long.with_rebased(long.with_compounded(placed, "k", "c", "index", 50.0), "k", "x", "rebased")
    whole = Window.partitionBy("k").orderBy("t", "id")
    upto = whole.rowsBetween(Window.unboundedPreceding, 0)
    wanted = ticks.select(
        "id", (F.product(1 + F.coalesce("c", F.lit(0.0))).over(upto) * 50).alias("index"), (F.col("x") / F.first("x").over(whole) * 100).alias("rebased"),
    )
    expected = {r.id: r for r in wanted.collect()}
    rows = found.collect()
    assert len(rows) == ROWS
    for r in rows:
        assert r["index"] == pytest.approx(max(expected[r.id]["index"], 0.1), rel=1e-11)
        assert r.rebased == pytest.approx(expected[r.id].rebased, rel=1e-12) if expected[r.id].rebased is not None else r.rebased is None


def test_a_hot_key_is_spread_over_chunks(ticks):
    placed = long.chunked(ticks, "k", ["t", "id"], 100)
    sizes = placed.groupBy("k", long.CHUNK).count().collect()
    assert max(r["count"] for r in sizes) == 100 and sum(r.k == "hot" for r in sizes) == ROWS * 7 // 10 // 100
    plan = long.with_frames(placed, "k", {"d": long.change("x")}, 1, 100)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(k" in plan and "__part" in plan.split("hashpartitioning(")[1].split(")")[0]


def test_frames_may_not_reach_over_a_chunk(ticks):
    with pytest.raises(ValueError):
        long.with_frames(ticks, "k", {}, 101, 100)
