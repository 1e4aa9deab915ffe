import datetime as dt
import math
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from ecometrics.operators import series as s

START = dt.date(2024, 1, 1)


@pytest.fixture(scope="module")
def prices():
    draw = random.Random(3)
    rows = []
    for key in ("a", "b"):
        price = 100.0
        for day in range(120):
            price = max(1.0, price * (1 + draw.uniform(-0.1, 0.1)))
            rows.append((key, START + dt.timedelta(days=day), round(price, 2), draw.randrange(1000)))
    return rows


@pytest.fixture(scope="module")
def series(spark, prices):
    return spark.createDataFrame(prices, "key string, date date, price double, volume bigint").repartition(8)


@pytest.fixture(scope="module")
def frames(prices):
    df = pd.DataFrame(prices, columns=["key", "date", "price", "volume"])
    return {key: part.reset_index(drop=True) for key, part in df.groupby("key")}


def column(df, key, name):
    return [r[name] for r in df.filter(F.col("key") == key).orderBy("date").collect()]


def same(found, expected):
    assert len(found) == len(expected)
    for a, b in zip(found, expected, strict=True):
        assert (a is None and pd.isna(b)) or math.isclose(a, b, rel_tol=1e-9)


def test_moving_averages_wait_until_the_frame_is_full(series, frames):
    df = series.withColumns({"ma20": s.moving_average(20), "ma50": s.moving_average(50)})
    for key, frame in frames.items():
        same(column(df, key, "ma20"), frame.price.rolling(window=20).mean().tolist())
        same(column(df, key, "ma50"), frame.price.rolling(window=50).mean().tolist())


def test_returns_flags_and_rebasing(series, frames):
    df = s.with_returns(series).withColumns({"rise": s.is_rise(), "rebased": s.rebased()})
    for key, frame in frames.items():
        same(column(df, key, "daily_return"), (frame.price.pct_change() * 100).tolist())
        same(column(df, key, "rebased"), (frame.price / frame.price[0] * 100).tolist())
        assert column(df, key, "rise") == (frame.price.diff() > 0).tolist()


def test_summary(series, frames):
    for row in s.summary(series).collect():
        frame = frames[row.key]
        prices = frame.price
        assert (row.first_price, row.last_price) == (prices.iloc[0], prices.iloc[-1])
        assert (row.lowest_price, row.highest_price) == (prices.min(), prices.max())
        assert math.isclose(row.mean_volume, frame.volume.mean())
        assert math.isclose(row.performance, (prices.iloc[-1] / prices.iloc[0] - 1) * 100)
        assert math.isclose(row.volatility, (prices.pct_change() * 100).std())


def test_compounding_keeps_the_sign_but_shows_the_floor(spark):
    changes = [None, 0.5, -1.5, -0.1, -3.0, -1.0, 0.2]
    rows = [("k", START + dt.timedelta(days=i), c) for i, c in enumerate(changes)]
    df = spark.createDataFrame(rows, "key string, date date, change double").withColumn("p", s.compounded("change", 10.0))
    price, expected = 10.0, []
    for change in changes:
        price *= 1 + (change or 0.0)
        expected.append(max(0.1, price))
    same(column(df, "k", "p"), expected)


def test_histogram_counts_every_value_once(series, frames):
    binned = s.histogram(s.with_returns(series), "daily_return").collect()
    for key, frame in frames.items():
        known = (frame.price.pct_change() * 100).dropna()
        mine = {r.bin: r.n for r in binned if r.key == key}
        assert sum(mine.values()) == len(known) and min(mine) == 1 and max(mine) == 30
        low, high = known.min(), known.max()
        expected = known.map(lambda v: min(30, math.floor((v - low) / (high - low) * 30) + 1)).value_counts()  # noqa: B023
        assert mine == expected.to_dict()


def test_histogram_of_a_single_value(spark):
    df = spark.createDataFrame([("k", START, 2.0), ("k", START, 2.0), ("k", START, None)], "key string, date date, x double")
    assert [tuple(r) for r in s.histogram(df, "x").collect()] == [("k", 1, 2)]


def test_look_back_and_presets(series):
    last = START + dt.timedelta(days=119)

    def days(df):
        return [r.date for r in df.filter("key = 'a'").select("date").orderBy("date").collect()]

    assert days(s.look_back(series, "1M")) == [last - dt.timedelta(days=i) for i in range(29, -1, -1)]
    assert len(days(s.look_back(series, "3M"))) == 90
    assert len(days(s.look_back(series, "Tout"))) == 120
    until = F.lit("2024-03-31").cast("date")
    assert days(s.look_back(series, "1M", until=until))[-1] == dt.date(2024, 3, 31)
    assert days(s.calendar_range(series, "1m"))[0] == dt.date(2024, 3, 29)
    assert days(s.calendar_range(series, "1m", until=until))[0] == dt.date(2024, 2, 29)
    assert len(days(s.calendar_range(series, "YTD"))) == 120
    assert len(days(s.calendar_range(series, "all"))) == 120


def test_windows_on_days(spark):
    moments = [dt.datetime(2024, 1, d, h) for d in (9, 10, 20, 21) for h in (0, 23)]
    df = spark.createDataFrame([(m,) for m in moments], "ts timestamp_ntz")
    assert s.recent(df, "ts", F.lit("2024-01-20").cast("date")).count() == 4
    bounded = s.between_days(df, "ts", "2024-01-10", "2024-01-20")
    assert sorted(r.ts for r in bounded.collect()) == moments[2:6]


def test_daily_series_folds_events(spark):
    rows = [("a", dt.datetime(2024, 1, 1, 1), 2.0), ("a", dt.datetime(2024, 1, 1, 23), 4.0), ("a", dt.datetime(2024, 1, 2), 5.0)]
    events = spark.createDataFrame(rows, "k string, ts timestamp_ntz, x double")
    daily = s.daily_series(events, F.col("k"), F.col("ts"), F.avg("x"), F.count(F.lit(1)))
    assert sorted(map(tuple, daily.collect())) == [("a", dt.date(2024, 1, 1), 3.0, 2), ("a", dt.date(2024, 1, 2), 5.0, 1)]
