"""Analytics over daily series: one row per key and calendar day.

``daily_series`` brings any event table to that grain with a partial
aggregation.  From there a key holds at most 366 rows a year however many
events lie behind them, which bounds the windows below.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ecometrics.functions.measures import floored, percent_change
from ecometrics.operators import exact

# Days of history behind each range label; None keeps everything.
LOOKBACK_DAYS = {"1M": 30, "3M": 90, "6M": 180, "1A": 365, "Tout": None}
# Months behind each calendar preset.
PRESET_MONTHS = {"1m": 1, "6m": 6, "1y": 12}

KEY, DATE, PRICE, VOLUME = "key", "date", "price", "volume"


def daily_series(df: DataFrame, key: Column, moment: Column, price: Column, volume: Column) -> DataFrame:
    """(key, date, price, volume) out of aggregate columns ``price`` and ``volume``."""
    return df.groupBy(key.alias(KEY), F.to_date(moment).alias(DATE)).agg(price.alias(PRICE), volume.alias(VOLUME))


def in_order() -> Window:
    return Window.partitionBy(KEY).orderBy(DATE)


def moving_average(size: int, value: str = PRICE) -> Column:
    """Mean of the last ``size`` rows, NULL until that many known values are in the frame."""
    frame = in_order().rowsBetween(1 - size, 0)
    return F.when(F.count(value).over(frame) == size, F.avg(value).over(frame))


def daily_return(value: str = PRICE) -> Column:
    """Percent change against the row before; NULL on the first row."""
    return percent_change(F.col(value), F.lag(value).over(in_order()))


def is_rise(value: str = PRICE) -> Column:
    return F.coalesce(F.col(value) > F.lag(value).over(in_order()), F.lit(False))


def rebased(value: str = PRICE, base: float = 100.0) -> Column:
    first = F.first(value).over(in_order().rowsBetween(Window.unboundedPreceding, 0))
    return F.try_divide(F.col(value), first) * F.lit(float(base))


def compounded(change: str, base: float, floor: float = 0.1) -> Column:
    """Price index out of relative changes (0.01 is one percent); only the shown price is floored."""
    growth = F.product(F.lit(1.0) + F.coalesce(F.col(change), F.lit(0.0)))
    running = growth.over(in_order().rowsBetween(Window.unboundedPreceding, 0))
    return floored(F.lit(float(base)) * running, floor)


def with_returns(series: DataFrame, name: str = "daily_return") -> DataFrame:
    return series.withColumn(name, daily_return())


def summary(series: DataFrame) -> DataFrame:
    """First, last, extremes, mean volume, performance and volatility per key.

    The mean comes from an exact sum, the volatility from central moments (see ``exact``); the windows and the fold
    share one shuffle by key.
    """
    dated = F.when(F.col(DATE).isNotNull(), F.struct(DATE, PRICE))
    kept = {
        "first": (F.min(dated), F.min),
        "last": (F.max(dated), F.max),
        "lowest_price": (F.min(PRICE), F.min),
        "highest_price": (F.max(PRICE), F.max),
    }
    found = exact.totals(with_returns(series), [KEY], [VOLUME, "daily_return"], moments=["daily_return"], keep=kept)
    first, last = F.col("first")[PRICE], F.col("last")[PRICE]
    return found.select(
        KEY,
        first.alias("first_price"),
        last.alias("last_price"),
        "lowest_price",
        "highest_price",
        F.col(f"mean_{VOLUME}").alias("mean_volume"),
        percent_change(last, first).alias("performance"),
        F.col("deviation_daily_return").alias("volatility"),
    )


def histogram(series: DataFrame, value: str, bins: int = 30) -> DataFrame:
    """Row count per key and equal-width bin between the key's own extremes.

    The highest value belongs to the last bin; a key with a single value has
    one bin.  The extremes use the partitioning the returns already have.
    """
    whole = Window.partitionBy(KEY)
    low, high = F.min(value).over(whole), F.max(value).over(whole)
    placed = series.select(KEY, value, low.alias("__low"), high.alias("__high")).filter(F.col(value).isNotNull())
    share = F.try_divide(F.col(value) - F.col("__low"), F.col("__high") - F.col("__low"))
    number = F.least(F.coalesce(F.floor(share * F.lit(bins)) + 1, F.lit(1)), F.lit(bins)).cast("bigint")
    return placed.groupBy(KEY, number.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def last_date(df: DataFrame, date: str) -> Column:
    return df.agg(F.max(date)).scalar()


def look_back(df: DataFrame, label: str, date: str = DATE, until: Column | None = None) -> DataFrame:
    """The last N calendar days up to ``until`` (default: the latest date in the data)."""
    days = LOOKBACK_DAYS[label]
    if days is None:
        return df
    end = last_date(df, date) if until is None else until
    return df.filter((F.col(date) > F.date_sub(end, days)) & (F.col(date) <= end))


def calendar_range(df: DataFrame, preset: str, date: str = DATE, until: Column | None = None) -> DataFrame:
    """Months back, year to date (``YTD``) or ``all``, counted from ``until``."""
    if preset == "all":
        return df
    end = last_date(df, date) if until is None else until
    start = F.trunc(end, "year") if preset == "YTD" else F.add_months(end, -PRESET_MONTHS[preset])
    return df.filter(F.col(date).between(start, end))


def in_ranges(df: DataFrame, starts: dict[str, Column | None], until: Column, date: str = DATE) -> DataFrame:
    """Every row once per range that it belongs to, named in column ``range``, in one pass.

    ``starts`` gives each range its first day; None is open at both ends.
    """
    names = [
        F.lit(name) if start is None else F.when(F.col(date).between(start, until), F.lit(name))
        for name, start in starts.items()
    ]
    return df.withColumn("range", F.explode(F.array_compact(F.array(*names))))


def look_back_starts(until: Column) -> dict[str, Column | None]:
    return {name: None if days is None else F.date_add(F.date_sub(until, days), 1) for name, days in LOOKBACK_DAYS.items()}


def calendar_starts(until: Column) -> dict[str, Column | None]:
    months = {name: F.add_months(until, -n) for name, n in PRESET_MONTHS.items()}
    return {**months, "YTD": F.trunc(until, "year"), "all": None}


def recent(df: DataFrame, moment: str, until: Column, days: int = 10) -> DataFrame:
    """Rows of the last days, both ends included."""
    return df.filter(F.to_date(moment).between(F.date_sub(until, days), until))


def between_days(df: DataFrame, moment: str, first: str, last: str) -> DataFrame:
    """Rows from the start of ``first`` to the end of ``last``.

    Written as bounds on the bare column, so that they reach the file scan.
    """
    kind = df.schema[moment].dataType
    start = F.lit(first).cast("date").cast(kind)
    end = F.date_add(F.lit(last).cast("date"), 1).cast(kind)
    return df.filter((F.col(moment) >= start) & (F.col(moment) < end))


def chronological(df: DataFrame, *order: str) -> DataFrame:
    return df.orderBy(*order)
