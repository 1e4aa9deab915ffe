"""Daily series: order value per priority, event value per type."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ecometrics.functions import measures as m
from ecometrics.operators import long_series as long
from ecometrics.operators import series as s
from ecometrics.operators.joins import enrich
from ecometrics.operators.screening import peers
from ecometrics.session import settle
from workload.registry import agreed, agreed_sql, query

# Whole cents: sums and means of them are exact in any order.
AMOUNT = "CAST(round(o_totalprice * 100) AS BIGINT)"
VALUE = "CAST(round(value * 100) AS BIGINT)"
SERIES_SQL = f"""WITH series AS (
  SELECT o_orderpriority AS key, CAST(o_orderdate AS DATE) AS date, CAST(sum({AMOUNT}) AS DOUBLE) AS price, count(*) AS volume
  FROM orders GROUP BY 1, 2),
returns AS (SELECT *, (price / lag(price) OVER (PARTITION BY key ORDER BY date) - 1) * 100 AS daily_return FROM series)"""


def order_series(star) -> DataFrame:
    total = F.sum(F.expr(AMOUNT)).cast("double")
    return s.daily_series(star.orders, F.col("o_orderpriority"), F.col("o_orderdate"), total, F.count(F.lit(1)))


@query(SERIES_SQL + " SELECT key, date, price, volume FROM series")
def daily_series(star):
    return order_series(star)


@query(
    f"""SELECT event_type AS key, CAST(ts AS DATE) AS date, CAST(sum({VALUE}) AS DOUBLE) AS price,
       count(*) AS volume, CASE WHEN count(*) OVER w = 20 THEN avg(CAST(sum({VALUE}) AS DOUBLE)) OVER w END AS ma20
       FROM events GROUP BY 1, 2 WINDOW w AS (PARTITION BY event_type ORDER BY CAST(ts AS DATE) ROWS 19 PRECEDING)"""
)
def event_moving_average(star):
    total = F.sum(F.expr(VALUE)).cast("double")
    events = s.daily_series(star.events, F.col("event_type"), F.col("ts"), total, F.count(F.lit(1)))
    return events.withColumn("ma20", s.moving_average(20))


@query(
    SERIES_SQL
    + """ SELECT key, date, price,
      CASE WHEN count(price) OVER (PARTITION BY key ORDER BY date ROWS 19 PRECEDING) = 20
           THEN avg(price) OVER (PARTITION BY key ORDER BY date ROWS 19 PRECEDING) END AS ma20,
      CASE WHEN count(price) OVER (PARTITION BY key ORDER BY date ROWS 49 PRECEDING) = 50
           THEN avg(price) OVER (PARTITION BY key ORDER BY date ROWS 49 PRECEDING) END AS ma50 FROM series"""
)
def moving_averages(star):
    averages = {"ma20": s.moving_average(20), "ma50": s.moving_average(50)}
    return order_series(star).withColumns(averages).drop("volume")


@query(SERIES_SQL + " SELECT key, date, daily_return FROM returns")
def daily_returns(star):
    return s.with_returns(order_series(star)).select("key", "date", "daily_return")


@query(SERIES_SQL + " SELECT key, date, volume, coalesce(daily_return > 0, false) AS rise FROM returns")
def rise_flags(star):
    return order_series(star).select("key", "date", "volume", s.is_rise().alias("rise"))


@query(SERIES_SQL + " SELECT key, date, price / first(price) OVER (PARTITION BY key ORDER BY date) * 100 AS rebased FROM series")
def rebased_prices(star):
    return order_series(star).select("key", "date", s.rebased().alias("rebased"))


@query(
    SERIES_SQL
    + f""" SELECT {agreed_sql('mean_volume', 'volatility')} FROM (
      SELECT key, arg_min(price, date) AS first_price, arg_max(price, date) AS last_price, min(price) AS lowest_price,
        max(price) AS highest_price, avg(volume) AS mean_volume,
        (arg_max(price, date) / arg_min(price, date) - 1) * 100 AS performance, stddev_samp(daily_return) AS volatility
      FROM returns GROUP BY key)"""
)
def period_summary(star):
    return agreed(s.summary(order_series(star)), "mean_volume", "volatility")


@query(
    SERIES_SQL
    + """ SELECT key, CAST(least(30, floor((daily_return - low) / (high - low) * 30) + 1) AS BIGINT) AS bin, count(*) AS n
      FROM returns JOIN (SELECT key AS k, min(daily_return) AS low, max(daily_return) AS high FROM returns GROUP BY 1) ON k = key
      WHERE daily_return IS NOT NULL GROUP BY 1, 2"""
)
def return_histogram(star):
    return s.histogram(s.with_returns(order_series(star)), "daily_return")


@query(
    SERIES_SQL
    + """ SELECT key, date,
      round(greatest(0.1, 50.0::DOUBLE * product(1 + coalesce(change, 0)) OVER w), 6) AS index_price,
      round(greatest(0.1, 1e6::DOUBLE * product(1 - coalesce(change, 0) / 10 * 4) OVER w), 2) AS short_price
      FROM (SELECT key, date, daily_return / 100.0::DOUBLE AS change FROM returns)
      WINDOW w AS (PARTITION BY key ORDER BY date ROWS UNBOUNDED PRECEDING)"""
)
def compounded_index(star):
    """The index follows the prices; the short one holds losses beyond 100 percent and hits the floor.

    Rounded, because engines multiply the factors of a frame in different orders.
    """
    changes = s.with_returns(order_series(star)).withColumn("change", F.col("daily_return") / 100.0)
    return changes.withColumn("loss", F.col("change") / 10 * -4).select(
        "key",
        "date",
        F.round(s.compounded("change", 50.0), 6).alias("index_price"),
        F.round(s.compounded("loss", 1e6), 2).alias("short_price"),
    )


@query(
    f"""SELECT event_id, event_type AS key, CASE WHEN count(cents) OVER f = 20 THEN avg(cents) OVER f END AS ma20,
      (cents / nullif(lag(cents) OVER w, 0) - 1) * 100 AS change, coalesce(cents > lag(cents) OVER w, false) AS rise,
      cents / nullif(first(cents) OVER w, 0) * 100 AS rebased
    FROM (SELECT *, CAST({VALUE} AS DOUBLE) AS cents FROM events)
    WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id), f AS (PARTITION BY event_type ORDER BY ts, event_id ROWS 19 PRECEDING)"""
)
def intraday_series(star):
    """Every event, without a fold by day: a type's events are cut into chunks that run in tasks of their own."""
    events = star.events.select("event_id", "ts", F.col("event_type").alias("key"), F.expr(VALUE).cast("double").alias("cents"))
    placed = long.chunked(events, "key", ["ts", "event_id"], 1000)
    columns = {"ma20": long.moving_average(20, "cents"), "change": long.change("cents"), "rise": long.is_rise("cents")}
    shown = long.with_rebased(long.with_frames(placed, "key", columns, 19, 1000), "key", "cents", "rebased")
    return shown.select("event_id", "key", "ma20", "change", "rise", "rebased")


def _counted(starts, star) -> DataFrame:
    """Each row of the series goes into all its ranges in one pass over a written series."""
    series = settle(order_series(star).select("key", "date"), "series")
    ranged = s.in_ranges(series, starts(s.last_date(series, "date")), s.last_date(series, "date"))
    return ranged.groupBy("key", "range").agg(F.count(F.lit(1)).alias("days"), F.min("date").alias("first_day"))


def _ranges_sql(ranges: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT key, count(*) AS days, min(date) AS first_day, '{name}' AS range FROM series, latest WHERE {test} GROUP BY key"
        for name, test in ranges.items()
    )


LATEST_SQL = SERIES_SQL + ", latest AS (SELECT max(date) AS newest FROM series) "


@query(
    LATEST_SQL
    + _ranges_sql(
        {
            "1M": "date > newest - 30",
            "3M": "date > newest - 90",
            "6M": "date > newest - 180",
            "1A": "date > newest - 365",
            "Tout": "true",
        }
    )
)
def look_back_ranges(star):
    return _counted(s.look_back_starts, star)


@query(
    LATEST_SQL
    + _ranges_sql(
        {
            "1m": "date >= newest - INTERVAL 1 MONTH",
            "6m": "date >= newest - INTERVAL 6 MONTH",
            "YTD": "date >= date_trunc('year', newest)",
            "1y": "date >= newest - INTERVAL 1 YEAR",
            "all": "true",
        }
    )
)
def calendar_ranges(star):
    return _counted(s.calendar_starts, star)


@query(
    """SELECT event_id, event_type FROM events
       WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-20' - 10 AND DATE '2024-01-20'"""
)
def recent_window(star):
    return s.recent(star.events, "ts", F.lit("2024-01-20").cast("date")).select("event_id", "event_type")


@query("SELECT l_returnflag, count(*) AS n FROM lineitem WHERE CAST(l_shipdate AS DATE) BETWEEN '1997-02-13' AND '1997-02-23' GROUP BY 1")
def fixed_date_range(star):
    lines = s.between_days(star.lineitem, "l_shipdate", "1997-02-13", "1997-02-23")
    return lines.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))


@query(SERIES_SQL + " SELECT key, date, daily_return FROM returns WHERE daily_return IS NOT NULL ORDER BY key, date")
def chronological_returns(star):
    known = s.with_returns(order_series(star)).select("key", "date", "daily_return").dropna()
    return s.chronological(known, "key", "date")


@query(
    f"""WITH prices AS (SELECT s_nationkey AS focus, l_suppkey AS supplier, CAST(l_shipdate AS DATE) AS date,
        CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS DOUBLE) AS price
        FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY ALL),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_name, s_suppkey) AS pos FROM supplier),
    pairs AS (SELECT a.s_suppkey AS key, b.s_suppkey AS peer, row_number() OVER (PARTITION BY a.s_suppkey ORDER BY b.pos) AS position
      FROM ranked a JOIN ranked b ON a.s_nationkey = b.s_nationkey AND a.s_suppkey <> b.s_suppkey),
    indexed AS (SELECT supplier, date, price / first(price) OVER (PARTITION BY supplier ORDER BY date) * 100 AS rebased FROM prices),
    finals AS (SELECT supplier, arg_max(rebased, date) AS final FROM indexed GROUP BY 1)
    SELECT key, peer, position, o.final AS own_index, t.final AS peer_index FROM pairs
    LEFT JOIN finals o ON o.supplier = key LEFT JOIN finals t ON t.supplier = peer WHERE position <= 3"""
)
def peers_rebased(star):
    total = F.sum(F.expr("CAST(round(l_extendedprice * 100) AS BIGINT)")).cast("double")
    sold = s.daily_series(star.lineitem, F.col("l_suppkey"), F.col("l_shipdate"), total, F.count(F.lit(1)))
    final = m.divided(F.max_by("price", "date"), F.min_by("price", "date")) * F.lit(100.0)
    finals = settle(sold.groupBy(F.col("key").alias("supplier")).agg(final.alias("final")), "finals")
    pairs = peers(star.supplier, "s_suppkey", "s_nationkey", "s_name").withColumnRenamed("s_suppkey", "key")
    own = enrich(pairs, finals, {"key": "supplier"}, {"final": "own_index"})
    return enrich(own, finals, {"peer": "supplier"}, {"final": "peer_index"})
