"""Named queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ecometrics.session import input_bytes, tune

# The tables; a declared schema spares a pass over the file footers per read.
TABLES = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
    "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
    "l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Star:
    """The tables of one data folder, by attribute."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self._folder = folder

    def __getattr__(self, table: str) -> DataFrame:
        if table not in TABLES:
            raise AttributeError(table)
        return self.spark.read.schema(TABLES[table]).parquet(f"{self._folder}/{table}.parquet")


def query(sql: str | None = None, name: str | None = None):
    """Register a function of a ``Star``, with the SQL that must give the same rows."""

    def register(build: Callable[[Star], DataFrame]):
        key = name or build.__name__

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(Star(tune(spark, input_bytes(spark, folder)), folder))

        QUERIES[key] = run
        if sql is not None:
            SQL[key] = sql
        return build

    return register


MOVED = 1.00000000001


def agreed(df: DataFrame, *columns: str, places: tuple[str, ...] = ()) -> DataFrame:
    """Columns to nine significant digits, ``places`` to nine decimals: other engines add doubles up with an error.

    Values are moved by a hundredth of the last digit first, because engines print exact halves differently.
    """
    moved = {c: F.col(c).cast("double") * F.lit(MOVED) for c in columns}
    digits = {c: F.when(F.col(c).isNotNull(), F.format_string("%.8e", moved[c]).cast("double")) for c in columns}
    return df.withColumns(digits | {c: F.round(c, 9) for c in places})


def agreed_sql(*columns: str, places: tuple[str, ...] = ()) -> str:
    """The same for ``SELECT *`` in SQL."""
    digits = [f"CAST(printf('%.8e', CAST({c} AS DOUBLE) * {MOVED}::DOUBLE) AS DOUBLE) AS {c}" for c in columns]
    return f"* REPLACE ({', '.join([*digits, *(f'round({c}, 9) AS {c}' for c in places)])})"
