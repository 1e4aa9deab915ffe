"""Row numbers and the order statistics that follow from them.

A window partitioned by a class with few values puts a whole class into one
task.  ``rank_within`` orders all rows by range partitioning instead: each
task numbers its own slice, and a table with one row per slice and class turns
the local numbers into ranks.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ecometrics.operators.exact import scaled_by, scaled_sql
from ecometrics.session import settle

BUCKET_BITS = 12
BUCKETS = 1 << BUCKET_BITS
ROUNDS = (52, 40, 28, 16, 4, 0)  # the lowest bit that each round looks at; the last has four bits left
SLOT_BITS = 33  # monotonically_increasing_id keeps the row number of a task in its low 33 bits


def rank_within(df: DataFrame, by: Sequence[str], order: Sequence[Column], name: str = "rank") -> DataFrame:
    """Number the rows of each class from 1 along ``order``; end the order with a unique key.

    The slices are written before they are counted: a second evaluation of the
    range partitioning could draw other borders.  There are as many slices as
    shuffle partitions, whose number ``session.tune`` draws from the input size.
    """
    keys = [F.col(column) for column in by]
    slices = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sliced = df.repartitionByRange(slices, *keys, *order).sortWithinPartitions(*keys, *order)
    placed = settle(sliced.withColumn("__slot", F.monotonically_increasing_id()), "ranked")
    placed = placed.withColumn("__slice", F.shiftright("__slot", SLOT_BITS))

    earlier = Window.partitionBy(*by).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy(*by, "__slice")
        .agg(F.min("__slot").alias("__first"), F.count(F.lit(1)).alias("__rows"))
        .withColumn("__before", F.coalesce(F.sum("__rows").over(earlier), F.lit(0)))
        .select(
            *[F.col(column).alias("__by_" + column) for column in by],
            F.col("__slice").alias("__of_slice"),
            "__first",
            "__before",
        )
    )
    starts = settle(starts, "rank-starts")
    same = [placed[column].eqNullSafe(starts["__by_" + column]) for column in by]
    met = placed.join(starts, reduce(Column.__and__, same, placed["__slice"] == starts["__of_slice"]))
    rank = F.col("__slot") - F.col("__first") + F.col("__before") + 1
    return met.select(*[F.col(column) for column in df.columns], rank.alias(name))


def descending(value: str, *ties: str) -> list[Column]:
    """Greatest value first, NULL last, equal values by the tie keys."""
    return [F.desc_nulls_last(value), *[F.col(tie).asc_nulls_first() for tie in ties]]


SMALLEST_NORMAL = 2.0**-1022
INFINITE_BITS = 2047 << 52


def with_key(df: DataFrame, value: str, name: str = "__key") -> DataFrame:
    """``df`` with a long in the order of doubles: the bits of the size, negated below zero; NULL stays NULL.

    -0.0 equals 0.0, NaN is the greatest.  Exponent and fraction are taken apart by exact scaling; the logarithm, which
    may be one off beside a power of two, only proposes the exponent.
    """
    number, lifted = f"CAST(`{value}` AS DOUBLE)", 2.0**600
    normal = f"(__exponent + 1023) * {1 << 52}L + CAST(({scaled_sql('__size', '-__exponent')} - 1) * {2.0**52!r}D AS BIGINT)"
    bits = f"""CASE WHEN isnan(__size) THEN {INFINITE_BITS + 1}L WHEN __size = double('infinity') THEN {INFINITE_BITS}L WHEN __size = 0 THEN 0L
      WHEN __size < {SMALLEST_NORMAL!r}D THEN CAST(__size * {lifted!r}D * {2.0**474!r}D AS BIGINT) ELSE {normal} END"""
    return (
        df.selectExpr("*", f"abs({number}) AS __size")
        .selectExpr("*", f"CASE WHEN __size < {SMALLEST_NORMAL!r}D THEN __size * {lifted!r}D WHEN __size < double('infinity') THEN __size END AS __lifted")
        .selectExpr("*", "floor(log2(__lifted)) AS __guess")
        .selectExpr("*", f"{scaled_sql('__lifted', '-__guess')} AS __fraction")
        .selectExpr("*", "__guess + CASE WHEN __fraction >= 2 THEN 1 WHEN __fraction < 1 THEN -1 ELSE 0 END AS __exponent")
        .selectExpr("*", f"IF({number} < 0, -1L, 1L) * {bits} AS `{name}`")
        .drop("__size", "__lifted", "__guess", "__fraction", "__exponent")
    )


def of_key(key: Column) -> Column:
    """The double of an ordered key."""
    bits = F.abs(key)
    exponent, fraction = F.shiftright(bits, 52), bits.bitwiseAND(F.lit((1 << 52) - 1)).cast("double")
    normal = scaled_by(F.lit(1.0) + fraction / 2.0**52, exponent - 1023)
    size = F.when(exponent == 0, fraction / 2.0**537 / 2.0**537).otherwise(normal)
    finite = F.when(key < 0, -size).otherwise(size)
    return F.when(key > INFINITE_BITS, float("nan")).when(bits == INFINITE_BITS, F.when(key < 0, float("-inf")).otherwise(float("inf"))).otherwise(finite)


def selected(df: DataFrame, by: Sequence[str], value: str, ranks: Callable[[Column], Sequence[Column]]) -> DataFrame:
    """(by..., __side, value): of each class the values at the ranks (from 1) that ``ranks`` draws from its count.

    Radix selection on ordered keys: rows are counted per class and the next 12 bits of the key, the bucket that
    holds a rank is kept, and only rows with its prefix go on.  Six rounds settle any 64 bits whatever the values
    are, all in one plan; a round is one scan and aggregation, and a window over at most ``BUCKETS`` rows per class
    and rank.
    """
    known = with_key(df.filter(F.col(value).isNotNull()).select(*by, F.col(value).alias("__value")), "__value")
    known = settle(known.select(*by, "__key"), "known-keys")
    names = ["__by_" + column for column in by]
    whole, running = Window.partitionBy(*names), Window.partitionBy(*names, "__side").orderBy("__bucket")
    same = reduce(Column.__and__, [F.col(column).eqNullSafe(F.col(name)) for column, name in zip(by, names)], F.lit(True))
    buckets = (
        known.groupBy(*[F.col(column).alias(name) for column, name in zip(by, names)], F.shiftright("__key", ROUNDS[0]).alias("__bucket"))
        .agg(F.count(F.lit(1)).alias("__n"))
        .withColumn("__size", F.sum("__n").over(whole))
    )
    places = F.posexplode(F.array(*[r.cast("bigint") for r in ranks(F.col("__size"))])).alias("__side", "__rank")
    counted = buckets.select(*names, "__bucket", "__n", places)
    for before, shift in zip((None, *ROUNDS), ROUNDS):
        if before is not None:
            counted = (
                known.join(goals, same & (F.shiftright("__key", before) == F.col("__prefix")))
                .groupBy(*names, "__side", "__rank", F.shiftright("__key", shift).alias("__bucket"))
                .agg(F.count(F.lit(1)).alias("__n"))
            )
        upto = counted.withColumn("__upto", F.sum("__n").over(running))
        held = upto.filter((F.col("__upto") >= F.col("__rank")) & (F.col("__upto") - F.col("__n") < F.col("__rank")))
        rank = F.col("__rank") - (F.col("__upto") - F.col("__n"))
        goals = held.select(*names, "__side", rank.alias("__rank"), F.col("__bucket").alias("__prefix"))
    return goals.select(*[F.col(name).alias(column) for column, name in zip(by, names)], "__side", of_key(F.col("__prefix")).alias("value"))


def middle_values(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """(by..., low, high): the two middle values of each class (the same one for odd sizes), exactly and unsorted."""
    found = selected(df, by, value, lambda n: (F.floor((n + 1) / 2), F.ceil((n + 1) / 2)))
    sides = [F.max(F.when(F.col("__side") == i, F.col("value"))).alias(side) for i, side in enumerate(("low", "high"))]
    return found.groupBy(*by).agg(*sides)


def exact_median(df: DataFrame, by: Sequence[str], value: str, name: str = "median") -> DataFrame:
    """Interpolated median per class; holds no class in memory.

    Halves are added, so that two large values do not overflow; of an infinity and its opposite it is NaN.
    """
    middle = middle_values(df, by, value)
    same = F.col("low").eqNullSafe(F.col("high"))
    return middle.select(*by, F.when(same, F.col("low")).otherwise(F.col("low") / 2 + F.col("high") / 2).alias(name))


def first_per_class(df: DataFrame, by: Sequence[str], order: Sequence[Column], count: int = 1) -> DataFrame:
    """The first rows of each class.

    Spark trims every task's share to ``count`` rows per class before the
    shuffle (window group limit), so a hot class costs no more than a cold one.
    """
    numbered = df.withColumn("__rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    return numbered.filter(F.col("__rank") <= count).drop("__rank")


def top(df: DataFrame, order: Sequence[Column], count: int) -> DataFrame:
    return df.orderBy(*order).limit(count)
