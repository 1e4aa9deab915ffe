"""Windows over series of any length: one key may hold most of the rows.

A window by key sorts a whole series in one task.  Here rows are numbered within their key by range partitioning
(``rank_within``), and a series is cut into chunks of equally many rows, so that the windows run by key and chunk
and a hot key spreads over as many tasks as it has chunks.  A frame of the last n rows sees the n - 1 rows before its
chunk as a halo; running products and first values are scanned within the chunks and joined over them, of which there
are few.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ecometrics.functions.measures import floored, percent_change
from ecometrics.operators.ranking import rank_within
from ecometrics.session import settle

CHUNK_ROWS = 100_000
RANK, CHUNK = "__rank", "__chunk"

Framed = Callable[[WindowSpec], Column]


def chunked(df: DataFrame, key: str, order: Sequence[str], chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """``df``, written, with each row's number within its key and its chunk; end ``order`` with a unique column."""
    ranked = rank_within(df, [key], [F.col(c).asc_nulls_first() for c in order], RANK)
    return settle(ranked.withColumn(CHUNK, F.floor((F.col(RANK) - 1) / F.lit(chunk_rows))), "chunks")


def with_frames(series: DataFrame, key: str, columns: Mapping[str, Framed], reach: int, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """``series`` of ``chunked`` with window columns that look at most ``reach`` rows back.

    The last ``reach`` rows of a chunk also go to the next one, as rows that only frames see.
    """
    if reach > chunk_rows:
        raise ValueError("a frame may not reach over more than one chunk")
    place = (F.col(RANK) - 1) % F.lit(chunk_rows)
    own, next_too = F.array(F.col(CHUNK)), F.array(F.col(CHUNK), F.col(CHUNK) + 1)
    dealt = series.withColumn("__part", F.explode(F.when(place >= chunk_rows - reach, next_too).otherwise(own)))
    ordered = Window.partitionBy(key, "__part").orderBy(RANK)
    shown = dealt.withColumns({name: made(ordered) for name, made in columns.items()})
    return shown.filter(F.col("__part") == F.col(CHUNK)).drop("__part")


def moving_average(size: int, value: str) -> Framed:
    """Mean of the last ``size`` rows, NULL until that many known values are in the frame; reaches ``size`` - 1 back."""

    def made(ordered: WindowSpec) -> Column:
        frame = ordered.rowsBetween(1 - size, 0)
        return F.when(F.count(value).over(frame) == size, F.avg(value).over(frame))

    return made


def change(value: str) -> Framed:
    """Percent change against the row before; NULL on the first row; reaches one back."""
    return lambda ordered: percent_change(F.col(value), F.lag(value).over(ordered))


def is_rise(value: str) -> Framed:
    return lambda ordered: F.coalesce(F.col(value) > F.lag(value).over(ordered), F.lit(False))


def _joined(series: DataFrame, key: str, over_chunks: DataFrame) -> DataFrame:
    """Meet a row per key and chunk; both sides are written, and a hot key is spread by its chunks."""
    side = settle(over_chunks, "over-chunks").withColumnsRenamed({key: "__of", CHUNK: "__at"})
    met = series.join(side, series[key].eqNullSafe(side["__of"]) & (series[CHUNK] == side["__at"]))
    return met.drop("__of", "__at")


def with_compounded(series: DataFrame, key: str, change: str, name: str, base: float, floor: float = 0.1) -> DataFrame:
    """Price index out of relative changes (0.01 is one percent); an unknown change counts as none, only what is shown is floored."""
    factor = F.lit(1.0) + F.coalesce(F.col(change), F.lit(0.0))
    across = Window.partitionBy(key).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    products = series.groupBy(key, CHUNK).agg(F.product(factor).alias("__factor"))
    before = products.select(key, CHUNK, F.coalesce(F.product("__factor").over(across), F.lit(1.0)).alias("__before"))
    inside = Window.partitionBy(key, CHUNK).orderBy(RANK).rowsBetween(Window.unboundedPreceding, 0)
    running = _joined(series, key, before).withColumn("__running", F.product(factor).over(inside))
    return running.withColumn(name, floored(F.lit(float(base)) * F.col("__before") * F.col("__running"), floor)).drop("__before", "__running")


def with_rebased(series: DataFrame, key: str, value: str, name: str, base: float = 100.0) -> DataFrame:
    """Every value relative to the first of its key."""
    first = series.filter(F.col(RANK) == 1).select(key, F.col(value).alias("__first"))
    chunks = series.select(key, CHUNK).distinct()
    side = settle(first, "first").withColumnRenamed(key, "__whose")
    known = chunks.join(side, chunks[key].eqNullSafe(side["__whose"])).drop("__whose")
    return _joined(series, key, known).withColumn(name, F.try_divide(F.col(value), F.col("__first")) * F.lit(float(base))).drop("__first")


def plain(series: DataFrame) -> DataFrame:
    """Without the columns that place the rows."""
    return series.drop(RANK, CHUNK)
