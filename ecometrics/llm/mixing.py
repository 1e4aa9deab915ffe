"""Mix sources to target weights with hash-threshold histograms.

Every document has a place on a line of 60-bit hashes.  A source's budget is a number of whole
passes and a rest; the rest goes to the documents below a threshold, which is found without a
sort: words are summed per source and hash bucket, the bucket where the running sum passes the
budget is found among the bounded number of buckets, and only that bucket is refined by the next
bits.  A smaller budget always takes a subset of what a larger one takes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ecometrics.llm.common import WORD, prepared
from ecometrics.session import settle

HASH_BITS, BUCKET_BITS = 60, 12


def text_size(text: str | Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def place(id_value: Column, text: Column) -> Column:
    """A document's place: 60 bits of a digest of its id and text, the same in every run."""
    digest = F.md5(
        F.concat(F.coalesce(id_value.cast("string"), F.lit("")), F.lit(":"), F.coalesce(F.md5(text), F.lit("")))
    )
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("bigint")


def targets(sources: DataFrame, weights: tuple[int, ...], share: tuple[int, int], most: int) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row per source.

    Weights repeat over the sources in code point order, null last.  ``share`` of all sizes is dealt
    by weight; a source gets at most ``most`` times its size, and what it can't take is dealt again
    among the others until none is above.  Each round is one aggregate over the sources.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(weights)
    weighed = settle(
        sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")).cast("bigint")),
        "weights",
    )
    # Without the capped ones, a unit of weight gets (share * all - most * capped) / weight; kept as a fraction.
    above, below = 0, 1
    capped = F.lit(False)
    total = weighed.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("size")).first()["size"]
    last = None
    while True:
        row = weighed.agg(
            F.coalesce(F.sum(F.when(capped, F.col("source_size"))), F.lit(0)).alias("full"),
            F.coalesce(F.sum(F.when(~capped, F.col("weight"))), F.lit(0)).alias("weight"),
        ).first()
        if (row["full"], row["weight"]) == last or not row["weight"]:
            break
        last = (row["full"], row["weight"])
        above, below = share[0] * total - share[1] * most * row["full"], share[1] * row["weight"]
        capped = F.col("weight") * F.lit(above) >= F.col("source_size") * F.lit(most * below)
    even = (F.col("weight") * F.lit(above)).cast("double") / F.lit(below).cast("double")
    return weighed.select("source", "source_size", F.when(capped, (F.col("source_size") * most).cast("double")).otherwise(even).alias("target"))


def budgets(sized: DataFrame, weights: tuple[int, ...], share: tuple[int, int], most: int) -> DataFrame:
    """One row per source: source, source_size, target, passes and the threshold of the rest.

    ``sized`` has source, size and place, and is read once per level of refinement.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    goal = targets(sources, weights, share, most)
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    goal = goal.withColumn("passes", passes.cast("bigint"))
    state = settle(
        goal.withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size"))
        .withColumn("prefix", F.lit(0).cast("bigint"))
        .withColumn("passed", F.lit(0).cast("bigint"))
        .withColumn("unit", F.col("source_size")),
        "budgets",
    )
    for shift in range(HASH_BITS - BUCKET_BITS, -1, -BUCKET_BITS):
        # The rows of the boundary bucket alone; at the first level that is all of a source.
        edge = state.select(F.col("source").alias("of"), "prefix")
        inside = sized.join(
            edge, F.col("source").eqNullSafe(F.col("of")) & (F.shiftright("place", shift + BUCKET_BITS) == F.col("prefix"))
        )
        histogram = inside.groupBy("source", F.shiftright("place", shift).alias("bucket")).agg(F.sum("size").alias("size"))
        running = Window.partitionBy("source").orderBy("bucket")
        walked = (
            histogram.withColumn("upto", F.sum("size").over(running))
            .withColumnRenamed("source", "of")
            .join(state, F.col("source").eqNullSafe(F.col("of")))
            .where(F.col("passed") + F.col("upto") > F.col("rest"))
            .groupBy("source").agg(F.min(F.struct("bucket", "upto", "size")).alias("edge"))
            .select(F.col("source").alias("of"), "edge")
        )
        state = settle(
            state.join(walked, F.col("source").eqNullSafe(F.col("of")), "left").select(
                "source", "source_size", "target", "passes", "rest",
                F.coalesce("edge.bucket", F.lit(-1)).alias("prefix"),
                F.when(F.col("edge").isNull(), F.col("passed")).otherwise(
                    F.col("passed") + F.col("edge.upto") - F.col("edge.size")
                ).alias("passed"),
                F.coalesce("edge.size", F.lit(0)).alias("unit"),
            ),
            "budgets",
        )
    # The documents of one place go together, on the side that comes nearer to the budget.
    near = (F.col("prefix") >= 0) & (2 * (F.col("rest") - F.col("passed")) >= F.col("unit"))
    return state.select(
        "source", "source_size", "target", "passes",
        F.when(near, F.col("prefix") + 1).otherwise(F.greatest("prefix", F.lit(0))).cast("bigint").alias("threshold"),
    )


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    return docs.select(
        docs[id_col].alias("doc_id"),
        docs[source_col].alias("source"),
        text_size(docs[text_col]).alias("size"),
        place(docs[id_col], docs[text_col]).alias("place"),
    )


def mix(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = (3, 1, 2),
    share: tuple[int, int] = (3, 2),
    most: int = 2,
) -> DataFrame:
    """Per row: doc_id, size, source_size, target, taken (words the mix takes, repeats counted), copies.

    A source's taken words differ from its target by at most half of one document.  Null text has
    size 0; null sources are one source, weighed last; rows that agree in id and text share a place,
    so they are taken alike; a source without words takes none; an empty table gives no rows; other
    columns are not read.
    """
    prepared(docs.sparkSession)
    sized = settle(_sized(docs, id_col, text_col, source_col), "sized")
    taken = budgets(sized, weights, share, most).withColumnRenamed("source", "of")
    copies = F.col("passes") + (F.col("place") < F.col("threshold")).cast("bigint")
    return sized.join(taken, F.col("source").eqNullSafe(F.col("of"))).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * copies).alias("taken"), copies.alias("copies")
    )


def take(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = (3, 1, 2),
    share: tuple[int, int] = (3, 2),
    most: int = 2,
) -> DataFrame:
    """The rows of the mix with all their columns: each as often as its source's budget takes it."""
    prepared(docs.sparkSession)
    sized = settle(_sized(docs, id_col, text_col, source_col), "sized")
    taken = budgets(sized, weights, share, most).select(
        F.col("source").alias("__mix_source"), F.col("passes").alias("__mix_passes"), F.col("threshold").alias("__mix_threshold")
    )
    below = place(docs[id_col], docs[text_col]) < F.col("__mix_threshold")
    copies = (F.col("__mix_passes") + below.cast("bigint")).cast("int")
    joined = docs.join(taken, docs[source_col].eqNullSafe(F.col("__mix_source")))
    repeated = joined.withColumn("__mix_copy", F.explode(F.array_repeat(F.lit(True), copies)))
    return repeated.drop("__mix_source", "__mix_passes", "__mix_threshold", "__mix_copy")


SQL = r"""
WITH sized AS (
  SELECT doc_id, source,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(md5(text), '')), 1, 15) AS BIGINT) AS place
  FROM documents
), weighed AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    CAST([3, 1, 2][1 + (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3] AS BIGINT) AS weight
  FROM sized GROUP BY source
), ordered AS (  -- sources fill up in the order of size per weight
  SELECT *,
    CAST(sum(source_size) OVER () AS BIGINT) AS everything,
    CAST(coalesce(sum(source_size) OVER before, 0) AS BIGINT) AS smaller,
    CAST(sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS BIGINT) AS weight_left,
    source_size * 1.0 / weight AS fill
  FROM weighed
  WINDOW before AS (ORDER BY source_size * 1.0 / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), filled AS (
  SELECT *, weight * (3 * everything - 4 * smaller) >= 4 * source_size * weight_left AS capped FROM ordered
), level AS (
  SELECT CAST(coalesce(sum(source_size) FILTER (WHERE capped), 0) AS BIGINT) AS full_size,
    CAST(sum(weight) FILTER (WHERE NOT capped) AS BIGINT) AS weight_open FROM filled
), goals AS (
  SELECT source, source_size,
    CASE WHEN capped THEN CAST(2 * source_size AS DOUBLE)
      ELSE CAST(weight * (3 * everything - 4 * full_size) AS DOUBLE) / CAST(2 * weight_open AS DOUBLE) END AS target
  FROM filled, level
), parts AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS passes FROM goals
), units AS (
  SELECT source, place, sum(size) AS unit,
    sum(sum(size)) OVER (PARTITION BY source ORDER BY place) AS upto
  FROM sized GROUP BY source, place
), chosen AS (
  SELECT u.source, u.place,
    u.upto <= p.target - p.passes * p.source_size
      OR (u.upto - u.unit <= p.target - p.passes * p.source_size
          AND 2 * (p.target - p.passes * p.source_size - (u.upto - u.unit)) >= u.unit) AS extra
  FROM units u JOIN parts p ON u.source IS NOT DISTINCT FROM p.source
)
SELECT s.doc_id, s.size, p.source_size, p.target,
  CAST(s.size * (p.passes + CAST(c.extra AS BIGINT)) AS BIGINT) AS taken,
  CAST(p.passes + CAST(c.extra AS BIGINT) AS BIGINT) AS copies
FROM sized s
JOIN parts p ON s.source IS NOT DISTINCT FROM p.source
JOIN chosen c ON s.source IS NOT DISTINCT FROM c.source AND s.place = c.place
"""
