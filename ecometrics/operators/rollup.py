"""One table with several grains of the same totals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ecometrics.functions.measures import divided, zero_as_null
from ecometrics.operators import exact


def multi_grain(
    df: DataFrame,
    grains: Sequence[str],
    label: str,
    total_label: str,
    count: str,
    means: Mapping[str, str],
    sums: Mapping[str, str],
    ratios: Mapping[str, tuple[str, str, float]],
) -> DataFrame:
    """A row per value of each grain, and one for everything.

    The detail is read and shuffled once, folded to the states of exact sums per combined grain; the grains and the
    total are built from that small table.  The total row exists for empty input too.  A ratio is a ratio of sums in
    which a missing amount counts as zero.  Sums are the same in any order (see ``exact``).  At least one mean, sum or
    ratio is wanted.
    """
    sources = sorted({*means.values(), *sums.values(), *[c for r in ratios.values() for c in r[:2]]})
    folded = exact.folded(df, grains, sources, keep=[F.count(F.lit(1)).alias("__rows")])
    states = exact.stacked(folded, grains, sources, keep=["__rows"])
    totals = [F.coalesce(F.sum("__rows"), F.lit(0)).alias(count), *exact.gathered(sources)]

    def shown(gathered: DataFrame) -> DataFrame:
        def filled(name):
            return F.coalesce(F.col(f"__sum_{name}"), F.lit(0.0))

        amounts = [f"{exact.total_sql(v)} AS `__sum_{v}`" for v in sources]
        known = [f"{exact.count_sql(v)} AS `__known_{v}`" for v in sources]
        return gathered.selectExpr("__label", f"`{count}`", *amounts, *known).select(
            "__label",
            count,
            *[divided(f"__sum_{source}", f"__known_{source}").alias(name) for name, source in means.items()],
            *[F.col(f"__sum_{source}").alias(name) for name, source in sums.items()],
            *[
                (divided(filled(top), zero_as_null(filled(bottom))) * F.lit(float(factor))).alias(name)
                for name, (top, bottom, factor) in ratios.items()
            ],
        )

    merged = [*exact.merged(), F.sum("__rows").alias("__rows")]
    key = ["__measure", "__bin"]
    group_of = reduce(
        lambda rest, grain: F.when(F.grouping(grain) == 0, F.col(grain)).otherwise(rest), reversed(grains), F.lit(None)
    )
    which = reduce(
        lambda rest, i: F.when(F.grouping(grains[i]) == 0, F.lit(i)).otherwise(rest), reversed(range(len(grains))), F.lit(None)
    )
    sets = states.groupingSets([[grain, *key] for grain in grains], *grains, *key)
    by_bin = sets.agg(group_of.alias("__of"), which.alias("__grain"), *merged)
    by_grain = by_bin.groupBy("__grain", F.col("__of").alias("__label")).agg(*totals).drop("__grain")
    total = states.groupBy(*key).agg(*merged).agg(*totals).withColumn("__label", F.lit(total_label))
    return shown(by_grain.unionByName(total)).withColumnRenamed("__label", label)
