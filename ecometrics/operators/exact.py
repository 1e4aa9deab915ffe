"""Sums, means and deviations that do not depend on the order of their rows.

Adding doubles one after another rounds at every step, so a total changes with the partitioning.  Here every value is
cut at fixed binary places into four whole digits of 20 bits, and values of one range of exponents (a bin) are
added up digit by digit as longs, which never round.  A class has one row per bin it touches (at most 106) after the
map-side combine; its rows meet once, carries are settled, and the total is rounded a single time: the result is the double
nearest to the true sum, as ``math.fsum`` gives it.  Infinities and NaN are counted apart and give what IEEE addition gives.

Deviations come from mergeable central moments: count, mean and squared distances per bin, brought together around the
exact mean.  A class and bin may hold 2**41 values; beyond that the longs overflow and the job fails.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS, DIGITS = 20, 4  # a bin spans as many exponents as a digit has bits
LOWEST = 53  # weight of digit j: 2 ** (BITS * j - LOWEST), so that the last bit of any value of bin j is whole
BASE = 1 << BITS
STATE = [*(f"__d{i}" for i in range(DIGITS)), "__n", "__up", "__down", "__nan"]

Merge = Callable[[str], Column]


def power_of_two(exponent: Column) -> Column:
    """Exact for whole exponents of normal doubles."""
    return F.pow(F.lit(2.0), exponent.cast("double"))


def scaled_by(value: Column, exponent: Column) -> Column:
    """value * 2 ** exponent in two steps, as the power alone may be out of range."""
    half = F.floor(exponent / 2)
    return value * power_of_two(half) * power_of_two(exponent - half)


# The expressions below are written as SQL, which Spark parses at once; built up call by call they take seconds.


def scaled_sql(value: str, exponent: str) -> str:
    half = f"floor(({exponent}) / 2)"
    return f"({value}) * pow(2D, {half}) * pow(2D, ({exponent}) - {half})"


def with_digits(df: DataFrame, values: Sequence[str]) -> DataFrame:
    """``df`` with the bin (NULL where nothing is to be added) and the signed digits of every value."""
    bins, sizes, digits = [], [], []
    for v in values:
        size = f"abs(CAST(`{v}` AS DOUBLE))"
        # The logarithm may be one off beside a power of two; LOWEST leaves a bit for it on either side.  NaN is above infinity.
        bins.append(f"CASE WHEN {size} > 0 AND {size} < double('infinity') THEN CAST(floor(log2({size}) / {BITS}) AS INT) END AS `__bin_{v}`")
        sizes.append(f"{scaled_sql(size, f'{LOWEST} - `__bin_{v}` * {BITS}')} AS `__size_{v}`")
        sign, whole = f"IF(`{v}` < 0, -1L, 1L)", f"`__size_{v}`"
        parts = [f"CAST({whole} - CAST(floor({whole} / {BASE}D) AS DOUBLE) * {BASE}D AS BIGINT)"]
        parts += [f"(floor({whole} / {BASE**i}D) & {BASE - 1}L)" for i in range(1, DIGITS - 1)]
        parts += [f"floor({whole} / {BASE ** (DIGITS - 1)}D)"]
        digits += [f"{sign} * {part} AS `__d{i}_{v}`" for i, part in enumerate(parts)]
    placed = df.selectExpr("*", *bins).selectExpr("*", *sizes).selectExpr("*", *digits)
    return placed.drop(*[f"__size_{v}" for v in values])


def folded(df: DataFrame, by: Sequence[str], values: Sequence[str], moments: Sequence[str] = (), keep: Sequence[Column] = ()) -> DataFrame:
    """A row per class and bins of the values: their states, and the aggregates ``keep``."""
    states = []
    for v in values:
        number = f"CAST(`{v}` AS DOUBLE)"
        tests = {"n": f"{number} IS NOT NULL", "up": f"{number} = double('infinity')", "down": f"{number} = double('-infinity')", "nan": f"isnan({number})"}
        states += [f"coalesce(sum(`__d{i}_{v}`), 0L) AS `__d{i}_{v}`" for i in range(DIGITS)]
        states += [f"count(CASE WHEN {test} THEN 1 END) AS `__{name}_{v}`" for name, test in tests.items()]
    for v in moments:
        states += [f"avg(`{v}`) AS `__mean_{v}`", f"var_pop(`{v}`) * count(`{v}`) AS `__m2_{v}`"]
    return with_digits(df, values).groupBy(*by, *[f"__bin_{v}" for v in values]).agg(*map(F.expr, states), *keep)


def stacked(df: DataFrame, keys: Sequence[str], values: Sequence[str], moments: Sequence[str] = (), keep: Sequence[str] = ()) -> DataFrame:
    """(keys..., __measure, __bin, the state's columns, keep...): a row per value of a folded row; ``keep`` stays with the first."""
    kinds, rows = {name: df.schema[name].dataType.simpleString() for name in keep}, []
    for i, v in enumerate(values):
        spread = [f"`__{x}_{v}`" if v in moments else "CAST(NULL AS DOUBLE)" for x in ("mean", "m2")]
        kept = [f"{f'`{name}`' if i == 0 else f'CAST(NULL AS {kind})'} AS `{name}`" for name, kind in kinds.items()]
        state = [f"`{name}_{v}` AS {name}" for name in STATE]
        rows.append(f"struct({', '.join([f'{i} AS __measure', f'`__bin_{v}` AS __bin', *state, f'{spread[0]} AS __mean', f'{spread[1]} AS __m2', *kept])})")
    return df.select(*keys, F.expr(f"inline(array({', '.join(rows)}))"))


def merged() -> list[Column]:
    """Aggregates that bring the digits and counts of one measure and bin together."""
    return [F.sum(name).alias(name) for name in STATE]


def gathered(values: Sequence[str], moments: Sequence[str] = ()) -> list[Column]:
    """Aggregates per class, over rows merged by bin: at most 106 bins of each measure, and its counts."""
    out = []
    for i, v in enumerate(values):
        digits = ", ".join(["__bin", *STATE[:DIGITS]])
        out.append(f"collect_list(CASE WHEN __measure = {i} AND __bin IS NOT NULL THEN struct({digits}) END) AS `__entries_{v}`")
        out += [f"sum(CASE WHEN __measure = {i} THEN {name} END) AS `{name}_of_{v}`" for name in STATE[DIGITS:]]
        if v in moments:
            known = f"__measure = {i} AND __n > 0"
            out.append(f"sort_array(collect_list(CASE WHEN {known} THEN struct(__bin, __n, __mean, __m2) END)) AS `__moments_{v}`")
    return [F.expr(x) for x in out]


def count_sql(v: str) -> str:
    return f"coalesce(`__n_of_{v}`, 0L)"


def total_sql(v: str) -> str:
    """The sum of a measure out of what ``gathered`` gives; NULL without any known value."""
    up, down, nan = (f"`{x}_of_{v}` > 0" for x in ("__up", "__down", "__nan"))
    return f"""CASE WHEN {count_sql(v)} = 0 THEN NULL
      WHEN {nan} OR ({up} AND {down}) THEN double('NaN') WHEN {up} THEN double('infinity') WHEN {down} THEN double('-infinity')
      ELSE {rounded_sql(f'`__entries_{v}`')} END"""


def rounded_sql(entries: str) -> str:
    """The double nearest to what bins with their digits add up to, halves to even."""
    first = f"array_min(transform({entries}, e -> e.__bin)) - 3"  # three blank digits below for the reading of the top four
    last = f"array_max(transform({entries}, e -> e.__bin)) + {DIGITS + 4}"  # and four above for what longs can carry
    of_place = " ".join(f"WHEN {i} THEN e.__d{i}" for i in range(DIGITS))
    digits = f"transform(sequence({first}, {last}), j -> aggregate({entries}, 0L, (total, e) -> total + CASE j - e.__bin {of_place} ELSE 0L END))"
    carry = f"""(s, d) -> named_struct('carry', shiftright(s.carry + d, {BITS}), 'out', concat(s.out, array((s.carry + d) & {BASE - 1}L)))"""
    settled = f"aggregate({digits}, named_struct('carry', 0L, 'out', CAST(array() AS ARRAY<BIGINT>)), {carry})"
    # The digits are those of a two's complement, the last carry is 0 or -1; top is the first that tells something.
    blank = f"CASE WHEN s.carry < 0 THEN {BASE - 1}L ELSE 0L END"
    top = f"greatest(coalesce(array_max(filter(transform(s.out, (x, i) -> CASE WHEN x <> {blank} THEN i END), i -> i IS NOT NULL)), 3), 3)"
    below = "CASE WHEN exists(slice(s.out, 1, greatest(t - 3, 0)), x -> x <> 0) THEN 1L ELSE 0L END"
    high = f"(s.carry * {BASE}L + element_at(s.out, t + 1)) * {BASE}L + element_at(s.out, t)"
    low = f"((element_at(s.out, t - 1) * {BASE}L + element_at(s.out, t - 2)) | {below})"
    # Both halves are exact doubles, with the rest told by the last bit: one addition, one rounding.
    top_four = f"CAST({high} AS DOUBLE) * {BASE**2}D + CAST({low} AS DOUBLE)"
    number = scaled_sql(top_four, f"({first} + t - 3) * {BITS} - {LOWEST}")
    read = f"element_at(transform(array({top}), t -> {number}), 1)"
    return f"IF(size({entries}) = 0, 0D, element_at(transform(array({settled}), s -> {read}), 1))"


def deviation_sql(v: str) -> str:
    """Sample deviation out of the moments of bins (count, mean, squares), around the mean of the class."""
    apart = f"(x.__mean - `mean_{v}`)"
    squares = f"aggregate(`__moments_{v}`, 0D, (t, x) -> t + x.__m2 + x.__n * {apart} * {apart})"
    return f"CASE WHEN `n_{v}` > 1 THEN sqrt({squares} / (`n_{v}` - 1)) END"


def totals(
    df: DataFrame,
    by: Sequence[str],
    values: Sequence[str],
    *,
    moments: Sequence[str] = (),
    keep: Mapping[str, tuple[Column, Merge]] | None = None,
) -> DataFrame:
    """(by..., sum_v, n_v, mean_v for every value, deviation_v for every one in ``moments``, keep...) in one scan.

    Classes may be NULL; NULL values are not counted.  ``keep`` holds further aggregates by name, each with the
    function that merges it (MIN again for a minimum, SUM for a count).  Without classes there is always one row.
    """
    keep = dict(keep or {})
    rows = folded(df, by, values, moments, [made.alias(name) for name, (made, _) in keep.items()])
    rows = stacked(rows, by, values, moments, list(keep))
    if len(values) > 1:  # several folded rows may share a bin of one measure
        mean, apart = "sum(__mean * __n) / sum(__n) AS __mean", "(x.__mean - __mean) * (x.__mean - __mean)"
        kept = [merge(name).alias(name) for name, (_, merge) in keep.items()]
        spread = [F.expr(x) for x in (mean, "sum(__m2) AS __m2", "collect_list(struct(__n, __mean)) AS __between")]
        rows = rows.groupBy(*by, "__measure", "__bin").agg(*merged(), *spread, *kept)
        between = f"__m2 + IF(size(__between) > 1, aggregate(__between, 0D, (t, x) -> t + x.__n * {apart}), 0D)"
        rows = rows.withColumn("__m2", F.expr(between))
    out = rows.groupBy(*by).agg(*gathered(values, moments), *[merge(name).alias(name) for name, (_, merge) in keep.items()])
    hidden = [f"`__moments_{v}`" for v in moments]
    sums = [x for v in values for x in (f"{total_sql(v)} AS `sum_{v}`", f"{count_sql(v)} AS `n_{v}`")]
    keys = [f"`{x}`" for x in (*by, *keep)]
    out = out.selectExpr(*keys, *sums, *hidden)
    out = out.selectExpr("*", *[f"try_divide(`sum_{v}`, `n_{v}`) AS `mean_{v}`" for v in values])
    if moments:
        out = out.selectExpr("*", *[f"{deviation_sql(v)} AS `deviation_{v}`" for v in moments])
    return out.drop(*[f"__moments_{v}" for v in moments])
