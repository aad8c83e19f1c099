"""Column profile (count, unique, top, freq, mean, std, min, quartiles, max).

Exact and distributed, from one pass over the rows:

1. The rows become counts of distinct (column, value), written once to the shared
   folder.  Partial aggregation comes first, so a value held by a third of the rows
   is one buffer row per map task, and null cells are left out before they
   become rows.  What is written is at most the cells themselves, each value once.
2. Everything but the quartiles is one aggregate over these counts, weighted by
   them; it also gives a mergeable quantile sketch of the distinct values.
3. A quartile is the value at a rank.  Columns with up to ``FEW`` distinct values
   are ranked at once, by a running count.  Of larger ones the sketch's cuts
   bracket the rank: one pass counts the rows between cuts, and the part that holds
   the rank is ranked (or cut again while it is still larger).  Parts are told
   apart by value alone, so results do not depend on partitioning, and a pass
   brings (columns x quartiles x cuts) numbers to the driver at most.

Integral columns are counted as 64-bit integers, so large ids stay apart.

``approximate=True`` takes the quartiles from ``percentile_approx`` over the rows
instead (rank error about n / accuracy).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskmart.operators.gold import ALL_REST, UNITS
from riskmart.session import new_work_dir

QUANTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
APPROX_ACCURACY = 10_000
#: Cuts of a bracket in one pass, and distinct values few enough for one task to rank.
CUTS = 64
FEW = 1_000_000
INTEGRAL = ("tinyint", "smallint", "int", "bigint")

COLUMNS = ["column_name", "count", "unique", "top", "freq", "mean", "std", "min", *QUANTILES, "max"]


def value_counts(df: DataFrame, numeric: list[str], categorical: list[str]) -> DataFrame:
    """(at, whole, num, txt, n): distinct non-null values of the profiled columns; ``at`` is the column's place in
    ``numeric`` followed by ``categorical``.  One of the three value columns is set."""
    types = dict(df.dtypes)

    def cell(at: int, c: str) -> Column:
        kind = "txt" if c in categorical else "whole" if types[c] in INTEGRAL else "num"
        values = {"whole": "bigint", "num": "double", "txt": "string"}
        return F.when(F.col(c).isNotNull(), F.struct(
            F.lit(at).alias("at"), *[(F.col(c) if k == kind else F.lit(None)).cast(t).alias(k) for k, t in values.items()]))

    cells = F.array_compact(F.array(*[cell(at, c) for at, c in enumerate([*numeric, *categorical])]))
    return df.select(F.explode(cells).alias("c")).select("c.*").groupBy("at", "whole", "num", "txt").agg(F.count(F.lit(1)).alias("n"))


def _value() -> Column:
    return F.coalesce("num", F.col("whole").cast("double"))


def _weighted_sum(x: Column, n: Column) -> Column:
    """``exact_sum`` of values that occur ``n`` times: whole units of 10^-6 as integers, the rest as a double."""
    units = F.when(F.abs(x) < ALL_REST, F.rint(x * UNITS)).when(x.isNotNull(), F.lit(0.0))
    whole = F.coalesce(F.try_sum(F.try_multiply(units.cast("bigint"), n)).cast("double"), F.sum(units * n)) / UNITS
    exact = F.count_if(F.try_multiply(units.cast("bigint"), n).isNull() & units.isNotNull()) == 0
    return F.when(exact, whole).otherwise(F.sum(units * n) / UNITS) + F.sum((x - units / UNITS) * n)


def _measures(counts: DataFrame, cuts: int) -> DataFrame:
    """One row a column: everything but spread and quartiles, and the sketch's cuts."""
    x = _value()
    at = [i / cuts for i in range(1, cuts)]
    return counts.groupBy("at").agg(
        F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"),
        F.min_by("txt", F.struct((-F.col("n")).alias("o"), "txt")).alias("top"),
        F.max(F.when(F.col("txt").isNotNull(), F.col("n"))).alias("freq"),
        (_weighted_sum(x, F.col("n")) / F.sum("n")).alias("mean"), F.min(x).alias("min"), F.max(x).alias("max"),
        F.percentile_approx(x, at, 20 * cuts).alias("cuts"))


def _spread(counts: DataFrame, means: dict[int, float]) -> dict[int, float]:
    """Sum of squared distances from the mean, by column."""
    mean = F.element_at(F.create_map(*[F.lit(v) for item in means.items() for v in item]), F.col("at"))
    off = _value() - mean
    rows = counts.where(F.col("at").isin(list(means))).groupBy("at").agg(F.sum(off * off * F.col("n"))).collect()
    return {r[0]: r[1] for r in rows}


class _Rank:
    """A rank looked for in a column: what is known of the values around it."""

    def __init__(self, at: int, rank: int, lo: float, hi: float, distinct: int):
        self.at, self.rank, self.lo, self.hi, self.below, self.distinct = at, rank, lo, hi, 0, distinct


def _inside(counts: DataFrame, ranks: list[_Rank]) -> DataFrame:
    """The counts of values inside the brackets, once a bracket (``k``: its place in ``ranks``)."""
    spark = counts.sparkSession
    # At most two ranks a quartile and column: some numbers each.
    b = spark.createDataFrame([(k, r.at, r.lo, r.hi) for k, r in enumerate(ranks)], "k int, at int, lo double, hi double")
    return counts.join(F.broadcast(b), "at").withColumn("x", _value()).where((F.col("x") >= F.col("lo")) & (F.col("x") <= F.col("hi")))


def _ranked(counts: DataFrame, ranks: list[_Rank]) -> dict[int, float]:
    """The value at every rank, of brackets with few distinct values: a running count a bracket."""
    before = Window.partitionBy("k").orderBy("x").rowsBetween(Window.unboundedPreceding, -1)
    left = F.element_at(F.create_map(*[F.lit(v) for k, r in enumerate(ranks) for v in (k, r.rank - r.below)]), F.col("k"))
    run = _inside(counts, ranks).withColumn("run", F.coalesce(F.sum("n").over(before), F.lit(0)))
    rows = run.where((left >= F.col("run")) & (left < F.col("run") + F.col("n"))).select("k", "x").collect()
    return {r.k: r.x for r in rows}


def _narrow(counts: DataFrame, ranks: list[_Rank], cuts: dict[int, list[float]]) -> None:
    """Move every bracket to the part between two cuts that holds its rank."""
    spark = counts.sparkSession
    table = F.broadcast(spark.createDataFrame([(k, sorted(set(c))) for k, c in cuts.items()], "k int, cuts array<double>"))
    part = F.size(F.filter("cuts", lambda c: c < F.col("x")))
    rows = _inside(counts, ranks).join(table, "k").groupBy("k", part.alias("part")).agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("distinct"), F.min("x").alias("lo"), F.max("x").alias("hi")).collect()
    for k, r in enumerate(ranks):
        below = r.below
        for row in sorted((x for x in rows if x.k == k), key=lambda x: x.part):
            if below <= r.rank < below + row.n:
                r.lo, r.hi, r.below, r.distinct = row.lo, row.hi, below, row.distinct
                break
            below += row.n


def exact_quantiles(counts: DataFrame, measured: list, cuts: int = CUTS, few: int = FEW) -> dict[int, dict[str, float]]:
    """{column: {p25, p50, p75}} by linear interpolation between neighbouring ranks."""
    ranks = {(m.at, r): _Rank(m.at, r, m.min, m.max, m.unique) for m in measured
             for q in QUANTILES.values() for r in (int((m["count"] - 1) * q), -int(-(m["count"] - 1) * q // 1))}
    sketch = {m.at: list(m.cuts) for m in measured}
    found: dict[tuple, float] = {}
    first = True
    while len(found) < len(ranks):
        small = [r for key, r in ranks.items() if key not in found and r.distinct <= few]
        large = [r for key, r in ranks.items() if key not in found and r.distinct > few]
        if small:
            found |= {(small[k].at, small[k].rank): x for k, x in _ranked(counts, small).items()}
        if large:
            if first:
                now = {k: sketch[r.at] for k, r in enumerate(large)}
            else:
                points = [i / cuts for i in range(1, cuts)]
                now = {r.k: list(r.cuts) for r in _inside(counts, large).groupBy("k").agg(
                    F.percentile_approx("x", points, 20 * cuts).alias("cuts")).collect()}
            _narrow(counts, large, now)
            first = False
    out: dict[int, dict[str, float]] = {}
    for m in measured:
        for name, q in QUANTILES.items():
            h = (m["count"] - 1) * q
            lo, hi = found[m.at, int(h)], found[m.at, -int(-h // 1)]
            out.setdefault(m.at, {})[name] = lo + (hi - lo) * (h - int(h))
    return out


def approx_quantiles(df: DataFrame, numeric: list[str], accuracy: int = APPROX_ACCURACY) -> dict[int, dict[str, float]]:
    """{column: {p25, p50, p75}} from mergeable sketches of all columns at once (values of the data, not interpolated)."""
    row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), list(QUANTILES.values()), accuracy).alias(f"q{k}")
                   for k, c in enumerate(numeric)]).first()
    return {k: dict(zip(QUANTILES, row[k])) for k in range(len(numeric)) if row[k] is not None}


def describe(df: DataFrame, numeric: list[str], categorical: list[str], approximate: bool = False,
             accuracy: int = APPROX_ACCURACY, cuts: int = CUTS, few: int = FEW) -> DataFrame:
    """AGG-17: one row per profiled column.

    Numeric columns get count, unique, mean, std (sample), min, quartiles, max;
    text columns get count, unique, top (most frequent, smallest on ties) and
    freq.  A column without values has count and unique 0 and nulls.
    """
    spark, names = df.sparkSession, [*numeric, *categorical]
    path = new_work_dir(spark, "value-counts")
    value_counts(df, numeric, categorical).write.parquet(path)
    counts = spark.read.parquet(path)
    measured = {r.at: r for r in _measures(counts, cuts).collect()}  # a row a column
    numbers = [measured[k] for k in range(len(numeric)) if k in measured]
    quart: dict[int, dict[str, float]] = {}
    spread: dict[int, float] = {}
    if numbers:
        spread = _spread(counts, {m.at: m.mean for m in numbers})
        quart = approx_quantiles(df, numeric, accuracy) if approximate else exact_quantiles(counts, numbers, cuts, few)
    rows = []
    for at, name in enumerate(names):
        m = measured.get(at)
        if m is None:
            rows.append((name, 0, 0, None, None, None, None, None, *[None] * len(QUANTILES), None))
            continue
        std = (spread[at] / (m["count"] - 1)) ** 0.5 if at in spread and m["count"] > 1 else None
        mean = m.mean if at in spread else None
        rows.append((name, m["count"], m.unique, m.top, m.freq, mean, std, m.min, *[quart.get(at, {}).get(k) for k in QUANTILES], m.max))
    kinds = {"column_name": "string", "count": "bigint", "unique": "bigint", "top": "string", "freq": "bigint"}
    return spark.createDataFrame(rows, ", ".join(f"`{c}` {kinds.get(c, 'double')}" for c in COLUMNS))
