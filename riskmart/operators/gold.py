"""Gold layer: daily risk mart per (ingestion, event date, country, city).

One hash aggregation with partial (map-side) combine, so a hot group costs one
buffer row per map task, not one task.

Sums are the same for every row order where the values allow it: a value is
split into whole units of 10^-6 (summed as 64-bit integers, which is exact) and
the rest (summed as a double, and exactly 0 for values of up to six decimals).
Nothing is cut: smaller values live in the rest, values of 10^9 and more are
all rest, and should the integer sum overflow, the units are summed as doubles.
The buffers are fixed-width, so the aggregate stays a hash aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GROUP_KEYS = ["ingestion_date", "event_date", "country", "city"]
UNITS = 1e6
ALL_REST = 1e9
# A weight times a multiplier is off by a binary bit or so (0.75 * 1.15 = 0.8624999999999999). Rounding the
# score here first keeps that from deciding a tie at the second digit.
NOISE_DIGITS = 9


def exact_sum(c: str | Column) -> Column:
    """Sum of the non-null values (null when there are none), as described above."""
    x = (F.col(c) if isinstance(c, str) else c).cast("double")
    units = F.when(F.abs(x) < ALL_REST, F.rint(x * UNITS)).when(x.isNotNull(), F.lit(0.0))
    whole = F.coalesce(F.try_sum(units.cast("bigint")).cast("double"), F.sum(units)) / UNITS
    return whole + F.sum(x - units / UNITS)


def exact_avg(c: str | Column) -> Column:
    """Mean of the non-null values (null when there are none)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.try_divide(exact_sum(col), F.count(col))


def gold(silver: DataFrame) -> DataFrame:
    """PIP-3 / AGG-1 + PRJ-9..11."""
    agg = silver.groupBy(*GROUP_KEYS).agg(
        F.count(F.lit(1)).alias("CNT_EVENTS"),
        exact_sum("risk_weight_adj").alias("_w"),
        exact_avg("goldstein_scale").alias("NUM_GOLDSTEIN_AVG"),
    )
    return agg.select(
        F.col("event_date").alias("DTE_EVENT"),
        F.col("country").alias("NAM_COUNTRY"),
        F.col("city").alias("NAM_CITY"),
        "CNT_EVENTS",
        "NUM_GOLDSTEIN_AVG",
        F.round(F.round(F.col("_w") / F.col("CNT_EVENTS") * 100, NOISE_DIGITS), 2).alias("NUM_RISK_SCORE"),
        F.to_date("ingestion_date").alias("DTE_INGESTION"),
    )
