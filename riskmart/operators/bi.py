"""BI queries over the Gold mart (dashboard SQL and runbook checks).

Each function takes a Gold DataFrame and returns a lazy DataFrame.  Every
``limit`` carries a full tie-break on the grain columns with explicit null
ordering, so results are reproducible; ``orderBy().limit(k)`` plans as a
per-partition top-k followed by a k-row merge (TakeOrderedAndProject).
Sums of scores do not depend on row order (see ``gold.exact_sum``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.functions.columns import risk_level
from riskmart.operators.gold import exact_avg, exact_sum

CRITICAL_SCORE = 75.0
DEMO_SCORE = 60.0


def grain_order() -> list[Column]:
    return [F.col("DTE_EVENT").asc_nulls_first(), F.col("NAM_COUNTRY").asc_nulls_first(),
            F.col("NAM_CITY").asc_nulls_first(), F.col("DTE_INGESTION").asc_nulls_first()]


def critical(gold: DataFrame, threshold: float = CRITICAL_SCORE) -> DataFrame:
    """FLT-2 / TOP-5: every Gold row at or above the critical score."""
    return (gold.where(F.col("NUM_RISK_SCORE") >= threshold)
                .orderBy(F.col("NUM_RISK_SCORE").desc_nulls_last(), *grain_order()))


def demo(gold: DataFrame, threshold: float = DEMO_SCORE, k: int = 25) -> DataFrame:
    """FLT-3 / TOP-1 / PRJ-19: five columns of the top-k scores >= threshold."""
    return (gold.where(F.col("NUM_RISK_SCORE") >= threshold)
                .orderBy(F.col("NUM_RISK_SCORE").desc_nulls_last(), *grain_order(),
                         F.col("CNT_EVENTS").asc())
                .limit(k)
                .select("DTE_EVENT", "NAM_COUNTRY", "NAM_CITY", "CNT_EVENTS", "NUM_RISK_SCORE"))


def country_avg(gold: DataFrame) -> DataFrame:
    """AGG-2."""
    return (gold.groupBy("NAM_COUNTRY")
                .agg(exact_avg("NUM_RISK_SCORE").alias("avg_risk_score"))
                .orderBy(F.col("avg_risk_score").desc_nulls_last(), F.col("NAM_COUNTRY").asc_nulls_first()))


def load_summary(gold: DataFrame, approximate: bool = False) -> DataFrame:
    """AGG-3: rows and distinct days / countries / cities (nulls not counted).

    ``approximate=True`` swaps the exact distinct counts (Expand + two-phase
    aggregate) for HyperLogLog++ sketches.
    """
    distinct = (lambda c: F.approx_count_distinct(c)) if approximate else (lambda c: F.count_distinct(c))
    return gold.agg(
        F.count(F.lit(1)).alias("rows"),
        distinct("DTE_EVENT").alias("days_loaded"),
        distinct("NAM_COUNTRY").alias("countries"),
        distinct("NAM_CITY").alias("cities"),
    )


def events_per_day(gold: DataFrame) -> DataFrame:
    """AGG-4."""
    return (gold.groupBy("DTE_EVENT").agg(F.sum("CNT_EVENTS").alias("total_events"))
                .orderBy(F.col("DTE_EVENT").desc_nulls_last()))


def time_evolution(gold: DataFrame) -> DataFrame:
    """AGG-5."""
    return (gold.groupBy("DTE_EVENT")
                .agg(exact_avg("NUM_RISK_SCORE").alias("avg_risk_score"),
                     F.max("NUM_RISK_SCORE").alias("max_risk_score"))
                .orderBy(F.col("DTE_EVENT").asc_nulls_first()))


def top_hotspots(gold: DataFrame, k: int = 10) -> DataFrame:
    """AGG-6 / PRJ-12: location = 'city, country' (null city -> null location)."""
    location = F.concat(F.col("NAM_CITY"), F.lit(", "), F.col("NAM_COUNTRY"))
    return (gold.groupBy(location.alias("location"))
                .agg(exact_sum("NUM_RISK_SCORE").alias("total_risk"))
                .orderBy(F.col("total_risk").desc_nulls_last(), F.col("location").asc_nulls_first())
                .limit(k))


def top_cities(gold: DataFrame, k: int = 20) -> DataFrame:
    """AGG-7."""
    return (gold.groupBy("NAM_COUNTRY", "NAM_CITY")
                .agg(exact_sum("NUM_RISK_SCORE").alias("total_risk_score"),
                     F.sum("CNT_EVENTS").alias("total_events"))
                .orderBy(F.col("total_risk_score").desc_nulls_last(), F.col("NAM_COUNTRY").asc_nulls_first(),
                         F.col("NAM_CITY").asc_nulls_first())
                .limit(k))


def country_total(gold: DataFrame, k: int = 20) -> DataFrame:
    """AGG-8."""
    return (gold.groupBy("NAM_COUNTRY")
                .agg(exact_sum("NUM_RISK_SCORE").alias("total_risk_score"),
                     F.sum("CNT_EVENTS").alias("total_events"))
                .orderBy(F.col("total_risk_score").desc_nulls_last(), F.col("NAM_COUNTRY").asc_nulls_first())
                .limit(k))


def rows_per_day(gold: DataFrame) -> DataFrame:
    """AGG-9."""
    return (gold.groupBy("DTE_EVENT").agg(F.count(F.lit(1)).alias("rows"))
                .orderBy(F.col("DTE_EVENT").desc_nulls_last()))


def country_by_day(gold: DataFrame, day: str, k: int = 20) -> DataFrame:
    """FLT-4 / AGG-10: one event date (partition-pruned on a stored mart)."""
    return (gold.where(F.col("DTE_EVENT") == F.lit(day).cast("date"))
                .groupBy("NAM_COUNTRY")
                .agg(exact_sum("NUM_RISK_SCORE").alias("total_score"))
                .orderBy(F.col("total_score").desc_nulls_last(), F.col("NAM_COUNTRY").asc_nulls_first())
                .limit(k))


def first_rows(gold: DataFrame, k: int = 50) -> DataFrame:
    """TOP-2: newest event dates first."""
    return gold.orderBy(F.col("DTE_EVENT").desc_nulls_last(), *grain_order()[1:]).limit(k)


def with_risk_level(gold: DataFrame, null_label: str | None = None) -> DataFrame:
    """PRJ-13 (dashboard, null -> BAJO) / PRJ-14 (analysis, null -> UNKNOWN)."""
    return gold.withColumn("RISK_LEVEL", risk_level("NUM_RISK_SCORE", null_label))


def dashboard_table(gold: DataFrame) -> DataFrame:
    """AGG-19: (date, country, city, level) -> events, mean score, mean Goldstein."""
    return (with_risk_level(gold)
            .groupBy("DTE_EVENT", "NAM_COUNTRY", "NAM_CITY", "RISK_LEVEL")
            .agg(F.sum("CNT_EVENTS").alias("CNT_EVENTS"),
                 exact_avg("NUM_RISK_SCORE").alias("NUM_RISK_SCORE"),
                 exact_avg("NUM_GOLDSTEIN_AVG").alias("NUM_GOLDSTEIN_AVG")))


def heatmap(gold: DataFrame) -> DataFrame:
    """AGG-20: map weight = summed score per city."""
    return gold.groupBy("NAM_CITY").agg(exact_sum("NUM_RISK_SCORE").alias("weight"))
