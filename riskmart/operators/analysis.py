"""Analysis of the Gold mart and of raw inputs (notebook computations).

Frame-wide statistics (min/max for normalisation) are a one-row aggregate
used as scalar subqueries: no unpartitioned window, no join, no driver round trip.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from riskmart.functions.columns import RISK_LEVEL_UNKNOWN, risk_level
from riskmart.operators.bi import grain_order
from riskmart.operators.gold import exact_avg, exact_sum

# Fixed values of the proposed composite score.
W_VOLUME = 0.6
W_CONFLICT = 0.4
NORM_EPSILON = 1e-9


def trend(gold: DataFrame) -> DataFrame:
    """AGG-11: per day: total events, mean and max score (null days dropped)."""
    return (gold.where(F.col("DTE_EVENT").isNotNull()).groupBy("DTE_EVENT")
                .agg(F.sum("CNT_EVENTS").alias("total_events"),
                     exact_avg("NUM_RISK_SCORE").alias("avg_score"),
                     F.max("NUM_RISK_SCORE").alias("max_score"))
                .orderBy("DTE_EVENT"))


def top_countries(gold: DataFrame, k: int = 15) -> DataFrame:
    """AGG-12: countries by total score (null country dropped), top k."""
    return (gold.where(F.col("NAM_COUNTRY").isNotNull()).groupBy("NAM_COUNTRY")
                .agg(exact_sum("NUM_RISK_SCORE").alias("total_score"),
                     F.sum("CNT_EVENTS").alias("total_events"))
                .orderBy(F.col("total_score").desc_nulls_last(), F.col("NAM_COUNTRY").asc())
                .limit(k))


def top_rows(gold: DataFrame, k: int = 20) -> DataFrame:
    """TOP-3: the k highest-scoring Gold rows, six columns."""
    return (gold.orderBy(F.col("NUM_RISK_SCORE").desc_nulls_last(), *grain_order(), F.col("CNT_EVENTS").asc())
                .limit(k)
                .select("DTE_EVENT", "NAM_COUNTRY", "NAM_CITY", "CNT_EVENTS", "NUM_GOLDSTEIN_AVG", "NUM_RISK_SCORE"))


def level_counts(gold: DataFrame) -> DataFrame:
    """AGG-15: frequency of each alert level, UNKNOWN for null scores."""
    return (gold.select(risk_level("NUM_RISK_SCORE", RISK_LEVEL_UNKNOWN).alias("RISK_LEVEL"))
                .groupBy("RISK_LEVEL").agg(F.count(F.lit(1)).alias("count"))
                .orderBy(F.col("count").desc(), F.col("RISK_LEVEL").asc()))


def proposed_score(gold: DataFrame, w_volume: float = W_VOLUME, w_conflict: float = W_CONFLICT) -> DataFrame:
    """PRJ-15..18 + AGG-14: volume/conflict composite normalised over the frame.

    volume   = log1p(events), conflict = max(0, -Goldstein) (null stays null);
    each is min-max normalised over the whole frame; the score is
    100 * (w_volume * volume_n + w_conflict * conflict_n).

    The bounds are a one-row aggregate joined as scalar subqueries would be: the
    plan runs no job while it is built.  ``gold`` is read twice, so pass a stored mart.
    """
    parts = gold.select(
        "*",
        F.log1p(F.coalesce(F.col("CNT_EVENTS"), F.lit(0)).cast("double")).alias("_vol"),
        F.when(F.col("NUM_GOLDSTEIN_AVG").isNotNull(),
               F.greatest(-F.col("NUM_GOLDSTEIN_AVG"), F.lit(0.0))).alias("_conf"),
    )
    bounds = parts.agg(F.min("_vol").alias("vmin"), F.max("_vol").alias("vmax"),
                       F.min("_conf").alias("cmin"), F.max("_conf").alias("cmax"))
    bound = {c: bounds.select(c).scalar() for c in bounds.columns}
    vol_n = (F.col("_vol") - bound["vmin"]) / (bound["vmax"] - bound["vmin"] + NORM_EPSILON)
    conf_n = (F.col("_conf") - bound["cmin"]) / (bound["cmax"] - bound["cmin"] + NORM_EPSILON)
    return parts.select(
        "DTE_EVENT", "NAM_COUNTRY", "NAM_CITY", "CNT_EVENTS", "NUM_GOLDSTEIN_AVG", "NUM_RISK_SCORE",
        vol_n.alias("VOL_NORM"), conf_n.alias("CONF_NORM"),
        (100 * (w_volume * vol_n + w_conflict * conf_n)).alias("RISK_SCORE_PROPOSED"),
    )


def score_correlation(gold: DataFrame) -> DataFrame:
    """AGG-13: Pearson correlation of current vs proposed score (null pairs skipped)."""
    p = proposed_score(gold)
    return p.agg(F.corr("NUM_RISK_SCORE", "RISK_SCORE_PROPOSED").alias("corr"),
                 F.count(F.when(F.col("NUM_RISK_SCORE").isNotNull() & F.col("RISK_SCORE_PROPOSED").isNotNull(),
                                F.lit(1))).alias("pairs"))


NULL_COUNTS = "dataset string, column_name string, null_count bigint, total_rows bigint"


def _null_aggregates(columns: list[str]) -> list[Column]:
    """Rows, and values per column: a plain count is half the work of counting nulls."""
    return [F.count(F.lit(1)).alias("_rows"), *[F.count(c).alias(f"_n{i}") for i, c in enumerate(columns)]]


def null_counts(df: DataFrame, dataset: str) -> DataFrame:
    """AGG-16/18: nulls per column and the row count of one input: one aggregate, most nulls first."""
    counts = df.agg(*_null_aggregates(df.columns))
    # ordered inside its one row: no sort exchange
    long = F.array_sort(F.array(*[F.struct(F.col(f"_n{i}").alias("o"), F.lit(c).alias("column_name"),
                                           (F.col("_rows") - F.col(f"_n{i}")).alias("null_count"))
                                  for i, c in enumerate(df.columns)]))
    return (counts.select(F.explode(long).alias("x"), F.col("_rows").alias("total_rows"))
                  .select(F.lit(dataset).alias("dataset"), "x.column_name", "x.null_count", "total_rows"))


class NullCounts:
    """AGG-16/18 beside a job that reads the rows anyway: observed metrics, no scan of their own.

    Put ``observed(df)`` where ``df`` would be written or aggregated (in the job's last stage, so that no row is
    seen twice), and take ``rows()`` after the action.  ``names`` are the reported names of ``columns``."""

    def __init__(self, dataset: str, columns: list[str], names: list[str] | None = None):
        self.dataset, self.columns, self.names = dataset, columns, names or columns
        self._observation = Observation()

    def observed(self, df: DataFrame) -> DataFrame:
        return df.observe(self._observation, *_null_aggregates(self.columns))

    def rows(self) -> list[tuple[str, str, int, int]]:
        """(dataset, column_name, null_count, total_rows), most nulls first."""
        found = self._observation.get
        out = [(self.dataset, name, found["_rows"] - found[f"_n{i}"], found["_rows"]) for i, name in enumerate(self.names)]
        return sorted(out, key=lambda r: (-r[2], r[1]))
