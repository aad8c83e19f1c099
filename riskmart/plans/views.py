"""Temp views over stored layers, so dashboard SQL runs through ``spark.sql``.

The Gold view carries the warehouse table's column names, so existing BI SQL
runs unchanged apart from the table name, e.g.::

    register_views(spark, cfg)
    spark.sql("SELECT NAM_COUNTRY, AVG(NUM_RISK_SCORE) AS avg_risk_score "
              "FROM risk_events GROUP BY NAM_COUNTRY ORDER BY avg_risk_score DESC")

Filters on ``DTE_EVENT`` / ``DTE_INGESTION`` prune partition folders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskmart.plans import runs as P
from riskmart.plans.runs import RunConfig

GOLD_VIEW = "risk_events"
SILVER_VIEW = "silver_events"


def register_gold(gold: DataFrame, name: str = GOLD_VIEW) -> str:
    gold.createOrReplaceTempView(name)
    return name


def register_views(spark: SparkSession, cfg: RunConfig) -> dict[str, str]:
    P.read_gold(spark, cfg).createOrReplaceTempView(GOLD_VIEW)
    P.read_silver(spark, cfg).createOrReplaceTempView(SILVER_VIEW)
    return {"gold": GOLD_VIEW, "silver": SILVER_VIEW}
