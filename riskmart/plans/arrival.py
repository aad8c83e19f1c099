"""Runs started by what has landed.

A file-source stream that delivers names only notices each delivered file once
and notes its day, without opening it; the noted days are then run as a whole (Bronze, Silver, Gold, staged replace), so a
new upload refreshes every layer and a call without new files runs nothing.  A
note is taken away only after its day has been run: a call that dies in between
is made up for by the next one.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart import fs
from riskmart.plans.runs import RunConfig, read_gold, run
from riskmart.streaming.incremental import landed_files


def notice(spark: SparkSession, landing_events: str, checkpoint: str) -> list[str]:
    """Note the days of every file landed since the last call; returns all noted days."""
    root = checkpoint.rstrip("/")
    # One short row for each file, written beside its day; only the folder names are read.
    rows = landed_files(spark, landing_events).select(F.col("ingestion_date").alias("day"), "path")
    query = (rows.writeStream.format("parquet").option("checkpointLocation", f"{root}/files")
             .partitionBy("day").trigger(availableNow=True).start(f"{root}/noted"))
    query.awaitTermination()
    return fs.partition_values(spark, f"{root}/noted", "day")


def run_arrived(spark: SparkSession, cfg: RunConfig, checkpoint: str) -> DataFrame | None:
    """Run the days that files have landed for since the last call; returns the stored Gold table."""
    days = notice(spark, cfg.landing_events, checkpoint)
    if not days:
        return read_gold(spark, cfg) if fs.exists(spark, cfg.runs) else None
    gold = run(spark, replace(cfg, ingestion_dates=days))
    for day in days:
        fs.delete(spark, f"{checkpoint.rstrip('/')}/noted/day={day}")
    return gold
