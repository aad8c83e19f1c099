"""Incremental Silver: pick up newly landed event files exactly once.

A file-source stream over the landing root (same schema, glob filter and folder
rule as the batch reader) hands its micro-batches to ``add_batch``: the batch's
own copies are dropped as in a batch run, then the events that the stored Silver
of the same ingestion days holds already (an anti join against the key columns
of just these days' folders), and the rest is enriched and stored.

What was stored decides, not a window of remembered keys: a copy may come any
time later, in any order of days or files, and no state grows in the checkpoint.
Of copies in different micro-batches the one read first stays.

A micro-batch writes partitions of its own (``.../batch=<query>-<number>``)
by dynamic partition overwrite and does not look at them when it looks for
stored keys.  So one that is repeated after a crash, which Spark does with
exactly the same files, writes the same rows again in the same place.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart import fs
from riskmart import schemas as S
from riskmart.operators.silver import DEDUP_KEYS, PREPARED_COLUMNS, dedup_events, enrich, prepare, reference_dimension
from riskmart.sources.files import EVENT_FILE_GLOB, NO_QUOTE, is_day

PREPARED = T.StructType([S.SILVER[c] for c in PREPARED_COLUMNS])
LEAVES = ("ingestion_date", "event_date", "batch")


def _limited(reader, max_files_per_trigger: int | None, max_bytes_per_trigger: str | None):
    """A micro-batch takes everything there is, or as much as one of the limits allows
    (bytes suit a large landing area, files a small one)."""
    if max_files_per_trigger and max_bytes_per_trigger:
        raise ValueError("give one limit of a micro-batch, files or bytes")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    return reader


def landing_stream(spark: SparkSession, landing_root: str, max_files_per_trigger: int | None = None,
                   max_bytes_per_trigger: str | None = None) -> DataFrame:
    """Rows of newly landed files, oldest first."""
    schema = T.StructType(S.EVENTS_POSITIONAL.fields + [T.StructField("ingestion_date", T.StringType(), True)])
    reader = (spark.readStream.schema(schema)
              .option("sep", "\t").option("header", "false").option("quote", NO_QUOTE)
              .option("pathGlobFilter", EVENT_FILE_GLOB))
    return _limited(reader, max_files_per_trigger, max_bytes_per_trigger).csv(landing_root).where(is_day())


def landed_files(spark: SparkSession, landing_root: str) -> DataFrame:
    """(ingestion_date, path) of newly landed files, as a stream; no file is opened as long as nothing else is selected."""
    schema = T.StructType([T.StructField("path", T.StringType()), T.StructField("modificationTime", T.TimestampType()),
                           T.StructField("length", T.LongType()), T.StructField("content", T.BinaryType()),
                           T.StructField("ingestion_date", T.StringType())])
    return (spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", EVENT_FILE_GLOB)
            .load(landing_root).where(is_day()).select("ingestion_date", "path"))


def stored_keys(spark: SparkSession, out: str, days: list[str], batch: str) -> DataFrame:
    """Keys that other micro-batches have stored for ``days``; only these days' folders are listed, only the key column is read."""
    held = [f"{out.rstrip('/')}/ingestion_date={d}" for d in days]
    held = [folder for folder in held if fs.exists(spark, folder)]
    schema = T.StructType([S.SILVER["globaleventid"], *(T.StructField(c, T.StringType()) for c in LEAVES)])
    if not held:
        return spark.createDataFrame([], schema).select(*DEDUP_KEYS)
    rows = spark.read.schema(schema).option("basePath", out).parquet(*held)
    return rows.where(F.col("batch") != batch).select(*DEDUP_KEYS)


def add_batch(prepared: DataFrame, out: str, batch: str, ref_raw: DataFrame | None = None) -> None:
    """STR-1 / STR-2: store the events of a micro-batch that are not stored yet, enriched if a reference is given."""
    spark = prepared.sparkSession
    prepared = prepared.persist()  # parsed once for the days and once for the rows otherwise
    try:
        days = sorted(r[0] for r in prepared.select("ingestion_date").distinct().collect())
        if not days:
            return
        fresh = dedup_events(prepared).join(stored_keys(spark, out, days, batch), DEDUP_KEYS, "left_anti").select(*PREPARED_COLUMNS)
        if ref_raw is not None:
            fresh = enrich(fresh, reference_dimension(ref_raw))
        (fresh.withColumn("batch", F.lit(batch)).hint("rebalance", "ingestion_date", "event_date")
              .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*LEAVES).parquet(out))
    finally:
        prepared.unpersist()


def run_available(spark: SparkSession, landing_root: str, out: str, checkpoint: str, ingestion_ts: str,
                  ref_raw: DataFrame | None = None, **limits) -> None:
    """Store every file available now, in micro-batches, then stop (``ref_raw=None``: no enrichment)."""
    query = hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest()[:8]
    prepared = prepare(landing_stream(spark, landing_root, **limits), None, ingestion_ts)
    stream = (prepared.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
              .foreachBatch(lambda frame, number: add_batch(frame, out, f"{query}-{number:010d}", ref_raw)))
    stream.start().awaitTermination()


def read_stream_output(spark: SparkSession, out: str, schema: T.StructType = S.SILVER) -> DataFrame:
    """What has been stored so far: ``S.SILVER``, or ``PREPARED`` without a reference."""
    if not fs.exists(spark, out):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(out).select(*schema.fieldNames())
