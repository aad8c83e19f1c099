"""Adapter: driver tables -> a landing event feed and country-risk reference.

The driver ships a generic ``events`` table (event_id, ts, user_id,
event_type, value, props) and ``nation``.  This module derives from them, with
ordinary DataFrame operations, the 58-field text feed the pipeline consumes
(one feed row per event, plus exact copies for a tenth of the events), and a
country-risk reference for three of the five regions.  A few deterministic
faults are injected into every scale so the rejection paths are exercised:
malformed ids, impossible dates, missing / malformed country codes, missing
place names and an unknown conflict class.  No row is ever dropped here.

The same rules are written in SQL in ``riskmart.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart import fs
from riskmart import schemas as S

# Fixed values of the adapter (documented in FIXTURES.md section 3).
N_NATIONS = 25
CLASS_OF_EVENT_TYPE = {"view": "1", "click": "2", "purchase": "3", "error": "4"}
REFERENCE_REGIONS_BELOW = 3          # regions 0..2 have a reference row
REFERENCE_UPDATED_AT = "2024-01-20"
OLD_REFERENCE_UPDATED_AT = "2023-12-15"
REFERENCE_INGESTION_DATE = "2024-01-21"
OLD_REFERENCE_INGESTION_DATE = "2023-12-16"
REDELIVERED_GOLDSTEIN = "-9.5"


# Observed schemas of the driver columns the adapter uses (FIXTURES.md section 2);
# reading with them skips the footer-inference job on every read.
DRIVER_SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read.schema(DRIVER_SCHEMAS[name]) if name in DRIVER_SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _event_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskmart.sources.files import spread
    # the driver's events table is one row group: one task would derive the whole feed
    events = spread(read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value"),
                    spark.sparkContext.defaultParallelism)
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    # TPC-H ``nation`` has exactly 25 rows at every scale factor (size bound by
    # specification), so it is broadcast without a runtime count.
    return events.join(F.broadcast(nation), (F.col("user_id") % N_NATIONS) == F.col("n_nationkey"))


# Feed positions filled from the driver tables (Spark SQL expressions over
# events x nation; ``cc`` is the two-letter code of the event's nation).
_CC = "concat(chr(97 + n_nationkey), chr(97 + n_regionkey))"
_FEED_EXPRS = {
    0: "CASE WHEN event_id % 101 = 0 THEN concat('bad', CAST(event_id AS STRING)) ELSE CAST(event_id AS STRING) END",
    1: "CASE WHEN event_id % 97 = 0 THEN '20240230' ELSE date_format(CAST(ts AS DATE), 'yyyyMMdd') END",
    29: "CASE event_type " + " ".join(f"WHEN '{t}' THEN '{c}'" for t, c in CLASS_OF_EVENT_TYPE.items()) + " END",
    30: "CAST(round(10.0D - value / 5, 2) AS STRING)",
    50: ("CASE WHEN user_id % 11 = 0 THEN NULL WHEN user_id % 17 = 0 THEN n_name "
         "ELSE concat('City ', CAST(user_id % 7 AS STRING), ', ', n_name) END"),
    51: f"CASE WHEN user_id % 29 = 0 THEN NULL WHEN user_id % 13 = 0 THEN 'xyz' ELSE {_CC} END",
    52: f"concat(upper({_CC}), lpad(CAST(n_nationkey AS STRING), 2, '0'))",
    53: "concat(CAST(n_nationkey * 3 - 36 AS STRING), '.5')",
    54: "concat(CAST(n_regionkey * 40 - 80 AS STRING), '.25')",
}


def event_feed(spark: SparkSession, sf_dir: str, with_ingest_day: bool = False) -> DataFrame:
    """58 text columns ``_c0.._c57`` (optionally plus ``ingest_day`` date).

    ``ingest_day`` is the day after the event's own date: the landing folder a
    file holding that event would arrive in.  Every tenth event is delivered
    twice (identical copies).
    """
    exprs = [f"{_FEED_EXPRS.get(i, 'CAST(NULL AS STRING)')} AS {n}" for i, n in enumerate(S.POSITIONAL_NAMES)]
    if with_ingest_day:
        exprs.append("date_add(CAST(ts AS DATE), 1) AS ingest_day")
    return (_event_base(spark, sf_dir)
            .selectExpr("*", "explode(sequence(1, CASE WHEN event_id % 10 = 0 THEN 2 ELSE 1 END)) AS _copy")
            .selectExpr(*exprs))


def _reference(spark: SparkSession, sf_dir: str, mult_base: int, base_offset: int,
               updated_at: str) -> DataFrame:
    hundredths = f"({mult_base} + n_nationkey * 5)"
    return (read_table(spark, sf_dir, "nation")
            .where(F.col("n_regionkey") < REFERENCE_REGIONS_BELOW)
            .selectExpr(
                f"upper({_CC}) AS country",
                f"concat('0.', lpad(CAST(n_nationkey * 3 + {base_offset} AS STRING), 2, '0')) AS baseline_risk",
                f"concat(CAST(div({hundredths}, 100) AS STRING), '.', "
                f"lpad(CAST({hundredths} % 100 AS STRING), 2, '0')) AS risk_multiplier",
                f"'{updated_at}' AS updated_at"))


def reference_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current country-risk reference as delivered (4 text columns)."""
    return _reference(spark, sf_dir, 80, 10, REFERENCE_UPDATED_AT)


def old_reference_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An older delivery with other values (newest must win)."""
    return _reference(spark, sf_dir, 50, 5, OLD_REFERENCE_UPDATED_AT)


def land_fixture(spark: SparkSession, sf_dir: str, root: str) -> dict[str, str]:
    """Write the derived feed into a landing area laid out like production:

    ``root/landing/events/ingestion_date=D/events-<D>-<k>.csv`` (tab-separated,
    one folder per arrival day) and two reference deliveries under
    ``root/landing/country_risk/ingestion_date=D/`` (an old and the current
    one).  Returns the two landing roots.
    """
    from riskmart.sinks.writers import write_events_tsv

    r = root.rstrip("/")
    events_root, ref_root = f"{r}/landing/events", f"{r}/landing/country_risk"
    feed = event_feed(spark, sf_dir, with_ingest_day=True)
    landed = feed.withColumn("ingestion_date", F.date_format("ingest_day", "yyyy-MM-dd")).drop("ingest_day")
    # about one file per arrival day, as delivered (AQE still splits a very large day over several tasks)
    write_events_tsv(landed.hint("rebalance", "ingestion_date"), events_root, partition_by="ingestion_date")
    for day in fs.partition_days(spark, events_root):
        fs.name_files(spark, f"{events_root}/ingestion_date={day}", f"events-{day.replace('-', '')}", ".csv")
    land_reference(spark, sf_dir, root)
    return {"events": events_root, "reference": ref_root}


def land_reference(spark: SparkSession, sf_dir: str, root: str) -> str:
    """The two reference deliveries of ``land_fixture``; returns their root."""
    from riskmart.sinks.writers import write_csv

    ref_root = f"{root.rstrip('/')}/landing/country_risk"
    write_csv(old_reference_feed(spark, sf_dir), f"{ref_root}/ingestion_date={OLD_REFERENCE_INGESTION_DATE}")
    write_csv(reference_feed(spark, sf_dir), f"{ref_root}/ingestion_date={REFERENCE_INGESTION_DATE}")
    return ref_root


def land_redelivery(spark: SparkSession, sf_dir: str, root: str, day: str, later_day: str) -> None:
    """A second delivery of one day's events with another Goldstein value: once into the
    day's own folder (a new file there), once into a later day's folder."""
    from riskmart.sinks.writers import write_events_tsv

    feed = event_feed(spark, sf_dir, with_ingest_day=True).where(F.col("ingest_day") == F.lit(day).cast("date"))
    changed = feed.drop("ingest_day").withColumn(S.POSITIONAL_NAMES[S.POS_GOLDSTEIN], F.lit(REDELIVERED_GOLDSTEIN))
    for folder in (day, later_day):
        write_events_tsv(changed, f"{root.rstrip('/')}/landing/events/ingestion_date={folder}", mode="append")
