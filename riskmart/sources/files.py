"""Readers for landing, Bronze and stored marts.

All readers use explicit schemas: no inference pass, and the column count does
not depend on the first row of a file.  The landing layout is
``<root>/ingestion_date=YYYY-MM-DD/<file>.csv|.tsv``; partition discovery turns
the folder into an ``ingestion_date`` column, so a filter on it prunes whole
folders before any file is opened.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart import fs
from riskmart import schemas as S
from riskmart.functions.columns import check_ingestion_date, lenient_double, lenient_integral
from riskmart.sinks import register as REG

EVENT_FILE_GLOB = "*.{csv,tsv}"
NO_QUOTE = "\u0000"  # the event feed has no quoting: a leading '"' is data


def _with_partition(schema: T.StructType, name: str = "ingestion_date") -> T.StructType:
    return T.StructType(schema.fields + [T.StructField(name, T.StringType(), True)])


def events_reader(spark: SparkSession, named: bool = False, quote: str | None = None,
                  partitioned: bool = True):
    """A DataFrameReader for the tab-separated event feed."""
    schema = S.EVENTS_NAMED if named else S.EVENTS_POSITIONAL
    if partitioned:
        schema = _with_partition(schema)
    return (spark.read.schema(schema)
            .option("sep", "\t").option("header", "false")
            .option("quote", quote if quote is not None else NO_QUOTE)
            .option("mode", "PERMISSIVE")
            .option("pathGlobFilter", EVENT_FILE_GLOB))


def spread(df: DataFrame, partitions: int) -> DataFrame:
    """Hash-partition the rows of a file scan on their position in it.

    For inputs that one task would read alone (one Parquet row group, one gzip
    file): even shares, no hot partition even when many rows are identical
    copies, no sort, and the same split when a lost task re-reads its file.
    It is a shuffle, so the caller decides.
    """
    return df.repartition(partitions, F.monotonically_increasing_id())


def is_day(column: str = "ingestion_date") -> Column:
    """SRC-7: the landing folder is a valid ISO date."""
    c = F.col(column)
    return c.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & F.try_to_date(c, "yyyy-MM-dd").isNotNull()


def file_day(path: str) -> str:
    """The ISO date of a delivered file's ``ingestion_date=`` folder."""
    folder = path.rstrip("/").rsplit("/", 2)[-2] if "/" in path.rstrip("/") else ""
    value = folder.removeprefix("ingestion_date=")
    if folder == value:
        raise ValueError(f"{path} stands in no ingestion_date folder: give the ingestion date")
    return check_ingestion_date(value)


def read_events(spark: SparkSession, path: str, named: bool = False,
                ingestion_dates: list[str] | None = None) -> DataFrame:
    """SRC-1/3/6/7: landing or Bronze events, optionally pruned to some days.
    Folders that are no valid date are left out."""
    df = events_reader(spark, named=named).csv(path)
    if ingestion_dates is not None:
        df = df.where(F.col("ingestion_date").isin(list(ingestion_dates)))
    return df.where(is_day())


def read_events_file(spark: SparkSession, path: str, named: bool = False) -> DataFrame:
    """One delivered file (no partition column)."""
    return events_reader(spark, named=named, partitioned=False).csv(path)


def read_reference(spark: SparkSession, path: str, partitioned: bool = False) -> DataFrame:
    """SRC-2: country-risk CSV with header, as text (typed by Silver)."""
    return _reference_reader(spark, _with_partition(S.REFERENCE_RAW) if partitioned else S.REFERENCE_RAW).csv(path)


def _reference_reader(spark: SparkSession, schema: T.StructType):
    return (spark.read.schema(schema).option("header", "true").option("mode", "PERMISSIVE")
            .option("pathGlobFilter", "*.csv"))


def latest_reference(spark: SparkSession, root: str) -> DataFrame:
    """SRC-5: the newest delivery under ``root/ingestion_date=D/``.

    Newest = greatest ``ingestion_date`` taken from the folder names; among
    several files of that day the first path in name order wins (one small
    aggregate over that day's files only).  Raises if nothing was delivered.
    """
    days = fs.partition_days(spark, root)
    if not days:
        raise FileNotFoundError(f"no reference delivery under {root}/ingestion_date=...")
    day = (read_reference(spark, root, partitioned=True)
           .where(F.col("ingestion_date") == days[-1])
           .withColumn("_file", F.col("_metadata.file_path")))
    first_file = day.agg(F.min("_file").alias("f")).first()["f"]
    if first_file is None:
        raise FileNotFoundError(f"reference delivery {root}/ingestion_date={days[-1]} holds no rows")
    return day.where(F.col("_file") == first_file).select(*S.REFERENCE_COLUMNS)


def _registered(spark: SparkSession, layer: str, root: str, register: str | None, day_column: str, schema: T.StructType,
                days: list[str] | None = None, load=None) -> DataFrame:
    """The rows of a table that show (see ``sinks.register``), of some days or all."""
    load = load or (lambda paths: spark.read.schema(schema).option("basePath", root).parquet(*paths))
    return REG.read(spark, load, register or REG.default_register(root), layer, root, day_column, days,
                    schema).select(*schema.fieldNames())


def read_bronze_events(spark: SparkSession, root: str, register: str | None = None) -> DataFrame:
    return _registered(spark, "bronze_events", root, register, "ingestion_date", _with_partition(S.EVENTS_POSITIONAL),
                       load=lambda paths: events_reader(spark).option("basePath", root).csv(paths))


def read_bronze_reference(spark: SparkSession, root: str, register: str | None = None) -> DataFrame:
    return _registered(spark, "bronze_reference", root, register, "ingestion_date", _with_partition(S.REFERENCE_RAW),
                       load=lambda paths: _reference_reader(spark, _with_partition(S.REFERENCE_RAW)).option("basePath", root).csv(paths))


def read_layer(spark: SparkSession, layer: str, root: str, schema: T.StructType, register: str | None = None,
               ingestion_dates: list[str] | None = None) -> DataFrame:
    """Any other Parquet layer by ingestion day."""
    return _registered(spark, layer, root, register, "ingestion_date", schema, ingestion_dates)


def read_silver(spark: SparkSession, root: str, ingestion_dates: list[str] | None = None, register: str | None = None) -> DataFrame:
    """Stored Silver; a run of several layers registers them together, so give its register (``RunConfig.runs``)."""
    return _registered(spark, "silver", root, register, "ingestion_date", S.SILVER, ingestion_dates)


def read_gold(spark: SparkSession, root: str, register: str | None = None, ingestion_dates: list[str] | None = None) -> DataFrame:
    return _registered(spark, "gold", root, register, "DTE_INGESTION", S.GOLD, ingestion_dates)


def read_run(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """What a run has written so far, before it shows (a run without rows writes no day folder)."""
    return spark.read.schema(schema).parquet(folder).select(*schema.fieldNames())


def read_gold_csv(spark: SparkSession, path: str) -> DataFrame:
    """SRC-4: Gold CSV read as text, then coerced: bad dates/numbers -> null."""
    raw = spark.read.schema(S.GOLD_TEXT).option("header", "true").csv(path)
    return raw.select(
        F.try_to_date("DTE_EVENT", "yyyy-MM-dd").alias("DTE_EVENT"),
        "NAM_COUNTRY", "NAM_CITY",
        lenient_integral("CNT_EVENTS", "bigint").alias("CNT_EVENTS"),
        lenient_double("NUM_GOLDSTEIN_AVG").alias("NUM_GOLDSTEIN_AVG"),
        lenient_double("NUM_RISK_SCORE").alias("NUM_RISK_SCORE"),
        F.try_to_date("DTE_INGESTION", "yyyy-MM-dd").alias("DTE_INGESTION"),
    )
