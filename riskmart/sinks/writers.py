"""Writers for every layer.

No writer funnels data through one task (no ``coalesce(1)``): files are
written in parallel by the tasks that produced the rows.  Partitioned layers
are laid out ``run=R/ingestion_date=D/event_date=E`` (Silver) and
``run=R/DTE_INGESTION=D/DTE_EVENT=E`` (Gold).  A run writes below its own
``run=R`` folders with ordinary Spark writes, and its entry in the register
(``sinks.register``), written last, says for which days these rows show:
``replace`` rewrites exactly the ingestion days of the run, so re-running a day
yields the same table and never touches other days; ``append`` adds rows;
``overwrite`` replaces the whole table.  Nothing is renamed or removed to make
rows visible, on any store.

Gold is range-partitioned on day, country and city, so that the files of a day
hold ranges of countries that hardly overlap and Parquet's statistics skip the
rest of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.sinks.register import Run, check_mode, default_register
from riskmart.sources.files import NO_QUOTE

SILVER_DAY, GOLD_DAY, LANDING_DAY = "ingestion_date", "DTE_INGESTION", "ingestion_date"


def write_events_tsv(df: DataFrame, out: str, partition_by: str | None = None, mode: str = "overwrite") -> None:
    """SNK-1 / landing: tab-separated, no header, no quoting, cells as they are."""
    w = (df.write.mode(mode).option("sep", "\t").option("header", "false")
           .option("quote", NO_QUOTE).option("escape", NO_QUOTE)
           .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false"))
    if partition_by:
        w = w.partitionBy(partition_by)
    w.csv(out)


def write_csv(df: DataFrame, out: str, partition_by: str | None = None, mode: str = "overwrite") -> None:
    """SNK-2 / SNK-5: CSV with header."""
    w = (df.write.mode(mode).option("header", "true")
           .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false"))
    if partition_by:
        w = w.partitionBy(partition_by)
    w.csv(out)


def run_silver(df: DataFrame, run: Run, root: str) -> str:
    """SNK-3: Silver rows in the run's folder, which is returned.

    The rebalance hint clusters rows by partition folder, so that a task writes few files, and lets adaptive execution
    split a folder that holds a large share of the rows over several tasks."""
    folder = run.folder(root)
    leaf = (SILVER_DAY, "event_date")
    (df.hint("rebalance", *leaf).sortWithinPartitions(*leaf, "globaleventid").write.partitionBy(*leaf).parquet(folder))
    return folder


def run_gold(df: DataFrame, run: Run, root: str, files: int | None = None) -> str:
    """SNK-4 / SNK-7: Gold rows in the run's folder, partitioned by date, clustered by country and city across files.

    ``files`` fixes the number of ranges over the whole run; otherwise it follows from the session's partition count and
    adaptive execution, which merges neighbouring ranges up to its advisory size."""
    folder = run.folder(root)
    leaf, cluster = (GOLD_DAY, "DTE_EVENT"), ("NAM_COUNTRY", "NAM_CITY")
    spread = [*leaf, *cluster]
    ranged = df.repartitionByRange(files, *spread) if files else df.repartitionByRange(*[F.col(c) for c in spread])
    ranged.sortWithinPartitions(*spread).write.partitionBy(*leaf).parquet(folder)
    return folder


def run_parquet(df: DataFrame, run: Run, root: str, day_column: str = LANDING_DAY) -> str:
    """Any other rows with a day, as Parquet in the run's folder."""
    folder = run.folder(root)
    df.hint("rebalance", day_column).write.partitionBy(day_column).parquet(folder)
    return folder


def _alone(layer: str, write, df: DataFrame, root: str, day_column: str, mode: str, days: list[str] | None, **options) -> list[str]:
    """One layer as a run of its own, registered with the table."""
    check_mode(mode)
    run = Run(df.sparkSession, default_register(root))
    try:
        write(df, run, root, **options)
        named = run.note(layer, root, day_column, mode, days)
        run.commit()
    except Exception:
        run.discard()
        raise
    return named


def write_silver(df: DataFrame, root: str, mode: str = "replace", days: list[str] | None = None) -> list[str]:
    """SNK-3 + SNK-8; without a day list a replace takes the days the rows hold.  Returns the days named."""
    return _alone("silver", run_silver, df, root, SILVER_DAY, mode, days)


def write_gold(df: DataFrame, root: str, mode: str = "replace", days: list[str] | None = None, files: int | None = None) -> list[str]:
    """SNK-4 / SNK-7 + SNK-8."""
    return _alone("gold", run_gold, df, root, GOLD_DAY, mode, days, files=files)


def write_table(df: DataFrame, fmt: str, options: dict[str, str] | None = None, mode: str = "append",
                path: str | None = None) -> None:
    """SNK-4, any connector: ``format`` + options (warehouse connectors need their jar)."""
    w = df.write.format(fmt).options(**(options or {})).mode(mode)
    w.save(path) if path else w.save()
