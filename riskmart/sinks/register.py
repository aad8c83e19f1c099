"""Which run's rows the tables show.

A run writes every layer with an ordinary Spark write into folders of its own
(``<table>/run=<id>/...``), where no other run ever writes, and last of all its
entry in the register: a small Parquet table with one row per layer and day.
Readers take the folders to read from the register, so

* all layers of a run become visible together, with the one file of its entry;
* a run that fails or dies before that changes nothing anybody reads;
* runs may overlap in time, also on the same day: whichever entry comes later
  holds for the days it names, in all layers alike.

Modes, per layer and day: ``replace`` shows this run's rows in place of all
earlier ones of the day (a day without rows becomes empty), ``append`` shows them
too, ``overwrite`` in place of all earlier ones of every day.

Entries are ordered by a counter that is larger than every entry the run could
see, and by the clock where runs did not see each other; ties go by run id.
``vacuum`` removes what no longer shows.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart import fs

MODES = ("replace", "append", "overwrite")

ENTRY = T.StructType([
    T.StructField("committed_at", T.LongType(), False),   # microseconds
    T.StructField("layer", T.StringType(), False),
    T.StructField("root", T.StringType(), False),
    T.StructField("day_column", T.StringType(), False),
    T.StructField("mode", T.StringType(), False),
    T.StructField("day", T.StringType(), True),           # null: an overwrite, for all days
    T.StructField("stored", T.BooleanType(), False),      # the run has rows of the day
])


def default_register(root: str) -> str:
    """Where a table registers its runs unless told otherwise (hidden from Spark's readers of the table)."""
    return f"{root.rstrip('/')}/_runs"


def run_folder(root: str, run: str) -> str:
    return f"{root.rstrip('/')}/run={run}"


def check_mode(*modes: str) -> None:
    for mode in modes:
        if mode not in MODES:
            raise ValueError(f"mode must be one of {MODES}, got {mode!r}")


class Run:
    """The writes of one run: rows first, the entry that shows them last."""

    def __init__(self, spark: SparkSession, register: str):
        self.spark, self.register, self.id = spark, register, f"r{uuid.uuid4().hex[:15]}"
        self._entries: list[tuple] = []
        self._folders: list[str] = []

    def folder(self, root: str) -> str:
        """Where this run writes its rows of the table at ``root``."""
        folder = run_folder(root, self.id)
        self._folders.append(folder)
        return folder

    def note(self, layer: str, root: str, day_column: str, mode: str, days: list[str] | None = None) -> list[str]:
        """To be shown on commit: the rows written to ``folder(root)``, for ``days`` and every day they hold."""
        check_mode(mode)
        held = fs.partition_values(self.spark, run_folder(root, self.id), day_column)
        named = sorted(set(held) | set(days or []))
        self._entries += [(layer, root, day_column, mode, day, day in held) for day in named]
        if mode == "overwrite":
            self._entries.append((layer, root, day_column, mode, None, False))
        return named

    def commit(self) -> None:
        """Show the run: one file, written through Spark's commit protocol."""
        if not self._entries:
            return
        at = time.time_ns() // 1000
        if fs.exists(self.spark, self.register):
            at = max(at, (_entries(self.spark, self.register).agg(F.max("committed_at")).first()[0] or 0) + 1)
        rows = self.spark.createDataFrame([(at, *entry) for entry in self._entries], ENTRY)
        rows.coalesce(1).write.parquet(run_folder(self.register, self.id))

    def discard(self) -> None:
        """Remove the rows of a run that will not be shown."""
        for folder in self._folders:
            fs.delete(self.spark, folder)


def _entries(spark: SparkSession, register: str) -> DataFrame:
    schema = T.StructType([*ENTRY.fields, T.StructField("run", T.StringType())])
    return spark.read.schema(schema).parquet(register)


def _shown(entries: DataFrame) -> DataFrame:
    """Entries of rows that show: not before the last overwrite of their layer nor the last replacement of their day."""
    order = F.struct("committed_at", "run")
    overwrites = entries.where("day IS NULL").groupBy("layer").agg(F.max(order).alias("all_from"))
    replaced = entries.where("day IS NOT NULL AND mode <> 'append'").groupBy("layer", "day").agg(F.max(order).alias("day_from"))
    return (entries.where("day IS NOT NULL").join(overwrites, "layer", "left").join(replaced, ["layer", "day"], "left")
            .where((F.col("all_from").isNull() | (order >= F.col("all_from")))
                   & (F.col("day_from").isNull() | (order >= F.col("day_from"))))
            .drop("all_from", "day_from"))


def shown(spark: SparkSession, register: str, layer: str) -> list[tuple[str, str]]:
    """(day, run) of every folder that a reader of ``layer`` takes.  The register holds a row per day and run
    that is kept, never rows of data."""
    if not fs.exists(spark, register):
        raise FileNotFoundError(f"no run is registered in {register}")
    found = _shown(_entries(spark, register).where(F.col("layer") == layer)).where("stored").select("day", "run").distinct().collect()
    return sorted((r.day, r.run) for r in found)


def folders(spark: SparkSession, register: str, layer: str, root: str, day_column: str,
            days: list[str] | None = None) -> list[str]:
    """Folders of ``layer`` to read, of some days or all; nothing else is listed or opened."""
    wanted = None if days is None else set(days)
    return [f"{run_folder(root, run)}/{day_column}={day}" for day, run in shown(spark, register, layer)
            if wanted is None or day in wanted]


def read(spark: SparkSession, load: Callable[[list[str]], DataFrame], register: str, layer: str, root: str, day_column: str,
         days: list[str] | None, schema: T.StructType) -> DataFrame:
    """The rows of ``layer`` that show, through ``load(paths)``; an empty frame where none do."""
    paths = folders(spark, register, layer, root, day_column, days)
    return load(paths) if paths else spark.createDataFrame([], schema)


def vacuum(spark: SparkSession, register: str, keep_hours: float = 24 * 7) -> list[str]:
    """Remove day folders that have not shown for ``keep_hours`` and folders of runs that old that never got an entry;
    returns them.  Keep longer than the longest query and the longest run take."""
    if not fs.exists(spark, register):
        return []
    limit = int((time.time() - keep_hours * 3600) * 1e6)
    entries = _entries(spark, register).cache()
    try:
        newest = entries.agg(F.max("committed_at")).first()[0] or 0
        # What showed at the limit may still be read by a query that started then.
        keep = {(r.layer, r.day, r.run) for frame in (_shown(entries), _shown(entries.where(F.col("committed_at") <= limit)))
                for r in frame.select("layer", "day", "run").distinct().collect()}
        keep |= {(r.layer, None, r.run) for r in entries.where("day IS NULL").groupBy("layer").agg(
            F.max_by("run", F.struct("committed_at", "run")).alias("run")).collect()}
        known = entries.select("layer", "root", "day_column", "day", "run", "stored", "committed_at").distinct().collect()
    finally:
        entries.unpersist()
    gone = []
    for r in known:
        if r.stored and r.committed_at <= limit and (r.layer, r.day, r.run) not in keep:
            gone.append(f"{run_folder(r.root, r.run)}/{r.day_column}={r.day}")
    runs = {r.run for r in known}
    for root in sorted({r.root for r in known}):
        gone += [path for path, run, at in fs.partition_folders(spark, root, "run") if run not in runs and at * 1000 <= limit]
    for path in gone:
        fs.delete(spark, path)
    # An entry none of whose days shows decides nothing, unless it is the newest.
    for run in runs:
        mine = [r for r in known if r.run == run]
        if max(r.committed_at for r in mine) <= min(limit, newest - 1) and not any((r.layer, r.day, r.run) in keep for r in mine):
            fs.delete(spark, run_folder(register, run))
    return gone
