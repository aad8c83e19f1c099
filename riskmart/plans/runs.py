"""Whole runs: Bronze -> Silver -> Gold over a landing area.

A run covers one or more ingestion days (``None`` = every landed day), or one
named events file, with the newest or a chosen reference file.  Each day is
processed with the same semantics as a single-day run (dedup within the day,
Gold grouped per ingestion), but all days of a run share one Spark job per
layer.  The events feed is parsed once for Bronze and once for Silver (and once
more for the quarantine, when asked for).

Every layer is written to folders of the run's own, checked and read back; Gold
is computed from exactly the run's Silver rows.  One entry in the register,
written last, shows all layers together (``sinks.register``): a run that fails,
or is cut off anywhere before it, leaves the old Bronze, Silver and Gold in
view, and runs that overlap in time never see or touch each other's rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart import fs
from riskmart import schemas as S
from riskmart.operators import quality as Q
from riskmart.operators import silver as SV
from riskmart.operators.analysis import NULL_COUNTS, NullCounts
from riskmart.operators.gold import gold
from riskmart.sinks import register as REG
from riskmart.sinks import writers as W
from riskmart.sources import files as SRC


@dataclass
class RunConfig:
    landing_events: str
    landing_reference: str
    bronze_events: str
    bronze_reference: str
    silver: str
    gold: str
    ingestion_dates: list[str] | None = None      # None: every landed day
    events_file: str | None = None                # one named file instead (its day: the one ingestion date, or its folder)
    reference_file: str | None = None             # a chosen reference instead of the newest
    ingestion_ts: str = field(default_factory=lambda: datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ"))
    mode_silver: str = "replace"
    mode_gold: str = "replace"
    check: bool = True                            # stop before a write that breaks a contract
    gold_csv: str | None = None                   # optional CSV export of the run's Gold rows
    quarantine: str | None = None                 # optional folder for rejected rows (as delivered)
    profile: str | None = None                    # optional folder for the null counts of a run's inputs and mart
    register: str | None = None                   # where the runs of these tables are registered (default: with Gold)

    @staticmethod
    def under(root: str, **kw) -> "RunConfig":
        r = root.rstrip("/")
        return RunConfig(landing_events=f"{r}/landing/events", landing_reference=f"{r}/landing/country_risk",
                         bronze_events=f"{r}/bronze/events", bronze_reference=f"{r}/bronze/country_risk",
                         silver=f"{r}/silver/events", gold=f"{r}/gold/risk_events", **kw)

    @property
    def runs(self) -> str:
        """The register of all layers; readers of Silver and Bronze need it, Gold finds it by itself."""
        return self.register or REG.default_register(self.gold)

    @property
    def bronze_metadata(self) -> str:
        return self.bronze_events.rstrip("/") + "_metadata"

    def with_profile(self) -> "RunConfig":
        """Same run, also keeping the null counts of its inputs and mart under ``<silver>/../profile``."""
        return replace(self, profile=self.silver.rstrip("/").rsplit("/", 1)[0] + "/profile")

    def with_quarantine(self) -> "RunConfig":
        """Same run, also keeping rejected rows under ``<silver>/../quarantine``."""
        base = self.silver.rstrip("/").rsplit("/", 1)[0]
        return replace(self, quarantine=f"{base}/quarantine")


def landed_days(spark: SparkSession, root: str) -> list[str]:
    """Ingestion days present under a landing root (folder listing only)."""
    return fs.partition_days(spark, root)


def _days(spark: SparkSession, cfg: RunConfig) -> list[str]:
    if cfg.ingestion_dates is not None:
        days = [SV.check_ingestion_date(d) for d in cfg.ingestion_dates]
    elif cfg.events_file:
        days = [SRC.file_day(cfg.events_file)]
    else:
        days = landed_days(spark, cfg.landing_events)
    if cfg.events_file and len(days) != 1:
        raise ValueError("one events file has one ingestion date")
    return days


def _events(spark: SparkSession, cfg: RunConfig, days: list[str]) -> DataFrame:
    if cfg.events_file:
        return SRC.read_events_file(spark, cfg.events_file).withColumn("ingestion_date", F.lit(days[0]))
    return SRC.read_events(spark, cfg.landing_events, ingestion_dates=days)


def _reference(spark: SparkSession, cfg: RunConfig) -> DataFrame:
    if cfg.reference_file:
        return SRC.read_reference(spark, cfg.reference_file)
    return SRC.latest_reference(spark, cfg.landing_reference)


def _bronze_layers(spark: SparkSession, cfg: RunConfig, run: REG.Run, counts: list[NullCounts]) -> DataFrame:
    """Write the as-delivered copies; returns the reference used, and adds to ``counts`` what was counted on the way."""
    days = _days(spark, cfg)
    events, ref = _events(spark, cfg, days), _reference(spark, cfg)
    copied, copied_ref = events, ref
    if cfg.profile:
        # The copies read every cell anyway: the counts ride on the write.
        of_events = NullCounts("events", S.POSITIONAL_NAMES, S.EVENT_COLUMN_NAMES)
        of_reference = NullCounts("country_risk", S.REFERENCE_COLUMNS)
        copied, copied_ref = of_events.observed(events), of_reference.observed(ref)
        counts += [of_events, of_reference]
    W.write_events_tsv(copied, run.folder(cfg.bronze_events), partition_by="ingestion_date")
    W.run_parquet(Q.bronze_metadata(events, cfg.ingestion_ts), run, cfg.bronze_metadata)
    # one snapshot of the reference per run day (the day list is small)
    ref_out = copied_ref.withColumn("ingestion_date", F.explode(F.array(*[F.lit(d) for d in days])))
    W.write_csv(ref_out, run.folder(cfg.bronze_reference), partition_by="ingestion_date")
    for layer, root in (("bronze_events", cfg.bronze_events), ("bronze_metadata", cfg.bronze_metadata),
                        ("bronze_reference", cfg.bronze_reference)):
        run.note(layer, root, "ingestion_date", "replace", days)
    return ref


def _silver_layer(spark: SparkSession, cfg: RunConfig, run: REG.Run, ref_raw: DataFrame | None) -> DataFrame:
    """Write and check the run's Silver rows; returns them as written."""
    days = _days(spark, cfg)
    events = _events(spark, cfg, days)
    out = SV.silver(events, ref_raw if ref_raw is not None else _reference(spark, cfg), None, cfg.ingestion_ts)
    written = SRC.read_run(spark, W.run_silver(out, run, cfg.silver), S.SILVER)
    _checked(written, "silver", cfg)
    if cfg.quarantine:
        W.run_parquet(Q.rejected_rows(events), run, cfg.quarantine)
        run.note("quarantine", cfg.quarantine, "ingestion_date", "replace", days)
    run.note("silver", cfg.silver, W.SILVER_DAY, cfg.mode_silver, days)
    return written


def _gold_layer(spark: SparkSession, cfg: RunConfig, run: REG.Run, silver_rows: DataFrame, days: list[str],
                counts: list[NullCounts]) -> None:
    """Write and check the Gold rows of ``silver_rows``."""
    written = SRC.read_run(spark, W.run_gold(gold(silver_rows), run, cfg.gold), S.GOLD)
    if cfg.profile and cfg.check:
        of_gold = NullCounts("gold", S.GOLD_COLUMNS)
        _checked(of_gold.observed(written), "gold", cfg)
        counts.append(of_gold)
    else:
        _checked(written, "gold", cfg)
    if cfg.gold_csv:
        W.write_csv(written, cfg.gold_csv)
    run.note("gold", cfg.gold, W.GOLD_DAY, cfg.mode_gold, days)


def _checked(df: DataFrame, layer: str, cfg: RunConfig) -> None:
    if cfg.check:
        Q.require(df, layer)


def steps(spark: SparkSession, cfg: RunConfig, layers: tuple[str, ...] = ("bronze", "silver", "gold")) -> Iterator[str]:
    """A run step by step: the name of each step when it is done, ``shown`` last.  A step that fails removes the run's rows."""
    run = REG.Run(spark, cfg.runs)
    REG.check_mode(cfg.mode_silver, cfg.mode_gold)
    try:
        ref, counts = None, []
        if "bronze" in layers:
            ref = _bronze_layers(spark, cfg, run, counts)
            yield "bronze"
        if "silver" in layers:
            rows = _silver_layer(spark, cfg, run, ref)
            yield "silver"
        if "gold" in layers:
            # PIP-3: Gold of this run's Silver rows, whatever else the table holds.
            _gold_layer(spark, cfg, run, rows, _days(spark, cfg), counts)
            yield "gold"
        if counts:
            _write_profile(spark, cfg, run, counts)
        run.commit()
    except Exception:
        run.discard()
        raise
    yield "shown"


def _finish(run_steps: Iterator[str]) -> None:
    for _ in run_steps:
        pass


def bronze(spark: SparkSession, cfg: RunConfig) -> None:
    """PIP-1: as-delivered copies of the run's event files and the reference, and
    beside them the metadata of every delivered file."""
    _finish(steps(spark, cfg, ("bronze",)))


def read_bronze_metadata(spark: SparkSession, cfg: RunConfig) -> DataFrame:
    return SRC.read_layer(spark, "bronze_metadata", cfg.bronze_metadata, S.BRONZE_METADATA, cfg.runs)


def read_silver(spark: SparkSession, cfg: RunConfig, ingestion_dates: list[str] | None = None) -> DataFrame:
    """Stored Silver, as of the same runs as the stored Gold."""
    return SRC.read_silver(spark, cfg.silver, ingestion_dates, cfg.runs)


def read_gold(spark: SparkSession, cfg: RunConfig) -> DataFrame:
    return SRC.read_gold(spark, cfg.gold, cfg.runs)


def _write_profile(spark: SparkSession, cfg: RunConfig, run: REG.Run, counts: list[NullCounts]) -> None:
    rows = spark.createDataFrame([row for c in counts for row in c.rows()], NULL_COUNTS)
    rows.withColumn("ingestion_ts", F.lit(cfg.ingestion_ts)).coalesce(1).write.parquet(run.folder(cfg.profile))


def read_profile(spark: SparkSession, cfg: RunConfig) -> DataFrame:
    """(run, dataset, column_name, null_count, total_rows, ingestion_ts) of the runs whose Bronze or Gold rows show."""
    runs = sorted({run for layer in ("bronze_events", "gold") for _, run in REG.shown(spark, cfg.runs, layer)})
    schema = S.T.StructType.fromDDL(NULL_COUNTS + ", ingestion_ts string, run string")
    return spark.read.schema(schema).parquet(cfg.profile).where(F.col("run").isin(runs))


def read_quarantine(spark: SparkSession, cfg: RunConfig) -> DataFrame:
    return SRC.read_layer(spark, "quarantine", cfg.quarantine, S.QUARANTINE, cfg.runs)


def silver_run(spark: SparkSession, cfg: RunConfig) -> None:
    """PIP-2: landing -> Silver table."""
    _finish(steps(spark, cfg, ("silver",)))


def run(spark: SparkSession, cfg: RunConfig, with_bronze: bool = True) -> DataFrame:
    """PIP-4: end to end; returns the stored Gold table."""
    _finish(steps(spark, cfg, ("bronze", "silver", "gold") if with_bronze else ("silver", "gold")))
    return read_gold(spark, cfg)


def key_check(spark: SparkSession, cfg: RunConfig, days: list[str]) -> DataFrame:
    """DQ-6: events of ``days`` that the stored Silver of other days holds already (delivered again), and repeats inside ``days``."""
    kept = sorted({day for day, _ in REG.shown(spark, cfg.runs, "silver")} - set(days))
    return Q.new_key_check(read_silver(spark, cfg, days), read_silver(spark, cfg, kept), "globaleventid", "redelivered")


def gold_run(spark: SparkSession, cfg: RunConfig, days: list[str]) -> DataFrame:
    """PIP-3 on its own: Gold of the stored Silver rows of ``days``."""
    one = REG.Run(spark, cfg.runs)
    try:
        _gold_layer(spark, cfg, one, read_silver(spark, cfg, days), days, [])
        one.commit()
    except Exception:
        one.discard()
        raise
    return read_gold(spark, cfg)


def vacuum(spark: SparkSession, cfg: RunConfig, keep_hours: float = 24 * 7) -> list[str]:
    """Remove rows that no reader sees any more; see ``sinks.register.vacuum``."""
    return REG.vacuum(spark, cfg.runs, keep_hours)


def backfill(spark: SparkSession, cfg: RunConfig, start: str | None = None, end: str | None = None) -> DataFrame:
    """STR-4: run every landed day in [start, end], Bronze included, with the newest reference."""
    days = [d for d in landed_days(spark, cfg.landing_events)
            if (start is None or d >= start) and (end is None or d <= end)]
    if not days:
        return read_gold(spark, cfg) if fs.exists(spark, cfg.runs) else None
    return run(spark, replace(cfg, ingestion_dates=days))
