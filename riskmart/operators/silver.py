"""Silver layer: type, validate, deduplicate and enrich landing events.

Split into three steps so the same code serves batch and streaming:

* ``prepare``  – stateless: pick 9 of 58 positions, ANSI-safe typing, derived
                 country/city, lineage columns, and the data-quality gate.
* ``dedup_events`` – batch: one row per (ingestion_date, globaleventid) with a
                 total order, so the survivor is the same on every run.
                 ``row_number() = 1`` plans as a partial WindowGroupLimit
                 *before* the shuffle, so a key duplicated in a third of all
                 rows ships at most one row per map task.
* ``enrich``   – conflict weight and the country multiplier (left join against
                 the reference; Spark picks the join from run-time sizes).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskmart import schemas as S
from riskmart.functions.columns import (
    check_ingestion_date,
    city_of,
    country_of,
    lenient_double,
    lenient_integral,
    parse_event_date,
    risk_weight,
)

TYPED_COLUMNS = ["globaleventid", "event_date", "quadclass", "goldstein_scale", "actiongeo_fullname",
                 "actiongeo_countrycode", "actiongeo_adm1code", "actiongeo_lat", "actiongeo_long"]
PREPARED_COLUMNS = TYPED_COLUMNS + ["country", "city", "ingestion_date", "ingestion_ts"]
DEDUP_KEYS = ["ingestion_date", "globaleventid"]
# Survivor order among copies of one event: every other prepared column.
_SURVIVOR_ORDER = ["event_date", "quadclass", "goldstein_scale", "actiongeo_fullname",
                   "actiongeo_countrycode", "actiongeo_adm1code", "actiongeo_lat",
                   "actiongeo_long", "ingestion_ts"]


def _pos(i: int) -> Column:
    return F.col(S.POSITIONAL_NAMES[i])


def typed_events(raw: DataFrame) -> DataFrame:
    """PRJ-1/2: the nine consumed positions, typed; malformed -> null."""
    return raw.select(
        lenient_integral(_pos(S.POS_ID), "bigint").alias("globaleventid"),
        parse_event_date(_pos(S.POS_DATE)).alias("event_date"),
        lenient_integral(_pos(S.POS_CLASS), "int").alias("quadclass"),
        lenient_double(_pos(S.POS_GOLDSTEIN)).alias("goldstein_scale"),
        _pos(S.POS_GEO_NAME).alias("actiongeo_fullname"),
        _pos(S.POS_GEO_COUNTRY).alias("actiongeo_countrycode"),
        _pos(S.POS_GEO_ADM1).alias("actiongeo_adm1code"),
        lenient_double(_pos(S.POS_GEO_LAT)).alias("actiongeo_lat"),
        lenient_double(_pos(S.POS_GEO_LONG)).alias("actiongeo_long"),
        *([F.col("ingestion_date")] if "ingestion_date" in raw.columns else []),
    )


def with_derived(typed: DataFrame, ingestion_date: str | None, ingestion_ts: str) -> DataFrame:
    """PRJ-3/4/5: country, city and lineage columns.

    ``ingestion_date=None`` keeps a per-row ``ingestion_date`` column (landing
    partition) instead of one literal for the whole run.
    """
    ing = (F.col("ingestion_date").cast("string") if ingestion_date is None
           else F.lit(check_ingestion_date(ingestion_date)))
    return typed.select(
        *TYPED_COLUMNS,
        country_of("actiongeo_countrycode").alias("country"),
        city_of("actiongeo_fullname").alias("city"),
        ing.alias("ingestion_date"),
        F.lit(ingestion_ts).alias("ingestion_ts"),
    )


def dq_gate() -> Column:
    """FLT-1: the row-level acceptance predicate."""
    return (F.col("event_date").isNotNull() & F.col("globaleventid").isNotNull()
            & F.col("country").isNotNull() & (F.length("country") == 2))


def prepare(raw: DataFrame, ingestion_date: str | None, ingestion_ts: str) -> DataFrame:
    """Typed, derived and gated events (stateless; usable on a stream)."""
    return with_derived(typed_events(raw), ingestion_date, ingestion_ts).where(dq_gate())


def dedup_events(prepared: DataFrame) -> DataFrame:
    """DUP-1: keep one row per event and ingestion, deterministically."""
    w = Window.partitionBy(*DEDUP_KEYS).orderBy(*[F.col(c).asc_nulls_last() for c in _SURVIVOR_ORDER])
    return (prepared.withColumn("_rn", F.row_number().over(w))
                    .where(F.col("_rn") == 1).drop("_rn"))


def prepare_reference(ref_raw: DataFrame) -> DataFrame:
    """PRJ-8: upper-case key, ANSI-safe numeric casts, ``updated_at`` as text."""
    return ref_raw.select(
        F.upper("country").alias("country"),
        lenient_double("baseline_risk").alias("baseline_risk"),
        lenient_double("risk_multiplier").alias("risk_multiplier"),
        F.col("updated_at").cast("string").alias("updated_at"),
    )


def dedup_reference(ref: DataFrame) -> DataFrame:
    """DUP-2: one row per country, the newest ``updated_at`` wins (then a
    total order over the remaining columns)."""
    w = Window.partitionBy("country").orderBy(
        F.col("updated_at").desc_nulls_last(), F.col("risk_multiplier").desc_nulls_last(),
        F.col("baseline_risk").desc_nulls_last())
    return ref.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def reference_dimension(ref_raw: DataFrame) -> DataFrame:
    """Normalised, deduplicated reference.  Keys that cannot match an accepted
    event (length <> 2) are left out, which does not change a left join from
    the events side."""
    return dedup_reference(prepare_reference(ref_raw).where(F.length("country") == 2))


def enrich(events: DataFrame, ref_dim: DataFrame) -> DataFrame:
    """PRJ-6/7 + JON-1: weight, left join on country, adjusted weight.

    No hint: adaptive execution broadcasts the reference when its size at run
    time is below the session's threshold, and shuffles (splitting skewed
    countries) when it is not.
    """
    joined = events.join(ref_dim, on="country", how="left")
    return joined.select(
        "globaleventid", "event_date", "quadclass", "goldstein_scale", "actiongeo_fullname",
        "actiongeo_countrycode", "actiongeo_adm1code", "actiongeo_lat", "actiongeo_long",
        "country", "city", "ingestion_date", "ingestion_ts",
        risk_weight("quadclass").alias("risk_weight"),
        "baseline_risk", "risk_multiplier", "updated_at",
        (risk_weight("quadclass") * F.coalesce(F.col("risk_multiplier"), F.lit(1.0))).alias("risk_weight_adj"),
    )


def silver(raw: DataFrame, ref_raw: DataFrame, ingestion_date: str | None, ingestion_ts: str) -> DataFrame:
    """PIP-2: the whole Silver transformation as one lazy plan."""
    return enrich(dedup_events(prepare(raw, ingestion_date, ingestion_ts)), reference_dimension(ref_raw))
