"""Explicit schemas for every layer (no inference passes anywhere)."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Landing events: 58 tab-separated text fields ---------------------------
# The feed's public field names and, below, the mart's column names.
# Business names follow the public GDELT 1.0 event layout as the job reads it
# (ActionGeo full name at 50, country at 51, ADM1 at 52, lat/long at 53/54).
_ACTOR_FIELDS = ("Code", "Name", "CountryCode", "KnownGroupCode", "EthnicCode",
                 "Religion1Code", "Religion2Code", "Type1Code", "Type2Code", "Type3Code")
_GEO_FIELDS = ("Type", "Fullname", "CountryCode", "ADM1Code", "Lat", "Long", "FeatureID")


def _event_column_names() -> list[str]:
    names = ["GlobalEventID", "SQLDATE", "MonthYear", "Year", "FractionDate"]
    for actor in ("Actor1", "Actor2"):
        names += [actor + f for f in _ACTOR_FIELDS]
    names += ["IsRootEvent", "EventCode", "EventBaseCode", "EventRootCode", "QuadClass",
              "GoldsteinScale", "NumMentions", "NumSources", "NumArticles", "AvgTone"]
    for geo in ("Actor1Geo", "Actor2Geo", "ActionGeo"):
        names += [f"{geo}_{f}" for f in _GEO_FIELDS]
    names += ["DateAdded", "SourceURL"]
    return names


EVENT_COLUMN_NAMES: list[str] = _event_column_names()
N_EVENT_COLUMNS = len(EVENT_COLUMN_NAMES)
assert N_EVENT_COLUMNS == 58

POSITIONAL_NAMES: list[str] = [f"_c{i}" for i in range(N_EVENT_COLUMNS)]

# Positions the job consumes.
POS_ID, POS_DATE, POS_CLASS, POS_GOLDSTEIN = 0, 1, 29, 30
POS_GEO_NAME, POS_GEO_COUNTRY, POS_GEO_ADM1, POS_GEO_LAT, POS_GEO_LONG = 50, 51, 52, 53, 54

EVENTS_POSITIONAL = T.StructType([T.StructField(n, T.StringType(), True) for n in POSITIONAL_NAMES])
EVENTS_NAMED = T.StructType([T.StructField(n, T.StringType(), True) for n in EVENT_COLUMN_NAMES])

# Rejected rows kept as delivered, with the gate's reason and the arrival day.
QUARANTINE = T.StructType(EVENTS_POSITIONAL.fields + [
    T.StructField("reject_reason", T.StringType(), True),
    T.StructField("ingestion_date", T.StringType(), True),
])

# What Bronze keeps of every delivered file, beside the verbatim copy of its rows.
BRONZE_METADATA = T.StructType([
    T.StructField("ingestion_ts", T.StringType(), True),
    T.StructField("ingestion_date", T.StringType(), True),
    T.StructField("source_file", T.StringType(), True),
    T.StructField("source_system", T.StringType(), True),
    T.StructField("rows", T.LongType(), True),
])

# --- Country-risk reference --------------------------------------------------
REFERENCE_COLUMNS = ["country", "baseline_risk", "risk_multiplier", "updated_at"]
# As delivered: read as text, typed by ``prepare_reference`` (ANSI-safe).
REFERENCE_RAW = T.StructType([T.StructField(n, T.StringType(), True) for n in REFERENCE_COLUMNS])
REFERENCE_TYPED = T.StructType([
    T.StructField("country", T.StringType(), True),
    T.StructField("baseline_risk", T.DoubleType(), True),
    T.StructField("risk_multiplier", T.DoubleType(), True),
    T.StructField("updated_at", T.StringType(), True),
])

# --- Silver --------------------------------------------------------------------
SILVER = T.StructType([
    T.StructField("globaleventid", T.LongType(), True),
    T.StructField("event_date", T.DateType(), True),
    T.StructField("quadclass", T.IntegerType(), True),
    T.StructField("goldstein_scale", T.DoubleType(), True),
    T.StructField("actiongeo_fullname", T.StringType(), True),
    T.StructField("actiongeo_countrycode", T.StringType(), True),
    T.StructField("actiongeo_adm1code", T.StringType(), True),
    T.StructField("actiongeo_lat", T.DoubleType(), True),
    T.StructField("actiongeo_long", T.DoubleType(), True),
    T.StructField("country", T.StringType(), True),
    T.StructField("city", T.StringType(), True),
    T.StructField("ingestion_date", T.StringType(), True),
    T.StructField("ingestion_ts", T.StringType(), True),
    T.StructField("risk_weight", T.DoubleType(), True),
    T.StructField("baseline_risk", T.DoubleType(), True),
    T.StructField("risk_multiplier", T.DoubleType(), True),
    T.StructField("updated_at", T.StringType(), True),
    T.StructField("risk_weight_adj", T.DoubleType(), True),
])
SILVER_COLUMNS = [f.name for f in SILVER.fields]

# --- Gold mart -----------------------------------------------------------------
GOLD = T.StructType([
    T.StructField("DTE_EVENT", T.DateType(), True),
    T.StructField("NAM_COUNTRY", T.StringType(), True),
    T.StructField("NAM_CITY", T.StringType(), True),
    T.StructField("CNT_EVENTS", T.LongType(), False),
    T.StructField("NUM_GOLDSTEIN_AVG", T.DoubleType(), True),
    T.StructField("NUM_RISK_SCORE", T.DoubleType(), True),
    T.StructField("DTE_INGESTION", T.DateType(), True),
])
GOLD_COLUMNS = [f.name for f in GOLD.fields]
GOLD_TEXT = T.StructType([T.StructField(n, T.StringType(), True) for n in GOLD_COLUMNS])
