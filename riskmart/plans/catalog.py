"""Query catalog: one entry per operator of the inventory, plus its SQL oracle.

Every query reads the driver tables (through the landing adapter) and runs
over all of their rows.  Keys that exercise a source, sink or stream write
their input below the session's shared folder first and read it back.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.operators import bi
from riskmart.operators import silver as SV
from riskmart.operators.gold import gold
from riskmart.plans import constants as K
from riskmart.plans import oracle as O
from riskmart.sources import fixture as FX

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


# --- shared building blocks ----------------------------------------------------
def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FX.event_feed(spark, sf_dir)


def reference_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FX.reference_feed(spark, sf_dir)


def silver_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SV.silver(feed(spark, sf_dir), reference_raw(spark, sf_dir), K.RUN_DATE, K.RUN_TS)


def gold_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold(silver_df(spark, sf_dir))


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Round results whose last bits depend on the order of additions, for the comparison with SQL only."""
    return df.withColumns({c: F.round(c, digits) + 0.0 for c in columns})


GOLD_ORDER = "DTE_EVENT ASC NULLS FIRST, NAM_COUNTRY ASC NULLS FIRST, NAM_CITY ASC NULLS FIRST, DTE_INGESTION ASC NULLS FIRST"


# --- Silver steps ----------------------------------------------------------------
register("prj_typed_events", O.q(
    "SELECT globaleventid, event_date, quadclass, goldstein_scale, actiongeo_fullname, actiongeo_countrycode, "
    "actiongeo_adm1code, actiongeo_lat, actiongeo_long FROM typed"))(
    lambda spark, sf: SV.typed_events(feed(spark, sf)))

register("prj_country_city", O.q(
    "SELECT globaleventid, actiongeo_fullname, actiongeo_countrycode, country, city FROM prepared"))(
    lambda spark, sf: SV.with_derived(SV.typed_events(feed(spark, sf)), K.RUN_DATE, K.RUN_TS)
    .select("globaleventid", "actiongeo_fullname", "actiongeo_countrycode", "country", "city"))

register("prj_lineage", O.q("SELECT globaleventid, ingestion_date, ingestion_ts FROM prepared"))(
    lambda spark, sf: SV.with_derived(SV.typed_events(feed(spark, sf)), K.RUN_DATE, K.RUN_TS)
    .select("globaleventid", "ingestion_date", "ingestion_ts"))


@register("prj_risk_weight", O.q(
    "SELECT globaleventid, quadclass, CASE quadclass WHEN 1 THEN 0.25 WHEN 2 THEN 0.5 WHEN 3 THEN 0.75 "
    "WHEN 4 THEN 1.0 ELSE 0.5 END::DOUBLE AS risk_weight FROM typed"))
def _prj_risk_weight(spark, sf):
    from riskmart.functions.columns import risk_weight
    return SV.typed_events(feed(spark, sf)).select("globaleventid", "quadclass",
                                                   risk_weight("quadclass").alias("risk_weight"))


register("prj_reference", O.q("SELECT * FROM ref_typed"))(
    lambda spark, sf: SV.prepare_reference(reference_raw(spark, sf)))

register("flt_silver_dq", O.q("SELECT * FROM accepted"))(
    lambda spark, sf: SV.prepare(feed(spark, sf), K.RUN_DATE, K.RUN_TS))

register("dup_events", O.q("SELECT * FROM dedup"))(
    lambda spark, sf: SV.dedup_events(SV.prepare(feed(spark, sf), K.RUN_DATE, K.RUN_TS)))


@register("dup_reference", O.q("SELECT * FROM ref"))
def _dup_reference(spark, sf):
    both = FX.old_reference_feed(spark, sf).unionByName(reference_raw(spark, sf))
    return SV.dedup_reference(SV.prepare_reference(both))


register("silver_enriched", O.q(f"SELECT {O.SILVER_SELECT} FROM silver"))(silver_df)

# --- Gold -------------------------------------------------------------------------
register("gold_mart", O.q("SELECT * FROM gold"))(gold_df)

# --- BI over Gold -------------------------------------------------------------------
register("bi_critical", O.q(
    f"SELECT * FROM gold WHERE NUM_RISK_SCORE >= 75 ORDER BY NUM_RISK_SCORE DESC NULLS LAST, {GOLD_ORDER}"))(
    lambda spark, sf: bi.critical(gold_df(spark, sf)))

register("bi_demo", O.q(
    "SELECT DTE_EVENT, NAM_COUNTRY, NAM_CITY, CNT_EVENTS, NUM_RISK_SCORE FROM gold WHERE NUM_RISK_SCORE >= 60 "
    f"ORDER BY NUM_RISK_SCORE DESC NULLS LAST, {GOLD_ORDER}, CNT_EVENTS ASC LIMIT 25"))(
    lambda spark, sf: bi.demo(gold_df(spark, sf)))

register("bi_country_avg", O.q(
    f"SELECT NAM_COUNTRY, {O.exact_avg('NUM_RISK_SCORE')} AS avg_risk_score FROM gold GROUP BY NAM_COUNTRY "
    "ORDER BY avg_risk_score DESC NULLS LAST, NAM_COUNTRY ASC NULLS FIRST"))(
    lambda spark, sf: bi.country_avg(gold_df(spark, sf)))

register("bi_load_summary", O.q(
    "SELECT COUNT(*) AS \"rows\", COUNT(DISTINCT DTE_EVENT) AS days_loaded, COUNT(DISTINCT NAM_COUNTRY) AS countries, "
    "COUNT(DISTINCT NAM_CITY) AS cities FROM gold"))(
    lambda spark, sf: bi.load_summary(gold_df(spark, sf)))

register("bi_events_per_day", O.q(
    "SELECT DTE_EVENT, CAST(SUM(CNT_EVENTS) AS BIGINT) AS total_events FROM gold GROUP BY DTE_EVENT "
    "ORDER BY DTE_EVENT DESC NULLS LAST"))(
    lambda spark, sf: bi.events_per_day(gold_df(spark, sf)))

register("bi_time_evolution", O.q(
    f"SELECT DTE_EVENT, {O.exact_avg('NUM_RISK_SCORE')} AS avg_risk_score, MAX(NUM_RISK_SCORE) AS max_risk_score "
    "FROM gold GROUP BY DTE_EVENT ORDER BY DTE_EVENT ASC NULLS FIRST"))(
    lambda spark, sf: bi.time_evolution(gold_df(spark, sf)))

register("bi_top_hotspots", O.q(
    f"SELECT NAM_CITY || ', ' || NAM_COUNTRY AS location, {O.exact_sum('NUM_RISK_SCORE')} AS total_risk "
    "FROM gold GROUP BY location ORDER BY total_risk DESC NULLS LAST, location ASC NULLS FIRST LIMIT 10"))(
    lambda spark, sf: bi.top_hotspots(gold_df(spark, sf)))

register("bi_top_cities", O.q(
    f"SELECT NAM_COUNTRY, NAM_CITY, {O.exact_sum('NUM_RISK_SCORE')} AS total_risk_score, "
    "CAST(SUM(CNT_EVENTS) AS BIGINT) AS total_events FROM gold GROUP BY NAM_COUNTRY, NAM_CITY "
    "ORDER BY total_risk_score DESC NULLS LAST, NAM_COUNTRY ASC NULLS FIRST, NAM_CITY ASC NULLS FIRST LIMIT 20"))(
    lambda spark, sf: bi.top_cities(gold_df(spark, sf)))

register("bi_country_total", O.q(
    f"SELECT NAM_COUNTRY, {O.exact_sum('NUM_RISK_SCORE')} AS total_risk_score, "
    "CAST(SUM(CNT_EVENTS) AS BIGINT) AS total_events FROM gold GROUP BY NAM_COUNTRY "
    "ORDER BY total_risk_score DESC NULLS LAST, NAM_COUNTRY ASC NULLS FIRST LIMIT 20"))(
    lambda spark, sf: bi.country_total(gold_df(spark, sf)))

register("bi_rows_per_day", O.q(
    "SELECT DTE_EVENT, COUNT(*) AS \"rows\" FROM gold GROUP BY DTE_EVENT ORDER BY DTE_EVENT DESC NULLS LAST"))(
    lambda spark, sf: bi.rows_per_day(gold_df(spark, sf)))

register("bi_country_by_day", O.q(
    f"SELECT NAM_COUNTRY, {O.exact_sum('NUM_RISK_SCORE')} AS total_score FROM gold "
    f"WHERE DTE_EVENT = DATE '{K.REPORT_DAY}' GROUP BY NAM_COUNTRY "
    "ORDER BY total_score DESC NULLS LAST, NAM_COUNTRY ASC NULLS FIRST LIMIT 20"))(
    lambda spark, sf: bi.country_by_day(gold_df(spark, sf), K.REPORT_DAY))

register("bi_first_50", O.q(f"SELECT * FROM gold ORDER BY DTE_EVENT DESC NULLS LAST, "
                            "NAM_COUNTRY ASC NULLS FIRST, NAM_CITY ASC NULLS FIRST, DTE_INGESTION ASC NULLS FIRST LIMIT 50"))(
    lambda spark, sf: bi.first_rows(gold_df(spark, sf)))

LEVEL_BI = ("CASE WHEN NUM_RISK_SCORE IS NULL THEN 'BAJO' WHEN NUM_RISK_SCORE >= 75 THEN 'CRÍTICO' "
            "WHEN NUM_RISK_SCORE >= 60 THEN 'ALTO' WHEN NUM_RISK_SCORE >= 40 THEN 'MEDIO' ELSE 'BAJO' END")
LEVEL_NB = LEVEL_BI.replace("IS NULL THEN 'BAJO'", "IS NULL THEN 'UNKNOWN'")

register("prj_risk_level_bi", O.q(f"SELECT *, {LEVEL_BI} AS RISK_LEVEL FROM gold"))(
    lambda spark, sf: bi.with_risk_level(gold_df(spark, sf)))

register("prj_risk_level", O.q(f"SELECT *, {LEVEL_NB} AS RISK_LEVEL FROM gold"))(
    lambda spark, sf: bi.with_risk_level(gold_df(spark, sf), "UNKNOWN"))

register("bi_dashboard_table", O.q(
    f"SELECT DTE_EVENT, NAM_COUNTRY, NAM_CITY, RISK_LEVEL, CAST(SUM(CNT_EVENTS) AS BIGINT) AS CNT_EVENTS, "
    f"{O.exact_avg('NUM_RISK_SCORE')} AS NUM_RISK_SCORE, round(avg(NUM_GOLDSTEIN_AVG), 9) + 0.0 AS NUM_GOLDSTEIN_AVG "
    f"FROM (SELECT *, {LEVEL_BI} AS RISK_LEVEL FROM gold) GROUP BY DTE_EVENT, NAM_COUNTRY, NAM_CITY, RISK_LEVEL"))(
    lambda spark, sf: rounded(bi.dashboard_table(gold_df(spark, sf)), 9, "NUM_GOLDSTEIN_AVG"))

register("bi_heatmap", O.q(
    f"SELECT NAM_CITY, {O.exact_sum('NUM_RISK_SCORE')} AS weight FROM gold GROUP BY NAM_CITY"))(
    lambda spark, sf: bi.heatmap(gold_df(spark, sf)))


# --- Sources ----------------------------------------------------------------------
from riskmart import fs  # noqa: E402
from riskmart.plans import arrival as AR  # noqa: E402
from riskmart.plans import runs as P  # noqa: E402
from riskmart.schemas import EVENT_COLUMN_NAMES, POSITIONAL_NAMES  # noqa: E402
from riskmart.session import new_work_dir  # noqa: E402
from riskmart.sinks import writers as W  # noqa: E402
from riskmart.sources import files as SRC  # noqa: E402

FEED_COLS = ", ".join(POSITIONAL_NAMES)
FEED_WITH_DAY = f"{FEED_COLS}, strftime(ingest_day, '%Y-%m-%d') AS ingestion_date"
LANDING_DAY = "2024-01-16"


_LANDED: dict[tuple[str, str], dict[str, str]] = {}


def landed(spark: SparkSession, sf: str, tag: str) -> tuple[str, dict[str, str]]:
    """(fresh root for a query's own tables, landing roots); the landing copy is
    made once a session and only read after that."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _LANDED:
        _LANDED[key] = FX.land_fixture(spark, sf, new_work_dir(spark, "landing"))
    return new_work_dir(spark, tag), _LANDED[key]


def landed_anew(spark: SparkSession, sf: str, tag: str) -> tuple[str, dict[str, str]]:
    """A landing copy of its own, for queries that add files to it."""
    root = new_work_dir(spark, tag)
    return root, FX.land_fixture(spark, sf, root)


@register("src_events_tsv", O.q(f"SELECT {FEED_COLS} FROM feed"))
def _src_events_tsv(spark, sf):
    _, paths = landed(spark, sf, "src-events")
    return SRC.read_events(spark, paths["events"]).select(*POSITIONAL_NAMES)


@register("src_events_named", O.q("SELECT " + ", ".join(
    f"{p} AS {n}" for p, n in zip(POSITIONAL_NAMES, EVENT_COLUMN_NAMES)) + " FROM feed"))
def _src_events_named(spark, sf):
    _, paths = landed(spark, sf, "src-named")
    return SRC.read_events(spark, paths["events"], named=True).select(*EVENT_COLUMN_NAMES)


@register("src_reference_csv", O.q("SELECT * FROM ref_raw"))
def _src_reference_csv(spark, sf):
    out = new_work_dir(spark, "src-ref") + "/gdelt_country_risk"
    W.write_csv(reference_raw(spark, sf), out)
    return SRC.read_reference(spark, out)


@register("src_gold_csv_coerce", O.q("SELECT * FROM gold"))
def _src_gold_csv(spark, sf):
    out = new_work_dir(spark, "src-goldcsv") + "/gold_csv"
    W.write_csv(gold_df(spark, sf), out)
    return SRC.read_gold_csv(spark, out)


@register("src_latest_reference", O.q("SELECT * FROM ref_raw"))
def _src_latest_reference(spark, sf):
    return SRC.latest_reference(spark, FX.land_reference(spark, sf, new_work_dir(spark, "src-latest")))


@register("src_landing_partition", O.q(
    f"SELECT {FEED_WITH_DAY} FROM feed WHERE ingest_day = DATE '{LANDING_DAY}'"))
def _src_landing_partition(spark, sf):
    _, paths = landed(spark, sf, "src-day")
    return SRC.read_events(spark, paths["events"], ingestion_dates=[LANDING_DAY])


@register("src_landing_filter", O.q(f"SELECT {FEED_WITH_DAY} FROM feed"))
def _src_landing_filter(spark, sf):
    root, paths = landed_anew(spark, sf, "src-filter")
    junk_row = "\t".join(["999"] * 58) + "\n"
    fs.write_text(spark, f"{paths['events']}/ingestion_date={LANDING_DAY}/manifest.json", junk_row)
    fs.write_text(spark, f"{paths['events']}/ingestion_date={LANDING_DAY}/notes.txt", junk_row)
    fs.write_text(spark, f"{paths['events']}/ingestion_date={LANDING_DAY}/part-extra.csv.tmp", junk_row)
    for folder in ("garbage", "2024-02-30"):
        fs.write_text(spark, f"{paths['events']}/ingestion_date={folder}/events.csv", junk_row)
    return SRC.read_events(spark, paths["events"])


# --- Sinks and whole runs ----------------------------------------------------------
def _run_cfg(spark, sf, tag, **kw) -> P.RunConfig:
    root, paths = landed(spark, sf, tag)
    cfg = P.RunConfig.under(root, ingestion_ts=K.RUN_TS, **kw)
    return replace(cfg, landing_events=paths["events"], landing_reference=paths["reference"])


# Cells with blanks around them: what Bronze must not trim.
PADDED = "CASE WHEN _c50 IS NOT NULL THEN '  ' || _c50 || ' ' END"


@register("snk_bronze_events", O.q(f"SELECT * REPLACE ({PADDED} AS _c50) FROM (SELECT {FEED_WITH_DAY} FROM feed)"))
def _snk_bronze_events(spark, sf):
    root = new_work_dir(spark, "snk-bronze")
    cfg = P.RunConfig.under(root, ingestion_ts=K.RUN_TS)
    day = F.date_format("ingest_day", "yyyy-MM-dd").alias("ingestion_date")
    padded = FX.event_feed(spark, sf, with_ingest_day=True).withColumn("_c50", F.expr(PADDED))
    W.write_events_tsv(padded.select(*POSITIONAL_NAMES, day), cfg.landing_events, partition_by="ingestion_date")
    FX.land_reference(spark, sf, root)
    P.bronze(spark, cfg)
    return SRC.read_bronze_events(spark, cfg.bronze_events, cfg.runs)


@register("snk_bronze_reference", O.q(
    "SELECT r.*, unnest((SELECT list(DISTINCT strftime(ingest_day, '%Y-%m-%d')) FROM feed)) AS ingestion_date "
    "FROM ref_raw r"))
def _snk_bronze_reference(spark, sf):
    cfg = _run_cfg(spark, sf, "snk-bronze-ref")
    P.bronze(spark, cfg)
    return SRC.read_bronze_reference(spark, cfg.bronze_reference, cfg.runs)


@register("snk_bronze_metadata", O.q(
    f"SELECT strftime(ingest_day, '%Y-%m-%d') AS ingestion_date, 'gdelt' AS source_system, '{K.RUN_TS}' AS ingestion_ts, "
    "'events-' || strftime(ingest_day, '%Y%m%d') || '-0.csv' AS first_file, CAST(COUNT(*) AS BIGINT) AS n_rows, "
    "true AS named_by_day FROM feed GROUP BY ingest_day"))
def _snk_bronze_metadata(spark, sf):
    cfg = _run_cfg(spark, sf, "snk-bronze-meta")
    P.bronze(spark, cfg)
    meta = P.read_bronze_metadata(spark, cfg)
    named = F.col("source_file").rlike("^events-[0-9]{8}-[0-9]+[.]csv$") & F.col("source_file").contains(
        F.regexp_replace("ingestion_date", "-", ""))
    return meta.groupBy("ingestion_date", "source_system", "ingestion_ts").agg(
        F.min("source_file").alias("first_file"), F.sum("rows").alias("n_rows"), F.bool_and(named).alias("named_by_day"))


@register("snk_silver_parquet", O.q(f"SELECT {O.SILVER_SELECT} FROM silver", per_day=True))
def _snk_silver(spark, sf):
    cfg = _run_cfg(spark, sf, "snk-silver")
    P.silver_run(spark, cfg)
    return P.read_silver(spark, cfg)


@register("snk_gold_table", O.q("SELECT * FROM gold"))
def _snk_gold_table(spark, sf):
    out = new_work_dir(spark, "snk-gold") + "/gold"
    W.write_gold(gold_df(spark, sf), out, mode="replace", days=[K.RUN_DATE])
    return SRC.read_gold(spark, out)


@register("snk_gold_csv", O.q("SELECT * FROM gold", per_day=True))
def _snk_gold_csv(spark, sf):
    cfg = _run_cfg(spark, sf, "snk-goldcsv")
    cfg = replace(cfg, gold_csv=f"{cfg.gold}_csv")
    P.run(spark, cfg, with_bronze=False)
    return SRC.read_gold_csv(spark, cfg.gold_csv)


@register("snk_gold_preview", O.q(f"SELECT * FROM gold ORDER BY {GOLD_ORDER} LIMIT 100", per_day=True))
def _snk_gold_preview(spark, sf):
    cfg = _run_cfg(spark, sf, "snk-preview")
    stored = P.run(spark, cfg, with_bronze=False)
    return stored.orderBy(*bi.grain_order()).limit(100)


@register("snk_modes", O.q("SELECT * FROM gold UNION ALL SELECT * FROM gold"))
def _snk_modes(spark, sf):
    out = new_work_dir(spark, "snk-modes") + "/gold"
    mart = gold_df(spark, sf)
    W.write_gold(mart, out, mode="append")
    W.write_gold(mart, out, mode="overwrite")      # replaces everything
    W.write_gold(mart, out, mode="append")         # adds a second copy
    return SRC.read_gold(spark, out)


@register("e2e_run", O.q("SELECT * FROM gold", per_day=True))
def _e2e_run(spark, sf):
    cfg = _run_cfg(spark, sf, "e2e")
    return P.run(spark, cfg)


@register("inc_rerun", O.q("SELECT * FROM gold", per_day=True))
def _inc_rerun(spark, sf):
    cfg = _run_cfg(spark, sf, "rerun")
    P.run(spark, cfg, with_bronze=False)
    again = replace(cfg, ingestion_dates=["2024-01-10", LANDING_DAY])
    return P.run(spark, again, with_bronze=False)


@register("inc_backfill", O.q(
    "SELECT *, (SELECT COUNT(*) FROM feed) AS bronze_rows FROM gold", per_day=True))
def _inc_backfill(spark, sf):
    cfg = _run_cfg(spark, sf, "backfill")
    P.backfill(spark, cfg, end="2024-01-15")
    gold_ = P.backfill(spark, cfg, start="2024-01-16")
    return gold_.withColumn("bronze_rows", SRC.read_bronze_events(spark, cfg.bronze_events, cfg.runs).agg(F.count(F.lit(1))).scalar())


@register("inc_append", O.q("SELECT * FROM gold UNION ALL SELECT * FROM gold", per_day=True))
def _inc_append(spark, sf):
    cfg = _run_cfg(spark, sf, "append", mode_silver="append", mode_gold="append")
    P.run(spark, cfg, with_bronze=False)
    return P.run(spark, cfg, with_bronze=False)


@register("e2e_one_file", O.q(
    f"SELECT * FROM gold WHERE DTE_INGESTION = DATE '{LANDING_DAY}'", per_day=True, reference="ref_old_raw"))
def _e2e_one_file(spark, sf):
    """One named events file with a chosen, older reference."""
    root = new_work_dir(spark, "one-file")
    one, ref = f"{root}/ingestion_date={LANDING_DAY}/named.csv", f"{root}/chosen_reference"
    day = F.col("ingest_day") == F.lit(LANDING_DAY).cast("date")
    W.write_events_tsv(FX.event_feed(spark, sf, with_ingest_day=True).where(day).drop("ingest_day"), one)
    W.write_csv(FX.old_reference_feed(spark, sf), ref)
    return P.run(spark, P.RunConfig.under(root, ingestion_ts=K.RUN_TS, events_file=one, reference_file=ref))


@register("inc_arrival", O.q("SELECT * FROM gold", per_day=True, redelivered=(K.REDELIVERED_DAY, K.REDELIVERY_DAY)))
def _inc_arrival(spark, sf):
    """Landed files start the run of their days; the second call sees only the redelivery."""
    root, paths = landed_anew(spark, sf, "arrival")
    cfg = P.RunConfig.under(root, ingestion_ts=K.RUN_TS)
    AR.run_arrived(spark, cfg, f"{root}/_arrivals")
    FX.land_redelivery(spark, sf, root, K.REDELIVERED_DAY, K.REDELIVERY_DAY)
    return AR.run_arrived(spark, cfg, f"{root}/_arrivals")


# --- Notebook analysis ---------------------------------------------------------------
from riskmart.operators import analysis as A  # noqa: E402
from riskmart.functions.columns import lenient_double  # noqa: E402
from riskmart.operators import profile as PR  # noqa: E402
from riskmart.operators import quality as Q  # noqa: E402

register("nb_trend", O.q(
    f"SELECT DTE_EVENT, CAST(SUM(CNT_EVENTS) AS BIGINT) AS total_events, {O.exact_avg('NUM_RISK_SCORE')} AS avg_score, "
    "MAX(NUM_RISK_SCORE) AS max_score FROM gold WHERE DTE_EVENT IS NOT NULL GROUP BY DTE_EVENT ORDER BY DTE_EVENT"))(
    lambda spark, sf: A.trend(gold_df(spark, sf)))

register("nb_top_countries", O.q(
    f"SELECT NAM_COUNTRY, {O.exact_sum('NUM_RISK_SCORE')} AS total_score, CAST(SUM(CNT_EVENTS) AS BIGINT) AS total_events "
    "FROM gold WHERE NAM_COUNTRY IS NOT NULL GROUP BY NAM_COUNTRY "
    "ORDER BY total_score DESC NULLS LAST, NAM_COUNTRY ASC LIMIT 15"))(
    lambda spark, sf: A.top_countries(gold_df(spark, sf)))

register("nb_top20", O.q(
    "SELECT DTE_EVENT, NAM_COUNTRY, NAM_CITY, CNT_EVENTS, NUM_GOLDSTEIN_AVG, NUM_RISK_SCORE FROM gold "
    f"ORDER BY NUM_RISK_SCORE DESC NULLS LAST, {GOLD_ORDER}, CNT_EVENTS ASC LIMIT 20"))(
    lambda spark, sf: A.top_rows(gold_df(spark, sf)))

register("nb_level_counts", O.q(
    f"SELECT RISK_LEVEL, COUNT(*) AS count FROM (SELECT {LEVEL_NB} AS RISK_LEVEL FROM gold) GROUP BY RISK_LEVEL"))(
    lambda spark, sf: A.level_counts(gold_df(spark, sf)))

PROPOSED_CTE = """, parts AS (
  SELECT *, ln(1 + CAST(coalesce(CNT_EVENTS, 0) AS DOUBLE)) AS _vol,
         CASE WHEN NUM_GOLDSTEIN_AVG IS NOT NULL THEN greatest(-NUM_GOLDSTEIN_AVG, 0.0::DOUBLE) END AS _conf
  FROM gold),
normed AS (
  SELECT *,
    (_vol - (SELECT min(_vol) FROM parts)) / ((SELECT max(_vol) FROM parts) - (SELECT min(_vol) FROM parts) + 1e-9) AS vol_n,
    (_conf - (SELECT min(_conf) FROM parts)) / ((SELECT max(_conf) FROM parts) - (SELECT min(_conf) FROM parts) + 1e-9)
      AS conf_n
  FROM parts),
proposed AS (
  SELECT DTE_EVENT, NAM_COUNTRY, NAM_CITY, CNT_EVENTS, NUM_GOLDSTEIN_AVG, NUM_RISK_SCORE,
         vol_n AS VOL_NORM, conf_n AS CONF_NORM, 100 * (0.6 * vol_n + 0.4 * conf_n) AS RISK_SCORE_PROPOSED
  FROM normed)
"""

PROPOSED = ("VOL_NORM", "CONF_NORM", "RISK_SCORE_PROPOSED")


def stored_gold(spark: SparkSession, sf: str) -> DataFrame:
    """The mart as a written table."""
    out = new_work_dir(spark, "gold") + "/gold"
    W.write_gold(gold_df(spark, sf), out, days=[K.RUN_DATE])
    return SRC.read_gold(spark, out)


register("score_proposed", O.ctes().rstrip() + PROPOSED_CTE + (
    "SELECT * REPLACE (" + ", ".join(f"round({c}, 9) + 0.0 AS {c}" for c in PROPOSED) + ") FROM proposed"))(
    lambda spark, sf: rounded(A.proposed_score(stored_gold(spark, sf)), 9, *PROPOSED))

register("score_corr", O.ctes().rstrip() + PROPOSED_CTE + (
    "SELECT round(corr(NUM_RISK_SCORE, RISK_SCORE_PROPOSED), 9) + 0.0 AS corr, "
    "COUNT(*) FILTER (WHERE NUM_RISK_SCORE IS NOT NULL AND RISK_SCORE_PROPOSED IS NOT NULL) AS pairs FROM proposed"))(
    lambda spark, sf: rounded(A.score_correlation(stored_gold(spark, sf)), 9, "corr"))

register("bi_stored_country_by_day", O.q(
    f"SELECT NAM_COUNTRY, {O.exact_sum('NUM_RISK_SCORE')} AS total_score FROM gold "
    f"WHERE DTE_EVENT = DATE '{K.REPORT_DAY}' GROUP BY NAM_COUNTRY "
    "ORDER BY total_score DESC NULLS LAST, NAM_COUNTRY ASC NULLS FIRST LIMIT 20"))(
    lambda spark, sf: bi.country_by_day(stored_gold(spark, sf), K.REPORT_DAY))


def _nulls_sql(dataset: str, source: str, columns: list[tuple[str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{dataset}' AS dataset, '{name}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count, "
        f"COUNT(*) AS total_rows FROM {source}" for c, name in columns)


@register("prof_nulls", O.q(" UNION ALL ".join((
    _nulls_sql("events", "feed", list(zip(POSITIONAL_NAMES, EVENT_COLUMN_NAMES))),
    _nulls_sql("country_risk", "ref_raw", [(c, c) for c in ("country", "baseline_risk", "risk_multiplier", "updated_at")]),
    _nulls_sql("gold", "gold", [(c, c) for c in ("DTE_EVENT", "NAM_COUNTRY", "NAM_CITY", "CNT_EVENTS", "NUM_GOLDSTEIN_AVG",
                                                 "NUM_RISK_SCORE", "DTE_INGESTION")])))))
def _prof_nulls(spark, sf):
    return (A.null_counts(feed(spark, sf).toDF(*EVENT_COLUMN_NAMES), "events")
            .unionByName(A.null_counts(reference_raw(spark, sf), "country_risk"))
            .unionByName(A.null_counts(gold_df(spark, sf), "gold")))


# The feed's fields that hold numbers; the others are text.
EVENT_NUMBERS = ["GlobalEventID", "SQLDATE", "MonthYear", "Year", "FractionDate", "IsRootEvent", "QuadClass", "GoldsteinScale",
                 "NumMentions", "NumSources", "NumArticles", "AvgTone", "Actor1Geo_Lat", "Actor1Geo_Long", "Actor2Geo_Lat",
                 "Actor2Geo_Long", "ActionGeo_Lat", "ActionGeo_Long", "DateAdded"]
REFERENCE_NUMBERS = ["baseline_risk", "risk_multiplier"]
REFERENCE_TEXT = ["country", "updated_at"]


def _profile_sql(dataset: str, source: str, names: dict[str, str], numbers: list[str]) -> str:
    parts = []
    for c, name in names.items():
        if name in numbers:
            x = f"try_cast({c} AS DOUBLE)"
            quart = ", ".join(f"round(quantile_cont({x}, {p}), 6) + 0.0 AS {k}" for k, p in PR.QUANTILES.items())
            parts.append(
                f"SELECT '{dataset}' AS dataset, '{name}' AS column_name, COUNT({x}) AS count, COUNT(DISTINCT {x}) AS \"unique\", "
                f"CAST(NULL AS VARCHAR) AS top, CAST(NULL AS BIGINT) AS freq, round(avg({x}), 6) + 0.0 AS mean, "
                f"round(stddev_samp({x}), 6) + 0.0 AS std, min({x}) AS min, {quart}, max({x}) AS max FROM {source}")
        else:
            top = f"(SELECT {c} AS v, COUNT(*) AS n FROM {source} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY n DESC, v ASC LIMIT 1)"
            empty = ", ".join(f"CAST(NULL AS DOUBLE) AS {k}" for k in ("mean", "std", "min", "p25", "p50", "p75", "max"))
            parts.append(
                f"SELECT '{dataset}' AS dataset, '{name}' AS column_name, COUNT({c}) AS count, COUNT(DISTINCT {c}) AS \"unique\", "
                f"(SELECT v FROM {top}) AS top, (SELECT n FROM {top}) AS freq, {empty} FROM {source}")
    return " UNION ALL ".join(parts)


def _described(df: DataFrame, dataset: str, numbers: list[str]) -> DataFrame:
    """All columns of a raw input; number fields are read leniently, so a malformed cell counts as missing."""
    typed = df.select(*[lenient_double(c).alias(c) if c in numbers else F.col(c) for c in df.columns])
    out = PR.describe(typed, [c for c in df.columns if c in numbers], [c for c in df.columns if c not in numbers])
    return rounded(out, 6, "mean", "std", *PR.QUANTILES).select(F.lit(dataset).alias("dataset"), *PR.COLUMNS)


@register("prof_describe", O.q(
    _profile_sql("events", "feed", dict(zip(POSITIONAL_NAMES, EVENT_COLUMN_NAMES)), EVENT_NUMBERS) + " UNION ALL "
    + _profile_sql("country_risk", "ref_raw", {c: c for c in REFERENCE_TEXT + REFERENCE_NUMBERS}, REFERENCE_NUMBERS)))
def _prof_describe(spark, sf):
    return (_described(feed(spark, sf).toDF(*EVENT_COLUMN_NAMES), "events", EVENT_NUMBERS)
            .unionByName(_described(reference_raw(spark, sf), "country_risk", REFERENCE_NUMBERS)))


# --- Data quality ------------------------------------------------------------------------
register("dq_silver", O.q(O.contract_sql("silver", "silver")))(
    lambda spark, sf: Q.evaluate(silver_df(spark, sf), "silver", Q.silver_rules()))

register("dq_gold", O.q(O.contract_sql("gold", "gold")))(
    lambda spark, sf: Q.evaluate(gold_df(spark, sf), "gold", Q.gold_rules()))

register("dq_reference", O.q(O.contract_sql("reference", "ref_typed")))(
    lambda spark, sf: Q.evaluate(SV.prepare_reference(reference_raw(spark, sf)), "reference", Q.reference_rules()))


def bronze_files(spark: SparkSession, sf: str, tag: str) -> DataFrame:
    cfg = _run_cfg(spark, sf, tag)
    P.bronze(spark, cfg)
    return P.read_bronze_metadata(spark, cfg)


@register("dq_bronze", O.q(O.contract_sql("bronze", O.BRONZE_FILES)))
def _dq_bronze(spark, sf):
    return Q.evaluate(bronze_files(spark, sf, "dq-bronze"), "bronze", Q.bronze_rules())


def _pk_sql(stage: str, source: str) -> str:
    return (f"SELECT '{stage}' AS stage, CAST(SUM(n) AS BIGINT) AS \"rows\", COUNT(*) AS distinct_keys, "
            "COUNT(*) FILTER (WHERE n > 1) AS duplicate_keys, "
            "CAST(coalesce(SUM(CASE WHEN n > 1 THEN n - 1 END), 0) AS BIGINT) AS surplus_rows "
            f"FROM (SELECT globaleventid, COUNT(*) AS n FROM {source} GROUP BY globaleventid)")


NEW_KEYS_SQL = (
    "SELECT 'redelivered' AS stage, CAST(SUM(n) AS BIGINT) AS \"rows\", COUNT(*) AS distinct_keys, "
    "COUNT(*) FILTER (WHERE n + held > 1) AS duplicate_keys, CAST(SUM(n + held - 1) AS BIGINT) AS surplus_rows "
    "FROM (SELECT globaleventid, COUNT(*) AS n, CASE WHEN globaleventid IN (SELECT globaleventid FROM silver "
    f"WHERE ingestion_date <> '{K.REDELIVERY_DAY}') THEN 1 ELSE 0 END AS held "
    f"FROM silver WHERE ingestion_date = '{K.REDELIVERY_DAY}' GROUP BY globaleventid)")


@register("dq_silver_pk", " UNION ALL ".join(f"SELECT * FROM ({part})" for part in (
    O.q(_pk_sql("accepted", "accepted") + " UNION ALL " + _pk_sql("silver", "silver")),
    O.q(_pk_sql("stored", "silver") + " UNION ALL " + NEW_KEYS_SQL, per_day=True, redelivered=(K.REDELIVERED_DAY, K.REDELIVERY_DAY)))))
def _dq_silver_pk(spark, sf):
    """One run's rows before and after deduplication; then the stored Silver of several days, in which a later day
    delivered one day's events again: the whole table, and the later day against the rest of it."""
    gated = SV.prepare(feed(spark, sf), K.RUN_DATE, K.RUN_TS)
    root, _ = landed_anew(spark, sf, "dq-pk")
    FX.land_redelivery(spark, sf, root, K.REDELIVERED_DAY, K.REDELIVERY_DAY)
    cfg = P.RunConfig.under(root, ingestion_ts=K.RUN_TS)
    P.silver_run(spark, cfg)
    return (Q.primary_key_check(gated, ["globaleventid"], "accepted")
            .unionByName(Q.primary_key_check(silver_df(spark, sf), ["globaleventid"], "silver"))
            .unionByName(Q.primary_key_check(P.read_silver(spark, cfg), ["globaleventid"], "stored"))
            .unionByName(P.key_check(spark, cfg, [K.REDELIVERY_DAY])))


register("dq_rejects", O.q(
    "SELECT outcome, COUNT(*) AS \"rows\" FROM (SELECT CASE WHEN event_date IS NULL THEN 'missing_event_date' "
    "WHEN globaleventid IS NULL THEN 'missing_event_id' WHEN country IS NULL THEN 'missing_country' "
    "WHEN length(country) <> 2 THEN 'country_not_2_chars' END AS outcome FROM prepared) "
    "WHERE outcome IS NOT NULL GROUP BY outcome "
    "UNION ALL SELECT 'accepted', (SELECT COUNT(*) FROM dedup) "
    "UNION ALL SELECT 'duplicate', (SELECT COUNT(*) FROM accepted) - (SELECT COUNT(*) FROM dedup)"))(
    lambda spark, sf: Q.reject_accounting(feed(spark, sf), K.RUN_DATE, K.RUN_TS))


QUARANTINE_REASON = ("CASE WHEN try_strptime(_c1, '%Y%m%d') IS NULL THEN 'missing_event_date' "
                     "WHEN try_cast(_c0 AS BIGINT) IS NULL THEN 'missing_event_id' "
                     "WHEN _c51 IS NULL THEN 'missing_country' "
                     "WHEN length(upper(_c51)) <> 2 THEN 'country_not_2_chars' END")


@register("dq_quarantine", O.q(
    f"SELECT * FROM (SELECT {FEED_COLS}, {QUARANTINE_REASON} AS reject_reason, "
    "strftime(ingest_day, '%Y-%m-%d') AS ingestion_date FROM feed) WHERE reject_reason IS NOT NULL"))
def _dq_quarantine(spark, sf):
    cfg = _run_cfg(spark, sf, "dq-quarantine").with_quarantine()
    P.silver_run(spark, cfg)
    return P.read_quarantine(spark, cfg)


@register("dq_required_columns", O.q(" UNION ALL ".join((
    O.columns_sql("bronze", O.BRONZE_FILES), O.columns_sql("silver", "silver"), O.columns_sql("gold", "gold"),
    O.columns_sql("reference", "ref_typed")))))
def _dq_required_columns(spark, sf):
    out = None
    silver_frame = silver_df(spark, sf)
    for layer, df in (("bronze", bronze_files(spark, sf, "dq-columns")), ("silver", silver_frame),
                      ("gold", gold(silver_frame)), ("reference", SV.prepare_reference(reference_raw(spark, sf)))):
        schema, required = Q.LAYER_SCHEMAS[layer]
        part = Q.schema_conformance(df, layer, schema, required)
        out = part if out is None else out.unionByName(part)
    return out


# --- Streaming ------------------------------------------------------------------------------
from riskmart import schemas as S  # noqa: E402
from riskmart.streaming import incremental as ST  # noqa: E402


def _stream_to_table(spark, sf, tag, with_reference: bool) -> DataFrame:
    """Two starts over one checkpoint.  Between them a day's events land again with
    another value: in the same day's folder (copies, dropped) and in a later day's (kept)."""
    root, paths = landed_anew(spark, sf, tag)
    ref = SRC.latest_reference(spark, paths["reference"]) if with_reference else None
    for start in (1, 2):
        ST.run_available(spark, paths["events"], f"{root}/silver_stream", f"{root}/_checkpoints/silver_stream", K.RUN_TS, ref)
        if start == 1:
            FX.land_redelivery(spark, sf, root, K.REDELIVERED_DAY, K.REDELIVERY_DAY)
    return ST.read_stream_output(spark, f"{root}/silver_stream", S.SILVER if with_reference else ST.PREPARED)


register("str_incremental_silver", O.q(f"SELECT {O.SILVER_SELECT} FROM silver", per_day=True,
                                       redelivered=(K.REDELIVERY_DAY,)))(
    lambda spark, sf: _stream_to_table(spark, sf, "str-silver", True))

register("str_dedup", O.q("SELECT * FROM dedup", per_day=True, redelivered=(K.REDELIVERY_DAY,)))(
    lambda spark, sf: _stream_to_table(spark, sf, "str-dedup", False))
