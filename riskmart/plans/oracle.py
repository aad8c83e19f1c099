"""Independent SQL statements of every catalog query (DuckDB dialect).

They rebuild the landing feed, Silver and Gold from the driver tables
(``events``, ``nation``) with the same documented rules, then run each query
in SQL.  Conventions that keep the two engines bit-equal:

* exact sums as decimals, so they do not depend on row order;
* ``||`` instead of ``concat`` (DuckDB's ``concat`` skips nulls);
* ``CAST(SUM(bigint) AS BIGINT)`` (DuckDB widens to HUGEINT);
* every LIMIT has a full tie-break with explicit null ordering.
"""

from __future__ import annotations

from riskmart import schemas as S
from riskmart.plans import constants as K
from riskmart.sources.fixture import REDELIVERED_GOLDSTEIN


def exact_sum(x: str) -> str:
    return f"CAST(SUM(CAST({x} AS DECIMAL(38,10))) AS DOUBLE)"


def exact_avg(x: str) -> str:
    return f"({exact_sum(x)} / NULLIF(COUNT({x}), 0))"


def _feed_columns() -> str:
    picked = {
        0: "CASE WHEN event_id % 101 = 0 THEN 'bad' || CAST(event_id AS VARCHAR) ELSE CAST(event_id AS VARCHAR) END",
        1: "CASE WHEN event_id % 97 = 0 THEN '20240230' ELSE strftime(CAST(ts AS DATE), '%Y%m%d') END",
        29: ("CASE event_type WHEN 'view' THEN '1' WHEN 'click' THEN '2' WHEN 'purchase' THEN '3' "
             "WHEN 'error' THEN '4' END"),
        # + 0.0: Spark's decimal rounding never yields a negative zero.
        30: "CAST(round(10.0 - value / 5, 2) + 0.0 AS VARCHAR)",
        50: ("CASE WHEN user_id % 11 = 0 THEN NULL WHEN user_id % 17 = 0 THEN n_name "
             "ELSE 'City ' || CAST(user_id % 7 AS VARCHAR) || ', ' || n_name END"),
        51: "CASE WHEN user_id % 29 = 0 THEN NULL WHEN user_id % 13 = 0 THEN 'xyz' ELSE cc END",
        52: "upper(cc) || lpad(CAST(n_nationkey AS VARCHAR), 2, '0')",
        53: "CAST(n_nationkey * 3 - 36 AS VARCHAR) || '.5'",
        54: "CAST(n_regionkey * 40 - 80 AS VARCHAR) || '.25'",
    }
    return ",\n    ".join(f"{picked.get(i, 'CAST(NULL AS VARCHAR)')} AS {n}"
                           for i, n in enumerate(S.POSITIONAL_NAMES))


def _reference_sql(mult_base: int, base_offset: int, updated_at: str) -> str:
    h = f"({mult_base} + n_nationkey * 5)"
    return (f"SELECT upper(chr(97 + n_nationkey) || chr(97 + n_regionkey)) AS country, "
            f"'0.' || lpad(CAST(n_nationkey * 3 + {base_offset} AS VARCHAR), 2, '0') AS baseline_risk, "
            f"CAST({h} // 100 AS VARCHAR) || '.' || lpad(CAST({h} % 100 AS VARCHAR), 2, '0') AS risk_multiplier, "
            f"'{updated_at}' AS updated_at FROM nation WHERE n_regionkey < 3")


SURVIVOR_ORDER = ("event_date ASC NULLS LAST, quadclass ASC NULLS LAST, goldstein_scale ASC NULLS LAST, "
                  "actiongeo_fullname ASC NULLS LAST, actiongeo_countrycode ASC NULLS LAST, "
                  "actiongeo_adm1code ASC NULLS LAST, actiongeo_lat ASC NULLS LAST, "
                  "actiongeo_long ASC NULLS LAST, ingestion_ts ASC NULLS LAST")

SILVER_SELECT = ("globaleventid, event_date, quadclass, goldstein_scale, actiongeo_fullname, "
                 "actiongeo_countrycode, actiongeo_adm1code, actiongeo_lat, actiongeo_long, country, city, "
                 "ingestion_date, ingestion_ts, risk_weight, baseline_risk, risk_multiplier, updated_at, "
                 "risk_weight_adj")


def _redelivered(into: str) -> str:
    """One day's events once more, with another Goldstein value, landed in the folder ``into``."""
    return f"""
  UNION ALL SELECT * REPLACE ('{REDELIVERED_GOLDSTEIN}' AS _c30, DATE '{into}' AS ingest_day) FROM copied
  WHERE ingest_day = DATE '{K.REDELIVERED_DAY}'"""


def ctes(per_day: bool = False, redelivered: tuple[str, ...] = (), reference: str = "ref_raw") -> str:
    """All CTEs: ev, feed_one, feed, ref_raw, ref_old_raw, ref, typed, prepared,
    accepted, dedup, silver, gold.

    ``per_day``: each landing day is its own ingestion (incremental runs);
    otherwise one run ingests everything on ``RUN_DATE``.  ``redelivered``: landing
    folders in which one day's events arrived again with another Goldstein value.
    ``reference``: the delivery that is used.
    """
    ingestion = "strftime(ingest_day, '%Y-%m-%d')" if per_day else f"'{K.RUN_DATE}'"
    return f"""WITH
ev AS (
  SELECT e.event_id, e.ts, e.user_id, e.event_type, e.value, n.n_nationkey, n.n_name, n.n_regionkey,
         chr(97 + n.n_nationkey) || chr(97 + n.n_regionkey) AS cc
  FROM events e JOIN nation n ON e.user_id % 25 = n.n_nationkey
),
feed_one AS (
  SELECT
    {_feed_columns()},
    CAST(ts AS DATE) + 1 AS ingest_day,
    CASE WHEN event_id % 10 = 0 THEN 2 ELSE 1 END AS copies
  FROM ev
),
copied AS (
  SELECT * EXCLUDE (copies, copy_no)
  FROM (SELECT *, unnest(generate_series(1, copies)) AS copy_no FROM feed_one)
),
feed AS (SELECT * FROM copied {"".join(_redelivered(d) for d in redelivered)}),
ref_raw AS ({_reference_sql(80, 10, K.REFERENCE_UPDATED_AT)}),
ref_old_raw AS ({_reference_sql(50, 5, K.OLD_REFERENCE_UPDATED_AT)}),
ref_typed AS (
  SELECT upper(country) AS country, try_cast(baseline_risk AS DOUBLE) AS baseline_risk,
         try_cast(risk_multiplier AS DOUBLE) AS risk_multiplier, CAST(updated_at AS VARCHAR) AS updated_at
  FROM {reference}
),
ref AS (
  SELECT country, baseline_risk, risk_multiplier, updated_at FROM (
    SELECT *, row_number() OVER (PARTITION BY country ORDER BY updated_at DESC NULLS LAST,
           risk_multiplier DESC NULLS LAST, baseline_risk DESC NULLS LAST) AS rn
    FROM ref_typed WHERE length(country) = 2) WHERE rn = 1
),
typed AS (
  SELECT try_cast(_c0 AS BIGINT) AS globaleventid,
         CAST(try_strptime(_c1, '%Y%m%d') AS DATE) AS event_date,
         try_cast(_c29 AS INTEGER) AS quadclass,
         try_cast(_c30 AS DOUBLE) AS goldstein_scale,
         _c50 AS actiongeo_fullname, _c51 AS actiongeo_countrycode, _c52 AS actiongeo_adm1code,
         try_cast(_c53 AS DOUBLE) AS actiongeo_lat, try_cast(_c54 AS DOUBLE) AS actiongeo_long,
         ingest_day
  FROM feed
),
prepared AS (
  SELECT globaleventid, event_date, quadclass, goldstein_scale, actiongeo_fullname, actiongeo_countrycode,
         actiongeo_adm1code, actiongeo_lat, actiongeo_long,
         upper(actiongeo_countrycode) AS country,
         CASE WHEN actiongeo_fullname IS NULL THEN NULL ELSE trim(split_part(actiongeo_fullname, ',', 1)) END AS city,
         {ingestion} AS ingestion_date,
         '{K.RUN_TS}' AS ingestion_ts
  FROM typed
),
accepted AS (
  SELECT * FROM prepared
  WHERE event_date IS NOT NULL AND globaleventid IS NOT NULL AND country IS NOT NULL AND length(country) = 2
),
dedup AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY ingestion_date, globaleventid ORDER BY {SURVIVOR_ORDER}) AS rn
    FROM accepted) WHERE rn = 1
),
silver AS (
  SELECT d.globaleventid, d.event_date, d.quadclass, d.goldstein_scale, d.actiongeo_fullname,
         d.actiongeo_countrycode, d.actiongeo_adm1code, d.actiongeo_lat, d.actiongeo_long, d.country, d.city,
         d.ingestion_date, d.ingestion_ts,
         CASE d.quadclass WHEN 1 THEN 0.25 WHEN 2 THEN 0.5 WHEN 3 THEN 0.75 WHEN 4 THEN 1.0 ELSE 0.5 END::DOUBLE
           AS risk_weight,
         r.baseline_risk, r.risk_multiplier, r.updated_at,
         CASE d.quadclass WHEN 1 THEN 0.25 WHEN 2 THEN 0.5 WHEN 3 THEN 0.75 WHEN 4 THEN 1.0 ELSE 0.5 END::DOUBLE
           * coalesce(r.risk_multiplier, 1.0::DOUBLE) AS risk_weight_adj
  FROM dedup d LEFT JOIN ref r ON d.country = r.country
),
gold AS (
  SELECT event_date AS DTE_EVENT, country AS NAM_COUNTRY, city AS NAM_CITY,
         COUNT(*) AS CNT_EVENTS,
         {exact_avg('goldstein_scale')} AS NUM_GOLDSTEIN_AVG,
         round(round({exact_sum('risk_weight_adj')} / COUNT(*) * 100, 9), 2) AS NUM_RISK_SCORE,
         CAST(ingestion_date AS DATE) AS DTE_INGESTION
  FROM silver GROUP BY ingestion_date, event_date, country, city
)
"""


def q(body: str, per_day: bool = False, **given) -> str:
    return ctes(per_day, **given) + body


#: The layer contracts in SQL, written from the contract documents: (rule, severity, rows that break it).
CONTRACTS = {
    "bronze": [
        ("ingestion_ts_not_null", "error", "ingestion_ts IS NULL"),
        ("ingestion_date_not_null", "error", "ingestion_date IS NULL"),
        ("source_file_not_null", "error", "source_file IS NULL"),
        ("source_system_not_null", "error", "source_system IS NULL"),
        ("source_system_in_set", "error", "source_system IS DISTINCT FROM 'gdelt'"),
    ],
    "silver": [
        ("globaleventid_not_null", "error", "globaleventid IS NULL"),
        ("event_date_not_null", "error", "event_date IS NULL"),
        ("quadclass_not_null", "error", "quadclass IS NULL"),
        ("country_not_null", "error", "country IS NULL"),
        ("risk_weight_not_null", "error", "risk_weight IS NULL"),
        ("risk_weight_adj_not_null", "error", "risk_weight_adj IS NULL"),
        ("ingestion_date_not_null", "error", "ingestion_date IS NULL"),
        ("ingestion_ts_not_null", "error", "ingestion_ts IS NULL"),
        ("country_len_2", "error", "strlen(country) <> 2"),
        ("actiongeo_countrycode_len_2", "error", "strlen(actiongeo_countrycode) <> 2"),
        ("quadclass_between_1_4", "error", "quadclass < 1 OR quadclass > 4"),
        ("baseline_risk_between_0_1", "error", "baseline_risk < 0 OR baseline_risk > 1"),
        ("reference_match", "warning", "country NOT IN (SELECT country FROM ref WHERE risk_multiplier IS NOT NULL)"),
    ],
    "gold": [
        ("DTE_EVENT_not_null", "error", "DTE_EVENT IS NULL"),
        ("NAM_COUNTRY_not_null", "error", "NAM_COUNTRY IS NULL"),
        ("CNT_EVENTS_not_null", "error", "CNT_EVENTS IS NULL"),
        ("NUM_RISK_SCORE_not_null", "error", "NUM_RISK_SCORE IS NULL"),
        ("NUM_GOLDSTEIN_AVG_not_null", "error", "NUM_GOLDSTEIN_AVG IS NULL"),
        ("NAM_COUNTRY_len_2", "error", "strlen(NAM_COUNTRY) <> 2"),
        ("NUM_RISK_SCORE_between_0_100", "warning", "NUM_RISK_SCORE < 0 OR NUM_RISK_SCORE > 100"),
    ],
    "reference": [
        ("country_not_null", "error", "country IS NULL"),
        ("baseline_risk_not_null", "error", "baseline_risk IS NULL"),
        ("risk_multiplier_not_null", "error", "risk_multiplier IS NULL"),
        ("updated_at_not_null", "error", "updated_at IS NULL"),
        ("country_len_2", "error", "strlen(country) <> 2"),
        ("baseline_risk_between_0_1", "error", "baseline_risk < 0 OR baseline_risk > 1"),
    ],
}


def contract_sql(layer: str, source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{layer}' AS layer, '{rule}' AS rule, '{severity}' AS severity, "
        f"COUNT(*) FILTER (WHERE {broken}) AS violations, COUNT(*) AS total FROM {source}"
        for rule, severity, broken in CONTRACTS[layer])


#: Contract columns: name, type, whether the contract lists it as required.
COLUMNS = {
    "bronze": [("ingestion_ts", "string", True), ("ingestion_date", "string", True), ("source_file", "string", True),
               ("source_system", "string", True), ("rows", "bigint", False)],
    "silver": [("globaleventid", "bigint", True), ("event_date", "date", True), ("quadclass", "int", True),
               ("goldstein_scale", "double", True), ("actiongeo_fullname", "string", True),
               ("actiongeo_countrycode", "string", True), ("actiongeo_adm1code", "string", True),
               ("actiongeo_lat", "double", True), ("actiongeo_long", "double", True), ("country", "string", True),
               ("city", "string", True), ("ingestion_date", "string", True), ("ingestion_ts", "string", True),
               ("risk_weight", "double", True), ("baseline_risk", "double", True), ("risk_multiplier", "double", True),
               ("updated_at", "string", False), ("risk_weight_adj", "double", True)],
    "gold": [("DTE_EVENT", "date", True), ("NAM_COUNTRY", "string", True), ("NAM_CITY", "string", False),
             ("CNT_EVENTS", "bigint", True), ("NUM_GOLDSTEIN_AVG", "double", True), ("NUM_RISK_SCORE", "double", True),
             ("DTE_INGESTION", "date", False)],
    "reference": [("country", "string", True), ("baseline_risk", "double", True), ("risk_multiplier", "double", True),
                  ("updated_at", "string", True)],
}
#: What the SQL engine calls these types.
_SQL_TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "date": "DATE"}


def columns_sql(layer: str, source: str) -> str:
    """Per contract column: its type as found by the SQL engine in the rows themselves."""
    def actual(name: str) -> str:
        found = " ".join(f"WHEN '{sql}' THEN '{t}'" for t, sql in _SQL_TYPES.items())
        return f"CASE typeof(any_value(\"{name}\")) {found} END"
    return " UNION ALL ".join(
        f"SELECT '{layer}' AS layer, '{name}' AS column_name, {str(required).lower()} AS required, '{kind}' AS expected_type, "
        f"{actual(name)} AS actual_type, true AS present, {actual(name)} = '{kind}' AS type_ok, "
        f"COUNT(\"{name}\") AS non_null FROM {source}" for name, kind, required in COLUMNS[layer])


#: One row per delivered file, as Bronze notes them (one file a day in the landing fixture).
BRONZE_FILES = (f"(SELECT '{K.RUN_TS}' AS ingestion_ts, strftime(ingest_day, '%Y-%m-%d') AS ingestion_date, "
                "'events-' || strftime(ingest_day, '%Y%m%d') || '-0.csv' AS source_file, 'gdelt' AS source_system, "
                "COUNT(*) AS \"rows\" FROM feed GROUP BY ingest_day)")
