"""Data contracts as code: rule sets per layer, evaluated in one aggregate pass.

``evaluate(df, layer, rules)`` returns one row per rule:
``(layer, rule, severity, violations, total)``.  All rules of a layer are
``count_if`` aggregates of the same scan (partial aggregation, no shuffle of
rows); primary-key checks need one group-by on the key.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart import schemas as S
from riskmart.functions.columns import country_of, lenient_integral, parse_event_date
from riskmart.operators.silver import DEDUP_KEYS, typed_events, with_derived


@dataclass(frozen=True)
class Rule:
    """A contract rule: ``violation`` is a SQL predicate, true when a row
    breaks the rule (the same text runs in Spark and in other SQL engines)."""
    name: str
    violation: str
    severity: str = "error"    # "error" or "warning"

    def column(self) -> Column:
        return F.expr(self.violation)


def not_null(c: str) -> Rule:
    return Rule(f"{c}_not_null", f"{c} IS NULL")


def length_is(c: str, n: int) -> Rule:
    return Rule(f"{c}_len_{n}", f"{c} IS NOT NULL AND length({c}) <> {n}")


def between(c: str, lo: float, hi: float, severity: str = "error") -> Rule:
    return Rule(f"{c}_between_{lo:g}_{hi:g}", f"{c} IS NOT NULL AND NOT ({c} BETWEEN {lo:g} AND {hi:g})", severity)


def one_of(c: str, values: list[str]) -> Rule:
    listed = ", ".join("'" + v.replace("'", "''") + "'" for v in values)
    return Rule(f"{c}_in_set", f"{c} IS NULL OR {c} NOT IN ({listed})")


# --- Contracts (fixed values from the layer contracts) ---------------------------
SILVER_REQUIRED = ["globaleventid", "event_date", "quadclass", "goldstein_scale", "actiongeo_fullname",
                   "actiongeo_countrycode", "actiongeo_adm1code", "actiongeo_lat", "actiongeo_long", "country",
                   "city", "risk_weight", "baseline_risk", "risk_multiplier", "risk_weight_adj",
                   "ingestion_date", "ingestion_ts"]
SILVER_NOT_NULL = ["globaleventid", "event_date", "quadclass", "country", "risk_weight", "risk_weight_adj",
                   "ingestion_date", "ingestion_ts"]
GOLD_REQUIRED = ["DTE_EVENT", "NAM_COUNTRY", "CNT_EVENTS", "NUM_RISK_SCORE", "NUM_GOLDSTEIN_AVG"]
REFERENCE_REQUIRED = ["country", "baseline_risk", "risk_multiplier", "updated_at"]
BRONZE_METADATA = ["ingestion_ts", "ingestion_date", "source_file", "source_system"]
SOURCE_SYSTEMS = ["gdelt"]


def silver_rules() -> list[Rule]:
    return ([not_null(c) for c in SILVER_NOT_NULL]
            + [length_is("country", 2), length_is("actiongeo_countrycode", 2),
               between("quadclass", 1, 4), between("baseline_risk", 0, 1),
               # country codes the reference does not know (code systems may differ):
               # the event keeps multiplier 1.0; reported, not rejected
               Rule("reference_match", "risk_multiplier IS NULL", "warning")])


def gold_rules() -> list[Rule]:
    return ([not_null(c) for c in GOLD_REQUIRED]
            + [length_is("NAM_COUNTRY", 2),
               # documented as 0..100, but multipliers above 1 exceed it: warn only
               between("NUM_RISK_SCORE", 0, 100, severity="warning")])


def reference_rules() -> list[Rule]:
    return [not_null(c) for c in REFERENCE_REQUIRED] + [length_is("country", 2), between("baseline_risk", 0, 1)]


def bronze_rules() -> list[Rule]:
    return [not_null(c) for c in BRONZE_METADATA] + [one_of("source_system", SOURCE_SYSTEMS)]


def evaluate(df: DataFrame, layer: str, rules: list[Rule]) -> DataFrame:
    """DQ-2/3/4/7/8: one aggregate pass, one output row per rule."""
    counts = df.agg(F.count(F.lit(1)).alias("_total"),
                    *[F.count_if(r.column()).alias(f"_r{i}") for i, r in enumerate(rules)])
    per_rule = F.explode(F.array(*[
        F.struct(F.lit(r.name).alias("rule"), F.lit(r.severity).alias("severity"), F.col(f"_r{i}").alias("violations"))
        for i, r in enumerate(rules)]))
    return counts.select(per_rule.alias("r"), "_total").select(
        F.lit(layer).alias("layer"), "r.rule", "r.severity", "r.violations", F.col("_total").alias("total"))


#: What must hold before a write, layer by layer: the columns the tables declare as never null.
BEFORE_WRITE = {"silver": [not_null(c) for c in ("globaleventid", "event_date", "country", "ingestion_date")],
                "gold": [not_null(c) for c in ("CNT_EVENTS", "DTE_EVENT", "NAM_COUNTRY", "DTE_INGESTION")]}


class ContractError(ValueError):
    """Rows about to be written break a contract."""


def require(df: DataFrame, layer: str) -> None:
    """DQ-8: raise if a row breaks one of the layer's rules for a write (one aggregate, one row back)."""
    broken = evaluate(df, layer, BEFORE_WRITE[layer]).where("violations > 0").collect()
    if broken:
        raise ContractError("; ".join(f"{r.layer}.{r.rule}: {r.violations} of {r.total} rows" for r in broken))


def primary_key_check(df: DataFrame, keys: list[str], stage: str) -> DataFrame:
    """DQ-6: rows, distinct keys, keys seen more than once and surplus rows.

    One group-by on the key (partial aggregation first), then a global sum.
    """
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.lit(stage).alias("stage"),
        F.sum("n").cast("bigint").alias("rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.count_if(F.col("n") > 1).alias("duplicate_keys"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n") - 1)), F.lit(0)).cast("bigint").alias("surplus_rows"),
    )


def new_key_check(new: DataFrame, others: DataFrame, key: str, stage: str) -> DataFrame:
    """DQ-6 over a stored table, for the rows that came last: the same columns as ``primary_key_check``, where a key counts
    as seen more than once if ``new`` repeats it or ``others`` (the rest of the table) holds it.

    The history is not grouped: only its key column is read, only the row groups whose range meets the new keys' (stored
    Silver is sorted by id inside its files), and only keys that a semi join finds among the new ones go on."""
    mine = new.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    lo, hi = new.agg(F.min(key), F.max(key)).first()
    met = others.where(F.col(key).between(lo, hi)).select(key).join(mine.select(key), key, "left_semi").distinct()
    marked = mine.join(met.withColumn("held", F.lit(1)), key, "left").withColumn("held", F.coalesce("held", F.lit(0)))
    first = F.col("n") + F.col("held") - 1
    return marked.agg(
        F.lit(stage).alias("stage"), F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("rows"), F.count(F.lit(1)).alias("distinct_keys"),
        F.count_if(first > 0).alias("duplicate_keys"), F.coalesce(F.sum(first), F.lit(0)).cast("bigint").alias("surplus_rows"))


def schema_conformance(df: DataFrame, layer: str, expected: T.StructType, required: list[str]) -> DataFrame:
    """DQ-1/5: per contract column: required, present, expected vs actual type, and
    how many rows hold a value (one aggregate pass over the data)."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    cols = expected.fields
    filled = df.agg(*[(F.count(f.name) if f.name in actual else F.lit(None).cast("bigint")).alias(f"_n{i}")
                      for i, f in enumerate(cols)])
    rows = F.explode(F.array(*[
        F.struct(F.lit(f.name).alias("column_name"), F.lit(f.name in required).alias("required"),
                 F.lit(f.dataType.simpleString()).alias("expected_type"),
                 F.lit(actual.get(f.name)).cast("string").alias("actual_type"),
                 F.lit(f.name in actual).alias("present"),
                 F.lit(actual.get(f.name) == f.dataType.simpleString()).alias("type_ok"),
                 F.col(f"_n{i}").alias("non_null"))
        for i, f in enumerate(cols)]))
    return filled.select(rows.alias("c")).select(F.lit(layer).alias("layer"), "c.*")


# --- Rejects (DQ-9) ------------------------------------------------------------------
REJECT_REASON_ORDER = ["missing_event_date", "missing_event_id", "missing_country", "country_not_2_chars"]


def reject_reason() -> Column:
    """First failing gate condition, in gate order; null when accepted."""
    return (F.when(F.col("event_date").isNull(), "missing_event_date")
             .when(F.col("globaleventid").isNull(), "missing_event_id")
             .when(F.col("country").isNull(), "missing_country")
             .when(F.length("country") != 2, "country_not_2_chars"))


def rejected_rows(raw: DataFrame, ingestion_date: str | None = None) -> DataFrame:
    """Quarantine frame: the as-delivered rows the gate drops, all 58 fields
    kept as text (so they can be fixed and replayed), plus the reason.

    Only the three gate inputs are typed, with the same column rules as Silver.
    ``ingestion_date`` adds the run day when ``raw`` has no such column.
    """
    checked = raw.select(
        "*",
        parse_event_date(S.POSITIONAL_NAMES[S.POS_DATE]).alias("event_date"),
        lenient_integral(S.POSITIONAL_NAMES[S.POS_ID], "bigint").alias("globaleventid"),
        country_of(S.POSITIONAL_NAMES[S.POS_GEO_COUNTRY]).alias("country"),
    )
    out = (checked.withColumn("reject_reason", reject_reason())
                  .where(F.col("reject_reason").isNotNull())
                  .drop("event_date", "globaleventid", "country"))
    if "ingestion_date" not in raw.columns:
        out = out.withColumn("ingestion_date", F.lit(ingestion_date).cast("string"))
    return out.select(*S.POSITIONAL_NAMES, "reject_reason", F.col("ingestion_date").cast("string"))


def reject_accounting(raw: DataFrame, ingestion_date: str | None, ingestion_ts: str) -> DataFrame:
    """Raw rows by outcome: each reject reason, duplicate, accepted.

    One scan, two aggregations.  Rows are first counted per (reason, day, id)
    -- rejected rows carry no key, so they collapse into one group per reason
    during map-side partial aggregation (a flood of null ids costs one buffer
    row per task), accepted rows count per (day, id).  The second aggregation
    turns groups into outcomes; outcomes add up to the raw row count.
    """
    derived = with_derived(typed_events(raw), ingestion_date, ingestion_ts).withColumn("_reason", reject_reason())
    accepted = F.col("_reason").isNull()
    per_key = (derived.groupBy("_reason", *[F.when(accepted, F.col(k)).alias(k) for k in DEDUP_KEYS])
                      .agg(F.count(F.lit(1)).alias("n")))
    per_reason = per_key.groupBy("_reason").agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("keys"))
    outcomes = F.when(F.col("_reason").isNotNull(),
                      F.array(F.struct(F.col("_reason").alias("outcome"), F.col("rows").alias("rows"))))\
                .otherwise(F.array(F.struct(F.lit("accepted").alias("outcome"), F.col("keys").alias("rows")),
                                   F.struct(F.lit("duplicate").alias("outcome"),
                                            (F.col("rows") - F.col("keys")).alias("rows"))))
    return (per_reason.select(F.explode(outcomes).alias("o"))
                      .select("o.outcome", F.col("o.rows").cast("bigint").alias("rows")))


# --- Bronze metadata (SNK-9) ------------------------------------------------------------
def bronze_metadata(landing: DataFrame, ingestion_ts: str, source_system: str = "gdelt") -> DataFrame:
    """One row per delivered file: its name and day as landed, the source system, the
    run's UTC time and the number of rows.  ``landing`` is a scan of the delivered files."""
    return (landing.select("ingestion_date", F.col("_metadata.file_name").alias("source_file"))
            .groupBy("ingestion_date", "source_file").agg(F.count(F.lit(1)).alias("rows"))
            .select(F.lit(ingestion_ts).alias("ingestion_ts"), "ingestion_date", "source_file",
                    F.lit(source_system).alias("source_system"), "rows"))


LAYER_SCHEMAS = {"bronze": (S.BRONZE_METADATA, BRONZE_METADATA), "silver": (S.SILVER, SILVER_REQUIRED),
                 "gold": (S.GOLD, GOLD_REQUIRED), "reference": (S.REFERENCE_TYPED, REFERENCE_REQUIRED)}
