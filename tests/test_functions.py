"""Hand-written rows for the column rules (FIXTURES.md section 5)."""

from pyspark.sql import functions as F

from conftest import raw_rows
from riskmart.functions.columns import check_ingestion_date, city_of, lenient_integral, parse_event_date, risk_level, risk_weight
from riskmart.operators import silver as SV


def _one_col(spark, values, expr, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {typ}")
    return [r[0] for r in df.select(expr(F.col("v")).alias("o")).collect()]


def test_bad_ids_and_dates_become_null(spark):
    assert _one_col(spark, ["x", "12", " 7 "], lambda c: lenient_integral(c, "bigint")) == [None, 12, 7]
    dates = ["20260230", "2026011", "202601011", "2026XX01", "20260131"]
    out = _one_col(spark, dates, parse_event_date)
    assert out[:4] == [None, None, None, None]
    assert str(out[4]) == "2026-01-31"


def test_lenient_class_cast_and_default_weight(spark):
    classes = _one_col(spark, ["5.7", " 5 ", "1e2", "x", "3"], lambda c: lenient_integral(c, "int"))
    assert classes == [5, 5, None, None, 3]
    weights = _one_col(spark, [5, 5, None, None, 3, 1, 2, 4],
                       risk_weight, "int")
    assert weights == [0.5, 0.5, 0.5, 0.5, 0.75, 0.25, 0.5, 1.0]


def test_city_first_token(spark):
    assert _one_col(spark, [", X", " Paris , F", "Mexico", None], city_of) == ["", "Paris", "Mexico", None]


def test_country_gate(spark):
    rows = [{0: str(i), 1: "20260101", 51: cc} for i, cc in enumerate(["NA", "na", "MEX", None])]
    out = SV.prepare(raw_rows(spark, rows), "2026-01-02", "2026-01-02T00:00:00Z")
    got = sorted((r.globaleventid, r.country) for r in out.collect())
    assert got == [(0, "NA"), (1, "NA")]


def test_rejects_do_not_raise_under_ansi(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    rows = [{0: "x", 1: "20260101", 51: "fr"}, {0: "1", 1: "20260230", 51: "fr"},
            {0: "2", 1: "2026011", 51: "fr"}, {0: "3", 1: "20260105", 51: "fr", 29: "1e2", 30: "abc"}]
    out = SV.prepare(raw_rows(spark, rows), "2026-01-06", "t").collect()
    assert [(r.globaleventid, r.quadclass, r.goldstein_scale) for r in out] == [(3, None, None)]


def test_risk_levels(spark):
    scores = [None, 39.99, 40.0, 60.0, 75.0]
    assert _one_col(spark, scores, lambda c: risk_level(c, "UNKNOWN"), "double") == \
        ["UNKNOWN", "BAJO", "MEDIO", "ALTO", "CRÍTICO"]
    assert _one_col(spark, scores, risk_level, "double")[0] == "BAJO"


def test_bad_run_date_fails_fast():
    import pytest
    with pytest.raises(ValueError):
        check_ingestion_date("2026-13-01")
    with pytest.raises(ValueError):
        check_ingestion_date("20260101")


def test_reference_newest_wins(spark):
    ref = spark.createDataFrame(
        [("ir", "0.70", "1.20", "2025-12-11"), ("IR", "0.85", "1.40", "2026-01-09"),
         ("fr", "0.45", "1.10", "2025-12-11"), ("MEX", "0.5", "1.1", "2026-01-09")],
        "country string, baseline_risk string, risk_multiplier string, updated_at string")
    got = {r.country: r.risk_multiplier for r in SV.reference_dimension(ref).collect()}
    assert got == {"IR": 1.4, "FR": 1.1}


def test_goldstein_null_stays_null_in_composite(spark):
    from riskmart.operators.analysis import proposed_score
    gold = spark.createDataFrame(
        [("2026-01-01", "FR", "Paris", 3, None, 50.0), ("2026-01-01", "FR", "Lyon", 1, -4.0, 40.0),
         ("2026-01-02", "MX", "Mexico", 10, 2.0, 80.0)],
        "DTE_EVENT string, NAM_COUNTRY string, NAM_CITY string, CNT_EVENTS long, "
        "NUM_GOLDSTEIN_AVG double, NUM_RISK_SCORE double")
    out = {r.NAM_CITY: r for r in proposed_score(gold).collect()}
    assert out["Paris"].CONF_NORM is None and out["Paris"].RISK_SCORE_PROPOSED is None
    assert abs(out["Lyon"].CONF_NORM - 1.0) < 1e-9 and out["Mexico"].CONF_NORM == 0.0
