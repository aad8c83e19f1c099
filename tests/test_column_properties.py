"""Column rules against plain-Python models on generated inputs."""

from decimal import Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskmart.functions.columns import RISK_LEVEL_CUTOFFS, city_of, lenient_integral, risk_level

INT_MIN, INT_MAX = -(2 ** 31), 2 ** 31 - 1
SETTINGS = settings(max_examples=15, deadline=None)


def _apply(spark, values, typ, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {typ}")
    return [r.o for r in df.select("i", expr(F.col("v")).alias("o")).orderBy("i").collect()]


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.text(alphabet=" ,aBç-", max_size=12)), min_size=1, max_size=40))
def test_city_is_first_comma_token_trimmed(spark, values):
    expected = [None if v is None else v.split(",")[0].strip(" ") for v in values]
    assert _apply(spark, values, "string", city_of) == expected


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.floats(min_value=-10, max_value=200, allow_nan=False),
                          st.sampled_from([39.99, 40.0, 59.99, 60.0, 74.99, 75.0])), min_size=1, max_size=40))
def test_risk_level_cutoffs(spark, values):
    def model(v):
        if v is None:
            return "UNKNOWN"
        for bound, label in RISK_LEVEL_CUTOFFS:
            if v >= bound:
                return label
        return "BAJO"
    assert _apply(spark, values, "double", lambda c: risk_level(c, "UNKNOWN")) == [model(v) for v in values]


integer_text = st.builds(lambda sign, digits, pad: f"{pad}{sign}{digits}{pad}",
                         st.sampled_from(["", "-", "+"]), st.from_regex(r"[0-9]{1,12}", fullmatch=True),
                         st.sampled_from(["", " ", "  "]))
decimal_text = st.builds(lambda sign, a, b: f"{sign}{a}.{b}", st.sampled_from(["", "-"]),
                         st.from_regex(r"[0-9]{1,11}", fullmatch=True), st.from_regex(r"[0-9]{1,5}", fullmatch=True))
junk_text = st.sampled_from(["x", "1e2", "", " ", "--1", "1-", "0x10", "1,5", "."])


@SETTINGS
@given(st.lists(st.one_of(st.none(), integer_text, decimal_text, junk_text), min_size=1, max_size=40))
def test_lenient_int_cast(spark, values):
    def model(v):
        if v is None or v in ("x", "1e2", "", " ", "--1", "1-", "0x10", "1,5", "."):
            return None
        n = int(Decimal(v.strip()))          # truncation toward zero
        return n if INT_MIN <= n <= INT_MAX else None
    assert _apply(spark, values, "string", lambda c: lenient_integral(c, "int")) == [model(v) for v in values]
