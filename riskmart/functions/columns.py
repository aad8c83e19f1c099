"""Column expressions shared by every layer.

Everything here is a built-in Catalyst expression (codegen'd, no Python UDF).
Casts are ANSI-safe: malformed input becomes null and the row is judged by
the data-quality gate instead of failing the job.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's business rules).
# Conflict class -> base weight; any other class, null included -> default.
QUADCLASS_WEIGHTS = {1: 0.25, 2: 0.50, 3: 0.75, 4: 1.00}
DEFAULT_WEIGHT = 0.50
# Alert levels, highest first: (lower bound inclusive, label); below all -> BAJO.
RISK_LEVEL_CUTOFFS = [(75.0, "CRÍTICO"), (60.0, "ALTO"), (40.0, "MEDIO")]
RISK_LEVEL_FLOOR = "BAJO"
RISK_LEVEL_UNKNOWN = "UNKNOWN"
# ---------------------------------------------------------------------------

_DECIMAL_TEXT = r"^[+-]?[0-9]*[.][0-9]*$"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lenient_integral(c: str | Column, sql_type: str = "bigint") -> Column:
    """Text -> integral type, null when malformed.

    Plain integers go through ``try_cast``; decimal text such as ``5.7`` is
    truncated toward zero (the non-ANSI cast behaviour the job relied on);
    exponent forms and junk give null.
    """
    c = _col(c)
    via_decimal = (F.when(F.trim(c).rlike(_DECIMAL_TEXT),
                          c.try_cast("decimal(38,10)").try_cast(sql_type)))
    return F.coalesce(c.try_cast(sql_type), via_decimal)


def lenient_double(c: str | Column) -> Column:
    """Text -> finite double; malformed text, ``NaN`` and infinities give null like other bad cells."""
    value = _col(c).try_cast("double")
    return F.when(F.abs(value) < float("inf"), value)


def parse_event_date(c: str | Column, pattern: str = "yyyyMMdd") -> Column:
    """``yyyyMMdd`` text -> date; impossible or malformed dates -> null."""
    return F.try_to_date(_col(c), pattern)


def country_of(c: str | Column) -> Column:
    return F.upper(_col(c))


def city_of(c: str | Column) -> Column:
    """First comma-separated token of a place name, trimmed; null stays null."""
    c = _col(c)
    return F.when(c.isNotNull(), F.trim(F.substring_index(c, ",", 1)))


def risk_weight(quadclass: str | Column) -> Column:
    q = _col(quadclass)
    expr = None
    for cls, w in QUADCLASS_WEIGHTS.items():
        expr = (F.when(q == cls, F.lit(w)) if expr is None else expr.when(q == cls, F.lit(w)))
    return expr.otherwise(F.lit(DEFAULT_WEIGHT))


def risk_level(score: str | Column, null_label: str | None = None) -> Column:
    """Alert level of a score.

    ``null_label=None`` is the dashboard variant (null score falls to the
    lowest level); ``null_label="UNKNOWN"`` is the analysis variant.
    """
    s = _col(score)
    expr = F.when(s.isNull(), F.lit(null_label if null_label is not None else RISK_LEVEL_FLOOR))
    for bound, label in RISK_LEVEL_CUTOFFS:
        expr = expr.when(s >= bound, F.lit(label))
    return expr.otherwise(F.lit(RISK_LEVEL_FLOOR))


def check_ingestion_date(value: str) -> str:
    """A run's ingestion date must be ISO ``YYYY-MM-DD`` (fail fast otherwise)."""
    date.fromisoformat(value)
    if len(value) != 10:
        raise ValueError(f"ingestion date must be YYYY-MM-DD, got {value!r}")
    return value
