from riskmart.functions.columns import (  # noqa: F401
    RISK_LEVEL_CUTOFFS,
    city_of,
    country_of,
    lenient_double,
    lenient_integral,
    parse_event_date,
    risk_level,
    risk_weight,
)
