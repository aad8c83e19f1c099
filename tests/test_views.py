"""Dashboard SQL through spark.sql over the Gold view agrees with the DataFrame functions."""

import math

from riskmart.operators import bi
from riskmart.plans import catalog as C
from riskmart.plans.views import register_gold


def test_dashboard_sql_on_view(spark, sf_small):
    gold = C.gold_df(spark, sf_small)
    view = register_gold(gold)
    per_day = spark.sql(f"SELECT DTE_EVENT, SUM(CNT_EVENTS) AS total_events FROM {view} "
                        "GROUP BY DTE_EVENT ORDER BY DTE_EVENT DESC").collect()
    assert per_day == bi.events_per_day(gold).collect()
    summary = spark.sql(f"SELECT COUNT(*) AS rows, COUNT(DISTINCT DTE_EVENT) AS days_loaded, "
                        f"COUNT(DISTINCT NAM_COUNTRY) AS countries, COUNT(DISTINCT NAM_CITY) AS cities "
                        f"FROM {view}").collect()
    assert summary == bi.load_summary(gold).collect()
    avg_sql = {r[0]: r[1] for r in spark.sql(
        f"SELECT NAM_COUNTRY, AVG(NUM_RISK_SCORE) AS avg_risk_score FROM {view} GROUP BY NAM_COUNTRY").collect()}
    avg_df = {r[0]: r[1] for r in bi.country_avg(gold).collect()}
    assert avg_sql.keys() == avg_df.keys()
    assert all(math.isclose(avg_sql[k], avg_df[k], rel_tol=1e-12) for k in avg_df)
