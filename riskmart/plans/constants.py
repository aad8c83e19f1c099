"""Run parameters shared by the catalog and its SQL oracle.

A catalog run ingests the whole driver feed as one run on ``RUN_DATE`` with a
fixed lineage timestamp, so results are reproducible.
"""

from riskmart.sources.fixture import OLD_REFERENCE_UPDATED_AT, REFERENCE_UPDATED_AT  # noqa: F401

RUN_DATE = "2024-01-31"
RUN_TS = "2024-01-31T06:00:00Z"
REPORT_DAY = "2024-01-15"      # the one-day runbook report (FLT-4)
REDELIVERED_DAY = "2024-01-16"  # delivered a second time ...
REDELIVERY_DAY = "2024-02-20"   # ... also in this later day's folder
