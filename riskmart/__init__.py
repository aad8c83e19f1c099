"""riskmart: a Spark-native geopolitical event risk engine.

Layers (all plain DataFrame functions, planned by Catalyst):

* ``sources``   – readers for the landing feed, the country-risk reference and
                  stored marts, plus the adapter that derives a landing feed
                  from the driver tables.
* ``functions`` – column expressions (ANSI-safe casts, city, weights, levels).
* ``operators`` – Silver (prepare / dedup / enrich), Gold mart, BI queries,
                  notebook analytics, profiling and data-quality checks.
* ``sinks``     – Bronze / Silver / Gold writers with idempotent replace.
* ``plans``     – whole runs (bronze → silver → gold, rerun, backfill) and the
                  query catalog with its SQL oracle.
* ``streaming`` – incremental pick-up of newly landed files.
"""

__all__ = ["__version__"]
__version__ = "0.1.0"
