"""Operators: Silver, Gold, BI, analysis, profiling, quality."""
