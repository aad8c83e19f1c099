"""Whole runs and the query catalog."""
