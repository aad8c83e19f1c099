"""Readers and the landing adapter."""
