"""Scans, sinks and table definitions (S)."""
