"""Scans, sinks and table registration."""
