"""Incremental pick-up of late files."""
