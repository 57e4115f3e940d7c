"""Scans, sinks, schema registry and test-table roles."""
