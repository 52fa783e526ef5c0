"""Scans, listings, the load log, table specifications and writers."""
