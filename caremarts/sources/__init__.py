"""Scans: CSV extracts, seeds, the driver's test tables and fixture views."""
