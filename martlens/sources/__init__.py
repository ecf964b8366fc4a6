"""Typed scans, sinks and the mapping of the test tables."""
