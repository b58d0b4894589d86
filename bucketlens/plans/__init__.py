"""Whole jobs: the usage report and the daily metrics."""
