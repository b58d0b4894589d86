"""Incremental jobs on newly arrived log files."""
