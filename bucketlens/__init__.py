"""Usage analytics for object-store access logs, written as Spark DataFrame jobs."""

__version__ = "0.1.0"
